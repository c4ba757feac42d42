"""Previous-school names."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from scolaria.sources.seeds import OTHER_SCHOOL, SCHOOL_GROUPS

# whitespace as Python strips it
_BLANKS = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0                　"


def normalize_school(raw: Column) -> Column:
    """Canonical school of a raw name: the first group with a pattern inside the name.

    One ``CASE`` expression, so it stays inside whole-stage code generation; NULL, blank and
    unmatched names fall into the catch-all group.
    """
    name = F.btrim(F.lower(raw), F.lit(_BLANKS))

    def matches(patterns: list[str]) -> Column:
        return reduce(lambda a, b: a | b, (name.contains(p) for p in patterns))

    groups = iter(SCHOOL_GROUPS.items())
    canonical, patterns = next(groups)
    case = F.when(matches(patterns), F.lit(canonical))
    for canonical, patterns in groups:
        case = case.when(matches(patterns), F.lit(canonical))
    return case.otherwise(F.lit(OTHER_SCHOOL))
