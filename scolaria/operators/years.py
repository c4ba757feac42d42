"""School-year parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scolaria.sources.seeds import DEFAULT_YEAR_LABEL
from scolaria.sources.tables import Tables


def _year_row(tables: Tables, key: str, column: str):
    return tables["DimSchoolYear"].where(F.col("SchoolYearKey") == int(key)).select(column).first()


def resolve_year(tables: Tables, school_year: str | int | None) -> str | None:
    """The school-year Oid a request means, or None for no filter.

    Digits are a SchoolYearKey (an unknown key means no filter), other text already is the Oid.
    One scalar is read, so that the filter reaches the fact scan as a literal.
    """
    if school_year is None or school_year == "":
        return None
    text = str(school_year)
    if not text.isdigit():
        return text
    row = _year_row(tables, text, "SchoolYearOid")
    return row[0] if row and row[0] else None


def year_label(tables: Tables, school_year: str | int | None) -> str | None:
    """Label such as ``2024-2025``; the default unless a known SchoolYearKey is given."""
    text = "" if school_year is None else str(school_year)
    if text.isdigit():
        row = _year_row(tables, text, "Description")
        if row:
            return row[0]
    return DEFAULT_YEAR_LABEL


def in_year(frame: DataFrame, year_oid: str | None) -> DataFrame:
    """Rows of one school year; no filter for None."""
    return frame if year_oid is None else frame.where(F.col("SchoolYearPeriodOid") == F.lit(year_oid))


def known_years(tables: Tables) -> DataFrame:
    return tables["DimSchoolYear"].where(F.col("SchoolYearKey") != 1)
