"""Surrogate keys and the filters of incremental loads."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scolaria.sources.tables import Tables, broadcast_if_small

# Natural key of the unknown student, key used where a dimension has no unknown row.
UNKNOWN_GUID = "00000000-0000-0000-0000-000000000000"
NO_KEY = -1

# Dimension, its key, the column and value that mark its unknown row.
UNKNOWN_ROWS = [
    ("DimBranch", "BranchKey", "Code", "UNKNOWN"),
    ("DimStudent", "StudentKey", "StudentOid", UNKNOWN_GUID),
    ("DimService", "ServiceKey", "Code", "UNKNOWN"),
    ("DimSchoolYear", "SchoolYearKey", "Code", "UNKNOWN"),
    ("DimZone", "ZoneKey", "Code", "UNKNOWN"),
    ("DimShuttleType", "ShuttleTypeKey", "Code", "UNKNOWN"),
    ("DimDate", "DateKey", "DateKey", -1),
]


@dataclass(frozen=True)
class KeyLookup:
    """Where the surrogate key of a natural key column comes from."""

    oid_col: str
    key_col: str
    dim: str
    dim_oid: str
    dim_key: str


NO_SUCH_TABLE = {"PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND"}


def _find(tables: Tables, name: str) -> DataFrame | None:
    """The table, or None where there is no such table. Any other fault is raised: a passing one must not become a key."""
    try:
        return tables[name]
    except KeyError:
        return None
    except AnalysisException as fault:
        if fault.getCondition() not in NO_SUCH_TABLE:
            raise
        return None


def unknown_keys(tables: Tables) -> DataFrame:
    """One row, one column per dimension: the key of its unknown row, or -1.

    The lookups are stacked and folded into one row by a single aggregation.
    """
    found = []
    for name, key, marker, value in UNKNOWN_ROWS:
        dim = _find(tables, name)
        if dim is not None and key in dim.columns and marker in dim.columns:
            rows = dim.where(F.col(marker) == F.lit(value))
            found.append(rows.select(F.lit(key).alias("name"), F.col(key).cast("bigint").alias("key")))
    if not found:
        raise ValueError("no dimension table found")
    stacked = reduce(DataFrame.unionAll, found)
    return stacked.agg(
        *[
            F.coalesce(F.min(F.when(F.col("name") == key, F.col("key"))), F.lit(NO_KEY)).alias(key)
            for _, key, _, _ in UNKNOWN_ROWS
        ]
    )


def unknown_key_values(tables: Tables) -> dict[str, int]:
    """The same row as numbers: seven scalars, used as literals in the load plans."""
    return unknown_keys(tables).first().asDict()


def resolve_keys(frame: DataFrame, lookups: list[KeyLookup], tables: Tables, unknown: dict[str, int]) -> DataFrame:
    """Adds the surrogate key of every natural key; NULL and unmatched ones get the unknown key.

    A natural key held twice by a dimension takes its largest surrogate key.  Natural keys are GUIDs, so
    case does not count (the warehouse's collation ignores it too).  Null-safe joins for the
    reason given at ``_same_key``: a student with a third of the rows is split over many tasks.
    """
    for lookup in lookups:
        oid = F.lower(F.col(lookup.dim_oid).cast("string"))
        dim = tables[lookup.dim].where(oid.isNotNull()).groupBy(oid.alias("_oid")).agg(F.max(lookup.dim_key).alias("_key"))
        dim = broadcast_if_small(tables, lookup.dim, dim)
        fallback = F.lit(unknown.get(lookup.key_col, NO_KEY))
        frame = (
            frame.join(dim, F.lower(F.col(lookup.oid_col).cast("string")).eqNullSafe(F.col("_oid")), "left")
            .withColumn(lookup.key_col, F.coalesce("_key", fallback))
            .drop("_oid", "_key")
        )
    return frame


def _loaded_once(loaded: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    return loaded.select(*[F.col(k).alias(f"_{k}") for k in keys]).distinct()


def _same_key(keys: tuple[str, ...]) -> Column:
    """NULL keys equal each other.

    A null-safe join also shuffles its grouped side anew.  That matters: adaptive execution splits a
    hot partition only where both join sides come straight from a shuffle, not from an aggregation.
    """
    return reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys))


def not_loaded(incoming: DataFrame, loaded: DataFrame, *keys: str) -> DataFrame:
    """Incoming rows whose key is not loaded yet."""
    return incoming.join(_loaded_once(loaded, keys), _same_key(keys), "left_anti")


def load_counts(incoming: DataFrame, loaded: DataFrame, *keys: str) -> DataFrame:
    """(inserted, skipped) a load of ``incoming`` gives."""
    seen = _loaded_once(loaded, keys).withColumn("_seen", F.lit(True))
    marked = incoming.join(seen, _same_key(keys), "left").select("_seen")
    return marked.agg(
        F.count_if(F.col("_seen").isNull()).alias("inserted"), F.count_if(F.col("_seen").isNotNull()).alias("skipped")
    )


def duplicate_keys(frame: DataFrame, *keys: str) -> DataFrame:
    """Keys held by more than one row, with their row count; loads do not remove them."""
    return frame.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)


# Columns that the queries take to identify a row of their dimension.
UNIQUE_KEYS = [("DimStudent", "StudentKey"), ("DimStudent", "StudentOid"), ("DimEvaluationReport", "EvaluationReportKey")]


def dimension_key_copies(tables: Tables) -> DataFrame:
    """table, key, values held by more than one row: all 0 where the queries' assumption holds. NULL keys don't count."""

    def one(table: str, key: str) -> DataFrame:
        twice = duplicate_keys(tables[table].where(F.col(key).isNotNull()), key)
        return twice.agg(F.count(F.lit(1)).alias("held_twice")).select(F.lit(table).alias("table"), F.lit(key).alias("key"), "held_twice")

    return reduce(DataFrame.unionAll, [one(table, key) for table, key in UNIQUE_KEYS])
