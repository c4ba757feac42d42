"""Incremental fact loads.

A load appends rows whose business key is not in the target yet; it never updates.  Parquet has no
unique constraint: run one load per target at a time, and use ``duplicate_keys`` to find copies
inside an incoming batch.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from scolaria.operators.keys import KeyLookup, not_loaded, resolve_keys, unknown_key_values
from scolaria.operators.reshape import cell_amount, detect_month_columns, filled_cells, melt, sum_tranches
from scolaria.sources.tables import Tables, extract_service_report, extract_service_report_tranche

REVENUE_TABLE = "FactStudentServiceRevenue"
TRANCHE_TABLE = "FactStudentServiceTranche"

# Warehouse columns, in warehouse order.
REVENUE_COLUMNS = [
    "StudentKey", "ServiceKey", "BranchKey", "SchoolYearKey", "DateKey", "ZoneKey", "ShuttleTypeKey",
    "SourceOid", "MonthNumber", "MonthlyAmount",
]
TRANCHE_COLUMNS = ["StudentKey", "ServiceKey", "BranchKey", "SchoolYearKey", "SourceOid", "SortOrder", "Amount"]

REVENUE_KEY = ["SourceOid", "MonthNumber"]
TRANCHE_KEY = ["SourceOid"]


def _lookups(student: str, service: str, branch: str, year: str) -> list[KeyLookup]:
    return [
        KeyLookup(student, "StudentKey", "DimStudent", "StudentOid", "StudentKey"),
        KeyLookup(service, "ServiceKey", "DimService", "ServiceOid", "ServiceKey"),
        KeyLookup(branch, "BranchKey", "DimBranch", "BranchOid", "BranchKey"),
        KeyLookup(year, "SchoolYearKey", "DimSchoolYear", "SchoolYearOid", "SchoolYearKey"),
    ]


TALL_LOOKUPS = _lookups("StudentOid", "ServiceOid", "BranchOid", "SchoolYearOid")
WIDE_LOOKUPS = _lookups("Student", "SchoolService", "Branch", "CurrentSchoolYear")


@dataclass(frozen=True)
class LoadResult:
    table: str
    inserted: int
    skipped: int


def _with_constants(rows: DataFrame, unknown: dict[str, int]) -> DataFrame:
    """The revenue source has no day, zone or shuttle: those keys are the unknown members."""
    return rows.withColumns({k: F.lit(unknown[k]) for k in ("DateKey", "ZoneKey", "ShuttleTypeKey")})


def revenue_rows_from_tall(tall: DataFrame, tables: Tables, loaded: DataFrame, unknown: dict[str, int]) -> DataFrame:
    """Fact rows of an unpivoted batch: drop loaded (report, month) pairs, resolve, project."""
    rows = resolve_keys(not_loaded(tall, loaded, *REVENUE_KEY), TALL_LOOKUPS, tables, unknown)
    return _with_constants(rows.withColumnRenamed("Amount", "MonthlyAmount"), unknown).select(*REVENUE_COLUMNS)


def revenue_rows(
    report: DataFrame, tables: Tables, loaded: DataFrame, unknown: dict[str, int], offered: Observation | None = None
) -> DataFrame:
    """The same fact rows straight from the wide report; ``offered`` observes the rows its unpivot has.

    All joins run on the wide rows, before the unpivot makes up to twelve of each.  The loaded
    months of a report travel as one bit mask, so the target is reduced to a row per report first.
    """
    months_loaded = loaded.groupBy(F.col("SourceOid").alias("_source")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1), F.col("MonthNumber").cast("int"))).alias("_loaded")
    )
    report = report.withColumnRenamed("Oid", "SourceOid")
    wide = report.join(months_loaded, F.col("SourceOid").eqNullSafe(F.col("_source")), "left").withColumn(
        "_loaded", F.coalesce("_loaded", F.lit(0))
    )
    months = detect_month_columns(report)
    if offered is not None:
        wide = wide.observe(offered, F.coalesce(F.sum(filled_cells(report, months)), F.lit(0)).alias("rows"))
    every_month = sum(1 << int(m) for m in months)
    pending = wide.where(F.col("_loaded").bitwiseAND(F.lit(every_month)) != every_month)
    keyed = _with_constants(resolve_keys(pending, WIDE_LOOKUPS, tables, unknown), unknown)
    ids = [*REVENUE_COLUMNS[:7], "SourceOid", "_loaded"]
    tall = melt(keyed, ids, months, "Month").withColumn("MonthNumber", F.col("Month").cast("int"))
    is_new = F.col("_loaded").bitwiseAND(F.call_function("shiftleft", F.lit(1), F.col("MonthNumber"))) == 0
    return (
        tall.where(is_new).withColumn("MonthlyAmount", cell_amount(tall)).where(F.col("MonthlyAmount").isNotNull()).select(*REVENUE_COLUMNS)
    )


def tranche_rows(
    raw: DataFrame, tables: Tables, loaded: DataFrame, unknown: dict[str, int], offered: Observation | None = None
) -> DataFrame:
    """Fact rows of the tranche source: drop loaded reports, resolve, sum the amounts of the row."""
    if offered is not None:
        raw = raw.observe(offered, F.count(F.lit(1)).alias("rows"))
    new = not_loaded(raw.withColumnRenamed("Oid", "SourceOid"), loaded, *TRANCHE_KEY)
    rows = sum_tranches(resolve_keys(new, WIDE_LOOKUPS, tables, unknown))
    order = F.col("Order") if "Order" in raw.columns else F.lit(0)
    return rows.withColumn("SortOrder", order).select(*TRANCHE_COLUMNS)


def append_rows(frame: DataFrame, path: str) -> int:
    """Appends to a parquet folder and returns the rows written.

    The rows are counted by the tasks that write them, so a lost executor does not count twice.
    """
    written = Observation()
    frame.observe(written, F.count(F.lit(1)).alias("rows")).write.mode("append").parquet(path)
    return written.get["rows"]


def append_jdbc(frame: DataFrame, url: str, table: str, batchsize: int = 500, **properties: str) -> None:
    """Appends to a database table in batches, one connection per partition."""
    frame.write.jdbc(url, table, mode="append", properties={**properties, "batchsize": str(batchsize)})


def loaded_keys(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Business keys in a target folder; no rows while the folder does not exist, or holds no file of a finished load."""
    types = {"SourceOid": "string", "MonthNumber": "int"}
    schema = ", ".join(f"{k} {types[k]}" for k in keys)
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def load_service_revenue(spark: SparkSession, tables: Tables, root: str) -> LoadResult:
    """Report -> FactStudentServiceRevenue under ``root``."""
    path = f"{root}/{REVENUE_TABLE}"
    report = extract_service_report(tables)
    offered = Observation() if detect_month_columns(report) else None  # without months the plan is empty, and observes nothing
    rows = revenue_rows(report, tables, loaded_keys(spark, path, REVENUE_KEY), unknown_key_values(tables), offered)
    inserted = append_rows(rows, path)
    return LoadResult(REVENUE_TABLE, inserted, (offered.get["rows"] if offered else 0) - inserted)


def load_service_tranche(spark: SparkSession, tables: Tables, root: str) -> LoadResult:
    """Tranche source -> FactStudentServiceTranche under ``root``."""
    path = f"{root}/{TRANCHE_TABLE}"
    raw = extract_service_report_tranche(tables)
    offered = Observation()
    rows = tranche_rows(raw, tables, loaded_keys(spark, path, TRANCHE_KEY), unknown_key_values(tables), offered)
    inserted = append_rows(rows, path)
    return LoadResult(TRANCHE_TABLE, inserted, offered.get["rows"] - inserted)


def load_all(spark: SparkSession, tables: Tables, root: str) -> list[LoadResult]:
    return [load_service_revenue(spark, tables, root), load_service_tranche(spark, tables, root)]
