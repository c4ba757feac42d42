"""Wide billing tables to tall ones."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scolaria.functions.parsing import comma_decimal, number, rounded
from scolaria.sources.tables import quoted

# Month columns.
MONTH_COLUMNS = [str(month) for month in range(1, 13)]

# Identifier columns of the wide tables and their tall names.
OID_NAMES = {
    "Oid": "SourceOid",
    "Student": "StudentOid",
    "SchoolService": "ServiceOid",
    "Branch": "BranchOid",
    "CurrentSchoolYear": "SchoolYearOid",
    "Zone": "ZoneOid",
    "ShuttleType": "ShuttleTypeOid",
}
REVENUE_IDS = ["Oid", "Student", "SchoolService", "Branch", "CurrentSchoolYear"]
TRANCHE_IDS = [*REVENUE_IDS, "Zone", "ShuttleType"]

# Patterns of tranche column names, matched from the start, in any case.
TRANCHE_PATTERNS = [r"^TR\d+$", r"^Tranche[\s_]?\d+", r"^Tranche_\d+_\d{2}_\d{2}$"]

# Columns never summed into a tranche amount, in lower case.
NON_AMOUNT_COLUMNS = {
    "oid", "branch", "createdby", "currentschoolyear", "schoolservice", "zone", "shuttletype",
    "serviceinvoicelineoption", "student", "order", "subscriptionpayed", "optimisticlockfield", "gcrecord",
    "sourceoid", "studentkey", "servicekey", "branchkey", "schoolyearkey",
}
BALANCE_SUFFIX = "_solde"


def detect_month_columns(frame: DataFrame) -> list[str]:
    """Month columns present, in month order; reads the schema only."""
    return [m for m in MONTH_COLUMNS if m in frame.columns]


def detect_tranche_columns(frame: DataFrame, exclude_balances: bool = False) -> dict[str, int]:
    """Tranche column -> slice number, the first run of digits in its name; reads the schema only.

    Several columns may share a slice.  A balance column such as ``Tranche_1_solde`` matches too
    unless excluded.
    """
    names = [c for c in frame.columns if not (exclude_balances and c.lower().endswith(BALANCE_SUFFIX))]
    is_tranche = re.compile("|".join(TRANCHE_PATTERNS), re.IGNORECASE).match
    return {c: int(re.search(r"\d+", c).group()) for c in names if is_tranche(c)}


def detect_amount_columns(frame: DataFrame) -> list[str]:
    """Numeric columns that are neither identifiers nor balances; reads the schema only."""
    return [
        f.name
        for f in frame.schema.fields
        if isinstance(f.dataType, T.NumericType)
        and f.name.lower() not in NON_AMOUNT_COLUMNS
        and not f.name.lower().endswith(BALANCE_SUFFIX)
    ]


def melt(frame: DataFrame, ids: list[str], values: list[str], name: str) -> DataFrame:
    """Identifiers, column name and value of every non-NULL cell; a narrow step.

    Cells are doubles where all value columns are numeric, else text.  No value columns give no rows.
    """
    if not values:
        nothing = F.lit(None).cast("string")
        return frame.select(*[F.col(quoted(c)).alias(c) for c in ids], nothing.alias(name), nothing.alias("Cell")).where(F.lit(False))
    kinds = {c: frame.schema[c].dataType for c in values}
    numeric = all(isinstance(kind, T.NumericType) for kind in kinds.values())
    cell = lambda c: number(F.col(quoted(c)), kinds[c]) if numeric else F.col(quoted(c)).cast("string")
    wide = frame.select(*[F.col(quoted(c)).alias(c) for c in ids], *[cell(c).alias(c) for c in values])
    tall = wide.unpivot([quoted(c) for c in ids], [quoted(c) for c in values], name, "Cell")
    return tall.where(F.col("Cell").isNotNull())


def cell_amount(tall: DataFrame) -> Column:
    """The cell of a melted frame as an amount with two decimals, NULL for text that is no number."""
    cell = F.col("Cell")
    return comma_decimal(cell) if isinstance(tall.schema["Cell"].dataType, T.StringType) else rounded(cell)


def filled_cells(frame: DataFrame, values: list[str]) -> Column:
    """How many of the row's cells ``melt`` and ``cell_amount`` turn into an amount."""
    kinds = {c: frame.schema[c].dataType for c in values}
    numeric = all(isinstance(kind, T.NumericType) for kind in kinds.values())
    amount = lambda c: rounded(number(F.col(quoted(c)), kinds[c])) if numeric else comma_decimal(F.col(quoted(c)).cast("string"))
    return reduce(lambda a, b: a + b, [amount(c).isNotNull().cast("bigint") for c in values], F.lit(0).cast("bigint"))


def _renamed(ids: list[str]) -> list[Column]:
    return [F.col(c).alias(OID_NAMES[c]) for c in ids]


def _no_rows(frame: DataFrame, ids: list[str], number: str) -> DataFrame:
    return frame.select(
        *_renamed(ids), F.lit(None).cast("int").alias(number), F.lit(None).cast("double").alias("Amount")
    ).limit(0)


def unpivot_service_revenue(frame: DataFrame) -> DataFrame:
    """One row per report and charged month: SourceOid, StudentOid, ServiceOid, BranchOid,
    SchoolYearOid, MonthNumber, Amount.  Cells that are no number are dropped."""
    ids = [c for c in REVENUE_IDS if c in frame.columns]
    months = detect_month_columns(frame)
    if not months:
        return _no_rows(frame, ids, "MonthNumber")
    tall = melt(frame, ids, months, "Month")
    number_of = F.col("Month").cast("int").alias("MonthNumber")
    return tall.select(*_renamed(ids), number_of, cell_amount(tall).alias("Amount")).where(F.col("Amount").isNotNull())


def unpivot_service_tranche(frame: DataFrame, exclude_balances: bool = False) -> DataFrame:
    """One row per source row and paid tranche: the identifiers, SliceNumber, Amount."""
    ids = [c for c in TRANCHE_IDS if c in frame.columns]
    slices = detect_tranche_columns(frame, exclude_balances)
    if not slices:
        return _no_rows(frame, ids, "SliceNumber")
    lookup = F.create_map(*[F.lit(v) for pair in slices.items() for v in pair])
    tall = melt(frame, ids, list(slices), "TrancheName")
    number_of = lookup[F.col("TrancheName")].alias("SliceNumber")
    return tall.select(*_renamed(ids), number_of, cell_amount(tall).alias("Amount")).where(F.col("Amount").isNotNull())


def revenue_cast_report(frame: DataFrame) -> DataFrame:
    """Per month column: filled cells, cells read as a number, cells that the unpivot drops."""
    cells = melt(frame, [], detect_month_columns(frame), "Month")
    return (
        cells.groupBy(F.col("Month").cast("int").alias("MonthNumber"))
        .agg(F.count("Cell").alias("filled"), F.count(cell_amount(cells)).alias("read"))
        .withColumn("dropped", F.col("filled") - F.col("read"))
    )


def tranche_cast_report(frame: DataFrame, exclude_balances: bool = False) -> DataFrame:
    """The same per tranche column."""
    cells = melt(frame, [], list(detect_tranche_columns(frame, exclude_balances)), "TrancheName")
    return (
        cells.groupBy("TrancheName")
        .agg(F.count("Cell").alias("filled"), F.count(cell_amount(cells)).alias("read"))
        .withColumn("dropped", F.col("filled") - F.col("read"))
    )


def row_sum(frame: DataFrame, columns: list[str]) -> Column:
    """Sum across numeric columns; NULL cells count 0, so a row of NULLs gives 0.0."""
    cells = [F.coalesce(number(F.col(quoted(c)), frame.schema[c].dataType), F.lit(0.0)) for c in columns]
    return reduce(lambda a, b: a + b, cells, F.lit(0.0))


def sum_tranches(frame: DataFrame) -> DataFrame:
    """Adds Amount, the sum of all tranche amounts of the row."""
    return frame.withColumn("Amount", row_sum(frame, detect_amount_columns(frame)))
