"""Reading the school tables.

Every query takes ``tables``, a mapping from table name to DataFrame.  ``ParquetTables`` serves a
warehouse folder; any dict of frames does as well (tests use that).
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scolaria.functions.parsing import number

Tables = Mapping[str, DataFrame]

# Tranche columns that are not amounts; spelling and case matter here.
TRANCHE_ID_COLUMNS = (
    "Oid", "Branch", "CreatedBy", "CurrentSchoolYear", "SchoolService", "Zone", "ShuttleType",
    "ServiceInvoiceLineOption", "Student", "Order", "SubscriptionPayed", "OptimisticLockField", "GCRecord",
)


# a frame of at most this many narrow rows (a key, an Oid, a label: some 100 bytes) may be broadcast
BROADCAST_ROWS = 100_000


class LazyTables(Mapping):
    """Frames opened on first use; remembers which of them passed the broadcast size check.

    A frame keeps the list of files it was opened with, so the remembered size holds as long as the frame: a table that
    has grown is seen, and checked again, by new tables.
    """

    def __init__(self):
        self._open: dict[str, DataFrame] = {}
        self._small: dict[str, bool] = {}

    def open(self, name: str) -> DataFrame:
        raise NotImplementedError

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._open:
            self._open[name] = self.open(name)
        return self._open[name]

    def is_small(self, name: str) -> bool:
        if name not in self._small:
            self._small[name] = has_few_rows(self[name])
        return self._small[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._open)

    def __len__(self) -> int:
        return len(self._open)


class ParquetTables(LazyTables):
    """``<root>/<table>`` parquet folders (or files named ``<table>.parquet``)."""

    def __init__(self, spark: SparkSession, root: str, suffix: str = ""):
        super().__init__()
        self.spark, self.root, self.suffix = spark, root.rstrip("/"), suffix

    def open(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}{self.suffix}")


def has_few_rows(frame: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether the frame has at most ``rows`` rows.

    A plain count: parquet answers it from file footers, task by task, whereas a limit would send up
    to ``rows`` rows of every partition to one task.
    """
    return frame.count() <= rows


def broadcast_if_small(tables: Tables, name: str, narrow: DataFrame) -> DataFrame:
    """``narrow``, derived from the table ``name`` without adding rows, as a broadcast side where the
    row count of the table allows it.  Beyond that Spark joins by shuffle and splits hot partitions.

    A dimension with few members (years, branches, services) must not be shuffle-joined: its few
    keys would put a fact into as few partitions.
    """
    small = tables.is_small(name) if isinstance(tables, LazyTables) else has_few_rows(tables[name])
    return F.broadcast(narrow) if small else narrow


def quoted(name: str) -> str:
    """A column name safe in expressions, whatever blanks or brackets it holds."""
    return "`" + name.replace("`", "``") + "`"


def extract_table(tables: Tables, name: str, where: str = "1=1") -> DataFrame:
    """All columns of a table under a predicate; Catalyst pushes the predicate into the scan."""
    return tables[name].where(where)


def extract_service_report(tables: Tables) -> DataFrame:
    """Monthly revenue source without its soft-deleted rows."""
    return tables["StudentServiceReport"].where(F.col("GCRecord").isNull())


def extract_service_report_tranche(tables: Tables) -> DataFrame:
    """Tranche source with every non-identifier column as double; text that is no number is NULL."""
    source = tables["StudentServiceReportTranche"]
    return source.select(
        *[
            F.col(quoted(f.name)) if f.name in TRANCHE_ID_COLUMNS else number(F.col(quoted(f.name)), f.dataType).alias(f.name)
            for f in source.schema.fields
        ]
    )


def extract_dim_keys(tables: Tables, dim: str, oid_col: str, key_col: str) -> DataFrame:
    """Natural key and surrogate key of a dimension; nothing else is read."""
    return tables[dim].select(oid_col, key_col)


def extract_date_keys(tables: Tables) -> DataFrame:
    """Calendar date to DateKey."""
    return tables["DimDate"].select("DateKey", F.col("FullDate").cast("date").alias("FullDate"))


def jdbc_table(
    spark: SparkSession, url: str, table: str, predicates: list[str] | None = None, **properties: str
) -> DataFrame:
    """A database table; each predicate becomes one read partition."""
    if predicates:
        return spark.read.jdbc(url, table, predicates=predicates, properties=properties)
    return spark.read.jdbc(url, table, properties=properties)
