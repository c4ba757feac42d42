"""School-year list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scolaria.operators.years import known_years
from scolaria.sources.tables import Tables


def school_years(tables: Tables, as_of=None) -> DataFrame:
    """Known school years; IsCurrent tells whether ``as_of`` (now by default) lies in the year."""
    now = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    current = now.between(F.col("StartDate").cast("timestamp"), F.col("EndDate").cast("timestamp"))
    return known_years(tables).select(
        "SchoolYearKey",
        "SchoolYearOid",
        F.col("Description").alias("YearLabel"),
        F.coalesce(current, F.lit(False)).alias("IsCurrent"),
    ).orderBy("SchoolYearKey")
