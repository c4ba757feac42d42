"""Daily precipitation from archive documents with parallel arrays."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DOCUMENT = "daily struct<time: array<string>, precipitation_sum: array<double>>"

# Fixed value: a day is rainy above this many millimetres.
RAINY_MM = 1.0


def zip_days(documents: DataFrame) -> DataFrame:
    """(full_date, precipitation_sum): the n-th date belongs to the n-th value.

    Documents may overlap; a day keeps one value, its largest.
    """
    pairs = documents.select(F.inline(F.arrays_zip("daily.time", "daily.precipitation_sum")))
    return (
        pairs.toDF("time", "precipitation_sum")
        .withColumn("full_date", F.to_date("time"))
        .groupBy("full_date")
        .agg(F.max("precipitation_sum").alias("precipitation_sum"))
    )


def read_weather(spark: SparkSession, path: str) -> DataFrame:
    """Archive files, one JSON document each; a missing path raises."""
    return zip_days(spark.read.schema(DOCUMENT).json(path, multiLine=True))


def parse_weather(texts: DataFrame, column: str = "document") -> DataFrame:
    """Archive documents held as text in a column."""
    return zip_days(texts.select(F.from_json(column, DOCUMENT).alias("d")).select("d.daily"))


def weather_days(daily: DataFrame) -> DataFrame:
    """(full_date, precipitation_mm, is_rainy); a missing measure counts as 0 mm."""
    mm = F.coalesce(F.col("precipitation_sum").cast("double"), F.lit(0.0))
    return daily.select(
        F.col("full_date").cast("date").alias("full_date"),
        mm.alias("precipitation_mm"),
        (mm > RAINY_MM).alias("is_rainy"),
    )
