"""Academic calendar: tagging days and measuring the days around holidays."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scolaria.sources.seeds import CALENDAR, DEFAULT_YEAR_LABEL, NORMAL_LABEL, NORMAL_TYPE, calendar_frame

# Fixed value: days looked at on each side of a holiday.
HOLIDAY_MARGIN = 5


def period_days(spark: SparkSession, year_label: str | None) -> DataFrame:
    """(day, period_type, period_label): one row per calendar day, its first period in list order.

    A label without a calendar uses the default year.
    """
    label = year_label if year_label in CALENDAR else DEFAULT_YEAR_LABEL
    days = calendar_frame(spark, label).select(
        "ordinal", "type", "label", F.explode(F.sequence("start", "end")).alias("day")
    )
    first = F.min_by(F.struct("type", "label"), "ordinal")
    return days.groupBy("day").agg(first.alias("p")).select(
        "day", F.col("p.type").alias("period_type"), F.col("p.label").alias("period_label")
    )


def tag_periods(frame: DataFrame, date_col: str, year_label: str | None) -> DataFrame:
    """Adds period_type and period_label; days outside every period, NULL and unreadable dates are
    normal.  An equi join on the expanded days, so no range comparison per row."""
    day = F.col(date_col)
    if dict(frame.dtypes)[date_col] == "string":
        day = F.substring(day, 1, 10).try_cast("date")
    else:
        day = day.cast("date")
    days = period_days(frame.sparkSession, year_label)
    return (
        frame.withColumn("_day", day)
        .join(days, F.col("_day") == F.col("day"), "left")
        .withColumn("period_type", F.coalesce("period_type", F.lit(NORMAL_TYPE)))
        .withColumn("period_label", F.coalesce("period_label", F.lit(NORMAL_LABEL)))
        .drop("_day", "day")
    )


def holiday_neighbours(spark: SparkSession, year_label: str | None) -> DataFrame:
    """(ordinal, label, start, end, side, day): the days before and after each holiday of a year;
    no rows for a label without a calendar."""
    holidays = calendar_frame(spark, year_label).where(F.col("type") == "holiday") if year_label in CALENDAR else (
        calendar_frame(spark).limit(0)
    )
    offsets = F.sequence(F.lit(1), F.lit(HOLIDAY_MARGIN))
    return (
        holidays.withColumn("i", F.explode(offsets))
        .select(
            "ordinal",
            "label",
            "start",
            "end",
            F.inline(
                F.array(
                    F.struct(F.lit("pre").alias("side"), F.date_sub("start", F.col("i")).alias("day")),
                    F.struct(F.lit("post").alias("side"), F.date_add("end", F.col("i")).alias("day")),
                )
            ),
        )
    )
