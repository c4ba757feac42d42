"""Axis 8: absence around holidays and exams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scolaria.functions.rounding import mean_of_rates
from scolaria.operators.attendance import daily_absence
from scolaria.operators.periods import holiday_neighbours, tag_periods
from scolaria.operators.years import resolve_year, year_label
from scolaria.sources.seeds import period_type_frame
from scolaria.sources.tables import Tables


def _tagged_days(tables: Tables, school_year) -> DataFrame:
    daily = daily_absence(tables, resolve_year(tables, school_year))
    return tag_periods(daily, "full_date", year_label(tables, school_year))


def period_absence(tables: Tables, school_year=None) -> DataFrame:
    """``absence_by_period`` with the ordinal of the period type, unsorted."""
    rates = _tagged_days(tables, school_year).groupBy("period_type").agg(
        mean_of_rates(F.col("absence_rate")).alias("rate"), F.count(F.lit(1)).alias("days")
    )
    types = period_type_frame(rates.sparkSession)
    return types.join(rates, "period_type", "left").select(
        "ordinal",
        "period_type",
        "period_label",
        F.coalesce("rate", F.lit(0.0)).alias("avg_absence_rate"),
        F.coalesce("days", F.lit(0)).alias("n_days"),
    )


def absence_by_period(tables: Tables, school_year=None) -> DataFrame:
    """Mean daily absence of the five reported period types; holidays themselves are left out."""
    return period_absence(tables, school_year).orderBy("ordinal").drop("ordinal")


def daily_absence_tagged(tables: Tables, school_year=None) -> DataFrame:
    return (
        _tagged_days(tables, school_year)
        .select(
            F.date_format("full_date", "yyyy-MM-dd").alias("full_date"),
            "absence_rate",
            F.col("records").alias("total_records"),
            "period_type",
            "period_label",
        )
        .orderBy("full_date")
    )


def holiday_impact(tables: Tables, school_year=None) -> DataFrame:
    """Mean daily absence on the five days before and after each holiday of the year."""
    daily = daily_absence(tables, resolve_year(tables, school_year))
    around = holiday_neighbours(daily.sparkSession, year_label(tables, school_year))
    rate_of = lambda side: mean_of_rates(F.when(F.col("side") == side, F.col("absence_rate")))
    return (
        around.join(daily, F.col("day") == F.col("full_date"), "left")
        .groupBy("ordinal", "label", "start", "end")
        .agg(rate_of("pre").alias("pre_avg_absence"), rate_of("post").alias("post_avg_absence"))
        .orderBy("ordinal")
        .select(
            F.col("label").alias("holiday_label"),
            F.date_format("start", "yyyy-MM-dd").alias("start"),
            F.date_format("end", "yyyy-MM-dd").alias("end"),
            "pre_avg_absence",
            "post_avg_absence",
        )
    )
