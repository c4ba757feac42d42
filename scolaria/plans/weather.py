"""Axis 4: weather and absence."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scolaria.functions.rounding import half_even, mean_of_rates, percent
from scolaria.operators.attendance import attendance_by_date, daily_absence
from scolaria.operators.years import resolve_year
from scolaria.sources.tables import Tables
from scolaria.sources.weather import weather_days


def days_with_weather(tables: Tables, school_year=None) -> DataFrame:
    """Daily absence with the weather of the day; a day the archive lacks is dry."""
    daily = daily_absence(tables, resolve_year(tables, school_year))
    return (
        daily.join(weather_days(tables["WeatherDaily"]), "full_date", "left")
        .withColumn("precipitation_mm", F.coalesce("precipitation_mm", F.lit(0.0)))
        .withColumn("is_rainy", F.coalesce("is_rainy", F.lit(False)))
    )


def weather_vs_absence(tables: Tables, school_year=None) -> DataFrame:
    rows = days_with_weather(tables, school_year).select(
        F.date_format("full_date", "yyyy-MM-dd").alias("full_date"),
        F.col("records").alias("total"),
        F.col("absent").alias("absent_count"),
        "absence_rate",
        "precipitation_mm",
        "is_rainy",
    )
    return rows.orderBy("full_date")


def rainy_vs_dry(tables: Tables, school_year=None) -> DataFrame:
    """One row: unweighted mean of the daily rates and number of days, rainy and dry."""
    rainy = F.col("is_rainy")
    return days_with_weather(tables, school_year).agg(
        mean_of_rates(F.when(rainy, F.col("absence_rate"))).alias("rainy_avg"),
        F.count_if(rainy).alias("n_rainy"),
        mean_of_rates(F.when(~rainy, F.col("absence_rate"))).alias("dry_avg"),
        F.count_if(~rainy).alias("n_dry"),
    )


def seasonal_patterns(tables: Tables, school_year=None) -> DataFrame:
    """Absence and mean rain per calendar month, all years pooled.

    Rain counts on every archive day between the first and the last attendance day.  That span is
    taken over the month rows (twelve at most), so the attendance fact is read once.
    """
    months = (
        attendance_by_date(tables, resolve_year(tables, school_year))
        .where(F.col("FullDate").isNotNull())
        .groupBy(F.col("MonthNumber").alias("month"), F.col("MonthName").alias("month_name"))
        .agg(
            F.sum("records").alias("records"),
            F.sum("absent").alias("absent"),
            F.min("FullDate").cast("date").alias("first_day"),
            F.max("FullDate").cast("date").alias("last_day"),
        )
    )
    everything = Window.partitionBy()
    months = months.withColumn("span_start", F.min("first_day").over(everything)).withColumn(
        "span_end", F.max("last_day").over(everything)
    )
    rain = weather_days(tables["WeatherDaily"]).withColumn("rain_month", F.month("full_date"))
    in_span = (F.col("month") == F.col("rain_month")) & F.col("full_date").between(F.col("span_start"), F.col("span_end"))
    mm = F.col("precipitation_mm").cast("decimal(18,6)")
    joined = months.join(rain, in_span, "left").groupBy("month", "month_name", "records", "absent", "first_day", "last_day")
    means = joined.agg(F.try_divide(F.sum(mm).cast("double"), F.count(mm).cast("double")).alias("mm"))
    return means.select(
        "month",
        "month_name",
        percent(F.col("absent"), F.col("records")).alias("absence_rate"),
        F.date_format("first_day", "yyyy-MM-dd").alias("sample_start"),
        F.date_format("last_day", "yyyy-MM-dd").alias("sample_end"),
        F.coalesce(half_even(F.col("mm"), 1), F.lit(0.0)).alias("avg_precipitation"),
    ).orderBy("month", "month_name")
