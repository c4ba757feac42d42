"""Axis 2: progression over school years."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scolaria.functions.rounding import half_up, mean, ratio, snap, stddev_from_moments
from scolaria.operators.scores import merge_moments, scored_reports, scores_by
from scolaria.operators.years import known_years
from scolaria.plans.performance import avg_score, subject_totals
from scolaria.sources.tables import Tables, broadcast_if_small

# Fixed value: change of the mean that counts as a trend.
TREND_DELTA = 2


def _years(tables: Tables) -> DataFrame:
    years = known_years(tables).select(
        "SchoolYearKey", F.col("SchoolYearOid").alias("SchoolYearPeriodOid"), F.col("Description").alias("year_label")
    )
    return broadcast_if_small(tables, "DimSchoolYear", years)


def _names(tables: Tables, *more: str) -> DataFrame:
    return tables["DimStudent"].where(F.col("StudentOid").isNotNull()).select(
        "StudentOid", F.col("FullNameArab").alias("student_name"), *more
    )


def student_years(tables: Tables, student_oid: str | None = None) -> DataFrame:
    """Mean score per student name and school year, unsorted."""
    reports = scored_reports(tables)
    if student_oid:
        reports = reports.where(F.col("StudentOid") == F.lit(student_oid))
    per_year = reports.groupBy("StudentOid", "SchoolYearPeriodOid").agg(*merge_moments())
    return (
        per_year.join(_names(tables), "StudentOid")
        .join(_years(tables), "SchoolYearPeriodOid")
        .groupBy("year_label", "SchoolYearKey", "student_name")
        .agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
        .select("year_label", "SchoolYearKey", "student_name", avg_score(), F.col("n").alias("n_evals"))
    )


def progression_by_student(tables: Tables, student_oid: str | None = None) -> DataFrame:
    """``student_years`` by year; the name as second key spreads the sort over many partitions."""
    return student_years(tables, student_oid).orderBy("SchoolYearKey", "student_name")


def year_over_year_by_subject(tables: Tables) -> DataFrame:
    rows = subject_totals(tables, None, "SchoolYearPeriodOid").join(_years(tables), "SchoolYearPeriodOid")
    return (
        rows.groupBy("year_label", "SchoolYearKey", "subject")
        .agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
        .select("year_label", "SchoolYearKey", "subject", avg_score())
        .orderBy("SchoolYearKey", "subject")
    )


def stability(tables: Tables) -> DataFrame:
    """Spread of the scores of every name with 2 or more years and 5 or more scores, unsorted."""
    per_year = scores_by(tables, "StudentOid", "SchoolYearPeriodOid")
    by_name = (
        per_year.join(_names(tables), "StudentOid")
        .groupBy("student_name")
        .agg(F.count_distinct("SchoolYearPeriodOid").alias("years_active"), *merge_moments())
        .where((F.col("years_active") >= 2) & (F.col("n") >= 5))
    )
    return by_name.select(
        "student_name",
        "years_active",
        avg_score(),
        half_up((F.col("highest") - F.col("lowest")).cast("double"), 2).alias("score_range"),
        half_up(stddev_from_moments(F.col("n"), F.col("total"), F.col("squares")), 2).alias("score_stddev"),
    )


def stability_index(tables: Tables, top: int = 20) -> DataFrame:
    return stability(tables).orderBy("score_stddev", "student_name").limit(top)


def _trend(total: Column, n: Column, latest: Column) -> dict[str, Column]:
    """Rounded figures and label of a student's year sums; latest is a struct (total, n)."""
    hist, last = ratio(total, n), ratio(latest["total"], latest["n"])
    change = snap(last - hist)
    return {
        "historical_avg": half_up(hist, 2),
        "latest_avg": half_up(last, 2),
        "delta": half_up(last - hist, 2),
        "trend_label": F.when(change < -TREND_DELTA, "Regression").when(change > TREND_DELTA, "Improvement").otherwise("Stable"),
    }


def trends(tables: Tables, chronological: bool = False) -> DataFrame:
    """Mean of all years, mean of the latest year and their difference per student, unsorted.

    "Latest" is the greatest school-year Oid; ``chronological`` takes the latest StartDate instead.
    Year sums are computed once and serve both means.
    """
    per_year = scores_by(tables, "StudentOid", "SchoolYearPeriodOid")
    rank = F.col("SchoolYearPeriodOid")
    if chronological:
        starts = tables["DimSchoolYear"].select(F.col("SchoolYearOid").alias("SchoolYearPeriodOid"), "StartDate")
        starts = broadcast_if_small(tables, "DimSchoolYear", starts)
        per_year, rank = per_year.join(starts, "SchoolYearPeriodOid", "left"), F.col("StartDate")
    year = F.struct(rank.alias("rank"), F.col("SchoolYearPeriodOid").alias("oid"), "total", "n")
    per_student = (
        per_year.groupBy("StudentOid")
        .agg(F.sum("total").alias("total"), F.sum("n").alias("n"), F.max(year).alias("latest"))
        .where(F.col("latest.rank").isNotNull())
    )
    figures = [value.alias(name) for name, value in _trend(F.col("total"), F.col("n"), F.col("latest")).items()]
    return per_student.join(_names(tables), "StudentOid").select("StudentOid", "student_name", *figures)


def standings(tables: Tables) -> DataFrame:
    """Trends, stability and years at once: the scores are read a single time for all of them.

    The moments of a (student, year) stand for three groups: their student (a key of the dimension),
    their name and their year label. They are merged by that expanded key, in the tasks before the
    shuffle first. Columns: part ('student', 'name' or 'year'), StudentKey, StudentOid, student_name,
    year_label (those of the part's key, else NULL), delta and trend_label of a student, score_stddev
    of a name as in ``stability``.
    """
    rows = (
        scores_by(tables, "StudentOid", "SchoolYearPeriodOid")
        .join(_names(tables, "StudentKey"), "StudentOid")
        .join(_years(tables), "SchoolYearPeriodOid", "left")
    )
    key = ["part", "StudentKey", "StudentOid", "student_name", "year_label"]
    held = {"student": key[1:4], "name": key[3:4], "year": key[4:]}
    groups = [
        F.struct(F.lit(part).alias("part"), *[(F.col(c) if c in columns else F.lit(None).cast(rows.schema[c].dataType)).alias(c) for c in key[1:]])
        for part, columns in held.items()
    ]
    moments = ["SchoolYearPeriodOid", "n", "total", "squares"]
    latest = F.max(F.struct(F.col("SchoolYearPeriodOid").alias("oid"), "total", "n"))
    merged = (
        rows.select(F.explode(F.array(*groups)).alias("group"), *moments)
        .select("group.*", *moments)
        .where((F.col("part") != "year") | F.col("year_label").isNotNull())
        .groupBy(*key)
        .agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.sum("squares").alias("squares"),
             F.size(F.collect_set("SchoolYearPeriodOid")).alias("years_active"), latest.alias("latest"))
    )
    trend = _trend(F.col("total"), F.col("n"), F.col("latest"))
    of_student = (F.col("part") == "student") & F.col("latest.oid").isNotNull()
    of_name = (F.col("part") == "name") & (F.col("years_active") >= 2) & (F.col("n") >= 5)
    spread = half_up(stddev_from_moments(F.col("n"), F.col("total"), F.col("squares")), 2)
    return merged.where(of_student | of_name | (F.col("part") == "year")).select(
        *key,
        F.when(of_student, trend["delta"]).alias("delta"),
        F.when(of_student, trend["trend_label"]).alias("trend_label"),
        F.when(of_name, spread).alias("score_stddev"),
    )


def regression_detection(tables: Tables, top: int = 15, chronological: bool = False) -> DataFrame:
    return trends(tables, chronological).orderBy("delta", "student_name", "StudentOid").limit(top).drop("StudentOid")


def semester_comparison(tables: Tables) -> DataFrame:
    """Mean score of every report, and its students: one, unless the dimension holds a report twice."""
    return (
        scored_reports(tables)
        .where(F.col("EvaluationReportKey") != 1)
        .join(_years(tables), "SchoolYearPeriodOid")
        .groupBy("EvaluationReportKey", "year_label")
        .agg(F.sum("total").alias("total"), F.sum("n").alias("n"), F.count_distinct("StudentOid").alias("student_count"))
        .select(
            "EvaluationReportKey",
            "year_label",
            F.col("EvaluationReportKey").cast("string").alias("report_name"),
            mean(F.col("total"), F.col("n")).alias("avg_score"),
            "student_count",
        )
        .orderBy("year_label", "EvaluationReportKey")
        .drop("EvaluationReportKey")
    )
