"""Axis 1: academic performance overview."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scolaria.functions.rounding import mean, percent
from scolaria.operators.scores import PASS_MARK, known_subjects, merge_moments, scored, scores_by, student_reports, subject_rows
from scolaria.operators.years import known_years, resolve_year
from scolaria.sources.tables import Tables

# Score bins, by exclusive upper bound; the last one is open.
SCORE_BINS = [(2, "0-2"), (4, "2-4"), (6, "4-6"), (8, "6-8"), (10, "8-10"), (12, "10-12"), (14, "12-14"), (16, "14-16"), (18, "16-18")]
LAST_BIN = "18-20"


def avg_score() -> Column:
    return mean(F.col("total"), F.col("n")).alias("avg_score")


def pass_rate() -> Column:
    return percent(F.col("passed"), F.col("n")).alias("pass_rate")


def performance_kpis(tables: Tables, school_year=None) -> DataFrame:
    """One row: students, mean, pass and fail rate, best and worst score."""
    students = scores_by(tables, "StudentOid", year_oid=resolve_year(tables, school_year))
    return students.agg(F.count(F.lit(1)).alias("total_students"), *merge_moments()).select(
        "total_students",
        avg_score(),
        pass_rate(),
        percent(F.col("failed"), F.col("n")).alias("fail_rate"),
        F.col("highest").cast("double").alias("max_score"),
        F.col("lowest").cast("double").alias("min_score"),
    )


def subject_totals(tables: Tables, school_year=None, *more_keys: str) -> DataFrame:
    """(subject, n, total, passed, failed), optionally split further by a report column.

    Grouped by subject key first, so the subject dimension meets a few aggregated rows only.
    """
    score = F.col("Average")
    by_key = (
        subject_rows(tables, resolve_year(tables, school_year))
        .groupBy("ContentKey", *more_keys)
        .agg(
            F.count(score).alias("n"),
            F.sum(score).alias("total"),
            F.count_if(score >= PASS_MARK).alias("passed"),
            F.count_if(score < PASS_MARK).alias("failed"),
        )
    )
    return (
        by_key.join(known_subjects(tables), "ContentKey")
        .groupBy("subject", *more_keys)
        .agg(*[F.sum(c).alias(c) for c in ("n", "total", "passed", "failed")])
    )


def average_by_subject(tables: Tables, school_year=None) -> DataFrame:
    rows = subject_totals(tables, school_year).select(
        "subject",
        avg_score(),
        F.col("n").alias("n_evaluations"),
        pass_rate(),
        F.col("passed").alias("pass_count"),
        F.col("failed").alias("fail_count"),
    )
    return rows.orderBy(F.desc("avg_score"), "subject")


def score_distribution(tables: Tables, school_year=None) -> DataFrame:
    """Scores per bin of width 2, lowest first; bins without scores are absent.

    Each report carries ten counters through the join, the bins become rows at the very end.
    """
    bins = [(i, label, upper) for i, (upper, label) in enumerate(SCORE_BINS)] + [(len(SCORE_BINS), LAST_BIN, None)]
    score = F.col("Average")
    bin_no = F.lit(len(SCORE_BINS))
    for i, (upper, _) in reversed(list(enumerate(SCORE_BINS))):
        bin_no = F.when(score < upper, F.lit(i)).otherwise(bin_no)
    counters = [F.count_if(F.col("bin_no") == i).alias(f"b{i}") for i, _, _ in bins]
    per_report = scored(tables).withColumn("bin_no", bin_no).groupBy("EvaluationReportKey").agg(*counters)
    totals = (
        student_reports(tables, resolve_year(tables, school_year))
        .join(per_report, "EvaluationReportKey")
        .agg(*[F.coalesce(F.sum(f"b{i}"), F.lit(0)).alias(f"b{i}") for i, _, _ in bins])
    )
    rows = F.array(
        *[F.struct(F.lit(i).alias("i"), F.lit(label).alias("bin"), F.col(f"b{i}").alias("count")) for i, label, _ in bins]
    )
    return totals.select(F.inline(rows)).where(F.col("count") > 0).orderBy("i").drop("i")


def average_by_school_year(tables: Tables) -> DataFrame:
    per_student = scores_by(tables, "StudentOid", "SchoolYearPeriodOid")
    per_year = per_student.groupBy("SchoolYearPeriodOid").agg(F.count(F.lit(1)).alias("student_count"), *merge_moments())
    years = known_years(tables).select("SchoolYearKey", "SchoolYearOid", F.col("Description").alias("year_label"))
    return (
        per_year.join(years, F.col("SchoolYearPeriodOid") == F.col("SchoolYearOid"))
        .select("year_label", "SchoolYearKey", avg_score(), pass_rate(), "student_count")
        .orderBy("SchoolYearKey")
    )


def pass_fail_by_subject(tables: Tables, school_year=None, top: int = 12) -> DataFrame:
    rows = subject_totals(tables, school_year).select(
        "subject", F.col("passed").alias("pass_count"), F.col("failed").alias("fail_count"), F.col("n").alias("total")
    )
    return rows.orderBy(F.desc("total"), "subject").limit(top)
