"""Axis 5: evaluation reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scolaria.functions.rounding import half_up, mean, percent, stddev_from_moments
from scolaria.operators.attendance import attendance_by_student
from scolaria.operators.scores import (
    known_subjects, report_scores, score_moments, scored, scored_reports, student_reports,
)
from scolaria.operators.years import known_years, resolve_year
from scolaria.plans.performance import avg_score, pass_rate
from scolaria.sources.tables import Tables, broadcast_if_small


def score_stddev() -> Column:
    return half_up(stddev_from_moments(F.col("n"), F.col("total"), F.col("squares")), 2).alias("score_stddev")


def report_name() -> Column:
    return F.col("EvaluationReportKey").cast("string").alias("report_name")


def known_report() -> Column:
    return F.col("EvaluationReportKey") != 1


def report_outcomes(tables: Tables, school_year=None, subject: str | None = None) -> DataFrame:
    """Results per report, subject and year, unsorted.

    Subjects are joined first, so a chosen subject cuts the fact before it is shuffled; a subject table
    too large to broadcast meets it in a join that adaptive execution splits.  The report join comes
    last and its partitioning serves the grouping.
    """
    subjects = known_subjects(tables)
    if subject:
        subjects = subjects.where(F.col("subject") == F.lit(subject))
    subjects = broadcast_if_small(tables, "DimContent", subjects)
    facts = scored(tables).where(known_report()).select("EvaluationReportKey", "ContentKey", "Average")
    years = known_years(tables).select(F.col("SchoolYearOid").alias("SchoolYearPeriodOid"), F.col("Description").alias("year_label"))
    years = broadcast_if_small(tables, "DimSchoolYear", years)
    reports = student_reports(tables, resolve_year(tables, school_year)).join(years, "SchoolYearPeriodOid")
    return (
        facts.join(subjects, "ContentKey")
        .join(reports.select("EvaluationReportKey", "StudentOid", "year_label"), "EvaluationReportKey")
        .groupBy("EvaluationReportKey", "subject", "year_label")
        .agg(*score_moments(), F.count_distinct("StudentOid").alias("student_count"))
        .select(
            "EvaluationReportKey",
            report_name(),
            "subject",
            "year_label",
            avg_score(),
            score_stddev(),
            "student_count",
            pass_rate(),
        )
    )


def outcomes_by_report(tables: Tables, school_year=None, subject: str | None = None) -> DataFrame:
    rows = report_outcomes(tables, school_year, subject).orderBy("year_label", "EvaluationReportKey", "subject")
    return rows.drop("EvaluationReportKey")


def report_dispersion(tables: Tables, school_year=None) -> DataFrame:
    """Spread of the scores of each report, unsorted."""
    rows = scored_reports(tables, resolve_year(tables, school_year)).where(known_report())
    return rows.select(
        "EvaluationReportKey",
        report_name(),
        half_up(F.col("lowest").cast("double"), 2).alias("score_min"),
        half_up(F.col("highest").cast("double"), 2).alias("score_max"),
        mean(F.col("total"), F.col("n")).alias("score_avg"),
        score_stddev(),
        "n",
    )


def dispersion_by_report(tables: Tables, school_year=None) -> DataFrame:
    return report_dispersion(tables, school_year).orderBy("EvaluationReportKey").drop("EvaluationReportKey")


def subject_list(tables: Tables) -> DataFrame:
    return known_subjects(tables).select("subject").distinct().orderBy("subject")


def presence_performance(tables: Tables, school_year=None) -> DataFrame:
    """Mean score of each report and presence rate of its student.

    Every score of a report meets the same attendance rows, so the product changes neither figure.
    """
    reports = student_reports(tables, resolve_year(tables, school_year)).where(known_report())
    scores = reports.join(report_scores(tables), "EvaluationReportKey").select("EvaluationReportKey", "StudentOid", "n", "total")
    students = tables["DimStudent"].where(F.col("StudentOid").isNotNull()).select("StudentKey", "StudentOid")
    attendance = students.join(attendance_by_student(tables), "StudentKey").select("StudentOid", "records", "present")
    return (
        scores.join(attendance, "StudentOid", "left")
        .select(
            "EvaluationReportKey", report_name(), avg_score(), percent(F.col("present"), F.col("records")).alias("presence_rate")
        )
        .orderBy("EvaluationReportKey")
        .drop("EvaluationReportKey")
    )
