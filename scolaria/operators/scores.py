"""Evaluation scores, reduced before they are joined.

``FactStudentEvaluation`` is the largest table.  It carries only report and subject keys, so all
queries without a subject first reduce it to one row per report: the partial aggregation runs
before the shuffle, a report that holds a third of all rows costs one row per task, and the join
with the equally large ``DimEvaluationReport`` is one to one.  Reports have one student, hence
everything else is a sum of report rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scolaria.operators.years import in_year
from scolaria.sources.tables import Tables

# Fixed value: pass mark.
PASS_MARK = 10


def scored(tables: Tables) -> DataFrame:
    """Evaluations with a score; a score stored as floating point becomes a decimal."""
    facts = tables["FactStudentEvaluation"].where(F.col("Average").isNotNull())
    if isinstance(facts.schema["Average"].dataType, T.DecimalType):
        return facts
    return facts.withColumn("Average", F.col("Average").cast("decimal(9,4)"))


def score_moments() -> list[Column]:
    """Mergeable aggregates of the raw score; Catalyst drops those a query does not use."""
    score = F.col("Average")
    return [
        F.count(score).alias("n"),
        F.sum(score).alias("total"),
        F.sum(score * score).alias("squares"),
        F.count_if(score >= PASS_MARK).alias("passed"),
        F.count_if(score < PASS_MARK).alias("failed"),
        F.min(score).alias("lowest"),
        F.max(score).alias("highest"),
    ]


def merge_moments() -> list[Column]:
    """The same aggregates over rows that already hold them."""
    return [
        F.sum("n").alias("n"),
        F.sum("total").alias("total"),
        F.sum("squares").alias("squares"),
        F.sum("passed").alias("passed"),
        F.sum("failed").alias("failed"),
        F.min("lowest").alias("lowest"),
        F.max("highest").alias("highest"),
    ]


def report_scores(tables: Tables) -> DataFrame:
    """One row of moments per report."""
    return scored(tables).groupBy("EvaluationReportKey").agg(*score_moments())


def student_reports(tables: Tables, year_oid: str | None = None) -> DataFrame:
    """(EvaluationReportKey, StudentOid, SchoolYearPeriodOid) of reports that belong to a student."""
    reports = tables["DimEvaluationReport"].where(F.col("StudentOid").isNotNull())
    return in_year(reports, year_oid).select("EvaluationReportKey", "StudentOid", "SchoolYearPeriodOid")


def scored_reports(tables: Tables, year_oid: str | None = None) -> DataFrame:
    """Reports with at least one score, their owner and their moments."""
    return student_reports(tables, year_oid).join(report_scores(tables), "EvaluationReportKey")


def scores_by(tables: Tables, *keys: str, year_oid: str | None = None) -> DataFrame:
    """Moments per ``StudentOid`` and/or ``SchoolYearPeriodOid``."""
    return scored_reports(tables, year_oid).groupBy(*keys).agg(*merge_moments())


def subject_rows(tables: Tables, year_oid: str | None = None) -> DataFrame:
    """Single scores with their report: input of queries that end in few groups per subject.

    One shuffle on the report key; the row-level join is split by adaptive execution where a report
    is hot, and the aggregation that follows combines before it shuffles.
    """
    facts = scored(tables).select("EvaluationReportKey", "ContentKey", "Average")
    return facts.join(student_reports(tables, year_oid), "EvaluationReportKey")


def student_exposure(tables: Tables, year_oid: str | None = None) -> DataFrame:
    """Per student: ``joined`` rows of reports left-joined to scores (a report without scores is one
    row), and the moments of the scores."""
    reports = student_reports(tables, year_oid).join(report_scores(tables), "EvaluationReportKey", "left")
    rows = F.greatest(F.coalesce(F.col("n"), F.lit(0)), F.lit(1))
    return reports.groupBy("StudentOid").agg(
        F.sum(rows).alias("joined"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        F.sum("total").alias("total"),
        F.coalesce(F.sum("passed"), F.lit(0)).alias("passed"),
    )


def known_subjects(tables: Tables) -> DataFrame:
    """(ContentKey, subject) without the unknown member."""
    return tables["DimContent"].where(F.col("ContentKey") != 1).select("ContentKey", F.col("Description").alias("subject"))
