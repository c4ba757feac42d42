"""Axis 9: previous school and performance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scolaria.functions.rounding import half_even, mean, percent, ratio
from scolaria.functions.schools import normalize_school
from scolaria.operators.fanout import exposed_students, exposure_rates
from scolaria.operators.scores import scores_by
from scolaria.operators.years import resolve_year
from scolaria.sources.tables import Tables


def _students(tables: Tables) -> DataFrame:
    """Students who named a previous school."""
    school = F.col("BacType")
    return tables["DimStudent"].where(F.col("StudentOid").isNotNull() & school.isNotNull() & (school != "")).select(
        "StudentKey", "StudentOid", F.col("FullNameArab").alias("student_name"), school.alias("raw_school")
    )


def _weighted_mean(rate: str, digits: int) -> Column:
    """Mean of the rates of the raw names, weighted by their students; NULL rates do not weigh in."""
    weight = F.col("student_count")
    total = F.sum(F.col(rate).cast("decimal(12,2)") * weight.cast("decimal(18,0)"))
    return half_even(ratio(total, F.sum(F.when(F.col(rate).isNotNull(), weight))), digits).alias(rate)


def _by_canonical(raw: DataFrame):
    return raw.groupBy(normalize_school(F.col("raw_school")).alias("school_name"))


def performance_by_school(tables: Tables, school_year=None) -> DataFrame:
    students = exposed_students(_students(tables), tables, resolve_year(tables, school_year))
    rows = _by_canonical(exposure_rates("raw_school", students=students)).agg(
        F.sum("student_count").alias("student_count"),
        _weighted_mean("avg_score", 2),
        _weighted_mean("pass_rate", 1),
        _weighted_mean("absence_rate", 1),
    )
    return rows.orderBy(F.desc("student_count"), "school_name")


def school_ranking(tables: Tables, school_year=None) -> DataFrame:
    """Schools by mean score: raw names with 3 or more students, schools with 5 or more."""
    scores = scores_by(tables, "StudentOid", year_oid=resolve_year(tables, school_year)).select("StudentOid", "n", "total", "passed")
    raw = (
        _students(tables)
        .join(scores, "StudentOid", "left")
        .groupBy("raw_school")
        .agg(F.count("StudentKey").alias("student_count"), *[F.sum(c).alias(c) for c in ("n", "total", "passed")])
        .where(F.col("student_count") >= 3)
        .select(
            "raw_school",
            "student_count",
            mean(F.col("total"), F.col("n")).alias("avg_score"),
            percent(F.col("passed"), F.col("n")).alias("pass_rate"),
        )
    )
    rows = _by_canonical(raw).agg(
        F.sum("student_count").alias("student_count"), _weighted_mean("avg_score", 2), _weighted_mean("pass_rate", 1)
    )
    return rows.where(F.col("student_count") >= 5).orderBy(F.coalesce("avg_score", F.lit(0.0)).desc(), "school_name")


def school_list(tables: Tables) -> DataFrame:
    """Canonical schools with one raw spelling each, the first in text order."""
    names = _students(tables).select("raw_school").distinct()
    rows = names.groupBy(normalize_school(F.col("raw_school")).alias("canonical")).agg(F.min("raw_school").alias("sample_raw"))
    return rows.orderBy("canonical")


def students_from_school(tables: Tables, school_name: str, school_year=None) -> DataFrame:
    """Students of one canonical school with 2 or more joined scores; the school is chosen before
    the joins, since it depends on the grouping column alone."""
    students = _students(tables).where(normalize_school(F.col("raw_school")) == F.lit(school_name))
    rates = exposure_rates(
        "student_name", "raw_school", students=exposed_students(students, tables, resolve_year(tables, school_year))
    ).where(F.col("eval_rows") >= 2)
    return rates.select(
        "student_name", F.col("raw_school").alias("prev_school"), "avg_score", "absence_rate", "pass_rate"
    ).orderBy(F.desc("avg_score"), "student_name", "prev_school")
