"""Attendance times evaluations per student, without building the product.

The reported rates weight every attendance row by the number of evaluation rows of its student and
the other way round.  Both sides are summed per student first; the weights become factors:

* left joins: ``A = max(attendance rows, 1)``, ``M = max(evaluation rows, 1)``
* inner joins: students with both, weighted by the plain row counts
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scolaria.functions.rounding import mean, percent
from scolaria.operators.attendance import attendance_by_student
from scolaria.operators.scores import scores_by, student_exposure
from scolaria.sources.tables import Tables


def _weighted(total, weight):
    return total * weight.cast("decimal(18,0)")


def _product(rows, weight):
    """Row counts multiplied as decimals: two hot sides of one student exceed a bigint."""
    return rows.cast("decimal(19,0)") * weight.cast("decimal(19,0)")


def exposed_students(students: DataFrame, tables: Tables, year_oid: str | None = None) -> DataFrame:
    """Students left-joined to both sides, with the weighted sums of the product.

    Assumes StudentKey and StudentOid identify a student, as in the dimension.
    """
    joined = students.join(attendance_by_student(tables), "StudentKey", "left").join(
        student_exposure(tables, year_oid), "StudentOid", "left"
    )
    zero = F.lit(0)
    att_weight = F.greatest(F.coalesce("records", zero), F.lit(1))
    eval_weight = F.greatest(F.coalesce("joined", zero), F.lit(1))
    return joined.select(
        *students.columns,
        _product(F.coalesce("records", zero), eval_weight).alias("att_rows"),
        _product(F.coalesce("absent", zero), eval_weight).alias("absent_rows"),
        _product(F.coalesce("late", zero), eval_weight).alias("late_rows"),
        _product(F.coalesce("n", zero), att_weight).alias("eval_rows"),
        _product(F.coalesce("passed", zero), att_weight).alias("passed_rows"),
        _weighted(F.col("total"), att_weight).alias("score_rows"),
    )


def exposure_rates(*keys: str, students: DataFrame) -> DataFrame:
    """Rates and row counts of ``exposed_students`` per group."""
    sums = students.groupBy(*keys).agg(
        F.count("StudentKey").alias("student_count"),
        F.sum("att_rows").alias("att_rows"),
        F.sum("absent_rows").alias("absent_rows"),
        F.sum("late_rows").alias("late_rows"),
        F.sum("eval_rows").alias("eval_rows"),
        F.sum("passed_rows").alias("passed_rows"),
        F.sum("score_rows").alias("score_rows"),
    )
    return sums.select(
        *keys,
        "student_count",
        "att_rows",
        "eval_rows",
        percent(F.col("absent_rows"), F.col("att_rows")).alias("absence_rate"),
        percent(F.col("late_rows"), F.col("att_rows")).alias("late_rate"),
        mean(F.col("score_rows"), F.col("eval_rows")).alias("avg_score"),
        percent(F.col("passed_rows"), F.col("eval_rows")).alias("pass_rate"),
    )


def attended_and_scored(students: DataFrame, tables: Tables, year_oid: str | None = None) -> DataFrame:
    """Students with attendance and scores (inner joins), with the weighted sums of the product."""
    scores = scores_by(tables, "StudentOid", year_oid=year_oid).select("StudentOid", "n", "total")
    joined = students.join(attendance_by_student(tables), "StudentKey").join(scores, "StudentOid")
    n, records = F.col("n"), F.col("records")
    return joined.select(
        *students.columns,
        _product(records, n).alias("pair_rows"),
        _product(F.col("absent"), n).alias("absent_rows"),
        _weighted(F.col("total"), records).alias("score_rows"),
    )
