"""Axis 6: composite risk scores and early warnings.

Only scores follow the school year; attendance and payments are all-time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scolaria.functions.rounding import half_up, percent, ratio, share, snap, sum_exact
from scolaria.operators.attendance import attendance_by_student
from scolaria.operators.scores import scores_by
from scolaria.operators.years import resolve_year
from scolaria.sources.tables import Tables

# Weights, level limits and warning limits.
SCORE_TARGET, SCORE_WEIGHT, ABSENCE_WEIGHT, FAIL_WEIGHT = 10, 4.0, 0.35, 0.25
HIGH_FROM, MEDIUM_FROM = 60, 35
LEVELS = ["High", "Medium", "Low"]
LOW_SCORE, HIGH_ABSENCE, HIGH_FAIL_RATE, MIN_WARNINGS = 10, 20, 50, 2


def risk(avg_score: Column, absence: Column, fail_rate: Column) -> Column:
    shortfall = F.when(avg_score < SCORE_TARGET, (SCORE_TARGET - avg_score) * SCORE_WEIGHT).otherwise(F.lit(0.0))
    return shortfall + absence * ABSENCE_WEIGHT + fail_rate * FAIL_WEIGHT


def risk_level(score: Column) -> Column:
    """Level of an unrounded risk; snapping keeps binary noise from moving a score off a limit."""
    exact = snap(score)
    return F.when(exact >= HIGH_FROM, "High").when(exact >= MEDIUM_FROM, "Medium").otherwise("Low")


def _students(tables: Tables) -> DataFrame:
    return tables["DimStudent"].where(F.col("StudentOid").isNotNull()).select(
        "StudentKey", "StudentOid", F.col("FullNameArab").alias("student_name")
    )


def _attended_and_paid(tables: Tables) -> DataFrame:
    """Attendance and payments of every StudentOid, all its keys together.

    Both facts are reduced to one row per StudentKey before they meet the dimension, so a hot student
    costs one row per task; what is added up per Oid are rows of the dimension.
    """
    payments = tables["FactStudentPayment"].where(F.col("StudentKey").isNotNull()).groupBy("StudentKey").agg(
        F.count(F.lit(1)).alias("payment_count")
    )
    attendance = attendance_by_student(tables).select("StudentKey", "records", "absent")
    by_key = _students(tables).select("StudentKey", "StudentOid").join(attendance, "StudentKey", "left").join(payments, "StudentKey", "left")
    return by_key.groupBy("StudentOid").agg(
        F.min("StudentKey").alias("first_key"), *[F.sum(c).alias(c) for c in ("records", "absent", "payment_count")]
    )


def _academic(tables: Tables, school_year) -> DataFrame:
    """One row per StudentOid with scores, with what it attended and paid if the dimension has it."""
    scores = scores_by(tables, "StudentOid", year_oid=resolve_year(tables, school_year)).select("StudentOid", "n", "total", "failed")
    return scores.join(_attended_and_paid(tables), "StudentOid", "left")


def _exact_inputs() -> list[Column]:
    return [
        ratio(F.col("total"), F.col("n")).alias("avg_raw"),
        F.coalesce(share(F.col("absent"), F.col("records")), F.lit(0.0)).alias("absence_raw"),
        share(F.col("failed"), F.col("n")).alias("fail_raw"),
    ]


def _shown_inputs() -> list[Column]:
    return [
        half_up(ratio(F.col("total"), F.col("n")), 2).alias("avg_score"),
        F.coalesce(percent(F.col("absent"), F.col("records")), F.lit(0.0)).alias("absence_rate"),
        percent(F.col("failed"), F.col("n")).alias("fail_rate_pct"),
    ]


def _shown_risk() -> Column:
    return risk(F.col("avg_score"), F.col("absence_rate"), F.col("fail_rate_pct"))


def _exact_risk() -> Column:
    return risk(F.col("avg_raw"), F.col("absence_raw"), F.col("fail_raw"))


def _flags() -> dict[str, Column]:
    flag = lambda condition: condition.cast("int")
    return {
        "flag_low_score": flag(F.col("avg_raw") < LOW_SCORE),
        "flag_high_absence": flag(F.col("absence_raw") > HIGH_ABSENCE),
        "flag_high_fail_rate": flag(F.col("fail_raw") > HIGH_FAIL_RATE),
    }


def _warnings() -> Column:
    return F.col("flag_low_score") + F.col("flag_high_absence") + F.col("flag_high_fail_rate")


def scored_students(tables: Tables, school_year=None) -> DataFrame:
    """Risk of every student with scores, unsorted; inputs are rounded before they are weighted."""
    rows = _academic(tables, school_year).join(_students(tables), "StudentOid").select(
        "StudentOid", "student_name", *_shown_inputs(), F.coalesce("payment_count", F.lit(0)).alias("payment_count")
    )
    return rows.withColumns({"risk_score": half_up(_shown_risk(), 1), "risk_level": risk_level(_shown_risk())})


def assessed_students(tables: Tables, school_year=None) -> DataFrame:
    """Every scored StudentOid once per name it has: what the list, the levels and the warnings say of it.

    risk_level is that of the distribution, risk_score that of the list. ``known`` tells whether the
    dimension has the student, ``first`` is true for one row of an Oid. The scores are read once.
    """
    rows = _academic(tables, school_year).join(_students(tables), "StudentOid", "left").select(
        "StudentOid",
        "student_name",
        F.col("StudentKey").isNotNull().alias("known"),
        F.col("StudentKey").eqNullSafe(F.col("first_key")).alias("first"),
        *_shown_inputs(),
        *_exact_inputs(),
    )
    rows = rows.withColumns({"risk_score": half_up(_shown_risk(), 1), "risk_level": risk_level(_exact_risk()), **_flags()})
    return rows.select("StudentOid", "student_name", "known", "first", "risk_score", "risk_level", _warnings().alias("warning_count"))


def risk_scores(tables: Tables, school_year=None, top: int = 30) -> DataFrame:
    rows = scored_students(tables, school_year)
    return rows.orderBy(F.desc("risk_score"), "student_name", "StudentOid").limit(top).drop("StudentOid")


def risk_distribution(tables: Tables, school_year=None) -> DataFrame:
    """Students, mean score and mean absence per level, the level taken on unrounded inputs."""
    rows = _academic(tables, school_year).select(*_exact_inputs()).withColumn("risk_level", risk_level(_exact_risk()))
    sums = rows.groupBy("risk_level").agg(
        F.count(F.lit(1)).alias("student_count"), sum_exact(F.col("avg_raw")).alias("scores"), sum_exact(F.col("absence_raw")).alias("absences")
    )
    rank = F.array_position(F.array(*[F.lit(v) for v in LEVELS]), F.col("risk_level"))
    return sums.select(
        "risk_level",
        "student_count",
        half_up(ratio(F.col("scores"), F.col("student_count")), 2).alias("avg_score"),
        half_up(ratio(F.col("absences"), F.col("student_count")), 1).alias("avg_absence_rate"),
    ).orderBy(rank)


def early_warnings(tables: Tables, school_year=None, top: int = 20) -> DataFrame:
    """Students with two or more of: low score, high absence, high fail rate."""
    rows = _academic(tables, school_year).join(_students(tables), "StudentOid").select("StudentOid", "student_name", *_exact_inputs())
    rows = rows.withColumns(_flags()).withColumn("warning_count", _warnings()).where(F.col("warning_count") >= MIN_WARNINGS)
    return (
        rows.orderBy(F.desc("warning_count"), "avg_raw", "student_name", "StudentOid")
        .limit(top)
        .select(
            "student_name",
            half_up(F.col("avg_raw"), 2).alias("avg_score"),
            half_up(F.col("absence_raw"), 1).alias("absence_rate"),
            half_up(F.col("fail_raw"), 1).alias("fail_rate_pct"),
            "flag_low_score",
            "flag_high_absence",
            "flag_high_fail_rate",
            "warning_count",
        )
    )
