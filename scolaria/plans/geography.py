"""Axis 7: students by governorate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scolaria.functions.rounding import percent
from scolaria.operators.attendance import attendance_by_student
from scolaria.operators.fanout import exposed_students, exposure_rates
from scolaria.operators.years import resolve_year
from scolaria.sources.tables import Tables


def students_by_zone(tables: Tables, school_year=None) -> DataFrame:
    """Students, absence, late rate and mean score per named governorate."""
    zone = F.col("Governorate")
    students = tables["DimStudent"].where(zone.isNotNull() & (zone != "") & F.col("StudentKey").isNotNull()).select(
        "StudentKey", "StudentOid", zone.alias("zone_name")
    )
    rates = exposure_rates("zone_name", students=exposed_students(students, tables, resolve_year(tables, school_year)))
    return rates.select("zone_name", "student_count", "absence_rate", "late_rate", "avg_score").orderBy(
        F.desc("student_count"), "zone_name"
    )


def governorate_summary(tables: Tables, school_year=None) -> DataFrame:
    """Students, absence and late rate per raw governorate; NULL is reported as Unknown."""
    students = tables["DimStudent"].where(F.col("StudentOid").isNotNull()).select("StudentKey", "StudentOid", "Governorate")
    sums = (
        students.join(attendance_by_student(tables, resolve_year(tables, school_year)), "StudentKey", "left")
        .groupBy("Governorate")
        .agg(
            F.count_distinct("StudentOid").alias("student_count"),
            *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("records", "absent", "late")],
        )
    )
    return sums.select(
        F.coalesce("Governorate", F.lit("Unknown")).alias("governorate"),
        "student_count",
        percent(F.col("absent"), F.col("records")).alias("absence_rate"),
        percent(F.col("late"), F.col("records")).alias("late_rate"),
    ).orderBy(F.desc("student_count"), "governorate")


def zone_detail(tables: Tables, zone_name: str, school_year=None, top: int = 15) -> DataFrame:
    """Highest absence rates of one governorate, names with 3 or more joined attendance rows."""
    students = tables["DimStudent"].where(F.col("StudentOid").isNotNull() & (F.col("Governorate") == F.lit(zone_name)))
    students = students.select("StudentKey", "StudentOid", F.col("FullNameArab").alias("student_name"), F.col("Governorate").alias("zone_name"))
    rates = exposure_rates(
        "student_name", "zone_name", students=exposed_students(students, tables, resolve_year(tables, school_year))
    ).where(F.col("att_rows") >= 3)
    return (
        rates.select("student_name", "zone_name", "absence_rate", "late_rate", "avg_score")
        .orderBy(F.desc("absence_rate"), "student_name")
        .limit(top)
    )
