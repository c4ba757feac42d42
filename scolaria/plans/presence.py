"""Axis 3: student and teacher attendance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scolaria.functions.rounding import mean, percent
from scolaria.operators.attendance import (
    attendance_by_date, attendance_by_student, attendance_counts, known_dates, teacher_attendance,
)
from scolaria.operators.fanout import attended_and_scored
from scolaria.operators.years import resolve_year
from scolaria.sources.tables import Tables, broadcast_if_small


def attendance_kpis(tables: Tables, school_year=None) -> DataFrame:
    """One row for students and teachers together.

    Both facts shrink to one row per person, are stacked, and meet in a single aggregation.
    """
    year = resolve_year(tables, school_year)
    students = attendance_by_student(tables, year).withColumnRenamed("StudentKey", "person")
    teachers = (
        teacher_attendance(tables, year).groupBy("TeacherKey").agg(*attendance_counts()).withColumnRenamed("TeacherKey", "person")
    )
    people = students.withColumn("role", F.lit("student")).unionByName(teachers.withColumn("role", F.lit("teacher")))
    of = lambda role, name: F.coalesce(F.sum(F.when(F.col("role") == role, F.col(name))), F.lit(0))
    sums = people.agg(
        *[of(role, c).alias(f"{role}_{c}") for role in ("student", "teacher") for c in ("records", "present", "absent", "late")],
        F.count_if(F.col("role") == "student").alias("students_tracked"),
        F.count_if(F.col("role") == "teacher").alias("teachers_tracked"),
    )
    rate = lambda role, name: percent(F.col(f"{role}_{name}"), F.col(f"{role}_records"))
    return sums.select(
        "students_tracked",
        rate("student", "present").alias("presence_rate"),
        rate("student", "absent").alias("absence_rate"),
        rate("student", "late").alias("late_rate"),
        F.col("student_records").alias("total_records"),
        "teachers_tracked",
        F.col("teacher_records").alias("teacher_sessions"),
        rate("teacher", "late").alias("teacher_late_rate"),
        rate("teacher", "present").alias("teacher_presence_rate"),
    )


def absence_by_month(tables: Tables, school_year=None) -> DataFrame:
    months = attendance_by_date(tables, resolve_year(tables, school_year)).groupBy(
        F.col("YearNumber").alias("year"), F.col("MonthNumber").alias("month"), F.col("MonthName").alias("month_name")
    )
    sums = months.agg(F.sum("records").alias("total_records"), F.sum("absent").alias("absent_count"))
    return sums.withColumn("absence_rate", percent(F.col("absent_count"), F.col("total_records"))).orderBy("year", "month", "month_name")


def teacher_sessions_by_month(tables: Tables, school_year=None) -> DataFrame:
    """Active teachers, sessions and mean checks per session and month."""
    per_day = (
        teacher_attendance(tables, resolve_year(tables, school_year))
        .groupBy("DateKey", "TeacherKey")
        .agg(F.count(F.lit(1)).alias("sessions"), F.sum("Checks").alias("checks"), F.count("Checks").alias("checked"))
    )
    months = per_day.join(broadcast_if_small(tables, "DimDate", known_dates(tables)), "DateKey").groupBy(
        F.col("MonthName").alias("month_name"), F.col("MonthNumber").alias("month"), F.col("YearNumber").alias("year")
    )
    sums = months.agg(
        F.count_distinct("TeacherKey").alias("active_teachers"),
        F.sum("sessions").alias("total_sessions"),
        F.sum("checks").alias("checks"),
        F.sum("checked").alias("checked"),
    )
    rate = mean(F.col("checks"), F.col("checked")).alias("avg_checks_per_session")
    return sums.select("month_name", "month", "year", "active_teachers", "total_sessions", rate).orderBy("year", "month", "month_name")


def top_absent_students(tables: Tables, school_year=None, top: int = 10) -> DataFrame:
    """Highest absence rates among names with 3 or more records."""
    names = tables["DimStudent"].select("StudentKey", F.col("FullNameArab").alias("student_name"))
    sums = (
        attendance_by_student(tables, resolve_year(tables, school_year))
        .join(names, "StudentKey")
        .groupBy("student_name")
        .agg(F.sum("records").alias("total_days"), F.sum("absent").alias("absent_days"))
        .where(F.col("total_days") >= 3)
    )
    rows = sums.withColumn("absence_rate", percent(F.col("absent_days"), F.col("total_days")))
    return rows.orderBy(F.desc("absence_rate"), "student_name").limit(top)


def attendance_vs_score(tables: Tables, school_year=None) -> DataFrame:
    """Absence rate and mean score per name over all (attendance, score) pairs, 3 pairs or more."""
    students = tables["DimStudent"].where(F.col("StudentOid").isNotNull()).select(
        "StudentKey", "StudentOid", F.col("FullNameArab").alias("student_name")
    )
    sums = (
        attended_and_scored(students, tables, resolve_year(tables, school_year))
        .groupBy("student_name")
        .agg(*[F.sum(c).alias(c) for c in ("pair_rows", "absent_rows", "score_rows")])
        .where(F.col("pair_rows") >= 3)
    )
    return sums.select(
        "student_name",
        percent(F.col("absent_rows"), F.col("pair_rows")).alias("absence_rate"),
        mean(F.col("score_rows"), F.col("pair_rows")).alias("avg_score"),
    )
