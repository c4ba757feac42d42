"""Attendance, reduced before it is joined."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scolaria.functions.rounding import percent
from scolaria.operators.years import in_year
from scolaria.sources.tables import Tables


def attendance_counts() -> list[Column]:
    """Rows, presences (Checks > 0), absences (Checks = 0) and late arrivals of a group."""
    return [
        F.count(F.lit(1)).alias("records"),
        F.count_if(F.col("Checks") > 0).alias("present"),
        F.count_if(F.col("Checks") == 0).alias("absent"),
        F.count_if(F.col("LateMinutes") > 0).alias("late"),
    ]


def student_attendance(tables: Tables, year_oid: str | None = None) -> DataFrame:
    """Attendance rows of a known student; the unknown member 1 counts as known here."""
    return in_year(tables["FactStudentAttendance"], year_oid).where(F.col("StudentKey").isNotNull())


def attendance_by_student(tables: Tables, year_oid: str | None = None) -> DataFrame:
    return student_attendance(tables, year_oid).groupBy("StudentKey").agg(*attendance_counts())


def teacher_attendance(tables: Tables, year_oid: str | None = None) -> DataFrame:
    return in_year(tables["FactTeacherAttendance"], year_oid).where(F.col("TeacherKey") != 1)


def known_dates(tables: Tables) -> DataFrame:
    return tables["DimDate"].where(F.col("DateKey") != -1)


def attendance_by_date(tables: Tables, year_oid: str | None = None) -> DataFrame:
    """Counts per day with the columns of DimDate.  The fact shrinks to one row per day and task
    before the shuffle, and only those rows meet the date dimension."""
    per_day = student_attendance(tables, year_oid).groupBy("DateKey").agg(*attendance_counts())
    return per_day.join(known_dates(tables), "DateKey")


def daily_absence(tables: Tables, year_oid: str | None = None) -> DataFrame:
    """(full_date, records, absent, absence_rate) of every dated day."""
    return (
        attendance_by_date(tables, year_oid)
        .where(F.col("FullDate").isNotNull())
        .select(
            F.col("FullDate").cast("date").alias("full_date"),
            "records",
            "absent",
            percent(F.col("absent"), F.col("records")).alias("absence_rate"),
        )
    )
