import datetime as dt
import os
import sys
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from scolaria.session import build_session  # noqa: E402

TESTDATA = os.environ.get("TESTDATA_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    conf = {"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g"}
    conf["spark.checkpoint.dir"] = f"file://{tmp_path_factory.mktemp('shared')}"
    session = build_session("scolaria-tests", "local[4]", **conf)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def sf_dir():
    if not os.path.isdir(TESTDATA):
        pytest.skip("no test tables")
    return TESTDATA


def rows(frame):
    return [tuple(r) for r in frame.collect()]


def by_key(frame):
    """First column -> the other columns."""
    return {r[0]: tuple(r)[1:] for r in frame.collect()}


@pytest.fixture(scope="session")
def school(spark):
    """Seven students with every edge of the fan-out: no attendance, no scores, a report without
    scores, NULL scores, homonyms, blank and NULL governorates and schools."""
    day = dt.date
    score = lambda v: None if v is None else Decimal(str(v))
    students = [
        (1, "u", "UNKNOWN", None, None),
        (2, "s2", "Amina", "Sousse", "SLS 1"),
        (3, "s3", "Amina", "Sousse", "SLS 1"),
        (4, "s4", "Bilel", "Sousse", "HS1"),
        (5, "s5", "Chiraz", "Monastir", " hs "),
        (6, "s6", "Dora", "", "Amad Sahloul"),
        (7, "s7", "Emna", None, None),
        (8, "s8", "Farah", "Monastir", "SLS 1"),
    ]
    reports = [
        (1, "s2", "y1"),
        (10, "s2", "y1"),
        (11, "s2", "y2"),
        (12, "s3", "y1"),
        (13, "s4", "y2"),
        (14, "s5", "y1"),
        (15, None, "y1"),
        (16, "s6", "y2"),
        (17, "s8", None),
    ]
    scores = [
        (1, 10, 2, 8), (2, 10, 3, 12), (3, 11, 2, 19.25), (4, 11, 3, 4), (5, 12, 2, 10), (6, 12, 2, 9.99),
        (7, 13, 2, None), (8, 14, 3, 15), (9, 14, 2, 2), (10, 15, 2, 20), (11, 16, 4, 7.5), (12, 16, 1, 6),
        (13, 1, 2, 11), (14, 17, 2, 13), (15, 99, 2, 1),
    ]
    attendance = [
        (1, 2, 20240914, 0, 5, "y1"), (2, 2, 20240915, 1, 0, "y1"), (3, 2, 20240916, 2, None, "y1"),
        (4, 3, 20240914, 0, 3, "y1"), (5, 4, 20240916, 1, 0, "y2"), (6, 4, 20241005, 0, 0, "y2"),
        (7, 6, 20241005, 1, 9, "y2"), (8, 8, 20240914, 1, 0, "y1"), (9, 1, -1, 0, 0, "y1"), (10, None, 20240914, 0, 0, "y1"),
        (11, 2, 20240913, 0, 0, "y1"),
    ]
    return {
        "DimStudent": spark.createDataFrame(
            students, "StudentKey long, StudentOid string, FullNameArab string, Governorate string, BacType string"
        ),
        "DimEvaluationReport": spark.createDataFrame(
            reports, "EvaluationReportKey long, StudentOid string, SchoolYearPeriodOid string"
        ),
        "FactStudentEvaluation": spark.createDataFrame(
            [(f, r, c, score(v)) for f, r, c, v in scores], "FactKey long, EvaluationReportKey long, ContentKey long, Average decimal(5,2)"
        ),
        "FactStudentAttendance": spark.createDataFrame(
            attendance, "FactKey long, StudentKey long, DateKey int, Checks int, LateMinutes int, SchoolYearPeriodOid string"
        ),
        "FactTeacherAttendance": spark.createDataFrame(
            [(1, 20240914, 1, 3, "y1"), (2, 20240914, 2, 3, "y1"), (2, 20240915, 0, None, "y1"), (3, 20241005, 1, 0, "y2")],
            "TeacherKey long, DateKey int, Checks int, LateMinutes int, SchoolYearPeriodOid string",
        ),
        "FactStudentPayment": spark.createDataFrame([(2, Decimal("10.50")), (2, Decimal("4.50"))], "StudentKey long, PaidAmount decimal(18,2)"),
        "DimContent": spark.createDataFrame([(1, "UNKNOWN"), (2, "Maths"), (3, "Arabic"), (4, "Maths")], "ContentKey long, Description string"),
        "DimSchoolYear": spark.createDataFrame(
            [
                (1, "u", "UNKNOWN", None, None, "UNKNOWN"),
                (2, "y1", "2024-2025", day(2024, 9, 1), day(2025, 6, 30), "A"),
                (3, "y2", "2023-2024", day(2023, 9, 1), day(2024, 6, 30), "B"),
            ],
            "SchoolYearKey int, SchoolYearOid string, Description string, StartDate date, EndDate date, Code string",
        ),
        "DimDate": spark.createDataFrame(
            [(-1, None, None, None, None)]
            + [(d.year * 10000 + d.month * 100 + d.day, d, d.year, d.month, f"M{d.month}") for d in (
                day(2024, 9, 13), day(2024, 9, 14), day(2024, 9, 15), day(2024, 9, 16), day(2024, 10, 5))],
            "DateKey int, FullDate date, YearNumber int, MonthNumber int, MonthName string",
        ),
        "WeatherDaily": spark.createDataFrame(
            [(day(2024, 9, 13), 1.0), (day(2024, 9, 14), 7.5), (day(2024, 9, 16), None), (day(2024, 9, 30), 2.0), (day(2024, 12, 1), 99.0)],
            "full_date date, precipitation_sum double",
        ),
    }
