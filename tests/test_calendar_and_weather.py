import datetime as dt
import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from scolaria.operators.periods import holiday_neighbours, period_days, tag_periods
from scolaria.operators.years import resolve_year, year_label
from scolaria.sources.seeds import CALENDAR
from scolaria.sources.weather import parse_weather, read_weather, weather_days
from tests.conftest import by_key, rows


def tags(spark, days, label, kind="string"):
    frame = spark.createDataFrame([(d,) for d in days], "d string").withColumn("d", F.col("d").cast(kind))
    return {str(r.d): (r.period_type, r.period_label) for r in tag_periods(frame, "d", label).collect()}


def test_shadowed_days_take_the_first_period(spark):
    got = tags(spark, ["2025-03-08", "2025-03-28", "2025-03-30"], "2024-2025")
    assert [got[d][0] for d in sorted(got)] == ["exam", "post_holiday", "post_holiday"]
    assert tags(spark, ["2026-03-20"], "2025-2026")["2026-03-20"] == ("post_holiday", "Post-Spring Break")


def test_days_outside_and_unreadable_days_are_normal(spark):
    got = tags(spark, ["2024-10-05", "no date", "2024-09-15T08:00"], "2024-2025")
    assert got["2024-10-05"] == ("normal", "Normal Period") == got["no date"]
    assert got["2024-09-15T08:00"] == ("holiday", "Mawlid Break")


def test_dates_and_timestamps_are_tagged(spark):
    assert tags(spark, ["2024-09-15"], "2024-2025", "date")["2024-09-15"][0] == "holiday"
    assert tags(spark, ["2024-09-15 23:00:00"], "2024-2025", "timestamp")["2024-09-15 23:00:00"][0] == "holiday"


def test_null_date_is_normal(spark):
    frame = spark.createDataFrame([(None,)], "d date")
    assert rows(tag_periods(frame, "d", "2024-2025").select("period_type")) == [("normal",)]


def test_unknown_label_tags_by_the_default_year(spark):
    assert tags(spark, ["2024-09-15"], "1999-2000")["2024-09-15"][0] == "holiday"
    assert tags(spark, ["2024-09-15"], None)["2024-09-15"][0] == "holiday"


def test_every_calendar_day_matches_a_scan_of_the_list(spark):
    for label, entries in CALENDAR.items():
        expected = {}
        for name, kind, start, end in entries:
            day = dt.date.fromisoformat(start)
            while day <= dt.date.fromisoformat(end):
                expected.setdefault(day, (kind, name))
                day += dt.timedelta(days=1)
        assert by_key(period_days(spark, label)) == expected


def test_holiday_neighbours(spark):
    got = holiday_neighbours(spark, "2024-2025").where("label = 'Mawlid Break'")
    assert sorted(str(r.day) for r in got.where("side = 'pre'").collect()) == [f"2024-09-{d}" for d in range(10, 15)]
    assert sorted(str(r.day) for r in got.where("side = 'post'").collect()) == [f"2024-09-{d}" for d in range(16, 21)]
    assert holiday_neighbours(spark, "1999-2000").count() == 0


def test_year_parameters(school):
    assert resolve_year(school, None) is None and resolve_year(school, "") is None
    assert resolve_year(school, "2") == "y1" == resolve_year(school, 2)
    assert resolve_year(school, "99") is None
    assert resolve_year(school, "some-oid") == "some-oid"
    assert year_label(school, "3") == "2023-2024"
    assert year_label(school, "99") == "2024-2025" == year_label(school, None) == year_label(school, "some-oid")


def document(days):
    return json.dumps({"latitude": 35.8, "daily": {"time": [d for d, _ in days], "precipitation_sum": [p for _, p in days]}}, indent=1)


def test_weather_files(spark, tmp_path):
    (tmp_path / "a.json").write_text(document([("2024-09-01", 0.0), ("2024-09-02", None), ("2024-09-03", 1.0)]))
    (tmp_path / "b.json").write_text(document([("2024-09-03", 1.0), ("2024-09-04", 1.1)]))
    got = {str(k): v for k, v in by_key(weather_days(read_weather(spark, str(tmp_path)))).items()}
    assert got == {"2024-09-01": (0.0, False), "2024-09-02": (0.0, False), "2024-09-03": (1.0, False), "2024-09-04": (1.1, True)}


def test_weather_texts(spark):
    texts = spark.createDataFrame([(document([("2024-09-01", 3.5)]),)], "document string")
    assert rows(weather_days(parse_weather(texts)).select("precipitation_mm", "is_rainy")) == [(3.5, True)]


def test_missing_weather_source_raises(spark, tmp_path):
    with pytest.raises(AnalysisException):
        read_weather(spark, str(tmp_path / "none"))
