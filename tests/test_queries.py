"""Query semantics on a hand-made school, with results worked out by hand or by the plain joins."""

import datetime as dt
from decimal import Decimal

import duckdb
import pytest
from pyspark.sql import functions as F

from checks import oracle
from scolaria.plans import geography, pedagogy, performance, periods, presence, progression, risk, rollups, schools, shared, weather
from tests.conftest import by_key, rows


def test_kpis(school):
    # students s2 s3 s5 s6 s8; the report of nobody and the score of no report are out
    assert rows(performance.performance_kpis(school)) == [(5, 9.81, 50.0, 50.0, 19.25, 2.0)]
    assert rows(performance.performance_kpis(school, "2")) == [(3, 9.71, 57.1, 42.9, 15.0, 2.0)]


def test_unknown_year_key_means_no_filter(school):
    assert rows(performance.performance_kpis(school, "99")) == rows(performance.performance_kpis(school))
    assert rows(performance.performance_kpis(school, "no-such-oid")) == [(0, None, None, None, None, None)]


def test_subjects_merge_by_name(school):
    got = by_key(performance.average_by_subject(school))
    assert set(got) == {"Maths", "Arabic"}
    assert got["Maths"] == (10.09, 8, 50.0, 4, 4)
    assert got["Arabic"] == (10.33, 3, 66.7, 2, 1)
    assert rows(performance.pass_fail_by_subject(school, top=1)) == [("Maths", 4, 4, 8)]


def test_score_bins_are_left_closed_and_skip_empty_ones(school):
    got = rows(performance.score_distribution(school))
    assert got == [("2-4", 1), ("4-6", 1), ("6-8", 2), ("8-10", 2), ("10-12", 2), ("12-14", 2), ("14-16", 1), ("18-20", 1)]


def test_bins_at_the_edges(spark, school):
    from decimal import Decimal

    values = ["0", "1.99", "2", "18", "20", "-1"]
    facts = spark.createDataFrame([(i, 10, 2, Decimal(v)) for i, v in enumerate(values)], school["FactStudentEvaluation"].schema)
    got = rows(performance.score_distribution({**school, "FactStudentEvaluation": facts}))
    assert got == [("0-2", 3), ("2-4", 1), ("18-20", 2)]


def test_float_scores_are_accepted(school):
    facts = school["FactStudentEvaluation"].withColumn("Average", F.col("Average").cast("double"))
    assert rows(performance.performance_kpis({**school, "FactStudentEvaluation": facts})) == rows(performance.performance_kpis(school))


def test_progression_of_one_student(school):
    got = rows(progression.progression_by_student(school, "s2"))
    assert got == [("2024-2025", 2, "Amina", 10.33, 3), ("2023-2024", 3, "Amina", 11.63, 2)]
    homonyms = [r for r in rows(progression.progression_by_student(school)) if r[2] == "Amina" and r[1] == 2]
    assert homonyms == [("2024-2025", 2, "Amina", 10.2, 5)]


def test_stability_needs_two_years_and_five_scores(school):
    got = rows(progression.stability_index(school))
    assert [(r[0], r[1]) for r in got] == [("Amina", 2)]
    assert got[0][2:] == (10.61, 15.25, 4.62)


def test_latest_year_by_oid_or_by_date(school):
    by_oid = {r.student_name: r for r in progression.regression_detection(school).collect() if r.historical_avg == 10.85}
    assert by_oid["Amina"].latest_avg == 11.63
    by_date = {r.student_name: r for r in progression.regression_detection(school, chronological=True).collect() if r.historical_avg == 10.85}
    assert by_date["Amina"].latest_avg == 10.33
    # a student whose only report has no year has no latest year
    assert "Farah" not in {r.student_name for r in progression.regression_detection(school).collect()}


def test_trend_labels(spark, school):
    from decimal import Decimal

    reports = [(10, "s2", "y1"), (11, "s2", "y2"), (12, "s3", "y1"), (13, "s3", "y2"), (14, "s4", "y1"), (15, "s4", "y2")]
    values = [(10, 12), (11, 8), (12, 8), (13, 12.5), (14, 11), (15, 14)]
    tables = {
        **school,
        "DimEvaluationReport": spark.createDataFrame(reports, school["DimEvaluationReport"].schema),
        "FactStudentEvaluation": spark.createDataFrame(
            [(i, r, 2, Decimal(str(v))) for i, (r, v) in enumerate(values)], school["FactStudentEvaluation"].schema
        ),
    }
    got = [(r.delta, r.trend_label) for r in progression.regression_detection(tables).collect()]
    assert got == [(-2.0, "Stable"), (1.5, "Stable"), (2.25, "Improvement")]


def test_reports_leave_out_the_unknown_one(school):
    names = {r.report_name for r in progression.semester_comparison(school).collect()}
    assert names == {"10", "11", "12", "14", "16"}
    got = by_key(pedagogy.dispersion_by_report(school))
    assert got["16"] == (6.0, 7.5, 6.75, 1.06, 2) and got["17"] == (13.0, 13.0, 13.0, None, 1)
    assert "13" not in got and "1" not in got


def test_outcomes_merge_subject_keys_of_one_name(spark, school):
    got = {(r.report_name, r.subject): r for r in pedagogy.outcomes_by_report(school).collect()}
    assert (got["12", "Maths"].avg_score, got["12", "Maths"].pass_rate, got["12", "Maths"].score_stddev) == (10.0, 50.0, 0.01)
    assert got["16", "Maths"].avg_score == 7.5  # subject key 1 is unknown
    assert {s for _, s in got} == {"Maths", "Arabic"}
    assert {r.subject for r in pedagogy.outcomes_by_report(school, subject="Arabic").collect()} == {"Arabic"}
    assert {r.year_label for r in pedagogy.outcomes_by_report(school, "3").collect()} == {"2023-2024"}
    assert rows(pedagogy.subject_list(school)) == [("Arabic",), ("Maths",)]


def test_presence_performance(school):
    got = by_key(pedagogy.presence_performance(school))
    assert got["10"] == (10.0, 50.0) and got["14"] == (8.5, None) and got["16"] == (6.75, 100.0)


def test_attendance_kpis(school):
    assert rows(presence.attendance_kpis(school)) == [(6, 50.0, 50.0, 30.0, 10, 2, 3, 33.3, 66.7)]
    assert rows(presence.attendance_kpis(school, "3")) == [(2, 66.7, 33.3, 33.3, 3, 1, 1, 0.0, 100.0)]
    assert rows(presence.attendance_kpis(school, "no-such-oid")) == [(0, None, None, None, 0, 0, 0, None, None)]


def test_months(school):
    assert rows(presence.absence_by_month(school)) == [(2024, 9, "M9", 7, 3, 42.9), (2024, 10, "M10", 2, 1, 50.0)]
    assert rows(presence.teacher_sessions_by_month(school)) == [("M9", 9, 2024, 1, 2, 1.0), ("M10", 10, 2024, 1, 1, 1.0)]


def test_top_absent_counts_homonyms_together(school):
    assert rows(presence.top_absent_students(school)) == [("Amina", 5, 3, 60.0)]


def naive(spark, school, sql):
    for name, frame in school.items():
        frame.createOrReplaceTempView(name)
    return spark.sql(sql)


FANOUT = """DimStudent s LEFT JOIN FactStudentAttendance att ON s.StudentKey = att.StudentKey
    LEFT JOIN DimEvaluationReport er ON er.StudentOid = s.StudentOid {year}
    LEFT JOIN FactStudentEvaluation ev ON ev.EvaluationReportKey = er.EvaluationReportKey AND ev.Average IS NOT NULL"""
MEASURES = """round(100.0 * sum(CASE WHEN att.Checks = 0 THEN 1 ELSE 0 END) / nullif(count(att.FactKey), 0), 1) AS absence_rate,
    round(100.0 * sum(CASE WHEN att.LateMinutes > 0 THEN 1 ELSE 0 END) / nullif(count(att.FactKey), 0), 1) AS late_rate,
    round(avg(cast(ev.Average AS double)), 2) AS avg_score,
    round(100.0 * sum(CASE WHEN ev.Average >= 10 THEN 1 ELSE 0 END) / nullif(count(ev.FactKey), 0), 1) AS pass_rate"""


def same(frame, expected, *columns):
    pick = lambda f: sorted([tuple(float(v) if not isinstance(v, (str, type(None))) else v for v in r) for r in rows(f.select(*columns))], key=str)
    got, want = pick(frame), pick(expected)
    assert got == [pytest.approx(w) for w in want] and got


@pytest.mark.parametrize("year, filter_", [(None, ""), ("2", "AND er.SchoolYearPeriodOid = 'y1'")])
def test_fanout_equals_the_joined_product(spark, school, year, filter_):
    joined = FANOUT.format(year=filter_)
    zones = naive(
        spark, school, f"""SELECT s.Governorate AS zone_name, count(DISTINCT s.StudentKey) AS student_count, {MEASURES} FROM {joined}
        WHERE s.Governorate IS NOT NULL AND s.Governorate <> '' GROUP BY s.Governorate"""
    )
    same(geography.students_by_zone(school, year), zones, "zone_name", "student_count", "absence_rate", "late_rate", "avg_score")
    detail = naive(
        spark, school, f"""SELECT s.FullNameArab AS student_name, s.Governorate AS zone_name, {MEASURES} FROM {joined}
        WHERE s.Governorate = 'Sousse' GROUP BY s.FullNameArab, s.Governorate HAVING count(att.FactKey) >= 3"""
    )
    same(geography.zone_detail(school, "Sousse", year), detail, "student_name", "absence_rate", "late_rate", "avg_score")
    students = naive(
        spark, school, f"""SELECT s.FullNameArab AS student_name, s.BacType AS prev_school, {MEASURES} FROM {joined}
        WHERE s.BacType LIKE 'SLS%' GROUP BY s.FullNameArab, s.BacType HAVING count(ev.FactKey) >= 2"""
    )
    same(
        schools.students_from_school(school, "SLS Leaders School", year), students,
        "student_name", "prev_school", "avg_score", "absence_rate", "pass_rate",
    )


@pytest.mark.parametrize("year, filter_", [(None, ""), ("2", "AND er.SchoolYearPeriodOid = 'y1'")])
def test_inner_fanout_equals_the_joined_product(spark, school, year, filter_):
    expected = naive(
        spark, school, f"""SELECT s.FullNameArab AS student_name, {MEASURES} FROM FactStudentAttendance att
        JOIN DimStudent s ON att.StudentKey = s.StudentKey JOIN DimEvaluationReport er ON er.StudentOid = s.StudentOid
        JOIN FactStudentEvaluation ev ON ev.EvaluationReportKey = er.EvaluationReportKey
        WHERE ev.Average IS NOT NULL {filter_} GROUP BY s.FullNameArab HAVING count(att.FactKey) >= 3"""
    )
    same(presence.attendance_vs_score(school, year), expected, "student_name", "absence_rate", "avg_score")


def test_governorates_keep_blank_and_null_apart(school):
    got = {(r.governorate, r.student_count, r.absence_rate, r.late_rate) for r in geography.governorate_summary(school).collect()}
    assert got == {("Sousse", 3, 57.1, 28.6), ("Monastir", 2, 0.0, 0.0), ("Unknown", 2, 100.0, 0.0), ("", 1, 0.0, 100.0)}


def test_unknown_zone_is_empty(school):
    assert rows(geography.zone_detail(school, "Nowhere")) == []
    assert rows(geography.zone_detail(school, "x' OR '1'='1")) == []


def test_risk_scores(school):
    got = {(r.student_name, r.avg_score): r for r in risk.risk_scores(school).collect()}
    two = got["Amina", 10.85]
    assert (two.absence_rate, two.fail_rate_pct, two.payment_count, two.risk_score, two.risk_level) == (50.0, 40.0, 2, 27.5, "Low")
    dora = got["Dora", 6.75]
    assert (dora.absence_rate, dora.fail_rate_pct, dora.risk_score, dora.risk_level) == (0.0, 100.0, 38.0, "Medium")
    three = got["Amina", 10.0]
    assert (three.absence_rate, three.risk_score) == (100.0, 47.5)
    assert [r.risk_score for r in risk.risk_scores(school).collect()] == sorted((r.risk_score for r in got.values()), reverse=True)
    assert len(rows(risk.risk_scores(school, top=2))) == 2


def test_risk_distribution_and_warnings(school):
    assert by_key(risk.risk_distribution(school)) == {"Medium": (2, 8.37, 50.0), "Low": (3, 10.78, 16.7)}
    # s3 averages 9.995: below the pass mark unrounded, on it once rounded
    assert rows(risk.early_warnings(school)) == [
        ("Dora", 6.75, 0.0, 100.0, 1, 0, 1, 2), ("Amina", 10.0, 100.0, 50.0, 1, 1, 0, 2),
    ]


def test_risk_level_limits(spark):
    frame = spark.createDataFrame([(60.0,), (59.999,), (35.0,), (34.99,), (100 * 0.35 + 0.1 + 0.2 - 0.3,)], "r double")
    assert [r[0] for r in rows(frame.select(risk.risk_level(F.col("r"))))] == ["High", "Medium", "Medium", "Low", "Medium"]


def test_weather_days(school):
    got = by_key(weather.weather_vs_absence(school))
    assert got["2024-09-14"] == (3, 2, 66.7, 7.5, True)
    assert got["2024-09-13"] == (1, 1, 100.0, 1.0, False)
    assert got["2024-10-05"] == (2, 1, 50.0, 0.0, False)  # not in the archive
    assert rows(weather.rainy_vs_dry(school)) == [(66.7, 1, 37.5, 4)]
    assert rows(weather.rainy_vs_dry(school, "no-such-oid")) == [(None, 0, None, 0)]


def test_seasonal_rain_counts_archive_days_within_the_span(school):
    assert rows(weather.seasonal_patterns(school)) == [
        (9, "M9", 42.9, "2024-09-13", "2024-09-16", 2.6), (10, "M10", 50.0, "2024-10-05", "2024-10-05", 0.0),
    ]


def test_periods(school):
    got = rows(periods.absence_by_period(school))
    assert [r[0] for r in got] == ["pre_holiday", "post_holiday", "pre_exam", "exam", "normal"]
    assert got[0][1:] == ("Before Holiday", 83.4, 2) and got[1][2:] == (0.0, 1) and got[2][2:] == (0.0, 0) and got[4][2:] == (50.0, 1)
    tagged = by_key(periods.daily_absence_tagged(school))
    assert tagged["2024-09-15"] == (0.0, 1, "holiday", "Mawlid Break")


def test_holiday_impact(school):
    got = rows(periods.holiday_impact(school))
    assert len(got) == 6
    assert got[0] == ("Mawlid Break", "2024-09-15", "2024-09-15", 83.4, 0.0)
    assert got[1][3:] == (None, None)
    assert rows(periods.holiday_impact(school, "3")) == []  # its label has no calendar


def test_schools(school):
    got = by_key(schools.performance_by_school(school))
    assert set(got) == {"SLS Leaders School", "Sahloul 4 / HS", "Other / Unknown", "Amad"}
    assert got["SLS Leaders School"][0] == 3 and got["Sahloul 4 / HS"] == (1, None, None, 50.0) and got["Other / Unknown"] == (1, 8.5, 50.0, None)
    assert rows(schools.school_ranking(school)) == []  # one school has 3 students, none has 5
    assert by_key(schools.school_list(school))["Sahloul 4 / HS"] == ("HS1",)
    assert rows(schools.students_from_school(school, "No such school")) == []


def test_school_ranking_limits(spark, school):
    students = [(i, f"s{i}", f"n{i}", "z", "Pilote A" if i < 5 else "Pilote B") for i in range(2, 10)]
    tables = {**school, "DimStudent": spark.createDataFrame(students, school["DimStudent"].schema)}
    assert [(r.school_name, r.student_count) for r in schools.school_ranking(tables).collect()] == [("Pilote", 8)]


def test_school_years(school):
    got = by_key(shared.school_years(school, dt.date(2025, 6, 30)))
    assert got == {2: ("y1", "2024-2025", True), 3: ("y2", "2023-2024", False)}
    assert rows(rollups.current_school_year(school, "2024-01-10")) == [(3, "2023-2024")]
    assert len(rows(shared.school_years(school))) == 2


def test_rollups(school):
    shares = by_key(rollups.histogram_share(school))
    assert shares["2-4"] == (1, 8.3, "rose") and shares["18-20"][2] == "teal" and shares["12-14"][2] == "amber"
    assert rows(rollups.subject_extremes(school)) == [("Arabic", "Maths", "2.00 – 19.25 / 20")]
    assert by_key(rollups.year_progression(school)) == {"2024-2025": (9.35,), "2023-2024": (9.19,)}
    summary = rollups.progression_summary(school).first()
    assert (summary.years_tracked, summary.most_stable, summary.stable_profiles, summary.biggest_regression) == (2, "Amina", 0, None)
    assert rows(rollups.peak_absence_month(school)) == [("M10", 50.0)]
    assert rows(rollups.absence_kpi(school)) == [(50.0,)]
    assert rows(rollups.weather_sensitivity(school)) == [(29.2, "M9", "M10")]
    assert {r[0] for r in rows(rollups.weather_series(school))} == {"Dry", "Rainy"}
    assert by_key(rollups.dispersion_bands(school))["16"] == (5.69, 7.81)
    assert rollups.report_summary(school).first().asDict() == {
        "reports": 6, "best_avg": 13.0, "highest_dispersion": 10.78, "best_report": "17", "most_volatile": "11", "evaluations": 11, "subjects": 2,
    }
    assert rows(rollups.risk_summary(school)) == [(0, 2, 5, 0, "Amina")]
    assert by_key(rollups.warning_levels(school)) == {"Dora": (2, "Medium"), "Amina": (2, "Medium")}
    zone = rollups.zone_summary(school).first()
    assert (zone.zones, zone.students, zone.top_zone) == (2, 5, "Sousse")
    period = rollups.period_summary(school).first()
    assert (period.highest_period, period.lowest_period, period.days) == ("Before Holiday", "Exam Period", 4)
    assert rollups.school_summary(school).first().schools == 4
    assert len(rows(rollups.school_top(school, top=2))) == 2
    assert {r[2] for r in rows(rollups.absence_bands(school))} == {"rose"}
    assert rows(rollups.subject_pass_fail(school)) == [("Arabic", 2, 1), ("Maths", 4, 4)]
    assert {r[2] for r in rows(rollups.subject_bands(school))} == {"amber"}
    assert all(r[3] in ("rose", "amber", "teal") for r in rows(rollups.risk_quadrants(school)))
    assert len(rows(rollups.risk_top(school, top=3))) == 3


def test_students_of_a_report_are_counted(spark, school):
    """A report that the dimension gives to two students counts both, in every query that reports students."""

    reports = school["DimEvaluationReport"]
    key = school["FactStudentEvaluation"].where("Average IS NOT NULL AND EvaluationReportKey <> 1 AND ContentKey <> 1").join(reports.where("StudentOid IS NOT NULL"), "EvaluationReportKey").first().EvaluationReportKey
    other = reports.where(F.col("EvaluationReportKey") == key).withColumn("StudentOid", F.lit("s7"))
    tables = {**school, "DimEvaluationReport": reports.unionAll(other)}
    semester = {r.report_name: r.student_count for r in progression.semester_comparison(tables).collect()}
    outcomes = {r.report_name: r.student_count for r in pedagogy.outcomes_by_report(tables).collect()}
    assert semester[str(key)] == 2 and outcomes[str(key)] == 2
    assert {n for name, n in semester.items() if name != str(key)} == {1}


def test_governorate_counts_students_not_rows(school):

    twice = school["DimStudent"].unionAll(school["DimStudent"].where("StudentKey = 4").withColumn("StudentKey", F.lit(40).cast("long")))
    count = lambda tables: {r.governorate: r.student_count for r in geography.governorate_summary(tables).collect()}
    assert count({**school, "DimStudent": twice.select(school["DimStudent"].columns)}) == count(school)


def test_product_of_row_counts_beyond_a_long(spark, school, monkeypatch):
    """One student with four thousand million rows on either side."""

    from scolaria.operators import fanout

    many = F.lit(4_000_000_000)
    attendance, exposure = fanout.attendance_by_student, fanout.student_exposure
    monkeypatch.setattr(fanout, "attendance_by_student", lambda *a: attendance(*a).withColumns({c: F.col(c) * many for c in ("records", "absent", "late")}))
    monkeypatch.setattr(fanout, "student_exposure", lambda *a: exposure(*a).withColumns({c: F.col(c) * many for c in ("joined", "n", "passed")}))
    rates = {r.zone_name: r.absence_rate for r in geography.students_by_zone(school).collect()}
    assert rates and any(rate is not None for rate in rates.values())


@pytest.fixture
def doubled(spark, school):
    """The school with two StudentOids that two rows of the dimension have, both with attendance and payments of their own."""
    more = spark.createDataFrame(
        [(20, "s2", "Amina the second", "Sousse", "SLS 1"), (21, "s6", "Dora", "", "HS1"), (22, None, "Nobody", "", "")], school["DimStudent"].schema
    )
    days = spark.createDataFrame(
        [(50 + i, key, 20240914, checks, 0, "y1") for i, (key, checks) in enumerate([(20, 0), (20, 0), (21, 1), (21, 0), (22, 0)])],
        school["FactStudentAttendance"].schema,
    )
    paid = spark.createDataFrame([(20, Decimal("1.00")), (21, Decimal("2.00")), (6, Decimal("3.00"))], school["FactStudentPayment"].schema)
    return {
        **school,
        "DimStudent": school["DimStudent"].unionAll(more),
        "FactStudentAttendance": school["FactStudentAttendance"].unionAll(days),
        "FactStudentPayment": school["FactStudentPayment"].unionAll(paid),
    }


def plain_joins(tables, key, statements):
    """Rows of a statement of the checks, on these tables."""
    names = {
        "fact_student_evaluation": "FactStudentEvaluation", "dim_evaluation_report": "DimEvaluationReport", "dim_student": "DimStudent",
        "fact_student_attendance": "FactStudentAttendance", "fact_student_payment": "FactStudentPayment", "dim_school_year": "DimSchoolYear",
    }
    connection = duckdb.connect()
    for view, name in names.items():
        connection.register(view, tables[name].toArrow())
    return [tuple(row) for row in connection.execute(statements[key]).fetchall()]


def test_risk_of_a_doubled_student_oid(doubled):
    """Keys of one Oid share their attendance and payments, in the lists under each of their names."""
    queries = {"a6_risk_scores": risk.risk_scores, "a6_risk_distribution": risk.risk_distribution, "a6_early_warning": risk.early_warnings}
    for year, of_year in ((None, False), ("2", "2")):
        for key, query in queries.items():
            want = plain_joins(doubled, key, oracle._risk(of_year))
            assert rows(query(doubled, year)) == want, key
    shared = [r for r in risk.risk_scores(doubled).collect() if r.student_name in ("Amina the second", "Amina") and r.avg_score == 10.85]
    assert len(shared) == 2 and {(r.absence_rate, r.payment_count) for r in shared} == {(66.7, 3)}


def test_risk_summary_of_a_doubled_student_oid(doubled):
    levels = by_key(risk.risk_distribution(doubled))
    (summary,) = rows(rollups.risk_summary(doubled))
    assert summary[:3] == (levels.get("High", (0,))[0], levels.get("Medium", (0,))[0], sum(v[0] for v in levels.values()))
    assert summary[3] == sum(r.warning_count >= 3 for r in risk.early_warnings(doubled).collect())
    assert summary[4] == risk.risk_scores(doubled, top=1).first().student_name
    assert rows(rollups.risk_summary(doubled, warned=0))[0][3] == 0


def test_standings_hold_trends_and_stability(doubled):
    frame = progression.standings(doubled)
    students = frame.where("part = 'student'").select("StudentOid", "student_name", "delta", "trend_label")
    names = frame.where("part = 'name'").select("student_name", "score_stddev")
    order = lambda found: sorted(found, key=str)
    assert order(rows(students)) == order(rows(progression.trends(doubled).select(*students.columns)))
    assert order(rows(names)) == order(rows(progression.stability(doubled).select(*names.columns)))
    labels = {r.year_label for r in progression.student_years(doubled).collect()}
    assert {r.year_label for r in frame.where("part = 'year'").collect()} == labels


def test_progression_summary_without_scores(school):
    nothing = {**school, "FactStudentEvaluation": school["FactStudentEvaluation"].limit(0)}
    assert rows(rollups.progression_summary(nothing)) == [(0, 0, 0, 0, None, None, None, None)]
    assert rows(rollups.risk_summary(nothing)) == [(0, 0, 0, 0, None)]
