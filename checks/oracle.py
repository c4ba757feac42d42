"""One SQL statement per registered query, written against the plain joins.

Fan-out queries really build the product here, standard deviations use the engine's own aggregate,
periods are matched by range: nothing is shared with the Spark plans but the seed lists, the
parameters and the rounding rule.
"""

from __future__ import annotations

import re

from checks.model_sql import VIEWS
from scolaria.plans.registry import AS_OF, CALENDAR_YEARS, FIRST_TERM, PREVIOUS_YEARS, SCHOOL, SCHOOL_YEAR, STUDENT as STUDENT_OID, SUBJECT as SUBJECT_NAME, ZONE
from scolaria.sources.seeds import CALENDAR, OTHER_SCHOOL, PERIOD_TYPES, SCHOOL_GROUPS

DEC = "DECIMAL(28,12)"


def up(x: str, n: int) -> str:
    return f"CAST(round(CAST({x} AS {DEC}), {n}) AS DOUBLE)"


def even(x: str, n: int) -> str:
    return f"CAST(round_even(CAST({x} AS {DEC}), {n}) AS DOUBLE)"


def pct(part: str, whole: str) -> str:
    return up(f"100.0::DOUBLE * CAST({part} AS DOUBLE) / nullif({whole}, 0)", 1)


def raw_pct(part: str, whole: str) -> str:
    return f"100.0::DOUBLE * CAST({part} AS DOUBLE) / nullif({whole}, 0)"


def avg(x: str) -> str:
    return f"CAST(sum({x}) AS DOUBLE) / count({x})"


def when(condition: str) -> str:
    """Rows that meet a condition."""
    return f"count(CASE WHEN {condition} THEN 1 END)"


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def in_year(alias: str, year: bool | str) -> str:
    """year: whether to take the registered year, or another SchoolYearKey."""
    key = SCHOOL_YEAR if year is True else year
    return f" AND {alias}.SchoolYearPeriodOid = (SELECT SchoolYearOid FROM dim_school_year WHERE SchoolYearKey = {key})" if year else ""


SCORED = (
    "fact_student_evaluation f JOIN dim_evaluation_report er ON f.EvaluationReportKey = er.EvaluationReportKey"
)
BASE = "er.StudentOid IS NOT NULL AND f.Average IS NOT NULL"
SUBJECT = "JOIN dim_content c ON f.ContentKey = c.ContentKey"
YEARS = "JOIN dim_school_year sy ON er.SchoolYearPeriodOid = sy.SchoolYearOid"
STUDENT = "JOIN dim_student s ON er.StudentOid = s.StudentOid"
AVG_SCORE = f"{up(avg('f.Average'), 2)} AS avg_score"
PASS = when("f.Average >= 10")
FAIL = when("f.Average < 10")
PASS_RATE = f"{pct(PASS, 'count(*)')} AS pass_rate"

SEEDS = {
    "academic_calendar": "SELECT * FROM (VALUES "
    + ", ".join(
        f"({text(year)}, {i}, {text(label)}, {text(kind)}, date '{start}', date '{end}')"
        for year, entries in CALENDAR.items()
        for i, (label, kind, start, end) in enumerate(entries, 1)
    )
    + ") v(year_label, ordinal, label, type, first_day, last_day)",
    "period_types": "SELECT * FROM (VALUES "
    + ", ".join(f"({i}, {text(kind)}, {text(label)})" for i, (kind, label) in enumerate(PERIOD_TYPES, 1))
    + ") v(ordinal, period_type, period_label)",
    "school_patterns": "SELECT * FROM (VALUES "
    + ", ".join(
        f"({i}, {text(name)}, {text(pattern)})"
        for i, (name, patterns) in enumerate(SCHOOL_GROUPS.items(), 1)
        for pattern in patterns
    )
    + ") v(ordinal, canonical, pattern)",
    "school_names": f"""
SELECT n.BacType, coalesce(min_by(p.canonical, p.ordinal), {text(OTHER_SCHOOL)}) AS canonical
FROM (SELECT DISTINCT BacType FROM dim_student) n
LEFT JOIN school_patterns p ON contains(lower(trim(n.BacType)), p.pattern) GROUP BY n.BacType""",
}


def _performance(y: bool) -> dict[str, str]:
    base, subject = BASE + in_year("er", y), f"{SCORED} {SUBJECT}"
    upper = [2, 4, 6, 8, 10, 12, 14, 16, 18]
    bins = " ".join(f"WHEN f.Average < {u} THEN '{u - 2}-{u}'" for u in upper)
    return {
        "a1_kpis": f"""SELECT count(DISTINCT er.StudentOid) AS total_students, {AVG_SCORE}, {PASS_RATE},
            {pct(FAIL, 'count(*)')} AS fail_rate, CAST(max(f.Average) AS DOUBLE) AS max_score,
            CAST(min(f.Average) AS DOUBLE) AS min_score FROM {SCORED} WHERE {base}""",
        "a1_avg_by_subject": f"""SELECT c.Description AS subject, {AVG_SCORE}, count(*) AS n_evaluations, {PASS_RATE},
            {PASS} AS pass_count, {FAIL} AS fail_count FROM {subject} WHERE {base} AND c.ContentKey <> 1
            GROUP BY c.Description ORDER BY avg_score DESC, subject""",
        "a1_score_distribution": f"""SELECT bin, count(*) AS count FROM (SELECT CASE {bins} ELSE '18-20' END AS bin, f.Average
            FROM {SCORED} WHERE {base}) GROUP BY bin ORDER BY min(Average)""",
        "a1_pass_fail_by_subject": f"""SELECT c.Description AS subject, {PASS} AS pass_count, {FAIL} AS fail_count, count(*) AS total
            FROM {subject} WHERE {base} AND c.ContentKey <> 1 GROUP BY c.Description ORDER BY total DESC, subject LIMIT 12""",
    }


def _progression() -> dict[str, str]:
    def regression(rank: str, join: str) -> str:
        return f"""WITH history AS (SELECT er.StudentOid, {avg('f.Average')} AS hist,
                arg_max(er.SchoolYearPeriodOid, {rank}) AS latest_oid FROM {SCORED} {join} WHERE {BASE} GROUP BY er.StudentOid),
            latest AS (SELECT er.StudentOid, {avg('f.Average')} AS last FROM {SCORED}
                JOIN history h ON er.StudentOid = h.StudentOid AND er.SchoolYearPeriodOid = h.latest_oid
                WHERE f.Average IS NOT NULL GROUP BY er.StudentOid)
            SELECT s.StudentOid AS oid, s.FullNameArab AS student_name, {up('h.hist', 2)} AS historical_avg, {up('l.last', 2)} AS latest_avg,
                {up('l.last - h.hist', 2)} AS delta,
                CASE WHEN CAST(l.last - h.hist AS {DEC}) < -2 THEN 'Regression'
                     WHEN CAST(l.last - h.hist AS {DEC}) > 2 THEN 'Improvement' ELSE 'Stable' END AS trend_label
            FROM history h JOIN latest l ON h.StudentOid = l.StudentOid JOIN dim_student s ON h.StudentOid = s.StudentOid"""

    def top15(inner: str) -> str:
        return f"SELECT * EXCLUDE (oid) FROM ({inner}) ORDER BY delta, student_name, oid LIMIT 15"

    by_oid = regression("er.SchoolYearPeriodOid", "")
    return {
        "school_years": f"""SELECT SchoolYearKey, SchoolYearOid, Description AS YearLabel,
            coalesce(date '{AS_OF}' BETWEEN StartDate AND EndDate, false) AS IsCurrent
            FROM dim_school_year WHERE SchoolYearKey <> 1 ORDER BY SchoolYearKey""",
        "a1_avg_by_school_year": f"""SELECT sy.Description AS year_label, sy.SchoolYearKey, {AVG_SCORE}, {PASS_RATE},
            count(DISTINCT er.StudentOid) AS student_count FROM {SCORED} {YEARS}
            WHERE {BASE} AND sy.SchoolYearKey <> 1 GROUP BY sy.Description, sy.SchoolYearKey ORDER BY sy.SchoolYearKey""",
        "a2_progression": f"""SELECT sy.Description AS year_label, sy.SchoolYearKey, s.FullNameArab AS student_name, {AVG_SCORE},
            count(*) AS n_evals FROM {SCORED} {YEARS} {STUDENT} WHERE {BASE} AND sy.SchoolYearKey <> 1
            GROUP BY sy.Description, sy.SchoolYearKey, s.FullNameArab ORDER BY sy.SchoolYearKey, student_name""",
        "a2_yoy_by_subject": f"""SELECT sy.Description AS year_label, sy.SchoolYearKey, c.Description AS subject, {AVG_SCORE}
            FROM {SCORED} {YEARS} {SUBJECT} WHERE {BASE} AND sy.SchoolYearKey <> 1 AND c.ContentKey <> 1
            GROUP BY sy.Description, sy.SchoolYearKey, c.Description ORDER BY sy.SchoolYearKey, subject""",
        "a2_stability": f"""SELECT s.FullNameArab AS student_name, count(DISTINCT er.SchoolYearPeriodOid) AS years_active, {AVG_SCORE},
            {up('CAST(max(f.Average) AS DOUBLE) - CAST(min(f.Average) AS DOUBLE)', 2)} AS score_range,
            {up('stddev_samp(CAST(f.Average AS DOUBLE))', 2)} AS score_stddev FROM {SCORED} {STUDENT} WHERE {BASE}
            GROUP BY s.FullNameArab HAVING count(DISTINCT er.SchoolYearPeriodOid) >= 2 AND count(*) >= 5
            ORDER BY score_stddev NULLS FIRST, student_name LIMIT 20""",
        "all_trends": by_oid,
        "a2_regression": top15(by_oid),
        "a2_regression_chronological": top15(
            regression("sy.StartDate", "LEFT JOIN dim_school_year sy ON er.SchoolYearPeriodOid = sy.SchoolYearOid")
        ),
        "a2_semester": f"""SELECT sy.Description AS year_label, CAST(er.EvaluationReportKey AS VARCHAR) AS report_name, {AVG_SCORE},
            count(DISTINCT er.StudentOid) AS student_count FROM {SCORED} {YEARS}
            WHERE {BASE} AND sy.SchoolYearKey <> 1 AND er.EvaluationReportKey <> 1
            GROUP BY sy.Description, er.EvaluationReportKey ORDER BY sy.Description, er.EvaluationReportKey""",
        "a5_subject_list": "SELECT DISTINCT Description AS subject FROM dim_content WHERE ContentKey <> 1 ORDER BY subject",
        "a9_school_list": """SELECT canonical, min(n.BacType) AS sample_raw FROM dim_student s JOIN school_names n ON s.BacType = n.BacType
            WHERE s.StudentOid IS NOT NULL AND s.BacType <> '' GROUP BY canonical ORDER BY canonical""",
    }


def _presence(y: bool) -> dict[str, str]:
    fact = in_year("f", y)
    absent, present, late = when("f.Checks = 0"), when("f.Checks > 0"), when("f.LateMinutes > 0")
    students = f"fact_student_attendance f WHERE f.StudentKey IS NOT NULL{fact}"
    dated = "JOIN dim_date d ON f.DateKey = d.DateKey"
    return {
        "a3_kpis": f"""SELECT st.*, te.* FROM (SELECT count(DISTINCT f.StudentKey) AS students_tracked,
            {pct(present, 'count(*)')} AS presence_rate, {pct(absent, 'count(*)')} AS absence_rate, {pct(late, 'count(*)')} AS late_rate,
            count(*) AS total_records FROM {students}) st,
            (SELECT count(DISTINCT f.TeacherKey) AS teachers_tracked, count(*) AS teacher_sessions,
            {pct(late, 'count(*)')} AS teacher_late_rate, {pct(present, 'count(*)')} AS teacher_presence_rate
            FROM fact_teacher_attendance f WHERE f.TeacherKey <> 1{fact}) te""",
        "a3_absence_by_month": f"""SELECT d.YearNumber AS year, d.MonthNumber AS month, d.MonthName AS month_name, count(*) AS total_records,
            {absent} AS absent_count, {pct(absent, 'count(*)')} AS absence_rate FROM fact_student_attendance f {dated}
            WHERE f.StudentKey IS NOT NULL AND d.DateKey <> -1{fact} GROUP BY ALL ORDER BY year, month""",
        "a3_teacher_hours": f"""SELECT d.MonthName AS month_name, d.MonthNumber AS month, d.YearNumber AS year,
            count(DISTINCT f.TeacherKey) AS active_teachers, count(*) AS total_sessions,
            {up(avg('f.Checks'), 2)} AS avg_checks_per_session FROM fact_teacher_attendance f {dated}
            WHERE f.TeacherKey <> 1 AND d.DateKey <> -1{fact} GROUP BY d.MonthName, d.MonthNumber, d.YearNumber ORDER BY year, month""",
        "a3_top_absent": f"""SELECT s.FullNameArab AS student_name, count(*) AS total_days, {absent} AS absent_days,
            {pct(absent, 'count(*)')} AS absence_rate FROM fact_student_attendance f JOIN dim_student s ON f.StudentKey = s.StudentKey
            WHERE f.StudentKey IS NOT NULL{fact} GROUP BY s.FullNameArab HAVING count(*) >= 3
            ORDER BY absence_rate DESC, student_name LIMIT 10""",
        "a3_att_vs_score": f"""SELECT s.FullNameArab AS student_name, {pct(when('att.Checks = 0'), 'count(att.FactKey)')} AS absence_rate,
            {up(avg('ev.Average'), 2)} AS avg_score FROM fact_student_attendance att
            JOIN dim_student s ON att.StudentKey = s.StudentKey JOIN dim_evaluation_report er ON er.StudentOid = s.StudentOid
            JOIN fact_student_evaluation ev ON ev.EvaluationReportKey = er.EvaluationReportKey
            WHERE att.StudentKey IS NOT NULL AND s.StudentOid IS NOT NULL AND ev.Average IS NOT NULL{in_year('er', y)}
            GROUP BY s.FullNameArab HAVING count(att.FactKey) >= 3 AND count(ev.FactKey) >= 3""",
    }


def _daily(y: bool | str) -> str:
    absent = when("f.Checks = 0")
    return f"""SELECT d.FullDate AS full_date, count(*) AS total, {absent} AS absent_count, {pct(absent, 'count(*)')} AS absence_rate
        FROM fact_student_attendance f JOIN dim_date d ON f.DateKey = d.DateKey
        WHERE f.StudentKey IS NOT NULL AND d.DateKey <> -1 AND d.FullDate IS NOT NULL{in_year('f', y)} GROUP BY d.FullDate"""


def rate_mean(x: str, n: int = 1) -> str:
    return even(f"CAST(sum(CAST({x} AS DECIMAL(12,1))) AS DOUBLE) / count({x})", n)


WEATHER = "SELECT full_date, coalesce(precipitation_sum, 0.0) AS precipitation_mm, coalesce(precipitation_sum, 0.0) > 1.0 AS is_rainy FROM weather_daily"


def _weather(y: bool) -> dict[str, str]:
    joined = f"""SELECT a.*, coalesce(w.precipitation_mm, 0.0) AS precipitation_mm, coalesce(w.is_rainy, false) AS is_rainy
        FROM ({_daily(y)}) a LEFT JOIN ({WEATHER}) w ON a.full_date = w.full_date"""
    absent = when("f.Checks = 0")
    return {
        "a4_weather_vs_absence": f"""SELECT strftime(full_date, '%Y-%m-%d') AS full_date, total, absent_count, absence_rate,
            precipitation_mm, is_rainy FROM ({joined}) ORDER BY full_date""",
        "a4_rainy_vs_dry": f"""SELECT {rate_mean('CASE WHEN is_rainy THEN absence_rate END')} AS rainy_avg, {when('is_rainy')} AS n_rainy,
            {rate_mean('CASE WHEN NOT is_rainy THEN absence_rate END')} AS dry_avg, {when('NOT is_rainy')} AS n_dry FROM ({joined})""",
        "a4_seasonal": f"""SELECT m.month, m.month_name, m.absence_rate, m.sample_start, m.sample_end,
            coalesce({even("r.mm", 1)}, 0.0) AS avg_precipitation FROM (
            SELECT d.MonthNumber AS month, d.MonthName AS month_name, {pct(absent, 'count(*)')} AS absence_rate,
            min(strftime(d.FullDate, '%Y-%m-%d')) AS sample_start, max(strftime(d.FullDate, '%Y-%m-%d')) AS sample_end
            FROM fact_student_attendance f JOIN dim_date d ON f.DateKey = d.DateKey
            WHERE f.StudentKey IS NOT NULL AND d.DateKey <> -1 AND d.FullDate IS NOT NULL{in_year('f', y)}
            GROUP BY d.MonthNumber, d.MonthName) m
            LEFT JOIN (SELECT month(full_date) AS month, CAST(sum(CAST(precipitation_mm AS DECIMAL(18,6))) AS DOUBLE) / count(*) AS mm
            FROM ({WEATHER}) WHERE full_date BETWEEN (SELECT min(full_date) FROM ({_daily(y)})) AND (SELECT max(full_date) FROM ({_daily(y)}))
            GROUP BY 1) r ON m.month = r.month ORDER BY m.month""",
    }


def _pedagogy(y: bool) -> dict[str, str]:
    base = f"{BASE} AND er.EvaluationReportKey <> 1{in_year('er', y)}"
    score = "CAST(f.Average AS DOUBLE)"
    name = "CAST(er.EvaluationReportKey AS VARCHAR) AS report_name"
    return {
        "a5_outcomes": f"""SELECT {name}, c.Description AS subject, sy.Description AS year_label, {AVG_SCORE},
            {up(f'stddev_samp({score})', 2)} AS score_stddev, count(DISTINCT er.StudentOid) AS student_count, {PASS_RATE}
            FROM {SCORED} {SUBJECT} {YEARS} WHERE {base} AND c.ContentKey <> 1 AND sy.SchoolYearKey <> 1
            GROUP BY er.EvaluationReportKey, c.Description, sy.Description ORDER BY sy.Description, er.EvaluationReportKey, subject""",
        "a5_dispersion": f"""SELECT {name}, {up(f'min({score})', 2)} AS score_min, {up(f'max({score})', 2)} AS score_max,
            {up(avg('f.Average'), 2)} AS score_avg, {up(f'stddev_samp({score})', 2)} AS score_stddev, count(*) AS n
            FROM {SCORED} WHERE {base} GROUP BY er.EvaluationReportKey ORDER BY er.EvaluationReportKey""",
        "a5_presence_perf": f"""SELECT {name}, {AVG_SCORE}, {pct(when('att.Checks > 0'), 'count(att.FactKey)')} AS presence_rate
            FROM {SCORED} LEFT JOIN dim_student ds ON ds.StudentOid = er.StudentOid
            LEFT JOIN fact_student_attendance att ON att.StudentKey = ds.StudentKey
            WHERE {base} GROUP BY er.EvaluationReportKey ORDER BY er.EvaluationReportKey""",
    }


def _risk(y: bool) -> dict[str, str]:
    score, fail, absent = avg("f.Average"), (FAIL, "count(*)"), (when("att.Checks = 0"), "count(*)")
    from_base = f"FROM {SCORED} WHERE {BASE}{in_year('er', y)} GROUP BY er.StudentOid"
    from_att = """FROM fact_student_attendance att JOIN dim_student s ON att.StudentKey = s.StudentKey
        WHERE att.StudentKey IS NOT NULL GROUP BY s.StudentOid"""
    rounded = f"""academic AS (SELECT er.StudentOid, {up(score, 2)} AS avg_score, {pct(*fail)} AS fail_rate_pct {from_base}),
        attendance AS (SELECT s.StudentOid, {pct(*absent)} AS absence_rate {from_att})"""
    exact = f"""academic AS (SELECT er.StudentOid, {score} AS avg_score, {raw_pct(*fail)} AS fail_rate_pct {from_base}),
        attendance AS (SELECT s.StudentOid, {raw_pct(*absent)} AS absence_rate {from_att})"""
    risk = """(CASE WHEN a.avg_score < 10 THEN (10 - a.avg_score) * 4.0::DOUBLE ELSE 0.0 END)
        + coalesce(att.absence_rate, 0.0) * 0.35::DOUBLE + a.fail_rate_pct * 0.25::DOUBLE"""
    level = f"CASE WHEN CAST({risk} AS {DEC}) >= 60 THEN 'High' WHEN CAST({risk} AS {DEC}) >= 35 THEN 'Medium' ELSE 'Low' END"
    flags = ["a.avg_score < 10", "coalesce(att.absence_rate, 0.0) > 20", "a.fail_rate_pct > 50"]
    low, absence, failing = [f"CASE WHEN {c} THEN 1 ELSE 0 END" for c in flags]
    return {
        "a6_risk_scores": f"""WITH {rounded}, payment AS (SELECT s.StudentOid, count(*) AS payment_count FROM fact_student_payment p
            JOIN dim_student s ON p.StudentKey = s.StudentKey WHERE p.StudentKey IS NOT NULL GROUP BY s.StudentOid)
            SELECT s.FullNameArab AS student_name, a.avg_score, coalesce(att.absence_rate, 0.0) AS absence_rate, a.fail_rate_pct,
            coalesce(pay.payment_count, 0) AS payment_count, {up(risk, 1)} AS risk_score, {level} AS risk_level
            FROM academic a JOIN dim_student s ON a.StudentOid = s.StudentOid
            LEFT JOIN attendance att ON a.StudentOid = att.StudentOid LEFT JOIN payment pay ON a.StudentOid = pay.StudentOid
            ORDER BY risk_score DESC, student_name, s.StudentOid LIMIT 30""",
        "a6_risk_distribution": f"""WITH {exact}, rated AS (SELECT {level} AS risk_level, a.avg_score, coalesce(att.absence_rate, 0.0) AS absence_rate
            FROM academic a LEFT JOIN attendance att ON a.StudentOid = att.StudentOid)
            SELECT risk_level, count(*) AS student_count, {up(f'CAST(sum(CAST(avg_score AS {DEC})) AS DOUBLE) / count(*)', 2)} AS avg_score,
            {up(f'CAST(sum(CAST(absence_rate AS {DEC})) AS DOUBLE) / count(*)', 1)} AS avg_absence_rate
            FROM rated GROUP BY risk_level ORDER BY CASE risk_level WHEN 'High' THEN 1 WHEN 'Medium' THEN 2 ELSE 3 END""",
        "a6_early_warning": f"""WITH {exact} SELECT s.FullNameArab AS student_name, {up('a.avg_score', 2)} AS avg_score,
            {up('coalesce(att.absence_rate, 0.0)', 1)} AS absence_rate, {up('a.fail_rate_pct', 1)} AS fail_rate_pct,
            {low} AS flag_low_score, {absence} AS flag_high_absence, {failing} AS flag_high_fail_rate,
            {low} + {absence} + {failing} AS warning_count
            FROM academic a JOIN dim_student s ON a.StudentOid = s.StudentOid LEFT JOIN attendance att ON a.StudentOid = att.StudentOid
            WHERE {low} + {absence} + {failing} >= 2
            ORDER BY warning_count DESC, a.avg_score, student_name, s.StudentOid LIMIT 20""",
    }


def _fanout(y: bool, on_attendance: str = "") -> str:
    return f"""dim_student s LEFT JOIN fact_student_attendance att ON s.StudentKey = att.StudentKey{on_attendance}
        LEFT JOIN dim_evaluation_report er ON er.StudentOid = s.StudentOid{in_year('er', y)}
        LEFT JOIN fact_student_evaluation ev ON ev.EvaluationReportKey = er.EvaluationReportKey AND ev.Average IS NOT NULL"""


ABSENCE = f"{pct(when('att.Checks = 0'), 'count(att.FactKey)')} AS absence_rate"
LATE = f"{pct(when('att.LateMinutes > 0'), 'count(att.FactKey)')} AS late_rate"
FANOUT_SCORE = f"{up(avg('ev.Average'), 2)} AS avg_score"
FANOUT_PASS = f"{pct(when('ev.Average >= 10'), 'count(ev.FactKey)')} AS pass_rate"


def _geography(y: bool) -> dict[str, str]:
    return {
        "a7_by_zone": f"""SELECT s.Governorate AS zone_name, count(DISTINCT s.StudentKey) AS student_count, {ABSENCE}, {LATE}, {FANOUT_SCORE}
            FROM {_fanout(y)} WHERE s.StudentKey IS NOT NULL AND s.Governorate IS NOT NULL AND s.Governorate <> ''
            GROUP BY s.Governorate ORDER BY student_count DESC, zone_name""",
        "a7_governorate": f"""SELECT coalesce(s.Governorate, 'Unknown') AS governorate, count(DISTINCT s.StudentOid) AS student_count, {ABSENCE}, {LATE}
            FROM dim_student s LEFT JOIN fact_student_attendance att ON s.StudentKey = att.StudentKey{in_year('att', y)}
            WHERE s.StudentOid IS NOT NULL GROUP BY s.Governorate ORDER BY student_count DESC, governorate""",
        "a7_zone_detail": f"""SELECT s.FullNameArab AS student_name, coalesce(s.Governorate, 'Unknown') AS zone_name, {ABSENCE}, {LATE}, {FANOUT_SCORE}
            FROM {_fanout(y)} WHERE s.StudentOid IS NOT NULL AND s.Governorate = {text(ZONE)}
            GROUP BY s.FullNameArab, s.Governorate HAVING count(att.FactKey) >= 3
            ORDER BY absence_rate DESC NULLS LAST, student_name LIMIT 15""",
    }


def _calendar_label(wanted: str) -> str:
    """Days of a year without a calendar are tagged by the default one."""
    return f"(SELECT coalesce((SELECT any_value(year_label) FROM academic_calendar WHERE year_label = {wanted}), '2024-2025'))"


def _periods(y: bool | str) -> dict[str, str]:
    wanted = f"(SELECT Description FROM dim_school_year WHERE SchoolYearKey = {SCHOOL_YEAR if y is True else y})" if y else "'2024-2025'"
    label = _calendar_label(wanted)  # holidays of a year without a calendar are none
    tagged = f"""SELECT a.full_date, any_value(a.total) AS total, any_value(a.absence_rate) AS absence_rate,
        coalesce(min_by(c.type, c.ordinal), 'normal') AS period_type, coalesce(min_by(c.label, c.ordinal), 'Normal Period') AS period_label
        FROM ({_daily(y)}) a LEFT JOIN (SELECT * FROM academic_calendar WHERE year_label = {label}) c
        ON a.full_date BETWEEN c.first_day AND c.last_day GROUP BY a.full_date"""
    return {
        "a8_by_period": f"""SELECT p.period_type, p.period_label, coalesce(r.rate, 0.0) AS avg_absence_rate, coalesce(r.days, 0) AS n_days
            FROM period_types p LEFT JOIN (SELECT period_type, {rate_mean('absence_rate')} AS rate, count(*) AS days FROM ({tagged})
            GROUP BY period_type) r ON p.period_type = r.period_type ORDER BY p.ordinal""",
        "a8_daily_tagged": f"""SELECT strftime(full_date, '%Y-%m-%d') AS full_date, absence_rate, total AS total_records, period_type, period_label
            FROM ({tagged}) ORDER BY full_date""",
        "a8_holiday_impact": f"""SELECT h.label AS holiday_label, strftime(h.first_day, '%Y-%m-%d') AS start, strftime(h.last_day, '%Y-%m-%d') AS "end",
            {rate_mean('CASE WHEN a.full_date < h.first_day THEN a.absence_rate END')} AS pre_avg_absence,
            {rate_mean('CASE WHEN a.full_date > h.last_day THEN a.absence_rate END')} AS post_avg_absence
            FROM academic_calendar h LEFT JOIN ({_daily(y)}) a
            ON (a.full_date BETWEEN h.first_day - 5 AND h.first_day - 1) OR (a.full_date BETWEEN h.last_day + 1 AND h.last_day + 5)
            WHERE h.year_label = {wanted} AND h.type = 'holiday'
            GROUP BY h.ordinal, h.label, h.first_day, h.last_day ORDER BY h.ordinal""",
    }


def _schools(y: bool) -> dict[str, str]:
    def weighted(x: str, n: int) -> str:
        total = f"CAST(sum(CAST({x} AS DECIMAL(12,2)) * CAST(student_count AS DECIMAL(18,0))) AS DOUBLE)"
        return f"{even(f'{total} / nullif(CAST(sum(CASE WHEN {x} IS NOT NULL THEN student_count END) AS DOUBLE), 0)', n)} AS {x}"

    named = "s.StudentOid IS NOT NULL AND s.BacType IS NOT NULL AND s.BacType <> ''"
    raw = f"""SELECT s.BacType, count(DISTINCT s.StudentKey) AS student_count, {FANOUT_SCORE}, {FANOUT_PASS}, {ABSENCE}
        FROM {_fanout(y)} WHERE {named} GROUP BY s.BacType"""
    plain = f"""SELECT s.BacType, count(DISTINCT s.StudentKey) AS student_count, {FANOUT_SCORE}, {FANOUT_PASS} FROM dim_student s
        LEFT JOIN dim_evaluation_report er ON er.StudentOid = s.StudentOid{in_year('er', y)}
        LEFT JOIN fact_student_evaluation ev ON ev.EvaluationReportKey = er.EvaluationReportKey AND ev.Average IS NOT NULL
        WHERE {named} GROUP BY s.BacType HAVING count(DISTINCT s.StudentKey) >= 3"""
    total = "CAST(sum(student_count) AS BIGINT)"
    return {
        "a9_perf_by_school": f"""SELECT n.canonical AS school_name, {total} AS student_count, {weighted('avg_score', 2)}, {weighted('pass_rate', 1)},
            {weighted('absence_rate', 1)} FROM ({raw}) r JOIN school_names n ON r.BacType = n.BacType GROUP BY n.canonical
            ORDER BY student_count DESC, school_name""",
        "a9_school_ranking": f"""SELECT n.canonical AS school_name, {total} AS student_count, {weighted('avg_score', 2)}, {weighted('pass_rate', 1)}
            FROM ({plain}) r JOIN school_names n ON r.BacType = n.BacType GROUP BY n.canonical HAVING sum(student_count) >= 5
            ORDER BY avg_score DESC NULLS LAST, school_name""",
        "a9_students_from_school": f"""SELECT s.FullNameArab AS student_name, s.BacType AS prev_school, {FANOUT_SCORE}, {ABSENCE}, {FANOUT_PASS}
            FROM {_fanout(y)} JOIN school_names n ON s.BacType = n.BacType WHERE {named} AND n.canonical = {text(SCHOOL)}
            GROUP BY s.FullNameArab, s.BacType HAVING count(ev.FactKey) >= 2
            ORDER BY avg_score DESC NULLS LAST, student_name, prev_school""",
    }


def _tagged_days(label: str) -> str:
    return f"""SELECT strftime(d.FullDate, '%Y-%m-%d') AS full_date, coalesce(min_by(c.type, c.ordinal), 'normal') AS period_type,
            coalesce(min_by(c.label, c.ordinal), 'Normal Period') AS period_label FROM dim_date d
            LEFT JOIN (SELECT * FROM academic_calendar WHERE year_label = {label}) c ON d.FullDate BETWEEN c.first_day AND c.last_day
            GROUP BY d.DateKey, d.FullDate"""


def _etl() -> dict[str, str]:
    months = [str(m) for m in range(1, 13)]
    number = lambda x: f"round_even(TRY_CAST(replace({x}, ',', '.') AS DOUBLE) * 100, 0) / 100"
    money = ["TR1", "TR2", "Tranche 1(22-23)", "Tranche_1_24_25"]
    report = "student_service_report WHERE GCRecord IS NULL"
    tall = " UNION ALL ".join(
        f"""SELECT Oid AS SourceOid, Student AS StudentOid, SchoolService AS ServiceOid, Branch AS BranchOid,
        CurrentSchoolYear AS SchoolYearOid, {m} AS MonthNumber, {number(f'"{m}"')} AS Amount FROM {report} AND "{m}" IS NOT NULL"""
        for m in months
    )
    slices = {"TR1": 1, "TR2": 2, "Tranche 1(22-23)": 1, "Tranche_1_24_25": 1, "TR1_solde": 1}
    matching = [c for c in slices if c != "TR1_solde"]
    tranches = " UNION ALL ".join(
        f"""SELECT Oid AS SourceOid, Student AS StudentOid, SchoolService AS ServiceOid, Branch AS BranchOid, CurrentSchoolYear AS SchoolYearOid,
        Zone AS ZoneOid, ShuttleType AS ShuttleTypeOid, {number(f'CAST("{c}" AS VARCHAR)')} AS Amount, {slices[c]} AS SliceNumber
        FROM student_service_report_tranche WHERE "{c}" IS NOT NULL"""
        for c in matching
    )
    balance = tranches.split(" UNION ALL ")[1]  # Tranche_2_solde holds what TR2 does
    first = "substr(Oid, 1, 1)"
    dirty_cells = " UNION ALL ".join(
        f"""SELECT Oid AS SourceOid, Student AS StudentOid, SchoolService AS ServiceOid, Branch AS BranchOid, CurrentSchoolYear AS SchoolYearOid,
        {m} AS MonthNumber, CASE WHEN {first} IN ('0', '1', '2', '3') THEN NULL WHEN {first} = '4' THEN 0.12 WHEN {first} = '5' THEN 7.5
        ELSE {number(f'"{m}"')} END AS Amount FROM {report} AND "{m}" IS NOT NULL"""
        for m in months
    )
    dirty = f"SELECT * FROM ({dirty_cells}) WHERE Amount IS NOT NULL"
    row_sum = " + ".join(f'coalesce(CAST("{c}" AS DOUBLE), 0.0)' for c in money)
    keys = lambda student, service, branch, year, a: f"""  -- surrogate keys with fallback to the unknown member
        coalesce((SELECT max(StudentKey) FROM dim_student WHERE StudentOid = {a}.{student}), 1) AS StudentKey,
        coalesce((SELECT max(ServiceKey) FROM dim_service WHERE ServiceOid = {a}.{service}), 1) AS ServiceKey,
        coalesce((SELECT max(BranchKey) FROM dim_branch WHERE BranchOid = {a}.{branch}), 1) AS BranchKey,
        coalesce((SELECT max(SchoolYearKey) FROM dim_school_year WHERE SchoolYearOid = {a}.{year}), 1) AS SchoolYearKey"""  # noqa: E731
    fact = f"""SELECT {keys('StudentOid', 'ServiceOid', 'BranchOid', 'SchoolYearOid', 't')}, -1 AS DateKey, 1 AS ZoneKey, 1 AS ShuttleTypeKey,
        t.SourceOid, t.MonthNumber, t.Amount AS MonthlyAmount FROM ({tall}) t"""
    tranche_source = f"""SELECT Oid, Student, SchoolService, Branch, CurrentSchoolYear, Zone, ShuttleType, "Order", GCRecord, OptimisticLockField,
        {', '.join(f'CAST("{c}" AS DOUBLE) AS "{c}"' for c in slices)} FROM student_service_report_tranche"""
    old = f"(SELECT SchoolYearOid FROM dim_school_year WHERE StartDate < date '{PREVIOUS_YEARS}')"
    unknown = {
        "BranchKey": "dim_branch WHERE Code = 'UNKNOWN'",
        "StudentKey": "dim_student WHERE StudentOid = '00000000-0000-0000-0000-000000000000'",
        "ServiceKey": "dim_service WHERE Code = 'UNKNOWN'",
        "SchoolYearKey": "dim_school_year WHERE Code = 'UNKNOWN'",
        "ZoneKey": "dim_zone WHERE Code = 'UNKNOWN'",
        "ShuttleTypeKey": "dim_shuttle_type WHERE Code = 'UNKNOWN'",
        "DateKey": "dim_date WHERE DateKey = -1",
    }
    return {
        "scan_filter": "SELECT StudentKey, PaidAmount FROM fact_student_payment WHERE PaidAmount >= 100000",
        "scan_soft_delete": f"SELECT * FROM {report}",
        "scan_tranche_numeric": tranche_source,
        "dim_keys": "SELECT StudentOid, StudentKey FROM dim_student",
        "date_keys": "SELECT DateKey, strftime(FullDate, '%Y-%m-%d') AS FullDate FROM dim_date",
        "weather_days": f"SELECT strftime(full_date, '%Y-%m-%d') AS full_date, precipitation_mm, is_rainy FROM ({WEATHER})",
        "comma_decimal": "SELECT Oid, " + ", ".join(f'{number(chr(34) + m + chr(34))} AS m{m}' for m in months) + f" FROM {report}",
        "unpivot_revenue": tall,
        "revenue_cast_report": f"""SELECT MonthNumber, count(*) AS filled, count(Amount) AS "read", count(*) - count(Amount) AS dropped
            FROM ({tall}) GROUP BY MonthNumber""",
        "unpivot_tranche": tranches,
        "tranche_row_sum": f"SELECT Oid, {row_sum} AS Amount FROM student_service_report_tranche",
        "unknown_keys": "SELECT " + ", ".join(f"coalesce((SELECT min({k}) FROM {src}), -1) AS {k}" for k, src in unknown.items()),
        "resolve_keys": f"""SELECT r.Oid, {keys('Student', 'SchoolService', 'Branch', 'CurrentSchoolYear', 'r')}
            FROM (SELECT * FROM {report}) r""",
        "anti_revenue": f"SELECT SourceOid, MonthNumber, Amount FROM ({tall}) WHERE MonthNumber > {FIRST_TERM}",
        "anti_tranche": f"""SELECT Oid AS SourceOid, Student, "Order" FROM student_service_report_tranche WHERE CurrentSchoolYear NOT IN {old}""",
        "fact_service_revenue": f"SELECT * FROM ({fact}) WHERE MonthNumber > {FIRST_TERM}",
        "fact_service_tranche": f"""SELECT {keys('Student', 'SchoolService', 'Branch', 'CurrentSchoolYear', 'r')}, r.Oid AS SourceOid,
            r."Order" AS SortOrder, {row_sum} AS Amount FROM student_service_report_tranche r WHERE CurrentSchoolYear NOT IN {old}""",
        "load_counts": f"""SELECT {when(f'MonthNumber > {FIRST_TERM}')} AS inserted, {when(f'MonthNumber <= {FIRST_TERM}')} AS skipped
            FROM ({tall})""",
        "append_load": fact,
        "duplicate_keys": """SELECT EvaluationReportKey, ContentKey, count(*) AS copies FROM fact_student_evaluation
            GROUP BY EvaluationReportKey, ContentKey HAVING count(*) > 1""",
        "duplicate_revenue_keys": f"""SELECT SourceOid, MonthNumber, 2 * count(*) AS copies FROM ({tall}) WHERE MonthNumber = 1
            GROUP BY SourceOid, MonthNumber""",
        "unpivot_dirty": dirty,
        "dirty_cast_report": f"""SELECT MonthNumber, count(*) AS filled, count(Amount) AS "read", count(*) - count(Amount) AS dropped
            FROM ({dirty_cells}) GROUP BY MonthNumber""",
        "unpivot_balances": f"{tranches} UNION ALL {balance}",
        "unpivot_no_balances": tranches,
        "tranche_cast_report": " UNION ALL ".join(
            f"""SELECT '{name}' AS TrancheName, count("{c}") AS filled, count("{c}") AS "read", 0 AS dropped FROM student_service_report_tranche
            HAVING count("{c}") > 0"""
            for name, c in [*((c, c) for c in matching), ("Tranche_2_solde", "TR2")]
        ),
        "key_copies": " UNION ALL ".join(
            f"""SELECT '{name}' AS "table", '{key}' AS "key", (SELECT count(*) FROM (SELECT {key} FROM {view} WHERE {key} IS NOT NULL
            GROUP BY {key} HAVING count(*) > 1)) AS held_twice"""
            for name, view, key in [
                ("DimStudent", "dim_student", "StudentKey"), ("DimStudent", "dim_student", "StudentOid"),
                ("DimEvaluationReport", "dim_evaluation_report", "EvaluationReportKey"),
            ]
        ),
        "calendar_tag": _tagged_days("'2024-2025'"),
        **{f"calendar_tag_{name}": _tagged_days(_calendar_label(f"(SELECT Description FROM dim_school_year WHERE SchoolYearKey = {year})"))
           for name, year in CALENDAR_YEARS.items()},
        "normalize_school": """SELECT s.StudentKey, n.canonical FROM dim_student s
            JOIN school_names n ON s.BacType IS NOT DISTINCT FROM n.BacType""",
    }


def _rollups() -> dict[str, str]:
    middle = "(CAST(split_part(bin, '-', 1) AS DOUBLE) + CAST(split_part(bin, '-', 2) AS DOUBLE)) / 2"
    fixed = lambda x, n: up(f"CAST(sum(CAST({x} AS DECIMAL(14,2))) AS DOUBLE) / count(*)", n)
    last = lambda name, table, order: f"(SELECT {name} FROM {table} ORDER BY {order} LIMIT 1)"
    rebuilt = lambda part: f"CAST(floor(n_evaluations * ({part}) + 0.5) AS BIGINT)"
    spread = "coalesce(score_stddev, 0.0)"
    return {
        "rollup_histogram_share": f"""SELECT bin, count, {up('100.0::DOUBLE * count / (SELECT sum(count) FROM a1_score_distribution)', 1)} AS share_pct,
            CASE WHEN {middle} < 10 THEN 'rose' WHEN {middle} < 14 THEN 'amber' ELSE 'teal' END AS band FROM a1_score_distribution""",
        "rollup_year_progression": f"SELECT year_label, {fixed('avg_score', 2)} AS avg_score FROM a2_progression GROUP BY year_label",
        "rollup_progression_summary": f"""SELECT (SELECT count(DISTINCT year_label) FROM a2_progression) AS years_tracked,
            (SELECT {when("trend_label = 'Improvement'")} FROM a2_regression) AS improving,
            (SELECT {when("trend_label = 'Regression'")} FROM a2_regression) AS regressing,
            (SELECT {when('score_stddev < 1.5')} FROM a2_stability) AS stable_profiles,
            (SELECT {fixed('score_stddev', 2)} FROM a2_stability) AS avg_stddev,
            {last('student_name', 'a2_stability', 'score_stddev, student_name')} AS most_stable,
            {last('student_name', "all_trends WHERE trend_label = 'Regression'", 'delta, student_name')} AS biggest_regression,
            {last('student_name', "all_trends WHERE trend_label = 'Improvement'", 'delta DESC, student_name DESC')} AS biggest_improvement""",
        "rollup_subject_extremes": f"""SELECT {last('subject', 'a1_avg_by_subject', 'avg_score DESC, subject')} AS best_subject,
            {last('subject', 'a1_avg_by_subject', 'avg_score, subject DESC')} AS weakest_subject,
            (SELECT CAST(CAST(min_score AS DECIMAL(10,2)) AS VARCHAR) || ' – ' || CAST(CAST(max_score AS DECIMAL(10,2)) AS VARCHAR) || ' / 20'
            FROM a1_kpis) AS score_range""",
        "rollup_subject_bands": """SELECT subject, avg_score, CASE WHEN avg_score >= 12 THEN 'teal' WHEN avg_score >= 10 THEN 'amber'
            ELSE 'rose' END AS band FROM a1_avg_by_subject""",
        "rollup_subject_pass_fail": f"""SELECT subject, CASE WHEN pass_count > 0 THEN pass_count ELSE {rebuilt('pass_rate / 100')} END AS pass_count,
            CASE WHEN fail_count > 0 THEN fail_count ELSE {rebuilt('1 - pass_rate / 100')} END AS fail_count
            FROM (SELECT * FROM a1_avg_by_subject ORDER BY avg_score DESC, subject LIMIT 8)""",
        "rollup_absence_bands": """SELECT student_name, absence_rate, CASE WHEN absence_rate >= 35 THEN 'rose' WHEN absence_rate >= 20 THEN 'amber'
            ELSE 'teal' END AS band FROM a3_top_absent""",
        "rollup_risk_quadrants": """SELECT student_name, absence_rate, avg_score, CASE WHEN avg_score < 10 AND absence_rate > 20 THEN 'rose'
            WHEN avg_score >= 14 THEN 'teal' ELSE 'amber' END AS band FROM a3_att_vs_score""",
        "rollup_peak_absence_month": f"""SELECT {last('month_name', 'a3_absence_by_month', 'absence_rate DESC, year DESC, month DESC')} AS peak_month,
            (SELECT max(absence_rate) FROM a3_absence_by_month) AS peak_rate""",
        "rollup_absence_kpi": f"SELECT coalesce(absence_rate, {up('100.0 - presence_rate', 1)}) AS absence_rate FROM a3_kpis",
        "rollup_weather_sensitivity": f"""SELECT (SELECT CASE WHEN rainy_avg <> 0 AND dry_avg <> 0 THEN {up('rainy_avg - dry_avg', 1)} END
            FROM a4_rainy_vs_dry) AS sensitivity,
            {last('month_name', 'a4_seasonal', 'avg_precipitation DESC, month DESC')} AS rainiest_month,
            {last('month_name', 'a4_seasonal', 'absence_rate DESC, month DESC')} AS worst_month""",
        "rollup_weather_series": """SELECT CASE WHEN is_rainy THEN 'Rainy' ELSE 'Dry' END AS series, full_date, precipitation_mm, absence_rate
            FROM a4_weather_vs_absence""",
        "rollup_dispersion_bands": f"""SELECT report_name, {up(f'greatest(0.0, score_avg - {spread})', 2)} AS band_low,
            {up(f'least(20.0, score_avg + {spread})', 2)} AS band_high FROM a5_dispersion""",
        "rollup_report_summary": f"""SELECT count(*) AS reports, max(score_avg) AS best_avg, max({spread}) AS highest_dispersion,
            {last('report_name', 'a5_dispersion', 'score_avg DESC, CAST(report_name AS BIGINT) DESC')} AS best_report,
            {last('report_name', 'a5_dispersion', f'{spread} DESC, CAST(report_name AS BIGINT) DESC')} AS most_volatile,
            CAST(sum(n) AS BIGINT) AS evaluations, (SELECT count(*) FROM a5_subject_list) AS subjects FROM a5_dispersion""",
        "rollup_risk_summary": f"""SELECT CAST(coalesce(sum(CASE WHEN risk_level = 'High' THEN student_count END), 0) AS BIGINT) AS high,
            CAST(coalesce(sum(CASE WHEN risk_level = 'Medium' THEN student_count END), 0) AS BIGINT) AS medium,
            CAST(sum(student_count) AS BIGINT) AS analysed,
            (SELECT {when('warning_count >= 3')} FROM a6_early_warning) AS three_flags,
            {last('student_name', 'a6_risk_scores', 'risk_score DESC, student_name')} AS highest_risk FROM a6_risk_distribution""",
        "rollup_risk_top": """SELECT student_name, risk_score, risk_level FROM a6_risk_scores
            ORDER BY risk_score DESC, student_name LIMIT 15""",
        "rollup_warning_levels": """SELECT student_name, warning_count, CASE WHEN warning_count >= 3 THEN 'High' ELSE 'Medium' END AS level
            FROM a6_early_warning""",
        "rollup_zone_summary": f"""SELECT count(*) AS zones, CAST(sum(student_count) AS BIGINT) AS students,
            {fixed('coalesce(absence_rate, 0.0)', 1)} AS avg_absence,
            {last('zone_name', 'a7_by_zone', 'student_count DESC, zone_name DESC')} AS top_zone FROM a7_by_zone""",
        "rollup_period_summary": f"""SELECT {last('p.period_label', 'a8_by_period p JOIN period_types t USING (period_type)', 'avg_absence_rate DESC, t.ordinal DESC')} AS highest_period,
            max(avg_absence_rate) AS highest_rate,
            {last('p.period_label', 'a8_by_period p JOIN period_types t USING (period_type)', 'avg_absence_rate, t.ordinal DESC')} AS lowest_period,
            min(avg_absence_rate) AS lowest_rate, CAST(sum(n_days) AS BIGINT) AS days FROM a8_by_period""",
        "rollup_school_summary": f"""SELECT count(*) AS schools,
            {last('school_name', 'a9_perf_by_school', 'coalesce(avg_score, 0) DESC, student_count, school_name DESC')} AS best_school,
            max(avg_score) AS best_avg, max(coalesce(pass_rate, 0.0)) AS top_pass_rate, CAST(sum(student_count) AS BIGINT) AS students
            FROM a9_perf_by_school""",
        "rollup_school_top": """SELECT school_name, avg_score, pass_rate FROM a9_perf_by_school
            ORDER BY student_count DESC, school_name LIMIT 10""",
        "rollup_current_year": "SELECT SchoolYearKey, YearLabel FROM school_years WHERE IsCurrent ORDER BY SchoolYearKey LIMIT 1",
    }


def _named() -> dict[str, str]:
    sections = (_performance, _presence, _weather, _pedagogy, _risk, _geography, _periods, _schools)
    plain = {k: v for section in sections for k, v in section(False).items()}
    one_year = {f"{k}_year": v for section in sections for k, v in section(True).items()}
    calendars = {f"{k}_{name}": v for name, year in CALENDAR_YEARS.items() for k, v in _periods(year).items()}
    chosen = {
        "a1_kpis_oid": _performance(SCHOOL_YEAR)["a1_kpis"],  # the Oid of the same year
        "a1_kpis_unknown_year": _performance(False)["a1_kpis"],  # an unknown key is no filter
        "a2_progression_student": f"SELECT p.* FROM a2_progression p JOIN dim_student s ON p.student_name = s.FullNameArab WHERE s.StudentOid = '{STUDENT_OID}'",
        "a5_outcomes_subject": f"SELECT * FROM a5_outcomes WHERE subject = {text(SUBJECT_NAME)}",
    }
    return {**plain, **one_year, **calendars, **chosen, **_progression(), **_etl(), **_rollups()}


def _with_views(sql: str, library: dict[str, str]) -> str:
    """The statement behind a WITH list of the views it names, directly or through other views."""
    needed: list[str] = []

    def visit(statement: str) -> None:
        for word in re.findall(r"\b[a-z][a-z0-9_]*\b", statement):
            if word in library and word not in needed:
                visit(library[word])
                if word not in needed:
                    needed.append(word)

    visit(sql)
    listed = ",\n".join(f"{name} AS ({library[name]})" for name in needed)
    return f"WITH {listed}\nSELECT * FROM (\n{sql}\n)" if needed else sql


def oracle_statements() -> dict[str, str]:
    named = _named()
    helpers = {"all_trends": named.pop("all_trends")}
    library = {**VIEWS, **SEEDS, **helpers, **named}
    own = {key: {k: v for k, v in library.items() if k != key} for key in named}
    return {key: _with_views(sql, own[key]) for key, sql in named.items()}
