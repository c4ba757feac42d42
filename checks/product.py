"""The fan-out queries as plain joins (Spark SQL), to time them against the pre-aggregated plans."""

from scolaria.plans.registry import SCHOOL, ZONE

TABLES = ["DimStudent", "DimEvaluationReport", "FactStudentEvaluation", "FactStudentAttendance"]

_OUTER = """DimStudent s LEFT JOIN FactStudentAttendance att ON s.StudentKey = att.StudentKey
    LEFT JOIN DimEvaluationReport er ON er.StudentOid = s.StudentOid
    LEFT JOIN FactStudentEvaluation ev ON ev.EvaluationReportKey = er.EvaluationReportKey AND ev.Average IS NOT NULL"""
_ABSENCE = "100.0D * count_if(att.Checks = 0) / nullif(count(att.FactKey), 0) AS absence_rate"
_LATE = "100.0D * count_if(att.LateMinutes > 0) / nullif(count(att.FactKey), 0) AS late_rate"
_SCORE = "avg(cast(ev.Average AS double)) AS avg_score"
_PASS = "100.0D * count_if(ev.Average >= 10) / nullif(count(ev.FactKey), 0) AS pass_rate"

STATEMENTS = {
    "a3_att_vs_score": f"""SELECT s.FullNameArab, {_ABSENCE}, {_SCORE} FROM FactStudentAttendance att
        JOIN DimStudent s ON att.StudentKey = s.StudentKey JOIN DimEvaluationReport er ON er.StudentOid = s.StudentOid
        JOIN FactStudentEvaluation ev ON ev.EvaluationReportKey = er.EvaluationReportKey
        WHERE ev.Average IS NOT NULL GROUP BY s.FullNameArab HAVING count(att.FactKey) >= 3""",
    "a5_presence_perf": f"""SELECT er.EvaluationReportKey, {_SCORE}, 100.0D * count_if(att.Checks > 0) / nullif(count(att.FactKey), 0)
        FROM FactStudentEvaluation ev JOIN DimEvaluationReport er ON ev.EvaluationReportKey = er.EvaluationReportKey
        LEFT JOIN DimStudent s ON s.StudentOid = er.StudentOid LEFT JOIN FactStudentAttendance att ON att.StudentKey = s.StudentKey
        WHERE er.StudentOid IS NOT NULL AND ev.Average IS NOT NULL AND er.EvaluationReportKey <> 1
        GROUP BY er.EvaluationReportKey ORDER BY er.EvaluationReportKey""",
    "a7_by_zone": f"""SELECT s.Governorate, count(DISTINCT s.StudentKey), {_ABSENCE}, {_LATE}, {_SCORE} FROM {_OUTER}
        WHERE s.Governorate <> '' GROUP BY s.Governorate""",
    "a7_zone_detail": f"""SELECT s.FullNameArab, {_ABSENCE}, {_LATE}, {_SCORE} FROM {_OUTER} WHERE s.Governorate = '{ZONE}'
        GROUP BY s.FullNameArab, s.Governorate HAVING count(att.FactKey) >= 3 ORDER BY absence_rate DESC LIMIT 15""",
    "a9_perf_by_school": f"""SELECT s.BacType, count(DISTINCT s.StudentKey), {_SCORE}, {_PASS}, {_ABSENCE} FROM {_OUTER}
        WHERE s.BacType <> '' GROUP BY s.BacType""",
    "a9_students_from_school": f"""SELECT s.FullNameArab, s.BacType, {_SCORE}, {_ABSENCE}, {_PASS} FROM {_OUTER}
        WHERE lower(s.BacType) LIKE '%{SCHOOL.split()[0].lower()}%' GROUP BY s.FullNameArab, s.BacType HAVING count(ev.FactKey) >= 2""",
}
