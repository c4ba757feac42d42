"""The school tables as SQL views over the generic test tables (DuckDB dialect)."""

_MONTHS = ",\n       ".join(
    "replace(cast(sum(CASE WHEN month(o_orderdate)={m} THEN cast(o_totalprice as decimal(18,2)) END) as string), '.', ',') AS \"{m}\"".format(m=m)
    for m in range(1, 13)
)

VIEWS = {
    "dim_school_year": """
SELECT 1 AS SchoolYearKey, md5('sy0') AS SchoolYearOid, 'UNKNOWN' AS Description,
       date '1900-01-01' AS StartDate, date '1900-01-01' AS EndDate, 'UNKNOWN' AS Code
UNION ALL
SELECT DISTINCT year(o_orderdate)-1993, md5(concat('sy', cast(year(o_orderdate) as string))),
       concat(cast(year(o_orderdate)+24 as string), '-', cast(year(o_orderdate)+25 as string)),
       cast(concat(cast(year(o_orderdate)+24 as string), '-09-01') as date),
       cast(concat(cast(year(o_orderdate)+25 as string), '-06-30') as date),
       concat(cast(year(o_orderdate)+24 as string), '-', cast(year(o_orderdate)+25 as string))
FROM orders""",
    "dim_student": """
SELECT 1 AS StudentKey, '00000000-0000-0000-0000-000000000000' AS StudentOid, 'UNKNOWN' AS FullNameArab,
       cast(null as string) AS Governorate, cast(null as string) AS BacType
UNION ALL
SELECT c_custkey+2, md5(concat('st', cast(c_custkey as string))), c_name,
       CASE WHEN c_custkey%20=0 THEN null WHEN c_custkey%20=1 THEN '' ELSE n_name END,
       CASE c_custkey%11 WHEN 0 THEN 'SLS Sousse' WHEN 1 THEN 'Ecole Allama' WHEN 2 THEN 'AVICENNE'
            WHEN 3 THEN 'Lycée Pilote' WHEN 4 THEN 'HS1' WHEN 5 THEN ' hs ' WHEN 6 THEN 'Les Élites'
            WHEN 7 THEN 'Village school' WHEN 8 THEN '' WHEN 9 THEN null ELSE 'Amad Sahloul' END
FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "dim_evaluation_report": """
SELECT o_orderkey+2 AS EvaluationReportKey,
       CASE WHEN o_orderkey%97=0 THEN null ELSE md5(concat('st', cast(o_custkey as string))) END AS StudentOid,
       md5(concat('sy', cast(year(o_orderdate) as string))) AS SchoolYearPeriodOid
FROM orders""",
    "dim_content": """
SELECT 1 AS ContentKey, 'UNKNOWN' AS Description
UNION ALL SELECT p_partkey+2, p_type FROM part""",
    "dim_date": """
SELECT -1 AS DateKey, cast(null as date) AS FullDate, cast(null as int) AS YearNumber,
       cast(null as int) AS MonthNumber, cast(null as string) AS MonthName
UNION ALL
SELECT year(d)*10000+month(d)*100+day(d), d, year(d), month(d), concat('M', cast(month(d) as string))
FROM (SELECT DISTINCT cast(date '2024-09-01' + cast(event_id%640 as int) as date) AS d FROM events) x""",
    "dim_branch": """
SELECT 1 AS BranchKey, md5('unknown') AS BranchOid, 'UNKNOWN' AS Code
UNION ALL SELECT DISTINCT c_custkey%5+2, md5(concat('br', cast(c_custkey%5 as string))),
       concat('B', cast(c_custkey%5 as string)) FROM customer""",
    "dim_service": """
SELECT 1 AS ServiceKey, md5('unknown') AS ServiceOid, 'UNKNOWN' AS Code
UNION ALL SELECT DISTINCT c_custkey%6+2, md5(concat('ct', cast(c_custkey%6 as string))),
       concat('S', cast(c_custkey%6 as string)) FROM customer WHERE c_custkey%6 < 5""",
    "dim_zone": """
SELECT 1 AS ZoneKey, md5('unknown') AS ZoneOid, 'UNKNOWN' AS Code
UNION ALL SELECT DISTINCT c_custkey%4+2, md5(concat('zo', cast(c_custkey%4 as string))),
       concat('Z', cast(c_custkey%4 as string)) FROM customer""",
    "dim_shuttle_type": """
SELECT 1 AS ShuttleTypeKey, md5('unknown') AS ShuttleTypeOid, 'UNKNOWN' AS Code
UNION ALL SELECT DISTINCT c_custkey%3+2, md5(concat('sh', cast(c_custkey%3 as string))),
       concat('S', cast(c_custkey%3 as string)) FROM customer""",
    "fact_student_evaluation": """
SELECT l_orderkey*10+l_linenumber AS FactKey, l_orderkey+2 AS EvaluationReportKey, l_partkey+2 AS ContentKey,
       CASE WHEN l_linenumber=7 THEN null
            ELSE cast(cast(cast(l_quantity as int)*8*(o_custkey%5+1) as decimal(9,2)) * cast(0.01 as decimal(3,2)) as decimal(5,2))
       END AS Average
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "fact_student_attendance": """
SELECT event_id AS FactKey, user_id+2 AS StudentKey, year(d)*10000+month(d)*100+day(d) AS DateKey,
       md5(concat('sy', case when d < date '2025-07-01' then '2000' else '2001' end)) AS SchoolYearPeriodOid,
       CASE WHEN event_type='error' OR (user_id%5=0 AND event_type IN ('click','view')) THEN 0
            ELSE 1+cast(event_id%3 as int) END AS Checks,
       CASE event_type WHEN 'signup' THEN cast(floor(value) as int)%15 WHEN 'view' THEN null ELSE 0 END AS LateMinutes
FROM (SELECT *, cast(date '2024-09-01' + cast(event_id%640 as int) as date) AS d FROM events) x""",
    "fact_teacher_attendance": """
SELECT l_suppkey+2 AS TeacherKey, year(d)*10000+month(d)*100+day(d) AS DateKey,
       md5(concat('sy', case when d < date '2025-07-01' then '2000' else '2001' end)) AS SchoolYearPeriodOid,
       cast(l_linenumber%4 as int) AS Checks,
       CASE WHEN l_returnflag='R' THEN cast(l_quantity as int) WHEN l_returnflag='N' THEN null ELSE 0 END AS LateMinutes
FROM (SELECT *, cast(date '2024-09-01' + cast(l_orderkey%640 as int) as date) AS d FROM lineitem) x""",
    "fact_student_payment": """
SELECT o_custkey+2 AS StudentKey, cast(o_totalprice as decimal(18,2)) AS PaidAmount FROM orders""",
    "weather_daily": """
SELECT d AS full_date, CASE WHEN i%9=0 THEN null ELSE cast((i*7)%11 as double)/2 END AS precipitation_sum
FROM (SELECT DISTINCT cast(date '2024-09-01' + cast(event_id%640 as int) as date) AS d, event_id%640 AS i FROM events) x""",
    "student_service_report": f"""
SELECT md5(concat('sr', cast(o_custkey as string), '-', cast(year(o_orderdate) as string))) AS Oid,
       md5(concat('st', cast(CASE WHEN o_custkey%13=0 THEN -1 ELSE o_custkey END as string))) AS Student,
       md5(concat('ct', cast(o_custkey%6 as string))) AS SchoolService, md5(concat('br', cast(o_custkey%5 as string))) AS Branch,
       md5(concat('sy', cast(year(o_orderdate) as string))) AS CurrentSchoolYear,
       CASE WHEN o_custkey%11=0 THEN 1 END AS GCRecord,
       {_MONTHS}
FROM orders GROUP BY o_custkey, year(o_orderdate)""",
    "student_service_report_tranche": """
SELECT md5(concat('tr', cast(o_orderkey as string))) AS Oid, md5(concat('st', cast(o_custkey as string))) AS Student,
       md5(concat('ct', cast(o_custkey%6 as string))) AS SchoolService, md5(concat('br', cast(o_custkey%5 as string))) AS Branch,
       md5(concat('sy', cast(year(o_orderdate) as string))) AS CurrentSchoolYear,
       md5(concat('zo', cast(o_custkey%4 as string))) AS Zone, md5(concat('sh', cast(o_custkey%3 as string))) AS ShuttleType,
       cast(o_orderkey%9 as int) AS "Order", cast(null as int) AS GCRecord, 0 AS OptimisticLockField,
       CASE WHEN o_orderkey%3<>0 THEN cast(o_totalprice as decimal(19,4)) END AS TR1,
       CASE WHEN o_orderkey%2=0 THEN cast(o_totalprice/2 as decimal(19,4)) END AS TR2,
       CASE WHEN o_orderkey%5=0 THEN cast(o_totalprice as decimal(19,4)) END AS "Tranche 1(22-23)",
       CASE WHEN o_orderkey%7=0 THEN cast(o_totalprice as decimal(19,4)) END AS Tranche_1_24_25,
       cast(1 as decimal(19,4)) AS TR1_solde
FROM orders""",
}
