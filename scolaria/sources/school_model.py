"""The school tables as views over the generic test tables.

Customers become students, orders become evaluation reports, payments and billing rows, line items
become scores and teacher attendance, events become student attendance and weather days.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scolaria.sources.tables import LazyTables, ParquetTables


def _oid(prefix: str, *parts: Column) -> Column:
    return F.md5(F.concat(F.lit(prefix), *[p.cast("string") for p in parts]))


def _year_oid(date: Column) -> Column:
    return _oid("sy", F.year(date))


def _date_key(day: Column) -> Column:
    return F.year(day) * 10000 + F.month(day) * 100 + F.day(day)


def _attendance_year(day: Column) -> Column:
    return F.md5(F.when(day < F.lit("2025-07-01").cast("date"), F.lit("sy2000")).otherwise(F.lit("sy2001")))


def _day_of(number: Column) -> Column:
    return F.date_add(F.lit("2024-09-01").cast("date"), (number % 640).cast("int"))


class SchoolModel(LazyTables):
    """Table name -> lazy frame, derived from ``<sf_dir>/*.parquet``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__()
        self.spark = spark
        self.raw = ParquetTables(spark, sf_dir, ".parquet")

    def open(self, name: str) -> DataFrame:
        return _VIEWS[name](self)

    def is_small(self, name: str) -> bool:
        return name in _BOUNDED or super().is_small(name)

    def _with_unknown(self, known: DataFrame, unknown: list) -> DataFrame:
        """The unknown member in front of the derived rows."""
        row = self.spark.range(1).select(
            *[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(unknown, known.schema.fields)]
        )
        return row.unionAll(known)

    def _small_dim(self, modulus: int, prefix: str, letter: str, key: str, oid: str, below: int | None = None) -> DataFrame:
        part = (F.col("c_custkey") % modulus).alias("part")
        parts = self.raw["customer"].select(part).where(F.col("part") < (below or modulus)).distinct()
        known = parts.select(
            (F.col("part") + 2).alias(key),
            _oid(prefix, F.col("part")).alias(oid),
            F.concat(F.lit(letter), F.col("part").cast("string")).alias("Code"),
        )
        return self._with_unknown(known, [1, _md5("unknown"), "UNKNOWN"])

    def _event_days(self) -> DataFrame:
        day_no = (F.col("event_id") % 640).alias("i")
        return self.raw["events"].select(day_no).distinct().withColumn("d", _day_of(F.col("i")))


def _md5(text: str) -> str:
    return hashlib.md5(text.encode()).hexdigest()


def _dim_school_year(m: SchoolModel) -> DataFrame:
    year = m.raw["orders"].select(F.year("o_orderdate").alias("y")).distinct()
    y = F.col("y")
    first, second = (y + 24).cast("string"), (y + 25).cast("string")
    label = F.concat(first, F.lit("-"), second)
    known = year.select(
        (y - 1993).alias("SchoolYearKey"),
        _oid("sy", y).alias("SchoolYearOid"),
        label.alias("Description"),
        F.concat(first, F.lit("-09-01")).cast("date").alias("StartDate"),
        F.concat(second, F.lit("-06-30")).cast("date").alias("EndDate"),
        label.alias("Code"),
    )
    return m._with_unknown(known, [1, _md5("sy0"), "UNKNOWN", "1900-01-01", "1900-01-01", "UNKNOWN"])


# Raw school names of the derived students, by customer key modulo 11.
_RAW_SCHOOLS = [
    "SLS Sousse", "Ecole Allama", "AVICENNE", "Lycée Pilote", "HS1", " hs ", "Les Élites", "Village school", "", None,
    "Amad Sahloul",
]


def _dim_student(m: SchoolModel) -> DataFrame:
    customers = m.raw["customer"].join(m.raw["nation"], F.col("c_nationkey") == F.col("n_nationkey"))
    key = F.col("c_custkey")
    school = F.element_at(F.array(*[F.lit(s) for s in _RAW_SCHOOLS]), (key % 11 + 1).cast("int"))
    governorate = F.when(key % 20 == 1, F.lit("")).when(key % 20 != 0, F.col("n_name"))
    known = customers.select(
        (key + 2).alias("StudentKey"),
        _oid("st", key).alias("StudentOid"),
        F.col("c_name").alias("FullNameArab"),
        governorate.alias("Governorate"),
        school.alias("BacType"),
    )
    return m._with_unknown(known, [1, "00000000-0000-0000-0000-000000000000", "UNKNOWN", None, None])


def _dim_evaluation_report(m: SchoolModel) -> DataFrame:
    key = F.col("o_orderkey")
    return m.raw["orders"].select(
        (key + 2).alias("EvaluationReportKey"),
        F.when(key % 97 != 0, _oid("st", F.col("o_custkey"))).alias("StudentOid"),
        _year_oid(F.col("o_orderdate")).alias("SchoolYearPeriodOid"),
    )


def _dim_content(m: SchoolModel) -> DataFrame:
    known = m.raw["part"].select((F.col("p_partkey") + 2).alias("ContentKey"), F.col("p_type").alias("Description"))
    return m._with_unknown(known, [1, "UNKNOWN"])


def _dim_date(m: SchoolModel) -> DataFrame:
    d = F.col("d")
    known = m._event_days().select(
        _date_key(d).alias("DateKey"),
        d.alias("FullDate"),
        F.year(d).alias("YearNumber"),
        F.month(d).alias("MonthNumber"),
        F.concat(F.lit("M"), F.month(d).cast("string")).alias("MonthName"),
    )
    return m._with_unknown(known, [-1, None, None, None, None])


def _fact_student_evaluation(m: SchoolModel) -> DataFrame:
    lines = m.raw["lineitem"].select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    # joined on the derived key, so that groupings by report need no further shuffle
    lines = lines.withColumn("EvaluationReportKey", F.col("l_orderkey") + 2)
    owners = m.raw["orders"].select((F.col("o_orderkey") + 2).alias("EvaluationReportKey"), "o_custkey")
    rows = lines.join(owners, "EvaluationReportKey")
    hundredths = F.col("l_quantity").cast("int") * 8 * (F.col("o_custkey") % 5 + 1)
    score = (hundredths.cast("decimal(9,2)") * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(5,2)")
    return rows.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("FactKey"),
        "EvaluationReportKey",
        (F.col("l_partkey") + 2).alias("ContentKey"),
        F.when(F.col("l_linenumber") != 7, score).alias("Average"),
    )


def _fact_student_attendance(m: SchoolModel) -> DataFrame:
    d, kind = _day_of(F.col("event_id")), F.col("event_type")
    absent = (kind == "error") | ((F.col("user_id") % 5 == 0) & kind.isin("click", "view"))
    late = F.when(kind == "signup", F.floor("value").cast("int") % 15).when(kind != "view", F.lit(0))
    return m.raw["events"].select(
        F.col("event_id").alias("FactKey"),
        (F.col("user_id") + 2).alias("StudentKey"),
        _date_key(d).alias("DateKey"),
        _attendance_year(d).alias("SchoolYearPeriodOid"),
        F.when(absent, F.lit(0)).otherwise((F.col("event_id") % 3).cast("int") + 1).alias("Checks"),
        late.alias("LateMinutes"),
    )


def _fact_teacher_attendance(m: SchoolModel) -> DataFrame:
    d, flag = _day_of(F.col("l_orderkey")), F.col("l_returnflag")
    late = F.when(flag == "R", F.col("l_quantity").cast("int")).when(flag != "N", F.lit(0))
    return m.raw["lineitem"].select(
        (F.col("l_suppkey") + 2).alias("TeacherKey"),
        _date_key(d).alias("DateKey"),
        _attendance_year(d).alias("SchoolYearPeriodOid"),
        (F.col("l_linenumber") % 4).alias("Checks"),
        late.alias("LateMinutes"),
    )


def _fact_student_payment(m: SchoolModel) -> DataFrame:
    return m.raw["orders"].select(
        (F.col("o_custkey") + 2).alias("StudentKey"), F.col("o_totalprice").cast("decimal(18,2)").alias("PaidAmount")
    )


def _weather_daily(m: SchoolModel) -> DataFrame:
    i = F.col("i")
    mm = F.when(i % 9 != 0, ((i * 7) % 11).cast("double") / 2)
    return m._event_days().select(F.col("d").alias("full_date"), mm.alias("precipitation_sum"))


def _weather_documents(m: SchoolModel) -> DataFrame:
    """The weather days as JSON texts with parallel arrays, one per month (at most 31 days each)."""
    day = F.struct(F.date_format("full_date", "yyyy-MM-dd").alias("t"), F.col("precipitation_sum").alias("p"))
    monthly = m["WeatherDaily"].groupBy(F.date_format("full_date", "yyyy-MM").alias("month")).agg(
        F.array_sort(F.collect_list(day)).alias("days")
    )
    arrays = F.struct(
        F.transform("days", lambda x: x["t"]).alias("time"),
        F.transform("days", lambda x: x["p"]).alias("precipitation_sum"),
    )
    return monthly.select(F.to_json(F.struct(arrays.alias("daily")), {"ignoreNullFields": "false"}).alias("document"))


def _student_service_report(m: SchoolModel) -> DataFrame:
    orders = m.raw["orders"].select(
        "o_custkey",
        F.year("o_orderdate").alias("y"),
        F.month("o_orderdate").alias("month"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("price"),
    )
    cells = [F.sum(F.when(F.col("month") == i, F.col("price"))).alias(str(i)) for i in range(1, 13)]
    key, y = F.col("o_custkey"), F.col("y")
    return orders.groupBy("o_custkey", "y").agg(*cells).select(
        F.md5(F.concat(F.lit("sr"), key.cast("string"), F.lit("-"), y.cast("string"))).alias("Oid"),
        _oid("st", F.when(key % 13 == 0, F.lit(-1)).otherwise(key)).alias("Student"),
        _oid("ct", key % 6).alias("SchoolService"),
        _oid("br", key % 5).alias("Branch"),
        _oid("sy", y).alias("CurrentSchoolYear"),
        F.when(key % 11 == 0, F.lit(1)).alias("GCRecord"),
        *[F.replace(F.col(f"`{i}`").cast("string"), F.lit("."), F.lit(",")).alias(str(i)) for i in range(1, 13)],
    )


def _student_service_report_tranche(m: SchoolModel) -> DataFrame:
    key, cust, price = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_totalprice")
    money = lambda x: x.cast("decimal(19,4)")
    return m.raw["orders"].select(
        _oid("tr", key).alias("Oid"),
        _oid("st", cust).alias("Student"),
        _oid("ct", cust % 6).alias("SchoolService"),
        _oid("br", cust % 5).alias("Branch"),
        _year_oid(F.col("o_orderdate")).alias("CurrentSchoolYear"),
        _oid("zo", cust % 4).alias("Zone"),
        _oid("sh", cust % 3).alias("ShuttleType"),
        (key % 9).cast("int").alias("Order"),
        F.lit(None).cast("int").alias("GCRecord"),
        F.lit(0).alias("OptimisticLockField"),
        F.when(key % 3 != 0, money(price)).alias("TR1"),
        F.when(key % 2 == 0, money(price / 2)).alias("TR2"),
        F.when(key % 5 == 0, money(price)).alias("Tranche 1(22-23)"),
        F.when(key % 7 == 0, money(price)).alias("Tranche_1_24_25"),
        F.lit(1).cast("decimal(19,4)").alias("TR1_solde"),
    )


_VIEWS: dict[str, Callable[[SchoolModel], DataFrame]] = {
    "DimSchoolYear": _dim_school_year,
    "DimStudent": _dim_student,
    "DimEvaluationReport": _dim_evaluation_report,
    "DimContent": _dim_content,
    "DimDate": _dim_date,
    "DimBranch": lambda m: m._small_dim(5, "br", "B", "BranchKey", "BranchOid"),
    "DimService": lambda m: m._small_dim(6, "ct", "S", "ServiceKey", "ServiceOid", below=5),
    "DimZone": lambda m: m._small_dim(4, "zo", "Z", "ZoneKey", "ZoneOid"),
    "DimShuttleType": lambda m: m._small_dim(3, "sh", "S", "ShuttleTypeKey", "ShuttleTypeOid"),
    "FactStudentEvaluation": _fact_student_evaluation,
    "FactStudentAttendance": _fact_student_attendance,
    "FactTeacherAttendance": _fact_teacher_attendance,
    "FactStudentPayment": _fact_student_payment,
    "WeatherDaily": _weather_daily,
    "WeatherDocuments": _weather_documents,
    "StudentServiceReport": _student_service_report,
    "StudentServiceReportTranche": _student_service_report_tranche,
}


# tables with a bound by construction (640 days, a few years, moduli): no count is needed
_BOUNDED = {"DimSchoolYear", "DimDate", "WeatherDaily", "DimBranch", "DimService", "DimZone", "DimShuttleType"}


@lru_cache(maxsize=8)
def school_model(spark: SparkSession, sf_dir: str) -> SchoolModel:
    """One model per session and folder: plans are reused, no data is cached."""
    return SchoolModel(spark, sf_dir)
