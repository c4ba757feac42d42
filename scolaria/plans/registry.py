"""All named queries: key -> function of the tables."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scolaria.functions.parsing import comma_decimal
from scolaria.functions.schools import normalize_school
from scolaria.operators import keys, load, reshape
from scolaria.operators.periods import tag_periods
from scolaria.operators.years import year_label
from scolaria.plans import geography, pedagogy, performance, periods, presence, progression, risk, rollups, schools, shared, weather
from scolaria.session import shared_folder
from scolaria.sources import tables as source
from scolaria.sources.tables import Tables
from scolaria.sources.weather import parse_weather, weather_days

Query = Callable[[Tables], DataFrame]

# parameters of the registered runs
AS_OF = "2025-01-15"
ZONE = "NATION_7"
SCHOOL = "SLS Leaders School"
SCHOOL_YEAR = "7"
CALENDAR_YEARS = {"next": "8", "none": "6"}  # a year with a calendar of its own, and one without any
STUDENT = hashlib.md5(b"st42").hexdigest()
SCHOOL_YEAR_OID = hashlib.md5(b"sy2000").hexdigest()
UNKNOWN_YEAR = "999"
SUBJECT = "ECONOMY"
FIRST_TERM = 6  # months 1..6 count as loaded in the incremental-load queries
PREVIOUS_YEARS = "2024-09-01"  # school years that start earlier count as loaded


def _text_dates(frame: DataFrame, *columns: str) -> DataFrame:
    return frame.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in columns})


def _calendar_tag(t: Tables, school_year: str | None = None) -> DataFrame:
    """Every day of the date dimension, tagged by the calendar of a school year."""
    days = t["DimDate"].select(F.date_format("FullDate", "yyyy-MM-dd").alias("full_date"))
    return tag_periods(days, "full_date", year_label(t, school_year))


def _normalized_schools(t: Tables) -> DataFrame:
    return t["DimStudent"].select("StudentKey", normalize_school(F.col("BacType")).alias("canonical"))


def _comma_decimals(t: Tables) -> DataFrame:
    """Every month cell as a number, wide as it came."""
    report = source.extract_service_report(t)
    months = reshape.detect_month_columns(report)
    return report.select("Oid", *[comma_decimal(F.col(f"`{m}`")).alias(f"m{m}") for m in months])


def _resolved(t: Tables) -> DataFrame:
    report = source.extract_service_report(t).select("Oid", "Student", "SchoolService", "Branch", "CurrentSchoolYear")
    rows = keys.resolve_keys(report, load.WIDE_LOOKUPS, t, keys.unknown_key_values(t))
    return rows.select("Oid", "StudentKey", "ServiceKey", "BranchKey", "SchoolYearKey")


def _tall(t: Tables) -> DataFrame:
    return reshape.unpivot_service_revenue(source.extract_service_report(t))


def _first_term(tall: DataFrame) -> DataFrame:
    return tall.where(F.col("MonthNumber") <= FIRST_TERM).select(*load.REVENUE_KEY)


def _previous_years(t: Tables, rows: DataFrame) -> DataFrame:
    """Source rows of earlier school years: what an earlier load has brought in."""
    years = t["DimSchoolYear"].where(F.col("StartDate") < F.lit(PREVIOUS_YEARS).cast("date")).select("SchoolYearOid")
    old = rows.join(years, F.col("CurrentSchoolYear") == F.col("SchoolYearOid"), "left_semi")
    return old.select(F.col("Oid").alias("SourceOid"))


def _anti_revenue(t: Tables) -> DataFrame:
    tall = _tall(t)
    return keys.not_loaded(tall, _first_term(tall), *load.REVENUE_KEY).select("SourceOid", "MonthNumber", "Amount")


def _anti_tranche(t: Tables) -> DataFrame:
    raw = source.extract_service_report_tranche(t)
    rows = raw.withColumnRenamed("Oid", "SourceOid")
    return keys.not_loaded(rows, _previous_years(t, raw), *load.TRANCHE_KEY).select("SourceOid", "Student", "Order")


def _fact_revenue(t: Tables) -> DataFrame:
    report = source.extract_service_report(t)
    return load.revenue_rows(report, t, _first_term(_tall(t)), keys.unknown_key_values(t))


def _fact_tranche(t: Tables) -> DataFrame:
    raw = source.extract_service_report_tranche(t)
    return load.tranche_rows(raw, t, _previous_years(t, raw), keys.unknown_key_values(t))


def _row_sums(t: Tables) -> DataFrame:
    return reshape.sum_tranches(source.extract_service_report_tranche(t)).select("Oid", "Amount")


def _load_counts(t: Tables) -> DataFrame:
    tall = _tall(t)
    return keys.load_counts(tall, _first_term(tall), *load.REVENUE_KEY)


def _duplicates(t: Tables) -> DataFrame:
    return keys.duplicate_keys(t["FactStudentEvaluation"], "EvaluationReportKey", "ContentKey")


def _append_load(t: Tables) -> DataFrame:
    """Two loads into a new folder, the second over all rows; what the folder then holds."""
    tall = _tall(t)
    spark = tall.sparkSession
    path = shared_folder(spark)
    unknown = keys.unknown_key_values(t)
    first = tall.where(F.col("MonthNumber") <= FIRST_TERM)
    none = load.loaded_keys(spark, path, load.REVENUE_KEY)
    load.append_rows(load.revenue_rows_from_tall(first, t, none, unknown), path)
    rest = load.revenue_rows(source.extract_service_report(t), t, load.loaded_keys(spark, path, load.REVENUE_KEY), unknown)
    load.append_rows(rest, path)
    return spark.read.parquet(path)


def _balances(t: Tables) -> DataFrame:
    """The tranche source with a balance column whose name is that of a tranche."""
    return t["StudentServiceReportTranche"].withColumn("Tranche_2_solde", F.col("TR2"))


def _dirty(t: Tables) -> DataFrame:
    """The revenue source with cells that are no clean number: words, thousands, NaN, half cents, by the first digit of Oid."""
    report = source.extract_service_report(t)
    digit = F.substring("Oid", 1, 1)
    marred = lambda cell: (
        F.when(digit == "0", F.lit("abc")).when(digit == "1", F.concat(F.lit("1 "), cell)).when(digit == "2", F.lit("NaN"))
        .when(digit == "3", F.concat(F.lit("1."), cell)).when(digit == "4", F.lit("0,125")).when(digit == "5", F.lit(" 7,5 ")).otherwise(cell)
    )
    return report.withColumns({m: F.when(F.col(f"`{m}`").isNotNull(), marred(F.col(f"`{m}`"))) for m in reshape.detect_month_columns(report)})


def _copied(t: Tables) -> DataFrame:
    """The revenue batch with every row of the first month twice."""
    tall = _tall(t)
    return tall.unionAll(tall.where(F.col("MonthNumber") == 1))


# named queries without a school-year parameter
FIXED: dict[str, Query] = {
    "school_years": partial(shared.school_years, as_of=AS_OF),
    "a1_avg_by_school_year": performance.average_by_school_year,
    "a2_progression": progression.progression_by_student,
    "a2_yoy_by_subject": progression.year_over_year_by_subject,
    "a2_stability": progression.stability_index,
    "a2_regression": progression.regression_detection,
    "a2_regression_chronological": partial(progression.regression_detection, chronological=True),
    "a2_semester": progression.semester_comparison,
    "a2_progression_student": partial(progression.progression_by_student, student_oid=STUDENT),
    "a1_kpis_oid": partial(performance.performance_kpis, school_year=SCHOOL_YEAR_OID),
    "a1_kpis_unknown_year": partial(performance.performance_kpis, school_year=UNKNOWN_YEAR),
    "a5_outcomes_subject": partial(pedagogy.outcomes_by_report, subject=SUBJECT),
    "a5_subject_list": pedagogy.subject_list,
    "a9_school_list": schools.school_list,
}

# named queries with one; each is also registered for SCHOOL_YEAR under "<key>_year"
BY_YEAR: dict[str, Callable[..., DataFrame]] = {
    "a1_kpis": performance.performance_kpis,
    "a1_avg_by_subject": performance.average_by_subject,
    "a1_score_distribution": performance.score_distribution,
    "a1_pass_fail_by_subject": performance.pass_fail_by_subject,
    "a3_kpis": presence.attendance_kpis,
    "a3_absence_by_month": presence.absence_by_month,
    "a3_teacher_hours": presence.teacher_sessions_by_month,
    "a3_top_absent": presence.top_absent_students,
    "a3_att_vs_score": presence.attendance_vs_score,
    "a4_weather_vs_absence": weather.weather_vs_absence,
    "a4_rainy_vs_dry": weather.rainy_vs_dry,
    "a4_seasonal": weather.seasonal_patterns,
    "a5_outcomes": pedagogy.outcomes_by_report,
    "a5_dispersion": pedagogy.dispersion_by_report,
    "a5_presence_perf": pedagogy.presence_performance,
    "a6_risk_scores": risk.risk_scores,
    "a6_risk_distribution": risk.risk_distribution,
    "a6_early_warning": risk.early_warnings,
    "a7_by_zone": geography.students_by_zone,
    "a7_governorate": geography.governorate_summary,
    "a7_zone_detail": partial(geography.zone_detail, zone_name=ZONE),
    "a8_by_period": periods.absence_by_period,
    "a8_daily_tagged": periods.daily_absence_tagged,
    "a8_holiday_impact": periods.holiday_impact,
    "a9_perf_by_school": schools.performance_by_school,
    "a9_school_ranking": schools.school_ranking,
    "a9_students_from_school": partial(schools.students_from_school, school_name=SCHOOL),
}

ETL: dict[str, Query] = {
    "scan_filter": lambda t: source.extract_table(t, "FactStudentPayment", "PaidAmount >= 100000"),
    "scan_soft_delete": source.extract_service_report,
    "scan_tranche_numeric": source.extract_service_report_tranche,
    "dim_keys": lambda t: source.extract_dim_keys(t, "DimStudent", "StudentOid", "StudentKey"),
    "date_keys": lambda t: _text_dates(source.extract_date_keys(t), "FullDate"),
    "weather_days": lambda t: _text_dates(weather_days(parse_weather(t["WeatherDocuments"])), "full_date"),
    "comma_decimal": _comma_decimals,
    "unpivot_revenue": _tall,
    "revenue_cast_report": lambda t: reshape.revenue_cast_report(source.extract_service_report(t)),
    "unpivot_tranche": lambda t: reshape.unpivot_service_tranche(t["StudentServiceReportTranche"]),
    "tranche_row_sum": _row_sums,
    "unknown_keys": keys.unknown_keys,
    "resolve_keys": _resolved,
    "anti_revenue": _anti_revenue,
    "anti_tranche": _anti_tranche,
    "fact_service_revenue": _fact_revenue,
    "fact_service_tranche": _fact_tranche,
    "load_counts": _load_counts,
    "append_load": _append_load,
    "duplicate_keys": _duplicates,
    "duplicate_revenue_keys": lambda t: keys.duplicate_keys(_copied(t), *load.REVENUE_KEY),
    "unpivot_dirty": lambda t: reshape.unpivot_service_revenue(_dirty(t)),
    "dirty_cast_report": lambda t: reshape.revenue_cast_report(_dirty(t)),
    "unpivot_balances": lambda t: reshape.unpivot_service_tranche(_balances(t)),
    "unpivot_no_balances": lambda t: reshape.unpivot_service_tranche(_balances(t), exclude_balances=True),
    "tranche_cast_report": lambda t: reshape.tranche_cast_report(_balances(t)),
    "key_copies": keys.dimension_key_copies,
    "calendar_tag": _calendar_tag,
    **{f"calendar_tag_{name}": partial(_calendar_tag, school_year=year) for name, year in CALENDAR_YEARS.items()},
    "normalize_school": _normalized_schools,
}

ROLLUPS: dict[str, Query] = {
    "rollup_histogram_share": rollups.histogram_share,
    "rollup_year_progression": rollups.year_progression,
    "rollup_progression_summary": rollups.progression_summary,
    "rollup_subject_extremes": rollups.subject_extremes,
    "rollup_subject_bands": rollups.subject_bands,
    "rollup_subject_pass_fail": rollups.subject_pass_fail,
    "rollup_absence_bands": rollups.absence_bands,
    "rollup_risk_quadrants": rollups.risk_quadrants,
    "rollup_peak_absence_month": rollups.peak_absence_month,
    "rollup_absence_kpi": rollups.absence_kpi,
    "rollup_weather_sensitivity": rollups.weather_sensitivity,
    "rollup_weather_series": rollups.weather_series,
    "rollup_dispersion_bands": rollups.dispersion_bands,
    "rollup_report_summary": rollups.report_summary,
    "rollup_risk_summary": rollups.risk_summary,
    "rollup_risk_top": rollups.risk_top,
    "rollup_warning_levels": rollups.warning_levels,
    "rollup_zone_summary": rollups.zone_summary,
    "rollup_period_summary": rollups.period_summary,
    "rollup_school_summary": rollups.school_summary,
    "rollup_school_top": rollups.school_top,
    "rollup_current_year": partial(rollups.current_school_year, as_of=AS_OF),
}


def all_queries() -> dict[str, Query]:
    by_year = {k: f for k, f in BY_YEAR.items()}
    one_year = {f"{k}_year": partial(f, school_year=SCHOOL_YEAR) for k, f in BY_YEAR.items()}
    calendars = {
        f"{k}_{name}": partial(BY_YEAR[k], school_year=year)
        for k in ("a8_by_period", "a8_daily_tagged", "a8_holiday_impact")
        for name, year in CALENDAR_YEARS.items()
    }
    return {**FIXED, **by_year, **one_year, **calendars, **ETL, **ROLLUPS}
