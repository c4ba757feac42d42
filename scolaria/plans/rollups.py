"""KPI rollups over the query results: shares, bands, best and worst entries.

Most are one aggregation over an unsorted query, so the sort of the query is never paid for.  Where a
figure is taken over a displayed list (top 15, top 20), it is taken over that list here too.  Of two
equal maxima the later one in list order wins, as in a left-to-right scan that keeps the new one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scolaria.functions.rounding import half_up, mean, ratio, share
from scolaria.operators.scores import known_subjects, subject_rows
from scolaria.operators.years import resolve_year
from scolaria.plans import geography, pedagogy, performance, periods, presence, progression, risk, schools, shared, weather
from scolaria.sources.tables import Tables

# Band names are the colours shown; limits as displayed.
GOOD, FAIR, POOR = "teal", "amber", "rose"
STABLE_BELOW = 1.5


def _fixed_mean(x: Column, digits: int) -> Column:
    """Mean of already rounded figures, rounded for display."""
    return half_up(ratio(F.sum(x.cast("decimal(14,2)")), F.count(F.lit(1))), digits)


def score_band(score: Column) -> Column:
    return F.when(score >= 12, GOOD).when(score >= 10, FAIR).otherwise(POOR)


def absence_band(rate: Column) -> Column:
    rate = F.coalesce(rate, F.lit(0.0))
    return F.when(rate >= 35, POOR).when(rate >= 20, FAIR).otherwise(GOOD)


def histogram_share(tables: Tables, school_year=None) -> DataFrame:
    """Score bins with their share of all scores (ten rows at most reach the window) and band."""
    bins = performance.score_distribution(tables, school_year)
    total = F.sum("count").over(Window.partitionBy())
    edges = F.split("bin", "-")
    middle = (edges[0].cast("double") + edges[1].cast("double")) / 2
    band = F.when(middle < 10, POOR).when(middle < 14, FAIR).otherwise(GOOD)
    return bins.select("bin", "count", half_up(share(F.col("count"), total), 1).alias("share_pct"), band.alias("band"))


def year_progression(tables: Tables) -> DataFrame:
    """Unweighted mean of the student-year means per year label."""
    rows = progression.student_years(tables)
    return rows.groupBy("year_label").agg(_fixed_mean(F.col("avg_score"), 2).alias("avg_score")).orderBy("year_label")


def progression_summary(tables: Tables, listed: int = 15, stable: int = 20) -> DataFrame:
    """One row: years tracked, trends and stability of the displayed lists, greatest changes of all.

    The lists are cut from one frame of standings by a rank within each of them; Spark drops what is
    beyond the longest list in every task before the shuffle.  All years share rank 1.
    """
    is_student, trend = F.col("part") == "student", F.col("trend_label")
    entry = lambda name, measure, condition: F.when(condition, F.struct(F.lit(name).alias("list"), measure.alias("measure")))
    entries = F.array(
        entry("listed", F.col("delta"), is_student),
        entry("fall", F.col("delta"), is_student & (trend == "Regression")),
        entry("rise", -F.col("delta"), is_student & (trend == "Improvement")),
        entry("stable", F.col("score_stddev"), F.col("part") == "name"),
        entry("years", F.lit(0.0), F.col("part") == "year"),
    )
    rows = progression.standings(tables).select(F.explode(F.array_compact(entries)).alias("entry"), "student_name", "StudentOid", "StudentKey", "trend_label")
    rows = rows.select("entry.*", "student_name", "StudentOid", "StudentKey", "trend_label")
    later_name = F.when(F.col("list") == "rise", F.col("student_name"))  # of equal rises the last name wins
    order = Window.partitionBy("list").orderBy("measure", later_name.desc(), "student_name", "StudentOid", "StudentKey")
    rows = rows.withColumn("rank", F.rank().over(order)).where(F.col("rank") <= max(listed, stable))
    within = lambda name, n: (F.col("list") == name) & (F.col("rank") <= n)
    first = lambda name: F.max(F.when(within(name, 1), F.col("student_name")))
    spread = F.when(within("stable", stable), F.col("measure").cast("decimal(14,2)"))
    return rows.agg(
        F.count_if(F.col("list") == "years").alias("years_tracked"),
        F.count_if(within("listed", listed) & (trend == "Improvement")).alias("improving"),
        F.count_if(within("listed", listed) & (trend == "Regression")).alias("regressing"),
        F.count_if(within("stable", stable) & (F.col("measure") < STABLE_BELOW)).alias("stable_profiles"),
        half_up(ratio(F.sum(spread), F.count(spread)), 2).alias("avg_stddev"),
        first("stable").alias("most_stable"),
        first("fall").alias("biggest_regression"),
        first("rise").alias("biggest_improvement"),
    )


def _side_by_side(parts: list[DataFrame]) -> DataFrame:
    """One-row frames as one row: stacked with NULLs, then folded by a single aggregation."""
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def subject_extremes(tables: Tables, school_year=None) -> DataFrame:
    """Best and weakest subject, and the range of all scores as text; scores of no known subject only
    count for the range.  The fact is read once."""
    score = F.col("Average")
    by_key = subject_rows(tables, resolve_year(tables, school_year)).groupBy("ContentKey").agg(
        F.count(score).alias("n"), F.sum(score).alias("total"), F.min(score).alias("lowest"), F.max(score).alias("highest")
    )
    by_subject = by_key.join(known_subjects(tables), "ContentKey", "left").groupBy("subject").agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"), F.min("lowest").alias("lowest"), F.max("highest").alias("highest")
    )
    rank = F.when(F.col("subject").isNotNull(), F.struct(-mean(F.col("total"), F.col("n")), "subject"))
    text = lambda c: c.cast("decimal(10,2)").cast("string")
    return by_subject.agg(
        F.min_by("subject", rank).alias("best_subject"),
        F.max_by("subject", rank).alias("weakest_subject"),
        F.concat(text(F.min("lowest")), F.lit(" – "), text(F.max("highest")), F.lit(" / 20")).alias("score_range"),
    )


def subject_bands(tables: Tables, school_year=None) -> DataFrame:
    return performance.average_by_subject(tables, school_year).select(
        "subject", "avg_score", score_band(F.col("avg_score")).alias("band")
    )


def subject_pass_fail(tables: Tables, school_year=None, top: int = 8) -> DataFrame:
    """Pass and fail counts of the best subjects; a zero count is rebuilt from the rate."""
    rows = performance.average_by_subject(tables, school_year).limit(top)
    n = F.when(F.col("n_evaluations") > 0, F.col("n_evaluations")).otherwise(F.lit(500))
    rebuilt = lambda part: F.floor(n * part + 0.5).cast("bigint")
    kept = lambda count, part: F.when(F.col(count) > 0, F.col(count)).otherwise(rebuilt(part))
    rate = F.col("pass_rate") / 100
    return rows.select("subject", kept("pass_count", rate).alias("pass_count"), kept("fail_count", 1 - rate).alias("fail_count"))


def absence_bands(tables: Tables, school_year=None) -> DataFrame:
    return presence.top_absent_students(tables, school_year).select(
        "student_name", "absence_rate", absence_band(F.col("absence_rate")).alias("band")
    )


def risk_quadrants(tables: Tables, school_year=None) -> DataFrame:
    """Names by absence and score: at risk, good, or in between."""
    absence, score = F.coalesce("absence_rate", F.lit(0.0)), F.coalesce("avg_score", F.lit(0.0))
    band = F.when((score < 10) & (absence > 20), POOR).when(score >= 14, GOOD).otherwise(FAIR)
    return presence.attendance_vs_score(tables, school_year).select("student_name", "absence_rate", "avg_score", band.alias("band"))


def peak_absence_month(tables: Tables, school_year=None) -> DataFrame:
    rows = presence.absence_by_month(tables, school_year)
    order = F.struct("absence_rate", "year", "month", "month_name")
    return rows.agg(F.max_by("month_name", order).alias("peak_month"), F.max("absence_rate").alias("peak_rate"))


def absence_kpi(tables: Tables, school_year=None) -> DataFrame:
    """Absence rate, or what presence leaves of 100."""
    rest = half_up(F.lit(100.0) - F.coalesce("presence_rate", F.lit(0.0)), 1)
    return presence.attendance_kpis(tables, school_year).select(F.coalesce("absence_rate", rest).alias("absence_rate"))


def weather_sensitivity(tables: Tables, school_year=None) -> DataFrame:
    """Rainy minus dry absence, the rainiest month and the month of most absence."""
    rainy, dry = F.col("rainy_avg"), F.col("dry_avg")
    both = (rainy != 0) & (dry != 0)
    delta = weather.rainy_vs_dry(tables, school_year).select(F.when(both, half_up(rainy - dry, 1)).alias("sensitivity"))
    months = weather.seasonal_patterns(tables, school_year).agg(
        F.max_by("month_name", F.struct("avg_precipitation", "month", "month_name")).alias("rainiest_month"),
        F.max_by("month_name", F.struct("absence_rate", "month", "month_name")).alias("worst_month"),
    )
    return _side_by_side([delta, months])


def weather_series(tables: Tables, school_year=None) -> DataFrame:
    """Scatter points by series."""
    return weather.weather_vs_absence(tables, school_year).select(
        F.when(F.col("is_rainy"), "Rainy").otherwise("Dry").alias("series"), "full_date", "precipitation_mm", "absence_rate"
    )


def dispersion_bands(tables: Tables, school_year=None) -> DataFrame:
    """Mean plus and minus one standard deviation, within 0 to 20."""
    spread = F.coalesce("score_stddev", F.lit(0.0))
    return pedagogy.report_dispersion(tables, school_year).select(
        "report_name",
        half_up(F.greatest(F.lit(0.0), F.col("score_avg") - spread), 2).alias("band_low"),
        half_up(F.least(F.lit(20.0), F.col("score_avg") + spread), 2).alias("band_high"),
    )


def report_summary(tables: Tables, school_year=None) -> DataFrame:
    """One row: reports, best mean, widest spread, the reports that hold them, scores, subjects."""
    spread = F.coalesce("score_stddev", F.lit(0.0))
    reports = pedagogy.report_dispersion(tables, school_year).agg(
        F.count(F.lit(1)).alias("reports"),
        F.max("score_avg").alias("best_avg"),
        F.max(spread).alias("highest_dispersion"),
        F.max_by("report_name", F.struct("score_avg", "EvaluationReportKey")).alias("best_report"),
        F.max_by("report_name", F.struct(spread, "EvaluationReportKey")).alias("most_volatile"),
        F.sum("n").alias("evaluations"),
    )
    subjects = pedagogy.subject_list(tables).agg(F.count(F.lit(1)).alias("subjects"))
    return _side_by_side([reports, subjects])


def risk_summary(tables: Tables, school_year=None, warned: int = 20) -> DataFrame:
    """One row: students at high and medium risk, students analysed, three-flag warnings of the
    displayed list, the student of highest risk.

    One frame and one aggregation: the warnings are listed by their number of flags, so those of three
    fill the list first, and the rest of its order doesn't matter.
    """
    level = lambda name: F.count_if(F.col("first") & (F.col("risk_level") == name))
    worst = F.when(F.col("known"), F.struct((-F.col("risk_score")).alias("least"), "student_name", "StudentOid"))
    return risk.assessed_students(tables, school_year).agg(
        level("High").alias("high"),
        level("Medium").alias("medium"),
        F.count_if("first").alias("analysed"),
        F.least(F.lit(warned), F.count_if(F.col("known") & (F.col("warning_count") >= 3))).alias("three_flags"),
        F.min_by("student_name", worst).alias("highest_risk"),
    )


def risk_top(tables: Tables, school_year=None, top: int = 15) -> DataFrame:
    """The charted head of the risk list."""
    return risk.risk_scores(tables, school_year, top).select("student_name", "risk_score", "risk_level")


def warning_levels(tables: Tables, school_year=None) -> DataFrame:
    return risk.early_warnings(tables, school_year).select(
        "student_name", "warning_count", F.when(F.col("warning_count") >= 3, "High").otherwise("Medium").alias("level")
    )


def zone_summary(tables: Tables, school_year=None) -> DataFrame:
    """One row: zones, students, unweighted mean absence, largest zone."""
    return geography.students_by_zone(tables, school_year).agg(
        F.count(F.lit(1)).alias("zones"),
        F.sum("student_count").alias("students"),
        _fixed_mean(F.coalesce("absence_rate", F.lit(0.0)), 1).alias("avg_absence"),
        F.max_by("zone_name", F.struct("student_count", "zone_name")).alias("top_zone"),
    )


def period_summary(tables: Tables, school_year=None) -> DataFrame:
    """One row: periods of highest and lowest absence, days analysed."""
    rate = F.col("avg_absence_rate")
    return periods.period_absence(tables, school_year).agg(
        F.max_by("period_label", F.struct(rate, "ordinal")).alias("highest_period"),
        F.max(rate).alias("highest_rate"),
        F.min_by("period_label", F.struct(rate, -F.col("ordinal"))).alias("lowest_period"),
        F.min(rate).alias("lowest_rate"),
        F.sum("n_days").alias("days"),
    )


def school_summary(tables: Tables, school_year=None) -> DataFrame:
    """One row: schools, best mean and its school, best pass rate, students."""
    score = F.coalesce("avg_score", F.lit(0.0))
    later = F.struct(score, -F.col("student_count"), "school_name")
    return schools.performance_by_school(tables, school_year).agg(
        F.count(F.lit(1)).alias("schools"),
        F.max_by("school_name", later).alias("best_school"),
        F.max_by("avg_score", later).alias("best_avg"),
        F.max(F.coalesce("pass_rate", F.lit(0.0))).alias("top_pass_rate"),
        F.sum("student_count").alias("students"),
    )


def school_top(tables: Tables, school_year=None, top: int = 10) -> DataFrame:
    return schools.performance_by_school(tables, school_year).limit(top).select("school_name", "avg_score", "pass_rate")


def current_school_year(tables: Tables, as_of=None) -> DataFrame:
    """The first school year that is current."""
    years = shared.school_years(tables, as_of)
    return years.where("IsCurrent").orderBy("SchoolYearKey").limit(1).select("SchoolYearKey", "YearLabel")
