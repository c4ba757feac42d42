"""Fixed reference data: the academic calendar and the school-name groups."""

from __future__ import annotations

import datetime as dt

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

# Fixed values: (label, type, start, end) per school year, in matching order.
CALENDAR = {
    "2024-2025": [
        ("Pre-Mawlid", "pre_holiday", "2024-09-13", "2024-09-14"),
        ("Mawlid Break", "holiday", "2024-09-15", "2024-09-15"),
        ("Post-Mawlid", "post_holiday", "2024-09-16", "2024-09-17"),
        ("Pre-Autumn Break", "pre_holiday", "2024-10-19", "2024-10-25"),
        ("Autumn Break", "holiday", "2024-10-26", "2024-11-03"),
        ("Post-Autumn Break", "post_holiday", "2024-11-04", "2024-11-10"),
        ("Pre-T1 Exams", "pre_exam", "2024-11-18", "2024-11-29"),
        ("T1 Exam Session", "exam", "2024-11-30", "2024-12-07"),
        ("Pre-Winter Break", "pre_holiday", "2024-12-21", "2024-12-27"),
        ("Winter Break", "holiday", "2024-12-28", "2025-01-05"),
        ("Post-Winter Break", "post_holiday", "2025-01-06", "2025-01-12"),
        ("Pre-T2 Exams", "pre_exam", "2025-02-17", "2025-02-28"),
        ("T2 Exam Session", "exam", "2025-03-01", "2025-03-08"),
        ("Pre-Spring Break", "pre_holiday", "2025-03-08", "2025-03-14"),
        ("Spring Break", "holiday", "2025-03-15", "2025-03-23"),
        ("Post-Spring Break", "post_holiday", "2025-03-24", "2025-03-30"),
        ("Pre-Eid al-Fitr", "pre_holiday", "2025-03-28", "2025-03-29"),
        ("Eid al-Fitr Break", "holiday", "2025-03-30", "2025-04-01"),
        ("Post-Eid al-Fitr", "post_holiday", "2025-04-02", "2025-04-04"),
        ("Pre-Final Exams", "pre_exam", "2025-05-01", "2025-05-14"),
        ("Final Exam Session", "exam", "2025-05-15", "2025-06-03"),
        ("Pre-Eid al-Adha", "pre_holiday", "2025-06-04", "2025-06-05"),
        ("Eid al-Adha Break", "holiday", "2025-06-06", "2025-06-08"),
        ("Post-Eid al-Adha", "post_holiday", "2025-06-09", "2025-06-10"),
    ],
    "2025-2026": [
        ("Pre-Mawlid", "pre_holiday", "2025-09-02", "2025-09-03"),
        ("Mawlid Break", "holiday", "2025-09-04", "2025-09-05"),
        ("Post-Mawlid", "post_holiday", "2025-09-06", "2025-09-08"),
        ("Pre-Autumn Break", "pre_holiday", "2025-10-11", "2025-10-17"),
        ("Autumn Break", "holiday", "2025-10-18", "2025-10-26"),
        ("Post-Autumn Break", "post_holiday", "2025-10-27", "2025-11-02"),
        ("Pre-T1 Exams", "pre_exam", "2025-11-03", "2025-11-14"),
        ("T1 Exam Session", "exam", "2025-11-15", "2025-11-22"),
        ("Pre-Winter Break", "pre_holiday", "2025-12-20", "2025-12-26"),
        ("Winter Break", "holiday", "2025-12-27", "2026-01-04"),
        ("Post-Winter Break", "post_holiday", "2026-01-05", "2026-01-11"),
        ("Pre-T2 Exams", "pre_exam", "2026-02-02", "2026-02-13"),
        ("T2 Exam Session", "exam", "2026-02-14", "2026-02-21"),
        ("Pre-Spring Break", "pre_holiday", "2026-02-28", "2026-03-06"),
        ("Spring Break", "holiday", "2026-03-07", "2026-03-15"),
        ("Post-Spring Break", "post_holiday", "2026-03-16", "2026-03-22"),
        ("Pre-Eid al-Fitr", "pre_holiday", "2026-03-18", "2026-03-19"),
        ("Eid al-Fitr Break", "holiday", "2026-03-20", "2026-03-22"),
        ("Post-Eid al-Fitr", "post_holiday", "2026-03-23", "2026-03-25"),
        ("Pre-Final Exams", "pre_exam", "2026-04-20", "2026-05-03"),
        ("Final Exam Session", "exam", "2026-05-04", "2026-05-24"),
        ("Pre-Eid al-Adha", "pre_holiday", "2026-05-25", "2026-05-26"),
        ("Eid al-Adha Break", "holiday", "2026-05-27", "2026-05-29"),
        ("Post-Eid al-Adha", "post_holiday", "2026-05-30", "2026-06-01"),
    ],
}

# Label used when no school year is chosen, or the year has no calendar.
DEFAULT_YEAR_LABEL = "2024-2025"

# Days outside every period.
NORMAL_TYPE, NORMAL_LABEL = "normal", "Normal Period"

# Reported period types in report order.
PERIOD_TYPES = [
    ("pre_holiday", "Before Holiday"),
    ("post_holiday", "After Holiday"),
    ("pre_exam", "Before Exams"),
    ("exam", "Exam Period"),
    ("normal", "Normal Days"),
]

# Canonical school -> substrings of the lower-cased name, in matching order.
SCHOOL_GROUPS = {
    "SLS Leaders School": ["sls", "leaders school", "leader school", "sousse leaders"],
    "Allama": ["allama", "علامة", "alema", "alalma", "allema"],
    "Avicenne / Ibn Sina": ["avicenne", "avecenne", "ibn sina", "ابن سينا", "ibn rochd"],
    "Amad": ["amad"],
    "Select School": ["select school", "select skills", "النخبة والمهارات"],
    "Les Élites / AKC": ["élites", "elites", "les elites", "akc", "أبو القاسم", "a.k.c"],
    "Marie Curie": ["marie curie"],
    "Esseddik": ["esseddik", "الصديق"],
    "Pilote": ["pilote", "النموذجية"],
    "Le Petit Prince / LPP": ["petit prince", "الأمير الصغير", "lpp", "lpl"],
    "Les Lauréats": ["lauréat", "laureats", "المتفوقون", "laureat"],
    "Sahloul 4 / HS": ["sahloul", "hs1", "hs2", "hs ", "h.s", "hammam sousse"],
    "Ennour / Annour": ["ennour", "annour", "النور", "nour academy"],
    "Perseverance": ["persevér", "persever", "المثابرة"],
    "Kalaa Soghra": ["kalaa", "قلعة"],
    "Khezama": ["khezam", "خزامة"],
    "Cité Erriadh": ["erriadh", "riadh", "الرياض", "cite riadh"],
    "Monastir International": ["monastir", "international monastir", "المنستير"],
}
OTHER_SCHOOL = "Other / Unknown"


def seed_frame(spark: SparkSession, **columns: list) -> DataFrame:
    """A frame over literal columns.  Arrow input of this size plans as a local relation, so Spark
    knows its true size and broadcasts it without a hint."""
    return spark.createDataFrame(pa.table(columns))


def calendar_frame(spark: SparkSession, year_label: str | None = None) -> DataFrame:
    """(year_label, ordinal, label, type, start, end); all years, or one."""
    rows = [
        (year, ordinal, *entry)
        for year, entries in CALENDAR.items()
        if year_label is None or year == year_label
        for ordinal, entry in enumerate(entries, start=1)
    ]
    column = lambda i: [row[i] for row in rows]
    day = lambda i: pa.array([dt.date.fromisoformat(v) for v in column(i)], pa.date32())
    return seed_frame(
        spark,
        year_label=pa.array(column(0), pa.string()),
        ordinal=pa.array(column(1), pa.int32()),
        label=pa.array(column(2), pa.string()),
        type=pa.array(column(3), pa.string()),
        start=day(4),
        end=day(5),
    )


def period_type_frame(spark: SparkSession) -> DataFrame:
    """(ordinal, period_type, period_label) of the five reported types."""
    return seed_frame(
        spark,
        ordinal=pa.array(range(1, len(PERIOD_TYPES) + 1), pa.int32()),
        period_type=pa.array([kind for kind, _ in PERIOD_TYPES], pa.string()),
        period_label=pa.array([label for _, label in PERIOD_TYPES], pa.string()),
    )
