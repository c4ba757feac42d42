import pytest
from pyspark.sql import types as T

from scolaria.operators.reshape import (
    detect_amount_columns, detect_month_columns, detect_tranche_columns, filled_cells, revenue_cast_report, sum_tranches,
    tranche_cast_report, unpivot_service_revenue, unpivot_service_tranche,
)
from tests.conftest import by_key, rows

REVENUE = "Oid string, Student string, SchoolService string, Branch string, CurrentSchoolYear string, `1` string, `2` string, `3` string"
TRANCHE = (
    "Oid string, Student string, SchoolService string, Branch string, CurrentSchoolYear string, Zone string, ShuttleType string,"
    " TR1 string, TR2 string, `Tranche 1(22-23)` string"
)


@pytest.fixture
def revenue_wide(spark):
    return spark.createDataFrame(
        [("r-1", "amel", "bus", "north", "y8", "42,50", "17,25", None), ("r-2", "badr", "bus", "south", "y8", "8,00", None, "1,75")], REVENUE
    )


@pytest.fixture
def tranche_wide(spark):
    return spark.createDataFrame([("t-1", "amel", "meals", "north", "y8", "coast", "van", "90,40", "11,00", "35,05")], TRANCHE)


def test_revenue_rows_without_empty_months(revenue_wide):
    got = {(r.SourceOid, r.MonthNumber, r.Amount) for r in unpivot_service_revenue(revenue_wide).collect()}
    assert got == {("r-1", 1, 42.5), ("r-1", 2, 17.25), ("r-2", 1, 8.0), ("r-2", 3, 1.75)}


def test_revenue_columns(revenue_wide):
    schema = unpivot_service_revenue(revenue_wide).schema
    assert schema.names == ["SourceOid", "StudentOid", "ServiceOid", "BranchOid", "SchoolYearOid", "MonthNumber", "Amount"]
    assert schema["Amount"].dataType == T.DoubleType() and schema["MonthNumber"].dataType == T.IntegerType()


def test_revenue_of_no_rows_or_no_months(revenue_wide):
    assert unpivot_service_revenue(revenue_wide.limit(0)).count() == 0
    bare = revenue_wide.drop("1", "2", "3")
    without = unpivot_service_revenue(bare)
    assert without.count() == 0 and "Amount" in without.columns
    assert revenue_cast_report(bare).count() == 0
    assert bare.select(filled_cells(bare, [])).distinct().collect() == [(0,)]


def test_revenue_drops_and_reports_bad_cells(spark):
    cells = [("abc", "1 234,56", "7,5"), ("NaN", "1d", None)]
    frame = spark.createDataFrame([("o", "s", "v", "b", "y", *c) for c in cells], REVENUE)
    assert [r.Amount for r in unpivot_service_revenue(frame).collect()] == [7.5]
    months = detect_month_columns(frame)
    assert sorted(r[0] for r in frame.select(filled_cells(frame, months)).collect()) == [0, 1]
    assert by_key(revenue_cast_report(frame)) == {1: (2, 0, 2), 2: (2, 0, 2), 3: (1, 1, 0)}


def test_months_keep_month_order(spark):
    frame = spark.createDataFrame([("x", "1", "2", "3", "4")], "Oid string, `12` string, `2` string, `10` string, `13` string")
    assert detect_month_columns(frame) == ["2", "10", "12"]


def test_tranche_detection(tranche_wide):
    assert detect_tranche_columns(tranche_wide) == {"TR1": 1, "TR2": 2, "Tranche 1(22-23)": 1}


def test_tranche_detection_by_pattern(spark):
    names = ["tr3", "Tranche_1_24_25", "tranche2", "Tranche_1_solde", "TR1_solde", "XTR1", "TR", "Zone"]
    frame = spark.createDataFrame([tuple("1" for _ in names)], ", ".join(f"`{n}` string" for n in names))
    assert detect_tranche_columns(frame) == {"tr3": 3, "Tranche_1_24_25": 1, "tranche2": 2, "Tranche_1_solde": 1}
    assert "Tranche_1_solde" not in detect_tranche_columns(frame, exclude_balances=True)


def test_tranche_rows(tranche_wide):
    tall = unpivot_service_tranche(tranche_wide)
    assert sorted((r.SliceNumber, r.Amount) for r in tall.collect()) == [(1, 35.05), (1, 90.4), (2, 11.0)]
    assert tall.schema["SliceNumber"].dataType == T.IntegerType()
    assert {"ZoneOid", "ShuttleTypeOid"} <= set(tall.columns)


def test_tranche_cells_that_are_no_number_are_reported(tranche_wide):
    from pyspark.sql import functions as F

    dirty = tranche_wide.withColumns({"TR2": F.lit("n/a"), "Tranche_3_solde": F.lit("1,5")})
    assert by_key(tranche_cast_report(dirty)) == {"TR1": (1, 1, 0), "TR2": (1, 0, 1), "Tranche 1(22-23)": (1, 1, 0), "Tranche_3_solde": (1, 1, 0)}
    assert "Tranche_3_solde" not in by_key(tranche_cast_report(dirty, exclude_balances=True))
    assert tranche_cast_report(tranche_wide.select("Oid")).count() == 0


def test_tranche_of_no_rows(tranche_wide):
    assert unpivot_service_tranche(tranche_wide.limit(0)).count() == 0
    assert unpivot_service_tranche(tranche_wide.select("Oid")).count() == 0


def test_row_sum_skips_balances_identifiers_and_nulls(spark):
    schema = "Oid string, Order int, GCRecord int, TR1 double, TR2 double, TR1_solde double, Note string"
    frame = spark.createDataFrame([("a", 3, None, 1.5, 2.0, 9.0, "7"), ("b", 4, None, None, None, 9.0, None)], schema)
    assert detect_amount_columns(frame) == ["TR1", "TR2"]
    assert rows(sum_tranches(frame).select("Oid", "Amount").orderBy("Oid")) == [("a", 3.5), ("b", 0.0)]


def test_numeric_cells_need_no_parsing(spark):
    from decimal import Decimal

    schema = "Oid string, TR1 decimal(19,4), TR2 double"
    frame = spark.createDataFrame([("a", Decimal("1.2350"), 2.5), ("b", None, float("nan")), ("c", Decimal("7"), None)], schema)
    tall = unpivot_service_tranche(frame)
    assert sorted((r.SourceOid, r.SliceNumber, r.Amount) for r in tall.collect()) == [("a", 1, 1.24), ("a", 2, 2.5), ("c", 1, 7.0)]
    assert "RLIKE" not in tall._jdf.queryExecution().executedPlan().toString()
    assert rows(sum_tranches(frame).select("Amount").orderBy("Oid")) == [(1.235 + 2.5,), (0.0,), (7.0,)]
