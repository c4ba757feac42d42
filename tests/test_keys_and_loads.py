from types import SimpleNamespace

import pytest

from scolaria.operators import load
from scolaria.operators.keys import (
    KeyLookup, dimension_key_copies, duplicate_keys, load_counts, not_loaded, resolve_keys, unknown_key_values, unknown_keys,
)
from scolaria.operators.reshape import unpivot_service_revenue
from scolaria.session import shared_folder
from scolaria.sources.school_model import school_model
from scolaria.sources.tables import (
    ParquetTables, broadcast_if_small, extract_date_keys, extract_dim_keys, extract_service_report, extract_service_report_tranche,
    extract_table, has_few_rows,
)
from tests.conftest import by_key, rows


@pytest.fixture
def billing(spark, school):
    wide = (
        "Oid string, Student string, SchoolService string, Branch string, CurrentSchoolYear string, GCRecord int,"
        " `1` string, `2` string, `9` string"
    )
    tranche = (
        "Oid string, Student string, SchoolService string, Branch string, CurrentSchoolYear string, Zone string, `Order` int,"
        " GCRecord int, TR1 string, TR2 decimal(19,4), TR1_solde string"
    )
    from decimal import Decimal

    return {
        **school,
        "DimBranch": spark.createDataFrame([(1, "u", "UNKNOWN"), (2, "b", "B"), (9, "b", "B again")], "BranchKey long, BranchOid string, Code string"),
        "DimService": spark.createDataFrame([(4, "v", "S")], "ServiceKey long, ServiceOid string, Code string"),
        "DimZone": spark.createDataFrame([(7, "u", "UNKNOWN")], "ZoneKey long, ZoneOid string, Code string"),
        "StudentServiceReport": spark.createDataFrame(
            [
                ("r1", "s2", "v", "b", "y1", None, "10,00", None, "5,5"),
                ("r2", "nobody", None, "b", "y2", None, None, "20,00", "bad"),
                ("r3", "s3", "v", "b", "y1", 1, "1,00", "1,00", "1,00"),
                (None, "s4", "v", None, "y1", None, "3,00", None, None),
            ],
            wide,
        ),
        "StudentServiceReportTranche": spark.createDataFrame(
            [
                ("t1", "s2", "v", "b", "y1", "z", 5, None, "100.5", Decimal("1.2500"), "50"),
                ("t2", "s9", "v", "b", "y1", "z", 6, 1, "x", None, "50"),
            ],
            tranche,
        ),
    }


def test_extractors(billing):
    assert extract_table(billing, "DimStudent").count() == 8
    assert extract_table(billing, "DimStudent", "Governorate = 'Sousse'").count() == 3
    assert {r.Oid for r in extract_service_report(billing).collect()} == {"r1", "r2", None}
    assert extract_dim_keys(billing, "DimStudent", "StudentOid", "StudentKey").columns == ["StudentOid", "StudentKey"]
    assert dict(extract_date_keys(billing).dtypes)["FullDate"] == "date"
    tranche = extract_service_report_tranche(billing)
    assert {t for c, t in tranche.dtypes if c in ("TR1", "TR2", "TR1_solde")} == {"double"}
    assert rows(tranche.select("Oid", "TR1", "GCRecord").orderBy("Oid")) == [("t1", 100.5, None), ("t2", None, 1)]


def test_unknown_keys_fall_back(billing):
    got = unknown_key_values(billing)
    # the student dimension has no all-zero Oid, services no UNKNOWN row, the shuttle table is absent
    assert got == {"BranchKey": 1, "StudentKey": -1, "ServiceKey": -1, "SchoolYearKey": 1, "ZoneKey": 7, "ShuttleTypeKey": -1, "DateKey": -1}
    no_code = {**billing, "DimSchoolYear": billing["DimSchoolYear"].drop("Code")}
    assert unknown_key_values(no_code)["SchoolYearKey"] == -1


def test_unknown_keys_is_one_row(billing):
    assert unknown_keys(billing).count() == 1


def test_resolve_keys(spark, billing):
    frame = spark.createDataFrame([("b",), ("zzz",), (None,)], "Branch string")
    lookup = [KeyLookup("Branch", "BranchKey", "DimBranch", "BranchOid", "BranchKey")]
    got = by_key(resolve_keys(frame, lookup, billing, {"BranchKey": 1}))
    assert got == {"b": (9,), "zzz": (1,), None: (1,)}
    assert set(by_key(resolve_keys(frame, lookup, billing, {})).values()) == {(9,), (-1,)}


def test_not_loaded_matches_nulls(spark):
    incoming = spark.createDataFrame([("a", 1), ("a", 2), (None, 1), (None, 2)], "SourceOid string, MonthNumber int")
    loaded = spark.createDataFrame([("a", 1), (None, 2), (None, 2)], "SourceOid string, MonthNumber int")
    assert sorted(rows(not_loaded(incoming, loaded, "SourceOid", "MonthNumber")), key=str) == [("a", 2), (None, 1)]
    assert rows(load_counts(incoming, loaded, "SourceOid", "MonthNumber")) == [(2, 2)]


def test_empty_text_is_not_null(spark):
    incoming = spark.createDataFrame([("",), (None,)], "SourceOid string")
    loaded = spark.createDataFrame([("",)], "SourceOid string")
    assert rows(not_loaded(incoming, loaded, "SourceOid")) == [(None,)]


def test_duplicate_keys(spark):
    frame = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1)], "SourceOid string, MonthNumber int")
    assert rows(duplicate_keys(frame, "SourceOid", "MonthNumber")) == [("a", 1, 2)]


def test_revenue_load_twice(spark, billing, tmp_path):
    root = str(tmp_path)
    first = load.load_service_revenue(spark, billing, root)
    assert (first.inserted, first.skipped) == (4, 0)
    again = load.load_service_revenue(spark, billing, root)
    assert (again.inserted, again.skipped) == (0, 4)
    fact = ParquetTables(spark, root)[load.REVENUE_TABLE]
    assert fact.columns == load.REVENUE_COLUMNS
    got = {(r.SourceOid, r.MonthNumber): (r.StudentKey, r.ServiceKey, r.BranchKey, r.MonthlyAmount) for r in fact.collect()}
    assert got == {
        ("r1", 1): (2, 4, 9, 10.0), ("r1", 9): (2, 4, 9, 5.5), ("r2", 2): (-1, -1, 9, 20.0), (None, 1): (4, 4, 1, 3.0),
    }
    assert {(r.DateKey, r.ZoneKey, r.ShuttleTypeKey) for r in fact.collect()} == {(-1, 7, -1)}


def test_revenue_load_adds_new_months_only(spark, billing, tmp_path):
    root = str(tmp_path)
    load.load_service_revenue(spark, billing, root)
    report = billing["StudentServiceReport"]
    later = {**billing, "StudentServiceReport": report.withColumn("2", report["9"])}
    result = load.load_service_revenue(spark, later, root)
    # r1 gains month 2; r2 loses its only readable cell; the rest is there already
    assert (result.inserted, result.skipped) == (1, 3)


def test_tranche_load_twice(spark, billing, tmp_path):
    root = str(tmp_path)
    assert load.load_service_tranche(spark, billing, root) == load.LoadResult(load.TRANCHE_TABLE, 2, 0)
    assert load.load_service_tranche(spark, billing, root) == load.LoadResult(load.TRANCHE_TABLE, 0, 2)
    fact = ParquetTables(spark, root)[load.TRANCHE_TABLE]
    got = by_key(fact.select("SourceOid", "StudentKey", "SortOrder", "Amount"))
    assert got == {"t1": (2, 5, 101.75), "t2": (-1, 6, 0.0)}


def test_tranche_without_order_column(spark, billing):
    raw = extract_service_report_tranche(billing).drop("Order")
    none = load.loaded_keys(spark, "/nonexistent-target", load.TRANCHE_KEY)
    got = load.tranche_rows(raw, billing, none, unknown_key_values(billing))
    assert {r.SortOrder for r in got.collect()} == {0}


def test_wide_and_tall_loads_agree(spark, sf_dir):
    tables = school_model(spark, sf_dir)
    report = extract_service_report(tables)
    tall = unpivot_service_revenue(report)
    loaded = tall.where("MonthNumber % 3 = 0").select(*load.REVENUE_KEY)
    unknown = unknown_key_values(tables)
    wide = load.revenue_rows(report, tables, loaded, unknown)
    plain = load.revenue_rows_from_tall(tall, tables, loaded, unknown)
    assert wide.columns == plain.columns
    assert wide.exceptAll(plain).count() == 0 and plain.exceptAll(wide).count() == 0
    assert wide.count() > 0


def test_load_all(spark, billing, tmp_path):
    results = load.load_all(spark, billing, str(tmp_path))
    assert [(r.table, r.inserted) for r in results] == [(load.REVENUE_TABLE, 4), (load.TRANCHE_TABLE, 2)]


def test_broadcast_only_below_the_bound(spark):
    frame = spark.range(50)
    assert has_few_rows(frame, 50) and not has_few_rows(frame, 49)
    hinted = broadcast_if_small({"d": frame}, "d", frame)
    assert "ResolvedHint" in hinted._jdf.queryExecution().analyzed().toString()
    big = spark.range(200_000)
    assert "ResolvedHint" not in broadcast_if_small({"d": big}, "d", big)._jdf.queryExecution().analyzed().toString()


def session_of(master, shared):
    conf = {"spark.checkpoint.dir": shared}
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: conf[key] or default, set=conf.__setitem__), sparkContext=SimpleNamespace(master=master))


@pytest.mark.parametrize("master", ["local[4]", "spark://host:7077"])
def test_shared_folder_follows_the_session(master):
    session = session_of(master, "hdfs://store/checkpoints/")
    first, second = shared_folder(session), shared_folder(session)
    assert first != second and first.startswith("hdfs://store/checkpoints/scolaria-")


def test_no_folder_of_one_machine():
    for master in ("local[2]", "local-cluster[2,1,1024]", "yarn"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_folder(session_of(master, None))


def test_report_without_months_loads_nothing(spark, billing, tmp_path):
    bare = {**billing, "StudentServiceReport": billing["StudentServiceReport"].drop("1", "2", "9")}
    assert load.load_service_revenue(spark, bare, str(tmp_path)) == load.LoadResult(load.REVENUE_TABLE, 0, 0)
    assert load.load_service_revenue(spark, billing, str(tmp_path)).inserted == 4


def test_target_left_by_a_failed_load(spark, billing, tmp_path):
    (tmp_path / load.REVENUE_TABLE / "_temporary" / "0").mkdir(parents=True)
    assert load.loaded_keys(spark, str(tmp_path / load.REVENUE_TABLE), load.REVENUE_KEY).count() == 0
    assert load.load_service_revenue(spark, billing, str(tmp_path)).inserted == 4


def test_faults_do_not_become_unknown_keys(billing):
    class Faulty(dict):
        def __getitem__(self, name):
            if name == "DimBranch":
                raise OSError("no connection")
            return super().__getitem__(name)

    with pytest.raises(OSError, match="no connection"):
        unknown_keys(Faulty(billing))


def test_missing_folders_have_no_unknown_row(spark, tmp_path):
    spark.createDataFrame([(3, "UNKNOWN")], "BranchKey long, Code string").write.parquet(str(tmp_path / "DimBranch"))
    found = unknown_key_values(ParquetTables(spark, str(tmp_path)))
    assert found["BranchKey"] == 3 and found["ZoneKey"] == -1


def test_guids_resolve_in_any_case(spark):
    tables = {"DimStudent": spark.createDataFrame([(4, "ab-1F")], "StudentKey long, StudentOid string")}
    frame = spark.createDataFrame([("AB-1f",), ("ab-1F",), ("ab-1",)], "Student string")
    got = resolve_keys(frame, [KeyLookup("Student", "StudentKey", "DimStudent", "StudentOid", "StudentKey")], tables, {"StudentKey": 1})
    assert sorted(rows(got)) == [("AB-1f", 4), ("ab-1", 1), ("ab-1F", 4)]


def test_keys_held_twice_are_counted(spark, school):
    twice = school["DimStudent"].unionAll(school["DimStudent"].where("StudentKey = 3"))
    got = {(r.table, r.key): r.held_twice for r in dimension_key_copies({**school, "DimStudent": twice}).collect()}
    assert got == {("DimStudent", "StudentKey"): 1, ("DimStudent", "StudentOid"): 1, ("DimEvaluationReport", "EvaluationReportKey"): 0}
