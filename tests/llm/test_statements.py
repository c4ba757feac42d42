"""Queries with a statement against DuckDB, and the plans of those that must stay native."""

import math

import duckdb
import pytest

import __spark_entry__ as registered
from scolaria.llm.queries import QUERIES
from scolaria.llm.sql import STATEMENTS


def plain(value):
    return float(value) if isinstance(value, (int, float)) and not isinstance(value, bool) and not math.isnan(value) else value


@pytest.mark.parametrize("key", sorted(STATEMENTS))
def test_query_equals_its_statement(spark, sf_dir, key):
    connection = duckdb.connect()
    for name in ("documents", "pages", "benchmark", "labels"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    result = connection.execute(STATEMENTS[key])
    columns = [c[0] for c in result.description]
    frame = QUERIES[key](spark, sf_dir)
    assert sorted(frame.columns) == sorted(columns)
    want = sorted(([plain(v) for v in row] for row in result.fetchall()), key=str)
    assert sorted(([plain(r[c]) for c in columns] for r in frame.collect()), key=str) == want


@pytest.mark.parametrize("key", ["op2_license_scan", "op4_line_dedup", "op7_quality_rules", "op13_exact_dedup"])
def test_native_queries_run_no_python(spark, sf_dir, key):
    plan = QUERIES[key](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    for node in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin", "ExistingRDD"):
        assert node not in plan


def test_all_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(registered.queries())
    assert {key.split("_")[0] for key in QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(STATEMENTS) <= set(registered.oracle_sql())
