"""Every registered query against its SQL statement, and the shape of every physical plan."""

import math
import os
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as registered
from scolaria.plans.registry import BY_YEAR, all_queries
from tests.conftest import TESTDATA

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
# those of this package; an optional part may register more, with tests of its own
QUERIES = {key: query for key, query in registered.queries().items() if key in all_queries()}
# a year without a calendar has no holidays, and without attendance no days to tag
WITHOUT_ROWS = {"a8_holiday_impact_none", "a8_daily_tagged_none"}
STATEMENTS = {key: sql for key, sql in registered.oracle_sql().items() if key in QUERIES}


def plain(value):
    if value is None or isinstance(value, (bool, str)):
        return value
    if isinstance(value, (int, float, Decimal)):
        number = float(value)
        return None if math.isnan(number) else number + 0.0
    return str(value)


def table(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(([plain(r[i]) for i in order] for r in records), key=str)


@pytest.fixture(scope="module")
def database(sf_dir_module):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir_module}/{name}.parquet'")
    return connection


@pytest.fixture(scope="module")
def sf_dir_module():
    if not os.path.isdir(TESTDATA):
        pytest.skip("no test tables")
    return TESTDATA


def test_every_query_has_a_statement():
    assert set(QUERIES) == set(STATEMENTS)
    assert len([k for k in QUERIES if k.endswith("_year")]) >= len(BY_YEAR)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_equals_its_statement(spark, database, sf_dir_module, key):
    frame = QUERIES[key](spark, sf_dir_module)
    result = database.execute(STATEMENTS[key])
    columns = [c[0] for c in result.description]
    expected = result.fetchall()
    assert sorted(frame.columns) == sorted(columns)
    assert table(frame.columns, frame.collect()) == table(columns, expected)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython", "MapInPandas"):
        assert node not in plan


def test_no_statement_is_proved_by_no_rows():
    """At the size of the correctness check every statement has rows, so that the queries it is held against have some."""
    folder = os.path.join(os.path.dirname(TESTDATA), "sf0.01")
    if not os.path.isdir(folder):
        pytest.skip("no test tables of that size")
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    empty = {key for key, sql in STATEMENTS.items() if connection.execute(f"SELECT count(*) FROM ({sql})").fetchone() == (0,)}
    assert empty == WITHOUT_ROWS


def test_entry(spark, sf_dir):
    frame = registered.entry(spark)
    assert frame.columns == ["student_name", "avg_score", "absence_rate", "fail_rate_pct", "payment_count", "risk_score", "risk_level"]
    assert 0 < frame.count() <= 30
