import random
from decimal import ROUND_HALF_EVEN, ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from scolaria.functions.parsing import comma_decimal, lenient_double
from scolaria.functions.rounding import half_even, half_up, mean_of_rates, percent, stddev_from_moments
from scolaria.functions.schools import normalize_school
from tests.conftest import by_key, rows


@pytest.mark.parametrize(
    "text, value",
    [
        ("100,00", 100.0), ("150.5", 150.5), (" 12,5 ", 12.5), ("-3,005", -3.0), ("1e2", 100.0), (",5", 0.5),
        ("abc", None), ("1 234,56", None), ("1.234,56", None), ("NaN", None), ("1d", None), ("inf", None), ("", None), (None, None),
    ],
)
def test_comma_decimal(spark, text, value):
    frame = spark.createDataFrame([(text,)], "t string")
    assert rows(frame.select(comma_decimal(F.col("t")))) == [(value,)]


def test_comma_decimal_rounds_to_even_cents(spark):
    frame = spark.createDataFrame([("0,125",), ("0,375",), ("7,0049",)], "t string")
    assert [r[0] for r in rows(frame.select(comma_decimal(F.col("t"))))] == [0.12, 0.38, 7.0]


def test_lenient_double_takes_numbers_and_decimals(spark):
    frame = spark.createDataFrame([(Decimal("12.3400"), 5)], "d decimal(19,4), i int")
    assert rows(frame.select(lenient_double(F.col("d")), lenient_double(F.col("i")))) == [(12.34, 5.0)]


def test_rounding_follows_decimal_arithmetic(spark):
    random.seed(7)
    pairs = [(random.randint(0, n), n) for n in (random.choice([3, 7, 16, 40, 200, 1000]) for _ in range(3000))]
    frame = spark.createDataFrame(pairs, "k long, n long").withColumn("x", F.col("k") / F.col("n") * 100)
    got = frame.select("k", "n", half_up(F.col("x"), 2), half_even(F.col("x"), 1), percent(F.col("k"), F.col("n"))).collect()
    for k, n, up, even, pct in got:
        exact = Decimal(100 * k) / Decimal(n)
        assert up == float(exact.quantize(Decimal("0.01"), ROUND_HALF_UP))
        assert even == float(exact.quantize(Decimal("0.1"), ROUND_HALF_EVEN))
        assert pct == float(exact.quantize(Decimal("0.1"), ROUND_HALF_UP))


def test_empty_groups_have_no_rate(spark):
    frame = spark.createDataFrame([(0, 0)], "k long, n long")
    assert rows(frame.select(percent(F.col("k"), F.col("n")))) == [(None,)]
    nothing = spark.createDataFrame([], "r double")
    assert rows(nothing.agg(mean_of_rates(F.col("r")))) == [(None,)]


def test_stddev_from_moments_equals_the_aggregate(spark):
    values = [("a", "3.25"), ("a", "7.00"), ("a", "19.50"), ("b", "12.34"), ("b", "12.34"), ("c", "5.00")]
    frame = spark.createDataFrame([(g, Decimal(v)) for g, v in values], "g string, v decimal(5,2)")
    v = F.col("v")
    sums = frame.groupBy("g").agg(
        stddev_from_moments(F.count(v), F.sum(v), F.sum(v * v)).alias("ours"), F.stddev_samp(v.cast("double")).alias("theirs")
    )
    got = by_key(sums)
    assert got["a"][0] == pytest.approx(got["a"][1])
    assert got["b"][0] == 0.0
    assert got["c"] == (None, None)


@pytest.mark.parametrize(
    "raw, canonical",
    [
        ("HS1", "Sahloul 4 / HS"), (" hs ", "Other / Unknown"), ("lycée hs sahara", "Sahloul 4 / HS"), ("Amad Sahloul", "Amad"),
        ("Les Élites", "Les Élites / AKC"), ("المنستير", "Monastir International"), ("SLS", "SLS Leaders School"), ("hs\t", "Other / Unknown"),
        ("Village school", "Other / Unknown"), ("", "Other / Unknown"), (None, "Other / Unknown"),
    ],
)
def test_normalize_school(spark, raw, canonical):
    frame = spark.createDataFrame([(raw,)], "s string")
    assert rows(frame.select(normalize_school(F.col("s")))) == [(canonical,)]
