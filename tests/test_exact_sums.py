"""Sums and means of doubles against Python's fractions, whatever their sizes and order."""

import math
import random
from fractions import Fraction

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from revisit.operators import exact_sums as X
from revisit.operators import rates as R

MEASURES = [R.rows("n"), R.average("mean", "x"), R.total("sum", "x")]


def means(spark, values, parts=3):
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(parts)
    return R.rate_by(df, [], MEASURES).first()


def slow(values):
    known = [Fraction(v) for v in values if v is not None]
    return X.half_up(sum(known, Fraction(0)) / len(known)) if known else None, float(sum(known, Fraction(0))) if known else None


@pytest.mark.parametrize(
    "values",
    [
        [1 / 3, 2 / 3, 1 / 3], [1e-9] * 7, [1e23, -1e23, 0.25], [1e15 + 0.1, 0.3], [0.1] * 10, [5e-324, -5e-324, 1e308, -1e308, 0.015],
        [1.7e308, 1.6e308, -1.5e308, -1.7e308], [2.0**-1060, 1.0], [0.0, -0.0], [None, 1.005, None], [None], [-0.125, -0.135], [2.0**k for k in range(-1074, 1023, 7)],
    ],
)
def test_means_and_sums_are_exact(spark, values):
    got = means(spark, values)
    assert (got["mean"], got["sum"]) == slow(values)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.floats(allow_nan=False, allow_infinity=False, min_value=-1e300, max_value=1e300), min_size=1, max_size=30))
def test_any_doubles(spark, values):
    got = means(spark, values)
    assert (got["mean"], got["sum"]) == slow(values)


def test_not_finite(spark):
    inf = float("inf")
    for values, expected in [([1.0, inf], inf), ([1.0, -inf], -inf), ([inf, -inf], None), ([1.0, float("nan")], None)]:
        got = means(spark, values)
        assert all(math.isnan(v) if expected is None else v == expected for v in (got["mean"], got["sum"]))
    assert means(spark, [1.7e308] * 3)["sum"] == inf


def test_floats_and_decimals_of_many_places(spark):
    df = spark.createDataFrame([("a", 0.1, "0.00000001"), ("a", 0.2, "1.00999999"), ("b", None, None)], "k string, f float, d string")
    df = df.withColumn("d", F.col("d").cast("decimal(20,8)"))
    got = R.rate_by(df, ["k"], [R.average("f", "f"), R.average("d", "d"), R.total("sum", "d")]).orderBy("k").collect()
    assert [tuple(r)[:3] for r in got] == [("a", 0.15, 0.51), ("b", None, None)] and got[0]["sum"] == 1.01


def test_parts_pool_in_any_order(spark):
    rng = random.Random(2)
    rows = [(i % 3, i % 5, rng.choice([1, -1]) * rng.random() * 10.0 ** rng.randint(-12, 12)) for i in range(300)]
    df = spark.createDataFrame(rows, "a int, b int, x double")
    measures = [*MEASURES, R.share_of_total("share", "x"), R.flag_percent("pct", "x")]
    fine = df.groupBy("a", "b").agg(*R.part_aggregates(df, measures))
    direct = {r.a: tuple(r) for r in R.rate_by(df, ["a"], measures).collect()}
    assert {r.a: tuple(r) for r in R.finish(R.pool_parts(fine, ["a"], measures), ["a"], measures).collect()} == direct
    sets = R.parts_by_sets(df, {"by_a": ["a"], "by_b": ["b"]}, measures)
    assert {r.a: tuple(r) for r in R.finish(sets.where("table = 'by_a'"), ["a"], measures).collect()} == direct
    whole = sum(Fraction(x) for _, _, x in rows)
    for a in range(3):
        own = [Fraction(x) for k, _, x in rows if k == a]
        assert direct[a] == (a, 100, X.half_up(sum(own) / 100), float(sum(own)), X.half_up(100 * sum(own) / whole), X.half_up(sum(own)))


def test_two_halves_with_other_sizes_add_up(spark):
    """Parts of two runs have different places; what one lacks counts as zero."""
    a, b = [1e-9, 3e-9], [1e20, 7.0]
    parts = [spark.createDataFrame([(v,) for v in half], "x double") for half in (a, b)]
    both = [df.agg(*R.part_aggregates(df, MEASURES)) for df in parts]
    pooled = R.pool_parts(both[0].unionByName(both[1], allowMissingColumns=True), [], MEASURES)
    assert R.finish(pooled, [], MEASURES).first()["sum"] == float(sum(map(Fraction, a + b)))
