from decimal import ROUND_HALF_UP, Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from revisit.functions.rounding import fraction, mean, percent
from revisit.operators import rates as R


def exact(num, den, scale):
    return float((Decimal(scale) * num / den).quantize(Decimal("0.01"), ROUND_HALF_UP))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(pairs=st.lists(st.tuples(st.integers(0, 10**11), st.integers(1, 10**11)), min_size=1, max_size=50))
def test_rounding_is_half_up_and_exact(spark, pairs):
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a long, b long")
    got = df.orderBy("i").select(percent(F.col("a"), F.col("b")).alias("p"), mean(F.col("a"), F.col("b")).alias("m")).collect()
    for row, (a, b) in zip(got, pairs):
        assert row.p == exact(a, b, 100)
        assert row.m == exact(a, b, 1)


def test_ties_and_zero_denominator(spark):
    df = spark.createDataFrame([(201, 20000), (1, 8), (0, 0), (3, 0)], "a long, b long")
    assert [r[0] for r in df.select(percent(F.col("a"), F.col("b"))).collect()] == [1.01, 12.5, None, None]
    assert [r[0] for r in df.select(fraction(F.col("a"), F.col("b"))).collect()] == [0.01005, 0.125, None, None]


ROWS = [("a", 1, 5), ("a", 0, 7), ("a", None, None), ("b", 1, 2), (None, 0, 1)]
MEASURES = [R.rows("n"), R.total("ones", "flag"), R.flag_percent("pct", "flag"), R.average("avg", "x"), R.share_of_rows("share")]


def frame(spark):
    return spark.createDataFrame(ROWS, "k string, flag int, x int")


def test_null_flags_count_as_rows_but_not_in_the_rate(spark):
    got = {r.k: tuple(r)[1:] for r in R.rate_by(frame(spark), ["k"], MEASURES).collect()}
    assert got == {"a": (3, 1, 50.0, 6.0, 60.0), "b": (1, 1, 100.0, 2.0, 20.0), None: (1, 0, 0.0, 1.0, 20.0)}


def test_filter_and_minimum(spark):
    got = R.rate_by(frame(spark), ["k"], MEASURES[:2], where="x IS NOT NULL", min_rows=2).collect()
    assert [tuple(r) for r in got] == [("a", 2, 1)]


def test_without_keys(spark):
    assert [tuple(r) for r in R.rate_by(frame(spark), [], MEASURES[:3]).collect()] == [(5, 2, 50.0)]


def test_grouping_sets_keep_null_keys_apart(spark):
    df = spark.createDataFrame([("a", "x", 1), (None, "x", 0), ("a", None, 1)], "k string, j string, flag int")
    sets = {"by_k": ["k"], "by_j": ["j"], "both": ["k", "j"]}
    parts = R.parts_by_sets(df, sets, MEASURES[:3])
    for name, keys in sets.items():
        shared = R.finish(parts.where(F.col("table") == name), keys, MEASURES[:3])
        assert sorted(map(str, shared.collect())) == sorted(map(str, R.rate_by(df, keys, MEASURES[:3]).collect()))


def test_top_n_breaks_ties(spark):
    df = spark.createDataFrame([("c", 2), ("a", 2), ("b", 5)], "k string, n int")
    assert [r.k for r in R.top_n(df, [F.col("n").desc(), F.col("k")], 2).collect()] == ["b", "a"]


def test_means_of_fractions_and_negative_numbers(spark):
    df = spark.createDataFrame([("a", 1.25), ("a", 1.5), ("b", -0.5), ("b", 0.25), ("c", -1.0), ("c", -2.0), ("d", -1.0), ("d", 0.0), ("d", 0.0), ("e", None)], "k string, v double")
    found = R.rate_by(df, ["k"], [R.average("mean", "v"), R.total("total", "v")]).collect()
    assert {r.k: (r["mean"], r.total if r.total is None else float(r.total)) for r in found} == {
        "a": (1.38, 2.75), "b": (-0.13, -0.25), "c": (-1.5, -3.0), "d": (-0.33, -1.0), "e": (None, None),
    }
    whole = spark.createDataFrame([(-1,), (-2,)], "v int")
    assert R.rate_by(whole, [], [R.average("mean", "v")]).first()["mean"] == -1.5


def test_numbers_of_many_places_need_no_end(spark):
    assert R.rate_by(spark.createDataFrame([(1 / 3,)], "v double"), [], [R.average("mean", "v")]).first()[0] == 0.33


def test_counts_have_no_limit(spark):
    big = spark.sql("SELECT 9000000000000000000 AS num, 9100000000000000000 AS den")
    assert big.select(percent(F.col("num"), F.col("den"))).first()[0] == 98.9


def test_tables_may_share_their_keys(spark):
    df = spark.createDataFrame([(1, "x"), (1, "y"), (2, "x")], "a int, b string")
    parts = R.parts_by_sets(df, {"one": ["a"], "two": ["a"], "three": ["b"]}, [R.rows("n")]).collect()
    assert sorted((r.table, r.a or 0, r.b or "", r.rows) for r in parts) == [
        ("one", 1, "", 2), ("one", 2, "", 1), ("three", 0, "x", 2), ("three", 0, "y", 1), ("two", 1, "", 2), ("two", 2, "", 1),
    ]


def test_min_rows_needs_no_rows_measure(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k string, v int")
    assert [tuple(r) for r in R.rate_by(df, ["k"], [R.total("t", "v")], min_rows=2).collect()] == [("a", 3)]
