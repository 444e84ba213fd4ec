import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from revisit.operators.keys import first_per_entity, group_size, sequence, surrogate_key
from revisit.operators.reshape import pooled_distinct, to_long


def brute_sequence(pairs):
    seen, out = {}, {}
    for entity, order in sorted(pairs):
        seen[entity] = seen.get(entity, 0) + 1
        out[order] = seen[entity]
    return out


def run_sequence(spark, pairs, **limits):
    df = spark.createDataFrame(pairs, "e long, o long")
    return {r.o: r.seq for r in sequence(df, "e", "o", **limits).collect()}


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    orders=st.lists(st.integers(-(2**63), 2**63 - 1), unique=True, min_size=1, max_size=60),
    hot=st.integers(1, 8),
    bits=st.integers(1, 20),
    seed=st.integers(0, 99),
)
def test_sequence_split_over_the_whole_number_range(spark, orders, hot, bits, seed):
    rng = random.Random(seed)
    pairs = [(rng.choice([1, 1, 1, 2, 3]), o) for o in orders]
    assert run_sequence(spark, pairs, hot_rows=hot, block_bits=bits) == brute_sequence(pairs)


def test_hot_entity_is_cut_into_bounded_blocks(spark):
    """One entity holds a third of the rows; no window group exceeds the bound."""
    pairs = [(0 if i % 3 == 0 else i, i) for i in range(30_000)]
    assert run_sequence(spark, pairs, hot_rows=1_000, block_bits=9) == brute_sequence(pairs)


def test_sequence_without_hot_entities(spark):
    pairs = [(i % 5, 100 - i) for i in range(40)]
    assert run_sequence(spark, pairs) == brute_sequence(pairs)


def test_first_per_entity_and_size(spark):
    df = spark.createDataFrame([(1, 5, "b"), (1, 2, "a"), (2, 9, None)], "p long, e long, race string")
    assert sorted(first_per_entity(df, "p", "e", ["race"], "n").collect()) == [(1, "a", 2), (2, None, 1)]


def test_group_size(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (None, "e")], "k int, v string")
    found = {(r.k, r.v, r.n) for r in group_size(df, "k", "n").collect()}
    assert found == {(1, "a", 2), (1, "b", 2), (2, "c", 1), (None, "d", 2), (None, "e", 2)}


def test_null_entities_are_cut_into_blocks(spark):
    df = spark.range(200).select(F.when(F.col("id") % 3 > 0, F.col("id") % 2).alias("entity"), "id")
    found = sequence(df, "entity", "id", hot_rows=10, block_bits=3)
    places = {}
    for r in sorted(found.collect(), key=lambda r: r.id):
        places[r.entity] = places.get(r.entity, 0) + 1
        assert r.seq == places[r.entity]
    assert sum(places.values()) == 200 and places[None] == 67


def test_surrogate_key_is_dense_in_order(spark):
    df = spark.createDataFrame([("b", 2), ("a", 1), ("x", None), ("c", 2)], "label string, mid int")
    keys = surrogate_key(df, "k", ["mid"]).orderBy("k").collect()
    assert [(r.k, r.label) for r in keys] == [(1, "a"), (2, "b"), (3, "c"), (4, "x")]


def test_surrogate_key_has_no_limit_and_no_single_task(spark):
    labels = spark.range(150_000).select(F.concat(F.lit("l"), F.reverse(F.col("id").cast("string"))).alias("label")).distinct()
    keys = surrogate_key(labels, "k", ["label"])
    found = keys.agg(F.count("*"), F.min("k"), F.max("k"), F.count_distinct("k")).first()
    assert tuple(found) == (150_000, 1, 150_000, 150_000)
    ordered = keys.orderBy("k").select("label").collect()
    assert [r.label for r in ordered] == sorted(r.label for r in ordered)
    numbering = [line for line in keys._jdf.queryExecution().executedPlan().toString().splitlines() if "Window" in line and "row_number" in line]
    assert numbering and all("_range" in line for line in numbering)


def test_unpivot_reads_once_and_pools_distinct(spark):
    df = spark.createDataFrame([(1, "Up", "No"), (2, None, "Down")], "id int, m_a string, m_b string")
    long = to_long(df, ["id"], {"m_a": "a", "m_b": "b"}, "drug", "dose", ["Up", "Down"])
    assert sorted(long.collect()) == [(1, "a", "Up"), (2, "b", "Down")]
    assert sorted(r.v or "" for r in pooled_distinct(df, ["m_a", "m_b"], "v").collect()) == ["", "Down", "No", "Up"]
    many = spark.range(10).select("id", F.lit("Up").alias("m_a"), F.lit("No").alias("m_b"))
    assert to_long(many, ["id"], {"m_a": "a", "m_b": "b"}, "drug", "dose", ["Up"]).count() == 10
