"""Distinct entities from stored parts equal a count of the rows themselves."""

import random

import pytest
from pyspark.sql import functions as F

from revisit.operators.distinct import entity_parts, in_all, pooled, pooled_estimates, sketch_parts

EDGES = [0, 1, -1, 32767, 32768, 32769, -32767, -32768, -32769, 2**40, -(2**40), 2**63 - 1, -(2**63) + 1, None]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    ids = [*EDGES, *[rng.randrange(200_000) for _ in range(300)]]
    return [(rng.choice(["x", "y", None]), rng.choice([1, 2, 3]), rng.choice(ids), rng.randrange(9)) for _ in range(4000)] + [("none", 1, None, 4)]


@pytest.fixture(scope="module")
def parts(spark, rows):
    df = spark.createDataFrame(rows, "a string, b int, id bigint, n int")
    return entity_parts(df, ["a", "b"], "id", {"total": F.col("n"), "rows": F.lit(1)}).cache()


def slow(rows, key):
    out = {}
    for row in rows:
        ids, total, count = out.setdefault(key(row), (set(), [], []))
        ids.add(row[2])
        total.append(row[3])
        count.append(1)
    return {k: (len(ids - {None}), sum(total), len(count)) for k, (ids, total, count) in out.items()}


@pytest.mark.parametrize("keys", [[], ["a"], ["b"], ["a", "b"]])
def test_counts_and_sums_over_coarser_keys(parts, rows, keys):
    got = {tuple(r[k] for k in keys): (r.ids, r.total, r.rows) for r in pooled(parts, keys, "ids", ["total", "rows"]).collect()}
    assert got == slow(rows, lambda row: tuple({"a": row[0], "b": row[1]}[k] for k in keys))


def test_a_filter_and_a_key_without_entities(parts, rows):
    got = {r.a: r.ids for r in pooled(parts, ["a"], "ids", where="b = 1").collect()}
    assert got == {k[0]: v[0] for k, v in slow([r for r in rows if r[1] == 1], lambda row: (row[0],)).items()} and got["none"] == 0
    assert [tuple(r) for r in pooled(parts, [], "ids", where="b = 9").collect()] == [(0,)]


def test_parts_of_parts_can_be_united(spark, rows, parts):
    half = [spark.createDataFrame(rows[i::2], "a string, b int, id bigint, n int") for i in (0, 1)]
    both = entity_parts(half[0], ["a", "b"], "id").unionByName(entity_parts(half[1], ["a", "b"], "id"))
    assert sorted(map(str, pooled(both, ["a"]).collect())) == sorted(map(str, pooled(parts, ["a"]).collect()))


def test_entities_under_several_conditions(parts, rows):
    ids = lambda test: {r[2] for r in rows if test(r)} - {None}
    assert in_all(parts, {"x": "a = 'x'", "y": F.col("a") == "y"}).first()[0] == len(ids(lambda r: r[0] == "x") & ids(lambda r: r[0] == "y"))
    three = {"one": "b = 1", "two": "b = 2", "x": "a = 'x'"}
    assert in_all(parts, three).first()[0] == len(ids(lambda r: r[1] == 1) & ids(lambda r: r[1] == 2) & ids(lambda r: r[0] == "x"))
    assert in_all(parts, {"x": "a = 'x'", "never": "b = 9"}).first()[0] == 0


def test_sketches_come_near(spark):
    df = spark.range(60_000).select((F.col("id") % 4).alias("k"), (F.col("id") % 20_000).alias("e"), F.lit(1).alias("one"))
    parts = sketch_parts(df, ["k"], "e", {"n": F.col("one")})
    rows = pooled_estimates(parts, [], "e", ["n"]).collect()
    assert rows[0].n == 60_000 and abs(rows[0].e - 20_000) < 1200
    assert pooled_estimates(parts, [], "e", where="k = 9").first().e == 0
