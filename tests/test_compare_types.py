"""Table compare with columns of every type, and without a key."""

from collections import Counter
from datetime import date, datetime

from revisit.operators import reconcile as C

TYPES = "k int, d date, t timestamp, b boolean, a array<int>, m map<string,int>, s struct<x:int,y:string>, raw binary, text string, n decimal(10,2), f double"


def row(k, **other):
    base = dict(d=date(2020, 1, k), t=datetime(2020, 1, 1, k), b=True, a=[1, k], m={"x": 1, "y": 2}, s=(1, "z"), raw=b"\x01", text="1", n=1, f=1.0)
    base |= other
    return (k, *[base[c] for c in ("d", "t", "b", "a", "m", "s", "raw", "text")], base["n"] if base["n"] is None else __import__("decimal").Decimal(base["n"]), base["f"])


def test_every_type(spark):
    left = spark.createDataFrame([row(1), row(2), row(3), row(4, f=float("nan")), row(5, d=None, a=None, b=None)], TYPES)
    other = dict(d=date(2021, 1, 1), t=datetime(2021, 1, 1), b=False, a=[1, 9], m={"x": 1, "y": 3}, s=(1, "q"), raw=b"\x02", text="1d", n=2, f=1.1)
    right = spark.createDataFrame([row(1), row(2, **other), row(3, m={"y": 2, "x": 1}, f=1.0 + 1e-9, text="1.0"), row(4, f=float("nan")), row(5, d=None, a=[], b=None)], TYPES)
    got = Counter((r.k, r.column_name, r.problem) for r in C.cell_differences(left, right, ["k"]).collect())
    assert got == Counter([*((2, c, "value") for c in other), (5, "a", "value")])
    assert C.cell_differences(left, left, ["k"]).collect() == []


def test_text_is_a_number_only_if_written_as_one(spark):
    pairs = [("1d", "1"), ("1f", "1.0"), ("NaN", "nan"), ("Infinity", "inf"), ("0x1", "1"), ("1e2", "100"), (" 7", "7.0"), ("1_0", "10"), ("", "0"), ("5.", "5"), (".5", "0.5")]
    left = spark.createDataFrame([(i, a) for i, (a, _) in enumerate(pairs)], "k int, v string")
    right = spark.createDataFrame([(i, b) for i, (_, b) in enumerate(pairs)], "k int, v string")
    assert sorted(r.k for r in C.cell_differences(left, right, ["k"]).collect()) == [0, 1, 2, 3, 4, 7, 8]
    numbers = spark.createDataFrame([(0, 1.0), (5, 100.0)], "k int, v double")
    assert sorted((r.k, r.problem) for r in C.cell_differences(left.where("k IN (0, 5)"), numbers, ["k"]).collect()) == [(0, "value")]


def bag(rows):
    return Counter(map(tuple, rows))


def test_bags_of_rows(spark):
    a = [("x", 1.0, None), ("x", 1.0, None), ("y", 0.0, [1]), ("y", 2.0, [1, 2]), ("z", 3.0, []), (None, None, None)]
    b = [("y", -0.0, [1]), ("x", 1.0, None), ("z", 3.0, []), ("z", 3.0, []), (None, None, None), ("y", 2.0, [1, 3])]
    types = "s string, f double, a array<int>"
    left, right = spark.createDataFrame(a, types).repartition(3), spark.createDataFrame(b, types)
    got = bag((r.s, r.f, r.a, r.left_copies, r.right_copies) for r in C.row_surplus(left, right).collect())
    assert got == bag([("x", 1.0, None, 1, 0), ("y", 2.0, "[1,2]", 1, 0), ("z", 3.0, "[]", 0, 1), ("y", 2.0, "[1,3]", 0, 1)])
    assert C.row_surplus(left, left.orderBy("f")).collect() == []
    found = C.differences_without_key(left, right).collect()
    assert Counter((r.pair, r.column_name, r.left_value, r.right_value, r.problem) for r in found) == Counter(
        [(1, "s", "x", "y", "value"), (1, "f", "1.0", "2.0", "value"), (1, "a", None, "[1,3]", "value"), (2, "s", "y", "z", "value"), (2, "f", "2.0", "3.0", "value"), (2, "a", "[1,2]", "[]", "value")]
    )


def test_sides_of_other_types_and_sizes(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "n int, s string")
    right = spark.createDataFrame([(1.0, "a"), (2.0, "b")], "n double, s string")
    assert [tuple(r) for r in C.row_surplus(left, right).collect()] == [(3.0, "c", 1, 0)]
    assert [(r.pair, r.problem) for r in C.differences_without_key(left, right).collect()] == [(1, "missing_right")]
    assert C.row_surplus(left.limit(0), left.limit(0)).collect() == []
