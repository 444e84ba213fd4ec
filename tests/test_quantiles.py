import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from revisit.operators import quantiles as module
from revisit.operators.quantiles import approximate_quantiles, quantiles, upper_fences

P = [0.0, 0.25, 0.5, 0.75, 1.0]


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.one_of(st.none(), st.integers(-200, 200), st.integers(-(2**31), 2**31 - 1)), min_size=1, max_size=80))
def test_equals_linear_interpolation(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x int")
    found = {r.p: r.value for r in quantiles(df, ["x"], P).collect()}
    known = [v for v in values if v is not None]
    if not known:
        assert found == {}
        return
    for p in P:
        assert found[p] == pytest.approx(np.quantile(known, p), rel=1e-12, abs=1e-6)


def test_two_columns_and_fence(spark):
    df = spark.createDataFrame([(1, 10), (2, 20), (3, 30), (10, None)], "a int, b int")
    row = upper_fences(df, ["a", "b"]).first()
    assert (row.a_q1, row.a_q3, row.a_fence) == (1.75, 4.75, 4.75 + 3 * 3.0)
    assert (row.b_q1, row.b_q3, row.b_fence) == (15.0, 25.0, 55.0)


def test_half_of_all_rows_on_one_value(spark):
    df = spark.range(100_000).selectExpr("CAST(CASE WHEN id % 2 = 0 THEN 7 ELSE id END AS INT) AS x")
    known = [7 if i % 2 == 0 else i for i in range(100_000)]
    found = {r.p: r.value for r in quantiles(df, ["x"], P).collect()}
    assert found == {p: float(np.quantile(known, p)) for p in P}


def test_approximate_form_returns_values_that_occur(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "x double")
    assert [r.value for r in approximate_quantiles(df, ["x"], [0.25]).collect()] == [1.0]
    ints = spark.createDataFrame([(1,), (2,), (3,), (10,)], "x int")
    assert upper_fences(ints, ["x"], exact=False).first().x_q1 == 1.0


def test_only_numbers(spark):
    with pytest.raises(TypeError):
        quantiles(spark.createDataFrame([("a",)], "id string"), ["id"], P)


KINDS = {
    "double": st.one_of(st.none(), st.floats(allow_nan=False, allow_infinity=False, width=64), st.sampled_from([0.0, -0.0, 5e-324, -5e-324, 2.0**-1022, 1.0, 2.0])),
    "float": st.one_of(st.none(), st.floats(allow_nan=False, allow_infinity=False, width=32)),
    "bigint": st.one_of(st.none(), st.integers(-(2**63), 2**63 - 1), st.integers(-3, 3)),
}


@pytest.mark.parametrize("kind", KINDS)
@pytest.mark.parametrize("bits", [16, 1])
def test_every_numeric_type(spark, monkeypatch, kind, bits):
    """With small blocks every level is gone through."""
    monkeypatch.setattr(module, "BLOCK_BITS", bits)

    @settings(max_examples=4 if bits == 1 else 3, deadline=None)
    @given(values=st.lists(KINDS[kind], min_size=1, max_size=60))
    def check(values):
        known = sorted(float(v) for v in values if v is not None)
        found = {r.p: r.value for r in quantiles(spark.createDataFrame([(v,) for v in values], f"x {kind}"), ["x"], P).collect()}
        if not known:
            assert found == {}
            return
        for p in P:
            place = p * (len(known) - 1)
            low, high = known[int(place)], known[-int(-place // 1)]
            above = place - int(place)
            assert found[p] == (low if low == high else low + (high - low) * above if kind == "bigint" else low * (1 - above) + high * above)

    check()


def test_keys_stand_in_the_order_of_doubles(spark):
    tiny = [5e-324 * k for k in (1, 2, 2**51, 2**52 - 1, 2**52, 2**52 + 1)]
    sizes = [*tiny, 1e-300, 0.1, 0.5, 1.0, 1.0 + 2**-52, 2.0, 3.0, 4.0 - 2**-51, 4.0, 1e23, 1.7976931348623157e308, float("inf")]
    values = [*(-x for x in reversed(sizes)), 0.0, *sizes, float("nan")]
    keyed, names = module.with_keys(spark.createDataFrame([(x,) for x in values], "x double").coalesce(1), ["x"], [module.T.DoubleType()])
    assert names == [["_key0_0"]]
    keys = [r["_key0_0"] for r in keyed.collect()]
    assert keys == sorted(set(keys))
    import struct

    known = [struct.unpack("<q", struct.pack("<d", x))[0] for x in (0.0, *sizes)]
    assert keys[len(sizes) : -1] == known


def test_decimals_wide_and_narrow(spark, monkeypatch):
    monkeypatch.setattr(module, "BLOCK_BITS", 1)
    raw = ["-99999999999999999999.123456789012345678", "-1.5", "0.000000000000000001", "2.25", "2.25", "12345678901234567890.5", None]
    for kind in ("decimal(38,18)", "decimal(22,1)", "decimal(10,2)"):
        values = [v if v is None or kind != "decimal(10,2)" else v[-6:].replace("-", "") for v in raw]
        df = spark.createDataFrame([(v,) for v in values], "x string").selectExpr(f"CAST(x AS {kind}) AS x")
        known = sorted(r.x for r in df.collect() if r.x is not None)
        found = {r.p: r.value for r in quantiles(df, ["x"], [0.0, 0.2, 0.6, 1.0]).collect()}
        assert found == {p: float(known[round(p * 5)]) for p in (0.0, 0.2, 0.6, 1.0)}


def test_many_rows_and_a_hot_value(spark):
    df = spark.range(300_000).selectExpr("CASE WHEN id % 3 = 0 THEN 0.5 ELSE id / 7.0D END AS x", "id * 1000003 AS y")
    x = np.where(np.arange(300_000) % 3 == 0, 0.5, np.arange(300_000) / 7.0)
    found = {(r.name, r.p): r.value for r in quantiles(df, ["x", "y"], P).collect()}
    for p in P:
        assert found["x", p] == pytest.approx(np.quantile(x, p), rel=1e-12)
        assert found["y", p] == pytest.approx(np.quantile(np.arange(300_000) * 1000003, p), rel=1e-12)
