"""Exact sums of any doubles, in parts that add up in any order.

A double is a whole number times a power of two, so it is cut into digits of 24 bits that stand at fixed
places. Digits are summed place by place as whole numbers: partial sums of tasks, groups and earlier results
add up without rounding, and the order of the rows never matters. A place holds 2**39 rows before it is
full. The places that a column needs follow from its smallest and largest size. NaN and the two infinities are counted.

What becomes of a total, its mean or its share is worked out once per group, in whole numbers of any size.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DIGIT = 24
LOWEST = -1080  # the power of two of place 0; doubles end at -1074
RADIX = float(1 << DIGIT)
SPECIAL = ("nan", "up", "down")


def _scaled(x: Column, power: int) -> Column:
    """``x`` times two to the given power, exactly where the result has digits; the factor may be beyond a double."""
    while abs(power) > 900:
        step = 900 if power > 0 else -900
        x, power = x * F.lit(2.0**step), power - step
    return x * F.lit(2.0**power)


def _digit(x: Column, place: int) -> Column:
    """The digit of ``x`` at a place, with its sign; 0 for what lies wholly above or isn't finite."""
    y = _scaled(x, -(LOWEST + DIGIT * place))
    # a double has 53 bits, so from 2**77 on nothing of it is left below 2**24
    return F.when(F.abs(y) < F.lit(2.0**77), (y % F.lit(RADIX)).cast("bigint")).otherwise(F.lit(0).cast("bigint"))


def _place(size: float, bits_below: int) -> int:
    """The place of a size's highest bit, less some bits, and one more for safety at the upper end."""
    exponent = Fraction(size).numerator.bit_length() - Fraction(size).denominator.bit_length()
    return max(0, (exponent - bits_below - LOWEST) // DIGIT)


def digit_sums(df: DataFrame, values: Mapping[str, Column]) -> list[Column]:
    """Aggregates of ``df`` that add up the given columns of doubles: ``name__place`` and ``name__nan``, ``__up``, ``__down``.

    One pass over ``df`` finds the smallest and largest size of each column first.
    """
    wide = {name: value.cast("double") for name, value in values.items()}
    sizes = {name: F.abs(F.when(~F.isnan(x) & (F.abs(x) != float("inf")) & (x != 0), x)) for name, x in wide.items()}
    ends = df.agg(*[f(size).alias(f"{name}_{f.__name__}") for name, size in sizes.items() for f in (F.min, F.max)]).first()
    out = []
    for name, x in wide.items():
        low, high = ends[f"{name}_min"], ends[f"{name}_max"]
        if low is not None:
            for place in range(_place(low, 54), _place(high, -1) + 1):
                out.append(F.sum(_digit(x, place)).alias(f"{name}__{place}"))
        infinite = (x == float("inf"), x == float("-inf"))
        out += [F.count_if(test).alias(f"{name}__{kind}") for kind, test in zip(SPECIAL, (F.isnan(x), *infinite))]
    return out


def is_split(columns: list[str], name: str) -> bool:
    return f"{name}__nan" in columns


def parts_of(columns: list[str], name: str) -> list[str]:
    """The columns that make up a part: itself, or its places and counts."""
    return [c for c in columns if c == name or c.startswith(f"{name}__")]


def gathered(columns: list[str], name: str, renamed: Callable[[str], str] = str) -> Column:
    """The places and counts of a sum as one value; ``renamed`` says where to find them if under other names."""
    places = [c for c in parts_of(columns, name) if c.rpartition("__")[2].isdigit()]
    entries = [F.struct(F.lit(int(c.rpartition("__")[2])).alias("place"), F.coalesce(F.col(renamed(c)), F.lit(0)).cast("bigint").alias("n")) for c in places]
    digits = F.array(*entries) if entries else F.array().cast("array<struct<place:int,n:bigint>>")
    return F.struct(digits.alias("digits"), *[F.coalesce(F.col(renamed(f"{name}__{kind}")), F.lit(0)).cast("bigint").alias(kind) for kind in SPECIAL], F.lit(None).cast("string").alias("number"))


def as_sum(number: Column) -> Column:
    """A decimal or whole number in the form of ``gathered``."""
    none = F.lit(0).cast("bigint")
    return F.struct(F.array().cast("array<struct<place:int,n:bigint>>").alias("digits"), *[none.alias(kind) for kind in SPECIAL], number.cast("string").alias("number"))


def _value(row: Mapping) -> Fraction | float | None:
    if row["nan"] or (row["up"] and row["down"]):
        return float("nan")
    if row["up"] or row["down"]:
        return float("inf") if row["up"] else float("-inf")
    if row["number"] is not None:
        return Fraction(row["number"])
    whole = sum(d["n"] << (DIGIT * d["place"]) for d in row["digits"])
    return Fraction(whole, 1 << -LOWEST)


def half_up(value: Fraction) -> float:
    """Rounded half away from zero to two decimals."""
    cents = (200 * abs(value.numerator) + value.denominator) // (2 * value.denominator)
    return (-cents if value < 0 else cents) / 100


def _one_quotient(top: Fraction | float, bottom: Fraction | float, scale: int) -> float | None:
    """Rounded; floats here are NaN and the infinities."""
    if bottom == 0:
        return None
    if isinstance(bottom, float):
        return 0.0 if isinstance(top, Fraction) and bottom == bottom else float("nan")
    if isinstance(top, float):
        return top if bottom > 0 else -top
    return half_up(scale * top / bottom)


def _quotients(above: pa.Array, below: list[Fraction | float], scale: int) -> pa.Array:
    tops = above.to_pylist()
    return pa.array([_one_quotient(_value(top), bottom, scale) if bottom else None for top, bottom in zip(tops, below)], pa.float64())


def _counts(count: pa.Array) -> list[Fraction]:
    return [Fraction(n or 0) for n in count.to_pylist()]


@F.arrow_udf(T.DoubleType())
def exact_mean(total: pa.Array, count: pa.Array) -> pa.Array:
    """Sum over count with two decimals; NULL for no count. NaN and infinities stay what they are."""
    return _quotients(total, _counts(count), 1)


@F.arrow_udf(T.DoubleType())
def exact_percent(total: pa.Array, count: pa.Array) -> pa.Array:
    """100 times a sum over a count with two decimals; NULL for no count."""
    return _quotients(total, _counts(count), 100)


@F.arrow_udf(T.DoubleType())
def exact_share(total: pa.Array, whole: pa.Array) -> pa.Array:
    """100 times a sum over another one with two decimals; NULL if that is zero."""
    return _quotients(total, [_value(row) for row in whole.to_pylist()], 100)


@F.arrow_udf(T.DoubleType())
def nearest_double(total: pa.Array, count: pa.Array) -> pa.Array:
    """The double nearest to the sum, an infinity beyond all doubles; NULL for no count."""

    def one(row: Mapping) -> float:
        value = _value(row)
        try:
            return float(value)
        except OverflowError:
            return float("inf") if value > 0 else float("-inf")

    return pa.array([one(row) if n else None for row, n in zip(total.to_pylist(), count.to_pylist())], pa.float64())
