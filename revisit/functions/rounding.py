"""Percentages and means rounded half away from zero to two decimals, exact because they stay decimal.

``round`` on doubles depends on the engine at ties (1.005); whole-number division does not. Numerators
are whole numbers or decimals of up to six places, of any sign; denominators are counts.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EXACT = "decimal(38,6)"


def _half_up(numerator: Column, denominator: Column, scale: int) -> Column:
    num, den = numerator.cast(EXACT), denominator.cast("decimal(20,0)")
    twice = F.nullif(den * 2, F.lit(0).cast("decimal(21,0)"))
    size = F.call_function("div", (F.abs(num) * F.lit(2 * scale)).cast(EXACT) + den, twice)
    return F.when(num < 0, -size).otherwise(size) / F.lit(100.0)


def percent(numerator: Column, denominator: Column) -> Column:
    """``100 * numerator / denominator`` with two decimals; NULL for a zero denominator."""
    return _half_up(numerator, denominator, 10_000)


def mean(total: Column, count: Column) -> Column:
    """``total / count`` with two decimals; NULL for a zero count."""
    return _half_up(total, count, 100)


def fraction(numerator: Column, denominator: Column) -> Column:
    """Unrounded quotient; NULL for a zero denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))
