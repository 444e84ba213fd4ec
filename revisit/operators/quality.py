"""Checks over tables: violations are counted, never dropped."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def count_if(condition: Column) -> Column:
    """Rows where the condition holds; an unknown condition does not count."""
    return F.sum(F.when(condition, 1).otherwise(0)).cast("bigint")


def filled(count: Column) -> Column:
    """A sum over an empty table counts 0."""
    return F.coalesce(count, F.lit(0).cast("bigint"))


def row_count(df: DataFrame, name: str = "rows") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def orphan_rows(fact: DataFrame, key: str, dimension: DataFrame, dimension_key: str | None = None) -> DataFrame:
    """One row: how many fact rows have a key that the dimension lacks. A NULL key is no violation.

    The fact is first counted per key, so neither a hot key nor a large dimension is a problem.
    """
    per_key = fact.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    known = dimension.select(F.col(dimension_key or key).alias(key))
    return per_key.join(known, key, "left_anti").agg(filled(F.sum("rows")).alias("failed_rows"))


def absent_rows(rows: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: how many rows have no equal row in the source on trimmed text keys."""
    texts = source.select(*[F.trim(F.col(k)).alias(k) for k in keys])
    return rows.join(texts, list(keys), "left_anti").agg(F.count(F.lit(1)).alias("failed_rows"))


def union_all(tables: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, tables)


def with_status(checks: DataFrame) -> DataFrame:
    """PASS where nothing failed."""
    status = F.when(F.col("failed_rows") == 0, "PASS").otherwise("FAIL")
    return checks.select("check_name", "failed_rows", status.alias("status"))


def pass_summary(assertions: DataFrame) -> DataFrame:
    passed = filled(count_if(F.col("status") == "PASS"))
    return assertions.agg(passed.alias("passed"), F.count(F.lit(1)).alias("total"))
