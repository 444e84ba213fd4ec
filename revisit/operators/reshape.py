"""Wide to long, and distinct values pooled from several columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def to_long(
    df: DataFrame, keep: Sequence[str], columns: Mapping[str, str], name: str, value: str, values: Sequence[str]
) -> DataFrame:
    """One row per listed column whose value is in ``values``, from a single scan.

    ``columns`` maps a column to the name it gets in the long table.
    """
    renamed = df.select(*keep, *[F.col(old).alias(new) for old, new in columns.items()])
    return renamed.unpivot(list(keep), list(columns.values()), name, value).where(F.col(value).isin(*values))


def pooled_distinct(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """Distinct values of several columns taken together (one scan instead of a union of scans)."""
    return df.select(F.explode(F.array(*columns)).alias(name)).distinct()


def rows_of(one_row: DataFrame, rows: Sequence[Mapping[str, Column]]) -> DataFrame:
    """Turn a one-row aggregate into several report rows."""
    structs = [F.struct(*[column.alias(name) for name, column in row.items()]) for row in rows]
    return one_row.select(F.inline(F.array(*structs)))
