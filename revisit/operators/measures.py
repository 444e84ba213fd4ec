"""Report measures evaluated under a filter context, by any keys of a fact or of its entity."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def additive_by(
    fact: DataFrame,
    keys: Sequence[str],
    sums: Mapping[str, Column],
    entity: str,
    entity_table: DataFrame | None = None,
    entity_keys: Sequence[str] = (),
    where: Column | str | None = None,
    entities: str = "entities",
) -> DataFrame:
    """Sums by ``keys`` and by attributes of the entity, with the exact number of entities.

    Rows are summed per entity and key first, map-side, so that an entity with very many rows
    reaches the entity join as one row per key. After that step each entity occurs once per key,
    and counting rows counts entities.
    """
    source = fact if where is None else fact.where(where)
    per_entity = source.groupBy(entity, *keys).agg(*[F.sum(column).alias(name) for name, column in sums.items()])
    if entity_table is not None:
        per_entity = per_entity.join(entity_table.select(entity, *entity_keys), entity)
    return per_entity.groupBy(*keys, *entity_keys).agg(
        F.count(F.lit(1)).alias(entities), *[F.sum(name).alias(name) for name in sums]
    )


def against_overall(groups: DataFrame, rate: Column, overall: DataFrame, name: str) -> DataFrame:
    """Group rate minus the rate with all filters removed; ``overall`` is a one-cell table."""
    return groups.withColumn(name, rate - overall.scalar())


def matrix(groups: DataFrame, row: str, column: str, labels: Sequence[str], value: str) -> DataFrame:
    """Cross table with one column per listed label; listing them saves a pass over the data."""
    return groups.groupBy(row).pivot(column, list(labels)).agg(F.first(value))


def related_rows(df: DataFrame, filtered: DataFrame, key: str) -> DataFrame:
    """Rows whose key survives a filter on the other table, without multiplying them."""
    return df.join(filtered.select(key), key, "left_semi")

