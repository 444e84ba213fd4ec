"""Distinct entities under any slicers from stored parts, so that no question reads or shuffles the facts again.

Distinct counts do not add up over groups, but sets of entities do. A part holds the set as bitmaps: one bit per
entity number and 4 KB per 32,768 consecutive numbers, so a part's size is bounded and a key with very many
entities spreads over many rows. Sums lie next to the bitmaps and add up with them. For very many keys there is
an estimate from sketches of a fixed size instead.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKET, BITS, SKETCH = "_bucket", "_bits", "_sketch"


def _summed(names: Sequence[str]) -> list[Column]:
    return [F.sum(name).alias(name) for name in names]


def entity_parts(df: DataFrame, keys: Sequence[str], entity: str, sums: Mapping[str, Column] | None = None) -> DataFrame:
    """A row per key and range of entity numbers: the sums of its rows and the bitmap of its entities.

    ``entity`` is a whole number above the smallest BIGINT. Dense numbers (see ``keys.surrogate_key``) make few rows;
    scattered ones are as right but take a bitmap per range that occurs. Rows without an entity add to the sums of
    a row of their own with an empty bitmap.
    """
    number = F.col(entity).cast("bigint")
    bits = F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias(BITS)
    added = [F.sum(column).alias(name) for name, column in (sums or {}).items()]
    return df.groupBy(*keys, F.bitmap_bucket_number(number).alias(BUCKET)).agg(bits, *added)


def pooled(parts: DataFrame, keys: Sequence[str], entities: str = "entities", sums: Sequence[str] = (), where: Column | str | None = None) -> DataFrame:
    """Sums and exact number of entities over coarser keys, under a filter on any key of the parts.

    Bitmaps of a range are joined first, so that each entity counts once; then ranges add up. Without keys there is
    one row, also over nothing.
    """
    rows = parts if where is None else parts.where(where)
    ranges = rows.groupBy(*keys, BUCKET).agg(F.bitmap_count(F.bitmap_or_agg(BITS)).alias(entities), *_summed(sums))
    counted = F.coalesce(F.sum(entities), F.lit(0)).cast("bigint").alias(entities)
    return ranges.groupBy(*keys).agg(counted, *_summed(sums))


def in_all(parts: DataFrame, conditions: Mapping[str, Column | str], entities: str = "entities") -> DataFrame:
    """How many entities have a row under every one of the conditions; they may be met by different rows.

    A condition filters the parts' keys. Each one's bitmaps are joined per range, and ranges that all conditions
    reach are intersected: one shuffle of bitmaps, no join of entities.
    """
    met = F.explode(F.array_compact(F.array(*[F.when(F.expr(c) if isinstance(c, str) else c, F.lit(name)) for name, c in conditions.items()])))
    each = parts.select(BUCKET, BITS, met.alias("_met")).groupBy(BUCKET, "_met").agg(F.bitmap_or_agg(BITS).alias(BITS))
    both = each.groupBy(BUCKET).agg(F.count(F.lit(1)).alias("_n"), F.bitmap_count(F.bitmap_and_agg(BITS)).alias("_in_all"))
    return both.where(F.col("_n") == len(conditions)).agg(F.coalesce(F.sum("_in_all"), F.lit(0)).cast("bigint").alias(entities))


def sketch_parts(df: DataFrame, keys: Sequence[str], entity: str, sums: Mapping[str, Column] | None = None, log_size: int = 12) -> DataFrame:
    """A row per key with the sums and a sketch of its entities, of any type; ``2**log_size`` registers at most."""
    added = [F.sum(column).alias(name) for name, column in (sums or {}).items()]
    return df.groupBy(*keys).agg(F.hll_sketch_agg(entity, F.lit(log_size)).alias(SKETCH), *added)


def pooled_estimates(parts: DataFrame, keys: Sequence[str], entities: str = "entities", sums: Sequence[str] = (), where: Column | str | None = None) -> DataFrame:
    """As :func:`pooled`, with an estimated number of entities: within about 2 percent for the given size, and near exact for small sets."""
    rows = parts if where is None else parts.where(where)
    return rows.groupBy(*keys).agg(F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(SKETCH)), F.lit(0)).cast("bigint").alias(entities), *_summed(sums))
