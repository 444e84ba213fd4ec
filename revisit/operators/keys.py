"""Deduplication, order within an entity, first row per entity, surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from revisit.session import fresh_folder, write_table

HOT_ROWS = 1_000_000
BLOCK_BITS = 20


def keep_first(df: DataFrame, key: str, prefer: Sequence[Column], tie: Column | None = None) -> DataFrame:
    """One row per non-null key: the first in ``prefer`` order, then by ``tie``.

    ``tie`` defaults to a hash of the other columns, which makes the choice among equally preferred
    copies repeatable; frames that hold the same rows in different columns need a common one. Spark limits each key to
    one row before the shuffle as well as after it, so a key with very many copies never gathers
    in one task.
    """
    rest = [name for name in df.columns if name != key]
    by_key = W.partitionBy(key).orderBy(*prefer, F.xxhash64(*rest) if tie is None else tie)
    return (
        df.where(F.col(key).isNotNull())
        .withColumn("_place", F.row_number().over(by_key))
        .where(F.col("_place") == 1)
        .drop("_place")
    )


def _block_starts(hot: DataFrame, entity: str, bits: int) -> DataFrame:
    """Rows of the entity that precede each of its blocks, summed in two bounded steps.

    Blocks are pooled into areas: at most ``2**(bits+1)`` blocks per area, and no more areas per
    entity than the remaining bits of a 64-bit number allow.
    """
    blocks = hot.groupBy(entity, "_block").agg(F.count(F.lit(1)).alias("_rows"))
    blocks = blocks.withColumn("_area", F.shiftright("_block", bits + 1))
    earlier = W.rowsBetween(W.unboundedPreceding, -1)
    areas = blocks.groupBy(entity, "_area").agg(F.sum("_rows").alias("_rows"))
    area_start = F.sum("_rows").over(earlier.partitionBy(entity).orderBy("_area"))
    areas = areas.select(entity, "_area", F.coalesce(area_start, F.lit(0)).alias("_area_start"))
    block_start = F.sum("_rows").over(earlier.partitionBy(entity, "_area").orderBy("_block"))
    return (
        blocks.select(entity, "_area", "_block", F.coalesce(block_start, F.lit(0)).alias("_in_area"))
        .join(areas.select(F.col(entity).alias("_of"), F.col("_area").alias("_in"), "_area_start"), F.col(entity).eqNullSafe(F.col("_of")) & (F.col("_area") == F.col("_in")))
        .select(entity, "_block", (F.col("_area_start") + F.col("_in_area")).alias("_start"))
    )


def sequence(
    df: DataFrame,
    entity: str,
    order: str,
    name: str = "seq",
    hot_rows: int = HOT_ROWS,
    block_bits: int = BLOCK_BITS,
) -> DataFrame:
    """``row_number`` of each row within its entity, by a unique whole-number ``order`` column.

    An entity of more than ``hot_rows`` rows is cut into blocks of ``2**block_bits`` consecutive
    order values. Order values are unique, so a block holds at most that many rows, and no task
    ever sorts more than ``max(hot_rows, 2**block_bits)`` rows of one entity. There are at most
    ``rows / hot_rows`` hot entities, which bounds the broadcast. NULL is an entity like any other.
    """
    hot = (
        df.groupBy(entity)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .where(F.col("_rows") > hot_rows)
        .select(entity, F.lit(True).alias("_hot"))
    )
    hot = hot.withColumnRenamed(entity, "_hot_entity")
    placed = df.join(F.broadcast(hot), F.col(entity).eqNullSafe(F.col("_hot_entity")), "left").drop("_hot_entity").withColumn(
        "_block",
        F.when(F.col("_hot"), F.shiftright(F.col(order).cast("bigint"), block_bits)).otherwise(F.lit(0).cast("bigint")),
    )
    within = F.row_number().over(W.partitionBy(entity, "_block").orderBy(order))
    starts = _block_starts(placed.where(F.col("_hot")), entity, block_bits)
    starts = starts.select(F.col(entity).alias("_start_entity"), F.col("_block").alias("_start_block"), "_start")
    same_block = F.col(entity).eqNullSafe(F.col("_start_entity")) & (F.col("_block") == F.col("_start_block"))
    return (
        placed.withColumn("_within", within)
        .join(starts, same_block, "left")
        .select(*df.columns, (F.col("_within") + F.coalesce("_start", F.lit(0))).cast("bigint").alias(name))
    )


def first_per_entity(df: DataFrame, entity: str, order: str, columns: Sequence[str], size: str) -> DataFrame:
    """Attributes of the entity's first row by ``order`` and its number of rows, in one partial aggregate."""
    first = F.min_by(F.struct(*columns), F.col(order)).alias("_first")
    return (
        df.groupBy(entity)
        .agg(first, F.count(F.lit(1)).alias(size))
        .select(entity, *[F.col(f"_first.{c}").alias(c) for c in columns], size)
    )


def group_size(df: DataFrame, key: str, name: str) -> DataFrame:
    """Every row with the number of rows of its key, NULL keys included: counted map-side, then joined back."""
    sizes = df.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias(name))
    return df.join(sizes, F.col(key).eqNullSafe(F.col("_key"))).drop("_key")


def surrogate_key(labels: DataFrame, name: str, order: Sequence[str], kind: str = "int") -> DataFrame:
    """Dense keys 1..n over a set of distinct labels, in ``order`` and then in that of all columns.

    Labels are written in ranges of their order. A window numbers each range by itself, and what is
    counted in one task is a row per range.
    """
    every = [F.col(c).asc_nulls_last() for c in dict.fromkeys([*order, *labels.columns])]
    ranged = labels.repartitionByRange(*every).withColumn("_range", F.spark_partition_id())
    ranged = write_table(ranged, fresh_folder(labels.sparkSession))
    sizes = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_rows"))
    earlier = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select(F.col("_range").alias("_of"), F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start"))
    number = F.row_number().over(W.partitionBy("_range").orderBy(*every))
    return (
        ranged.withColumn("_n", number)
        .join(starts, F.col("_range") == F.col("_of"))
        .select((F.col("_start") + F.col("_n")).cast(kind).alias(name), *labels.columns)
    )
