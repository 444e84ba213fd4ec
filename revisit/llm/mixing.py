"""Mixing sources to target weights by Sainte-Laguë apportionment, in DataFrame operations only.

1. Targets. Every source has a weight and a size; the mix is `share` times all sizes, divided by
   weight, but no source gives more than `repeats` times its size. What a capped source can't give is
   divided among the others, which is a common level: target = min(repeats * size, weight * level).
2. Quotas. The mix is cut into blocks of equally many tokens. Blocks go to the sources with the highest
   quotients target / (2 * blocks + 1), then in the same way to the shards of each source. Nearly all
   seats follow from a divisor that can't give too many; only the few left are ranked one by one.
3. Selection. A shard's documents stand in a seeded order and its words, read in that order, form its
   blocks. Whole passes are taken first, then the first blocks of the order.

Shards hold a bounded number of documents, so a hot source is numbered by many tasks. What is ranked in
one task is a row per source or a few rows per shard, not a row per document or block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from revisit.llm.common import WORD, stored

SHARD_ROWS = 32_768
SPREADS = 4096  # at least
MOST_BLOCK = 64
WEIGHTS = (5.0, 2.0, 1.0)


def seeded(key: Column, seed: int) -> Column:
    return F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(f":{seed}")).cast("binary"))


def source_targets(sizes: DataFrame, weight: Column, share: float, repeats: float) -> DataFrame:
    """Adds `target` to one row per source with `source_size`.

    Sources in order of the ratio at which they reach their cap: the level is fixed by the first source
    whose ratio is at least what the rest of the mix gives per weight.
    """
    cap = F.lit(repeats) * F.col("source_size")
    order = W.orderBy("ratio", "source_rank")
    before, rest = order.rowsBetween(W.unboundedPreceding, -1), order.rowsBetween(0, W.unboundedFollowing)
    every = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing).partitionBy(F.lit(0))
    total = F.lit(share) * F.sum("source_size").over(every)
    return (
        sizes.withColumn("weight", weight)
        .withColumn("ratio", cap / F.col("weight"))
        .withColumn("total", total)
        .withColumn("level", (F.col("total") - F.lit(repeats) * F.coalesce(F.sum("source_size").over(before), F.lit(0))) / F.sum("weight").over(rest))
        .withColumn("level", F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "source_rank", "level"))).over(every)["level"])
        .withColumn("target", F.least(cap, F.coalesce(F.col("weight") * F.col("level"), cap)).cast("double"))
        .drop("ratio", "total", "level")
    )


def apportioned(votes: DataFrame, group: list[str], order: list[str], seats: Column) -> DataFrame:
    """Adds `quota`: the group's seats by highest quotients votes / (2 * j + 1), ties by `order`.

    A divisor of total / (seats - n / 2) rounds to no more than the seats there are and leaves at most n
    of them, so quotients are ranked for about three candidates per row only.
    """
    whole = W.partitionBy(*[F.col(c) for c in group] or [F.lit(0)])
    first = F.greatest(F.lit(0), F.floor(F.col("votes") * (F.col("seats") - F.col("n") / 2) / F.col("all_votes") + 0.5) - 1)
    based = (
        votes.withColumn("seats", seats)
        .withColumn("n", F.count(F.lit(1)).over(whole))
        .withColumn("all_votes", F.sum("votes").over(whole))
        .withColumn("base", F.when((F.col("all_votes") > 0) & (F.col("seats") > F.col("n") / 2), first).otherwise(0).cast("bigint"))
        .withColumn("left", F.col("seats") - F.sum("base").over(whole))
    )
    extra = F.least(F.col("left"), F.ceil(F.col("votes") / F.col("all_votes") * F.col("left")) + F.lit(4)).cast("int")
    ranked = W.partitionBy(*[F.col(c) for c in group] or [F.lit(0)]).orderBy(F.col("quotient").desc(), *order)
    won = (
        based.where((F.col("votes") > 0) & (F.col("left") > 0))
        .select(*group, *order, "base", "left", "votes", F.explode(F.sequence(F.lit(0), F.greatest(extra, F.lit(0)))).alias("j"))
        .withColumn("quotient", F.col("votes") / (2 * (F.col("base") + F.col("j")) + 1))
        .withColumn("place", F.row_number().over(ranked))
        .where(F.col("place") <= F.col("left"))
        .groupBy(*group, *order)
        .agg(F.count(F.lit(1)).alias("won"))
    )
    names = list(dict.fromkeys([*group, *order]))
    return (
        based.join(won, names, "left")
        .withColumn("quota", (F.col("base") + F.coalesce(F.col("won"), F.lit(0))).cast("bigint"))
        .drop("seats", "n", "all_votes", "base", "left", "won")
    )


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: tuple[float, ...] = WEIGHTS, share: float = 1.5, repeats: float = 2.0, seed: int = 20,
) -> DataFrame:
    """How many words the mix takes of each document.

    Returns `id_col`, size, source_size, target and taken. Null text counts as no words; a null source is
    one source, after all others. Documents without words take nothing. Repeated ids are documents of
    their own; their order in a shard is by size. An empty table gives an empty result. Other columns of
    the input play no part. The sum over a source is within about one block per shard of its target.
    """
    words = F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(WORD)).cast("bigint")
    sized = stored(docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), words.alias("size")))

    # many more spreads than shards, whatever the number of rows, so that shards are even
    spreads = SPREADS << max(0, (sized.count() * 16 // SHARD_ROWS // SPREADS).bit_length())

    per_shard = (
        sized.withColumn("spread", F.conv(F.substring(seeded(F.col("id"), seed), 1, 8), 16, 10).cast("bigint") % spreads)
        .groupBy("source", "spread")
        .agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("docs"))
    )
    per_source = per_shard.groupBy("source").agg(F.sum("size").alias("source_size"), F.sum("docs").alias("docs"))
    ranked = per_source.withColumn("source_rank", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())))
    list_of = F.array(*[F.lit(float(w)) for w in weights])
    targets = source_targets(ranked, list_of[((F.col("source_rank") - 1) % len(weights)).cast("int")], share, repeats)
    # a block is at most a hundredth of the smallest target, so small sources come near theirs too
    every = W.partitionBy(F.lit(0))
    smallest = F.min(F.when(F.col("target") > 0, F.col("target"))).over(every)
    targets = (
        targets.withColumn("block", F.greatest(F.lit(1), F.least(F.lit(MOST_BLOCK), F.floor(smallest / 100))).cast("bigint"))
        .withColumn("votes", F.col("target"))
        .withColumn("blocks", F.floor(F.sum("target").over(every) / F.col("block") + 0.5))
    )
    sources = apportioned(targets, [], ["source_rank"], F.col("blocks")).drop("votes", "blocks")
    sources = stored(sources.withColumn("shards", F.ceil(F.col("docs") / SHARD_ROWS).cast("bigint")))

    shards = (
        per_shard.join(sources, per_shard["source"].eqNullSafe(sources["source"]))
        .select("source_rank", (F.col("spread") % F.col("shards")).alias("shard"), per_shard["size"], "quota", "block")
        .groupBy("source_rank", "shard", "quota", "block")
        .agg(F.sum("size").alias("shard_size"))
        .withColumnRenamed("quota", "source_quota")
        .withColumn("votes", F.col("shard_size").cast("double"))
    )
    shards = apportioned(shards, ["source_rank"], ["shard"], F.col("source_quota")).drop("votes", "source_quota")
    taken = F.least(F.col("quota") * F.col("block"), (F.lit(repeats) * F.col("shard_size")).cast("bigint"))
    shards = stored(shards.withColumn("words", taken))

    placed = (
        sized.join(sources.select("source", "source_rank", "source_size", "target", "shards"), sized["source"].eqNullSafe(sources["source"]))
        .select("id", "size", "source_rank", "source_size", "target", "shards", seeded(F.col("id"), seed).alias("place"))
        .withColumn("shard", F.conv(F.substring("place", 1, 8), 16, 10).cast("bigint") % spreads % F.col("shards"))
        .drop("shards")
    )
    before = W.partitionBy("source_rank", "shard").orderBy("place", "id", "size").rowsBetween(W.unboundedPreceding, -1)
    numbered = placed.withColumn("before", F.coalesce(F.sum("size").over(before), F.lit(0)))
    passes = F.when(F.col("shard_size") > 0, F.expr("words div shard_size")).otherwise(0)
    rest = F.col("words") - F.col("passes") * F.col("shard_size")
    own = F.least(F.col("size"), F.greatest(F.lit(0), rest - F.col("before")))
    return (
        numbered.join(shards, ["source_rank", "shard"])
        .withColumn("passes", passes)
        .select(F.col("id").alias(id_col), "size", "source_size", "target", (F.col("passes") * F.col("size") + own).cast("bigint").alias("taken"))
    )


def _apportioned_sql(name: str, votes: str, group: str, order: str) -> str:
    """CTE `name`: rows of `votes` with `quota`, by ranking every quotient there could be."""
    over = f"PARTITION BY {group} " if group else ""
    return f"""
{name}_quotients AS (
  SELECT {group + ', ' if group else ''}{order}, votes / (2 * j + 1) AS quotient, seats FROM (SELECT *, unnest(range(0, seats::BIGINT)) AS j FROM {votes} WHERE votes > 0)
), {name}_won AS (
  SELECT {group + ', ' if group else ''}{order}, count(*) AS won
  FROM (SELECT *, row_number() OVER ({over}ORDER BY quotient DESC, {order}) AS place FROM {name}_quotients) WHERE place <= seats GROUP BY ALL
), {name} AS (
  SELECT v.*, coalesce(won, 0) AS quota FROM {votes} v LEFT JOIN {name}_won USING ({group + ', ' if group else ''}{order})
)"""


#: The same in DuckDB's SQL.
SQL = rf"""
WITH sized AS MATERIALIZED (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size, md5(coalesce(doc_id::VARCHAR, '') || ':20') AS place FROM documents
), per_source AS (
  SELECT source, sum(size)::BIGINT AS source_size, count(*) AS docs FROM sized GROUP BY source
), ranked AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS source_rank, ([5.0, 2.0, 1.0]::DOUBLE[])[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight FROM per_source
), levels AS (
  SELECT *, 2.0::DOUBLE * source_size / weight AS ratio, (1.5::DOUBLE * (sum(source_size) OVER ())::BIGINT
      - 2.0::DOUBLE * coalesce(sum(source_size) OVER (ORDER BY 2.0::DOUBLE * source_size / weight, source_rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT)
    / sum(weight) OVER (ORDER BY 2.0::DOUBLE * source_size / weight, source_rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM ranked
), targets AS (
  SELECT * EXCLUDE (level, ratio), least(2.0::DOUBLE * source_size, coalesce(weight * (SELECT arg_min(level, (ratio, source_rank)) FROM levels WHERE level <= ratio), 2.0::DOUBLE * source_size)) AS target FROM levels
), blocks AS (
  SELECT *, greatest(1, least(64, floor((SELECT min(target) FROM targets WHERE target > 0) / 100)))::BIGINT AS block FROM targets
), source_votes AS (
  SELECT *, target AS votes, floor((SELECT sum(target) FROM targets) / block + 0.5) AS seats FROM blocks
), {_apportioned_sql('sources', 'source_votes', '', 'source_rank')}
, placed AS (
  SELECT d.doc_id, d.size, d.place, s.source_rank, s.source_size, s.target, s.block, s.quota AS seats, ('0x' || substr(d.place, 1, 8))::BIGINT % 4096 % ceil(s.docs / {SHARD_ROWS}.0)::BIGINT AS shard
  FROM sized d JOIN sources s ON d.source IS NOT DISTINCT FROM s.source
), shard_votes AS (
  SELECT source_rank, shard, seats, block, sum(size)::BIGINT AS shard_size, sum(size)::DOUBLE AS votes FROM placed GROUP BY ALL
), {_apportioned_sql('shards', 'shard_votes', 'source_rank', 'shard')}
, numbered AS (
  SELECT p.doc_id, p.size, p.source_size, p.target, least(h.quota * p.block, 2 * h.shard_size) AS words, h.shard_size,
    coalesce(sum(p.size) OVER (PARTITION BY p.source_rank, p.shard ORDER BY p.place, p.doc_id, p.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM placed p JOIN shards h USING (source_rank, shard)
)
SELECT doc_id, size, source_size, target,
  (CASE WHEN shard_size > 0 THEN words // shard_size ELSE 0 END * size
   + least(size, greatest(0, words - CASE WHEN shard_size > 0 THEN words // shard_size ELSE 0 END * shard_size - before)))::BIGINT AS taken
FROM numbered
"""
