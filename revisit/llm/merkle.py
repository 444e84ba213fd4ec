"""Merkle manifest of a dataset: a tree per language, a tree over their roots, and proofs by a recursive query.

A row is a leaf: the hash of its columns. Leaves of a language stand in the order of their ids, every eight
consecutive nodes become the hash of their digests, and so on up to the language's root; the languages'
roots, in the order of the languages, are the leaves of a last tree.

Built levels are written as rows, one per run of eight: its id, its children's digests, and the id of the run
that it belongs to itself. A recursive query then climbs from every leaf along these links. A step joins the
leaf's row with its run, appends the siblings' digests and folds the digest that it carries, so a changed row
shows by another root without any look at the other rows. A step's siblings are a row of their own, which
keeps what travels between steps narrow; a leaf's rows are put together at the end.

Positions come from ranges of the sorted leaves, so that no language is sorted or numbered in one task.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from revisit.llm.common import remainder, stored

BITS = 3
RUN = 1 << BITS
DIGEST = 32  # bytes
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER = 32  # levels of the tree over the languages' roots count from here
OUT = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def hexed(raw: Column) -> Column:
    return F.lower(F.hex(raw))


def encoded(value: Column) -> Column:
    """A value as its length in bytes, a colon and the value as text; a dash if null."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


@dataclass
class Manifest:
    """leaves: g, digest, up, pos, and what the caller carries; runs: run, kids, up, pos; subroots: lang, subroot. All written."""

    leaves: DataFrame
    runs: DataFrame
    subroots: DataFrame
    root: str | None


def _numbered_languages(ranged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Where each language starts in each range, and the languages with their numbers, sizes and first positions.

    A row per range and language that it holds; what one task counts is a row per range.
    """
    counts = stored(ranged.groupBy("part", "lang").agg(F.count(F.lit(1)).alias("rows"), F.min("nth").alias("low")))
    before = W.partitionBy("lang").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select("part", "lang", "low", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("before"))
    languages = counts.groupBy("lang").agg(F.sum("rows").alias("n"), F.min("low").alias("low"), F.min("part").alias("part"))
    per_part = languages.groupBy("part").agg(F.count(F.lit(1)).alias("many"), F.sum("n").alias("rows"))
    earlier = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    first = per_part.select(F.col("part").alias("of"), *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_before") for c in ("many", "rows")])
    inside = W.partitionBy("part").orderBy("low")
    numbered = languages.join(first, F.col("part") == F.col("of")).select(
        "lang", "n",
        (F.col("many_before") + F.row_number().over(inside) - 1).alias("tree"),
        (F.col("rows_before") + F.coalesce(F.sum("n").over(inside.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).alias("at"),
    )
    return starts, stored(numbered)


def _link(tree: Column, at: Column, idx: Column, level: int, nodes: Column, trees: int, upper: bool) -> list[Column]:
    """The run that a node belongs to and its place there; null for the root. A run's id tells its first leaf and its level."""
    inside = (at + F.shiftright(idx, BITS) * RUN ** (level + 1)) * 64 + level + 1
    over = F.lit(None).cast("long") if upper or trees < 2 else F.shiftright(tree, BITS) * RUN * 64 + UPPER + 1
    single = nodes == 1
    pos = F.when(~single, idx % RUN)
    if not (upper or trees < 2):
        pos = F.coalesce(pos, tree % RUN)
    base = F.when(single, over).otherwise(inside if not upper else inside + UPPER)
    return [base.cast("long").alias("up"), pos.cast("int").alias("pos")]


def _levels(nodes: DataFrame, largest: int, trees: int, upper: bool) -> Iterator[DataFrame]:
    """Written runs, level by level: tree, at, idx, n (nodes of that level in the tree), run, kids, digest, up, pos."""
    level = 0
    while largest > 1:
        level, largest = level + 1, -(-largest // RUN)
        kids = F.array_sort(F.collect_list(F.struct((F.col("idx") % RUN).alias("i"), "digest")))
        runs = nodes.where("n > 1").groupBy("tree", "at", F.expr(f"idx div {RUN}").alias("idx"), F.expr(f"(n + {RUN - 1}) div {RUN}").alias("n")).agg(kids.alias("kids"))
        runs = runs.withColumn("kids", F.array_join(F.transform("kids", lambda x: hexed(x["digest"])), ""))
        name = (F.col("at") + F.col("idx") * RUN**level) * 64 + level + (UPPER if upper else 0)
        runs = runs.select(
            "tree", "at", "idx", "n", name.cast("long").alias("run"), F.unhex("kids").alias("kids"), digest(F.col("kids")).alias("digest"),
            *_link(F.col("tree"), F.col("at"), F.col("idx"), level, F.col("n"), trees, upper),
        )
        nodes = stored(runs)
        yield nodes


def manifest(docs: DataFrame, carry: Sequence[Column] = (), id_col: str = "doc_id", lang_col: str = "lang", fields: Sequence[str] = FIELDS) -> Manifest:
    """The written tree over all rows.

    `carry` names further columns that leaves keep. Null languages are a language of their own, the first one;
    null ids come first; rows that repeat an id stand in the order of their hashes. An empty table has
    no root.
    """
    leaf = digest(F.concat(*[encoded(F.col(c)) for c in fields]))
    rows = stored(docs.select(F.col(lang_col).alias("lang"), F.col(id_col).alias("id"), leaf.alias("digest"), *carry))
    # rows equal in all of these are alike, so that any order of theirs is right; the last key spreads many of them
    order = [F.col("lang").asc_nulls_first(), F.col("id").asc_nulls_first(), F.col("digest"), F.col("copy")]
    ranged = rows.withColumn("copy", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order).drop("copy")
    ranged = stored(ranged.withColumn("part", F.spark_partition_id()).withColumn("nth", F.monotonically_increasing_id()))
    starts, languages = _numbered_languages(ranged)
    largest, trees = languages.agg(F.max("n"), F.count(F.lit(1))).first()
    starts = starts.join(languages.withColumnRenamed("lang", "of"), F.col("lang").eqNullSafe(F.col("of"))).select(
        F.col("part").alias("in_part"), F.col("lang").alias("of"), (F.col("before") - F.col("low")).alias("shift"), "n", "tree", "at"
    )
    placed = ranged.join(starts, (F.col("part") == F.col("in_part")) & F.col("lang").eqNullSafe(F.col("of")))
    idx = F.col("nth") + F.col("shift")
    placed = placed.withColumn("idx", idx)
    leaves = stored(placed.select("id", "lang", "digest", *[c for c in rows.columns if c not in ("lang", "id", "digest")], "tree", "at", "idx", "n", (F.col("at") + F.col("idx")).alias("g"), *_link(F.col("tree"), F.col("at"), F.col("idx"), 0, F.col("n"), trees, False)))

    levels = list(_levels(leaves.select("tree", "at", "idx", "n", "digest"), largest or 0, trees, False))
    tops = [frame.where("n = 1").select("tree", "digest") for frame in [leaves, *levels]]
    subroots = tops[0]
    for frame in tops[1:]:
        subroots = subroots.unionByName(frame)
    subroots = stored(subroots)
    over = subroots.select(F.lit(-1).cast("long").alias("tree"), F.lit(0).cast("long").alias("at"), F.col("tree").alias("idx"), F.lit(trees).cast("long").alias("n"), "digest")
    levels += list(_levels(over, trees, trees, True))
    runs = [frame.select("run", "kids", "up", "pos") for frame in levels]
    every = runs[0] if runs else leaves.sparkSession.createDataFrame([], "run long, kids binary, up long, pos int")
    for frame in runs[1:]:
        every = every.unionByName(frame)
    last = levels[-1].select("digest") if trees > 1 else subroots.select("digest")
    top = last.limit(1).collect()
    named = languages.join(subroots, "tree").select("lang", hexed(F.col("digest")).alias("subroot"))
    return Manifest(leaves, every, named, bytes(top[0][0]).hex() if top else None)


CLIMB = f"""
WITH RECURSIVE climb(g, step, up, pos, digest, siblings) AS (
  SELECT g, 0, up, pos, digest, CAST('' AS BINARY) FROM {{leaves}}
  UNION ALL
  SELECT c.g, c.step + 1, r.up, r.pos,
    unhex(sha2(CAST(lower(hex(concat(substring(r.kids, 1, {DIGEST} * c.pos), c.digest, substring(r.kids, {DIGEST} * c.pos + {DIGEST + 1})))) AS BINARY), 256)),
    concat(substring(r.kids, 1, {DIGEST} * c.pos), substring(r.kids, {DIGEST} * c.pos + {DIGEST + 1}))
  FROM climb c JOIN {{runs}} r ON c.up = r.run
)
SELECT g, step, CASE WHEN up IS NULL THEN digest END AS digest, siblings FROM climb
"""


@contextmanager
def _unlimited_recursion(spark: SparkSession) -> Iterator[None]:
    """A recursive query stops at a million rows by default; this one makes a row per leaf and level."""
    name = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def climbed(leaves: DataFrame, runs: DataFrame) -> DataFrame:
    """g, the hash of its proof, and the root that its digest folds to, for rows of g, up, pos and digest. Written."""
    spark = leaves.sparkSession
    steps = spark.sql(CLIMB, leaves=leaves.select("g", "up", "pos", "digest"), runs=runs)
    path = F.array_sort(F.collect_list(F.struct("step", "siblings")))
    found = steps.groupBy("g").agg(path.alias("path"), F.max("digest").alias("folded"))
    proof = F.array_join(F.transform("path", lambda x: hexed(x["siblings"])), "")
    with _unlimited_recursion(spark):
        return stored(found.select("g", F.sha2(proof.cast("binary"), 256).alias("proof_sha256"), hexed(F.col("folded")).alias("folded_root")))


def proved(docs: DataFrame) -> DataFrame:
    """Every document's leaf, its language's and the whole root, its proof's hash, and what a tampered copy folds to.

    Where 3 divides the crc32 of the id as text, the text's A-Z are lower-cased before the copy is hashed
    (without an id nothing is tampered with). `verified` says that the copy folds to the root. Null columns,
    empty and long texts are hashed as they are; rows that repeat are leaves of their own; a language's only
    document is its root, and the only document of all has the hash of nothing for its proof. An empty table
    gives an empty result. Other columns play no part.
    """
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    changed = digest(F.concat(*[encoded(lowered if c == "text" else F.col(c)) for c in FIELDS]))
    tampered = F.col("doc_id").isNotNull() & (remainder(F.col("doc_id"), 3) == 0)
    tree = manifest(docs, [F.when(tampered, changed).alias("changed")])
    if tree.root is None:
        return docs.sparkSession.createDataFrame([], OUT)
    climbs = climbed(tree.leaves.select("g", "up", "pos", F.coalesce("changed", "digest").alias("digest")), tree.runs)
    named = tree.leaves.join(tree.subroots.withColumnRenamed("lang", "of"), F.col("lang").eqNullSafe(F.col("of")))
    return named.join(climbs, "g").select(
        F.col("id").alias("doc_id"), hexed(F.col("digest")).alias("leaf"), "subroot", F.lit(tree.root).alias("root"), "proof_sha256", "folded_root",
        (F.col("folded_root") == F.lit(tree.root)).alias("verified"),
    )


def _sql(levels: int) -> str:
    """The same in DuckDB's SQL, level after level; for up to 8 ** levels documents of a language."""
    letters = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
    value = lambda c: f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR) || ':' || {c}::VARCHAR END"
    leaf = lambda text: "sha256(concat(" + ", ".join(value(text if c == "text" else c) for c in FIELDS) + "))"
    step = "list_reduce(list_concat([xor(c, b)], [0, 0, 0, 0, 0, 0, 0, 0]), lambda v, z: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END)"
    codes = "list_transform(regexp_extract_all(doc_id::VARCHAR, '.'), lambda d: ascii(d)::BIGINT)"
    crc = f"xor(list_reduce(list_concat([4294967295::BIGINT], {codes}), lambda c, b: {step}), 4294967295)"
    parts = [
        f"worded AS (SELECT doc_id, lang, {leaf('text')} AS leaf, {leaf(f'translate(text, {letters})')} AS other, coalesce({crc} % 3 = 0, false) AS hit FROM documents)",
        "placed AS MATERIALIZED (SELECT doc_id, lang, leaf, CASE WHEN hit THEN other ELSE leaf END AS folded, '' AS proof, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM worded)",
        "a0 AS (SELECT lang, i, leaf AS h FROM placed)",
        "b0 AS (SELECT *, i AS p FROM placed)",
    ]

    def climb(a: str, b: str, k: int, key: str, own: str) -> list[str]:
        match = lambda x, y: f"{x}.{key} IS NOT DISTINCT FROM {y}.{key}"
        return [
            f"{a}n{k} AS (SELECT {key}, count(*) AS n FROM {a}{k} GROUP BY {key})",
            f"{a}{k + 1} AS MATERIALIZED (SELECT {a}{k}.{key}, i // 8 AS i, CASE WHEN any_value(n) > 1 THEN sha256(string_agg(h, '' ORDER BY i)) ELSE any_value(h) END AS h FROM {a}{k} JOIN {a}n{k} ON {match(f'{a}{k}', f'{a}n{k}')} GROUP BY {a}{k}.{key}, i // 8)",
            f"{a}r{k} AS (SELECT {key}, i // 8 AS run, list(h ORDER BY i) AS hs FROM {a}{k} GROUP BY ALL)",
            f"{b}{k + 1} AS MATERIALIZED (SELECT {own}, p // 8 AS p, proof || array_to_string(hs[: p % 8], '') || array_to_string(hs[p % 8 + 2 :], '') AS proof,"
            f" CASE WHEN n > 1 THEN sha256(concat(array_to_string(hs[: p % 8], ''), folded, array_to_string(hs[p % 8 + 2 :], ''))) ELSE folded END AS folded"
            f" FROM {b}{k} JOIN {a}r{k} ON {match(f'{b}{k}', f'{a}r{k}')} AND {a}r{k}.run = p // 8 JOIN {a}n{k} ON {match(f'{b}{k}', f'{a}n{k}')})",
        ]

    for k in range(levels):
        parts += climb("a", "b", k, "lang", f"doc_id, b{k}.lang, leaf")
    parts += [
        f"c0 AS (SELECT 0 AS every, h, lang, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i FROM a{levels})",
        f"d0 AS (SELECT doc_id, leaf, folded, proof, c0.h AS subroot, c0.i AS p, 0 AS every FROM b{levels} b JOIN c0 ON b.lang IS NOT DISTINCT FROM c0.lang)",
    ]
    for k in range(levels):
        parts += climb("c", "d", k, "every", f"doc_id, leaf, subroot, d{k}.every")
    return (
        "WITH " + ",\n".join(parts) + f"\nSELECT doc_id, leaf, subroot, h AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = h AS verified FROM d{levels} JOIN c{levels} ON true"
    )


SQL = _sql(5)
