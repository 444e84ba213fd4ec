"""Hard negatives by threshold joins with an inverted index, after L2AP.

An anchor's positives are its best rows of the same label; a hard negative scores between a half and 95
percent of a positive's score. Both come from joins that return rows of at least a threshold, an anchor's
own one. Thresholds start high and are lowered for those anchors whose windows are not full yet, so that
most anchors never meet rows of ordinary scores; the last threshold is the window's own lower end, so the
result is exact.

Rows are indexed in blocks. Within a block a row's leading dimensions are in the inverted index; its last
ones are left out as soon as the norm of that suffix, times the largest ratio of an anchor's suffix norm to
its threshold, stays below one: what is left out can't reach any threshold by itself. Rows stand in the order
of how much of them is indexed, so a dimension's list is a run of rows. An anchor goes through the lists, adds
up partial scores and drops rows whose partial score and remaining norms can't reach its threshold; what
stays gets its exact score from the whole vectors.

Blocks of rows meet blocks of anchors, the stated query set, one pair in one task. A cell returns the best few
rows per anchor and window, however many rows share a label, a score or a vector. Components are whole numbers
and sums of their products are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from revisit.llm.common import stored

ROW_BLOCK, ANCHOR_BLOCK = 8192, 1024
STEP = 8  # dimensions between two looks at the bounds
POSITIVES, NEGATIVES = 5, 3
STARTS = (0.45, 0.2, 0.0)  # thresholds for positives, as shares of the anchor's norm times a usual norm
LOWER = (0.85, 0.65, 0.0)  # thresholds for negatives, as shares of the lowest window's upper end
EXACT = float(1 << 53)
OUT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def whole(vectors: Column) -> Column:
    """Components as floor(256 * x)."""
    return F.transform(vectors, lambda x: F.floor(x.cast("double") * 256).cast("long"))


def usable(vectors: Column) -> Column:
    wide = F.transform(vectors, lambda x: x.cast("double"))
    return vectors.isNotNull() & F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))


def suffix_norms(x: np.ndarray, looks: list[int]) -> np.ndarray:
    """Of each row, the norms of what starts at each look."""
    squares = np.concatenate((np.cumsum((x * x)[:, ::-1], axis=1)[:, ::-1], np.zeros((len(x), 1))), axis=1)
    return np.sqrt(squares[:, looks])


class Index:
    """Rows of a block with their leading dimensions in lists; x has a row per vector."""

    def __init__(self, x: np.ndarray, weight: np.ndarray):
        """`weight`, per look, is the largest suffix norm of an anchor over its threshold."""
        width = x.shape[1]
        self.looks = [*range(0, width, STEP), width]
        rest = suffix_norms(x, self.looks).T
        endless = np.isinf(weight)  # an anchor without a threshold needs all of a row
        needed = (rest * np.where(endless, 0, weight)[:, None] * (1 + 1e-9) >= 1) | endless[:, None]
        needed[-1] = False
        indexed = len(self.looks) - np.argmax(needed[::-1], axis=0)  # one after the last look that still matters
        indexed[~needed.any(0)] = 0
        self.order = np.argsort(-indexed, kind="stable")
        self.many = np.array([(indexed > i).sum() for i in range(len(self.looks))])
        self.rest = np.ascontiguousarray(rest[:, self.order])
        self.x = x[self.order]
        self.lists = np.ascontiguousarray(self.x.T)

    def candidates(self, q: np.ndarray, q_rest: np.ndarray, least: float) -> np.ndarray:
        """Places, in the index's order, of all rows that may score `least` or more."""
        alive = np.arange(self.many[0])
        partial = np.zeros(len(alive))
        for i, (a, b) in enumerate(zip(self.looks, self.looks[1:])):
            inside = int(np.searchsorted(alive, self.many[i]))
            if not inside:
                break
            some = slice(0, inside) if len(alive) == self.many[0] else alive[:inside]
            partial[:inside] += q[a:b] @ self.lists[a:b, some]
            bound = partial[:inside] + self.rest[i + 1, some] * (q_rest[i + 1] * (1 + 1e-9)) + 1e-6
            keep = bound >= least
            if keep.sum() < 0.9 * inside:
                keep = np.concatenate((keep, np.ones(len(alive) - inside, dtype=bool)))
                alive, partial = alive[keep], partial[keep]
        return alive


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors as rows of whole numbers, zeros where one is shorter."""
    lists = column.combine_chunks()
    lengths = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(lengths), width), dtype=np.int64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    out[row, np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def matches(q: np.ndarray, least: np.ndarray, x: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each anchor the rows that score `least` or more, and their scores."""
    largest = lambda m: float(np.abs(m.astype(np.float64)).max(initial=0))
    if not (largest(q) * largest(x) * max(1, x.shape[1]) < EXACT and largest(x) ** 2 * x.shape[1] < EXACT and largest(q) ** 2 * x.shape[1] < EXACT):
        slow = x.astype(object)  # whole numbers of any size, without bounds
        for i in range(len(q)):
            score = np.array([min(max(int(s), -(1 << 63)), (1 << 63) - 1) for s in slow @ q[i].astype(object)], dtype=np.int64)
            rows = np.flatnonzero(score >= least[i])
            yield rows, score[rows]
        return
    q, x = q.astype(np.float64), x.astype(np.float64)
    looks = [*range(0, x.shape[1], STEP), x.shape[1]]
    q_rest = suffix_norms(q, looks)
    with np.errstate(divide="ignore", invalid="ignore"):
        weight = np.where(least[:, None] > 0, q_rest / least[:, None], np.inf).max(0, initial=0)
    index = Index(x, weight)
    for i in range(len(q)):
        at = index.candidates(q[i], q_rest[i], float(least[i])) if x.shape[1] else np.arange(len(x))
        score = (index.x[at] @ q[i]).astype(np.int64)
        ok = score >= least[i]
        yield index.order[at[ok]], score[ok]


def _best(rows: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """The k first by score, ties by the smaller id."""
    if len(rows) > 4 * k:
        floor = np.partition(score, len(score) - k)[len(score) - k]
        use = np.flatnonzero(score >= floor)
    else:
        use = np.arange(len(rows))
    return use[np.lexsort((ids[rows[use]], -score[use]))[:k]]


FOUND = "akey long, place int, id long, score long"


def _cell(mode: str, width: int, positives: int, negatives: int):
    """What a block of anchors finds in a block of rows: positives, or for each positive (place) its negatives."""

    def run(asked: pa.Table, held: pa.Table) -> pa.Table:
        out: list[list] = [[], [], [], []]
        if asked.num_rows and held.num_rows:
            keys, ids, labels = (np.concatenate([np.frombuffer(b, dtype=np.int64) for b in held.column(c).to_pylist()]) for c in ("keys", "ids", "labels"))
            x = np.concatenate([np.frombuffer(b, dtype=np.int64).reshape(-1, width) for b in held.column("x").to_pylist()]) if width else np.zeros((len(keys), 0), np.int64)
            akey, label, least = (asked.column(c).to_numpy() for c in ("key", "label", "least"))
            tops = asked.column("scores").to_pylist() if mode == "negatives" else None
            for i, (rows, score) in enumerate(matches(_matrix(asked.column("v"), width), least, x)):
                if mode == "positives":
                    use = (labels[rows] == label[i]) & (keys[rows] != akey[i])
                    windows = [(0, use)]
                else:
                    other = labels[rows] != label[i]
                    # 50 p <= 100 s <= 95 p, without products that may leave a long
                    windows = [(j, other & (score >= p - p // 2) & (score <= p * 19 // 20)) for j, p in enumerate(tops[i])]
                for j, use in windows:
                    some, own = rows[use], score[use]
                    at = _best(some, own, ids, positives if mode == "positives" else negatives)
                    for column, values in zip(out, (np.full(len(at), akey[i]), np.full(len(at), j), ids[some[at]], own[at])):
                        column.append(values)
        parts = [np.concatenate([np.zeros(0, np.int64), *c]) for c in out]
        return pa.table({"akey": parts[0], "place": pa.array(parts[1].astype(np.int32)), "id": parts[2], "score": parts[3]})

    return run


def _joined(anchors: DataFrame, blocks: DataFrame, n_blocks: int, mode: str, width: int, positives: int, negatives: int) -> DataFrame:
    """Best rows per anchor and window of all cells together, ranked from 1."""
    many = max(1, -(-anchors.count() // ANCHOR_BLOCK))
    asked = anchors.withColumn("q", F.pmod(F.xxhash64("key"), F.lit(many)).cast("int")).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
    held = blocks.withColumn("q", F.explode(F.sequence(F.lit(0), F.lit(many - 1))))
    found = asked.groupBy("block", "q").cogroup(held.groupBy("block", "q")).applyInArrow(_cell(mode, width, positives, negatives), FOUND)
    order = W.partitionBy("akey", "place").orderBy(F.desc("score"), "id")
    ranked = found.withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= (positives if mode == "positives" else negatives))


def hard_negatives(
    vectors: DataFrame, anchors: Column, id_col: str = "vec_id", vector_col: str = "embedding", label: Column | None = None,
    positives: int = POSITIVES, negatives: int = NEGATIVES,
) -> DataFrame:
    """The first `negatives` rows of another label that score 50 to 95 percent of a positive's score, per anchor and positive.

    Anchors are the rows for which `anchors` holds. Positives are the first `positives` other rows of the same
    label; one of a negative score has no negatives and needs none. Scores are inner products of floor(256 * x),
    in whole numbers, cut at the ends of a long; higher ones come first, ties by the smaller id. Rows with a null id, label
    or vector or a null or non-finite component take no part. Shorter vectors count as zeros at their end. Rows
    that repeat an id are rows of their own. An empty table or no anchors give an empty result. Other columns
    play no part.
    """
    spark = vectors.sparkSession
    label = F.col("label") if label is None else label
    # one name for every row, so that columns with other names can't clash
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), F.col(vector_col).alias("v"), F.coalesce(anchors, F.lit(False)).alias("anchor")
    ).where(F.col("id").isNotNull() & F.col("label").isNotNull() & usable(F.col("v")))
    rows = stored(rows.select(F.monotonically_increasing_id().alias("key"), "id", "label", "anchor", whole(F.col("v")).alias("v")))
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    total, asked, width, usual = rows.agg(F.count(F.lit(1)), F.count_if("anchor"), F.max(F.size("v")), F.sqrt(F.avg(square))).first()
    if not asked:
        return spark.createDataFrame([], OUT)

    # dimensions that carry most of the anchors' energy first: a row per dimension
    energy = rows.where("anchor").select(F.posexplode("v").alias("d", "x")).groupBy("d").agg(F.sum(F.col("x").cast("double") ** 2).alias("e")).collect()
    known = {r["d"]: r["e"] for r in energy}
    turn = np.array(sorted(range(width), key=lambda d: -known.get(d, 0.0)), dtype=np.int64)

    def block(table: pa.Table) -> pa.Table:
        x = _matrix(table.column("v"), width)[:, turn]
        raw = {n: pa.array([np.ascontiguousarray(v, dtype=np.int64).tobytes()], pa.binary()) for n, v in (("keys", table.column("key").to_numpy()), ("ids", table.column("id").to_numpy()), ("labels", table.column("label").to_numpy()), ("x", x))}
        return pa.table({"block": table.column("block").slice(0, 1), **raw})

    n_blocks = max(1, -(-total // ROW_BLOCK))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("key"), F.lit(n_blocks)).cast("int")).select("block", "key", "id", "label", "v")
    blocks = stored(dealt.groupBy("block").applyInArrow(block, "block int, keys binary, ids binary, labels binary, x binary"))

    turned = F.transform(F.array(*[F.lit(int(d)) for d in turn]), lambda d: F.coalesce(F.get("v", d), F.lit(0).cast("long")))
    own = stored(rows.where("anchor").select("key", F.col("id").alias("aid"), "label", turned.alias("v"), F.sqrt(square).alias("norm")))

    found, open_ = [], own
    for share in STARTS:
        least = F.floor(F.col("norm") * (share * (usual or 0.0))).cast("long")
        best = stored(_joined(open_.withColumn("least", least), blocks, n_blocks, "positives", width, positives, negatives))
        if share:
            full = best.groupBy("akey").count().where(F.col("count") >= positives).select("akey")
            found.append(best.join(full, "akey"))
            open_ = stored(open_.join(full, F.col("key") == F.col("akey"), "left_anti"))
            if open_.isEmpty():
                break
        else:
            found.append(best)
    good = found[0]
    for more in found[1:]:
        good = good.unionByName(more)
    good = stored(good.select("akey", (F.col("rank") - 1).alias("place"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")))

    scores = good.groupBy("akey").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "positive_score"))), lambda s: s["positive_score"]).alias("scores"))
    open_ = stored(own.join(scores, F.col("key") == F.col("akey")).select("key", "aid", "label", "v", "scores"))
    lowest = F.array_min("scores")
    taken = []
    for share in LOWER:
        end = lowest - F.expr("array_min(scores) div 2")  # the lower end of the lowest window
        least = F.greatest(F.floor(lowest * (0.95 * share)).cast("long"), end) if share else end
        asking = open_.withColumn("least", least)
        best = stored(_joined(asking, blocks, n_blocks, "negatives", width, positives, negatives))
        if share:
            filled = best.groupBy("akey", "place").count().where(F.col("count") >= negatives).groupBy("akey").agg(F.count(F.lit(1)).alias("windows"))
            done = asking.join(filled, F.col("key") == F.col("akey"), "left").where((F.coalesce("windows", F.lit(0)) == F.size("scores")) | (F.col("least") <= end)).select(F.col("key").alias("done"))
            done = stored(done)
            taken.append(best.join(done, F.col("akey") == F.col("done"), "left_semi"))
            open_ = stored(open_.join(done, F.col("key") == F.col("done"), "left_anti"))
            if open_.isEmpty():
                break
        else:
            taken.append(best)
    bad = taken[0]
    for more in taken[1:]:
        bad = bad.unionByName(more)
    named = good.join(own.select(F.col("key").alias("akey"), F.col("aid").alias("anchor_id")), "akey")
    return named.join(bad.select("akey", "place", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), F.col("score").alias("negative_score")), ["akey", "place"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


def mined(vectors: DataFrame) -> DataFrame:
    """Hard negatives for every row whose id is divisible by 50; labels are shifted by one where 7 divides the id."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors, F.col("vec_id") % 50 == 0, label=label)


#: The same in DuckDB's SQL, from all scores of every anchor.
SQL = """
WITH items AS MATERIALIZED (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM items a JOIN items b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
), positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id)::INTEGER AS rank,
  other_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id) WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) <= 3
"""
