"""Approximate nearest neighbours by inner product with an inverted multi-index.

Vectors are cut in two halves, and each half is quantised by its own codebook, so that K centroids per
half make K * K cells. A query's distance to a cell is the sum of its distances to the two centroids,
here the negative inner products, of which the sum is the one with the rebuilt vector. A heap goes through
pairs of centroids in the order of that sum until the cells hold a wanted share of all distinct vectors, so
that copies don't use it up, and k besides the query's own. Entries of these cells are reranked by the exact
inner product in double precision.

Codebooks are fitted on a bounded sample; every vector is indexed. Entries and queries meet in blocks of
bounded size: a first-half centroid's entries, cut by a hash where there are many, against blocks of the
queries that visit it. A hot cell is only more blocks. What a block finds is cut to the best k per query.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from revisit.llm.common import stored

CENTROIDS = 32
SAMPLE_ROWS = 20_000
SHARE = 0.65
ENTRY_BLOCK = 8192
QUERY_BLOCK = 4096


def usable(vectors: Column) -> Column:
    """Neither null, zero, nor with null or non-finite components."""
    wide = F.transform(vectors, lambda x: x.cast("double"))
    finite = F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vectors.isNotNull() & finite & F.exists(wide, lambda x: x != 0)


def codebook(points: np.ndarray, k: int, seed: int, rounds: int = 12) -> np.ndarray:
    """k-means centroids; fewer if there are fewer distinct points."""
    distinct = np.unique(points, axis=0)
    pick = np.random.default_rng(seed).permutation(len(distinct))[:k]
    centroids = distinct[np.sort(pick)].astype(np.float64)
    for _ in range(rounds):
        nearest = assign(points, centroids)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, points)
        counts = np.bincount(nearest, minlength=len(centroids))
        centroids[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return centroids


def assign(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return np.argmin((centroids**2).sum(1)[None, :] - 2 * points @ centroids.T, axis=1)


def traversal(first: np.ndarray, second: np.ndarray, counts: np.ndarray, wanted: int) -> np.ndarray:
    """A mask of the cells visited: pairs in ascending order of first[i] + second[j] until `wanted` are counted."""
    a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    d1, d2 = first[a].tolist(), second[b].tolist()
    held = counts[np.ix_(a, b)].tolist()
    taken = np.zeros(counts.shape, dtype=bool)
    heap, reached, found = [(d1[0] + d2[0], 0, 0)], [0] * len(d1), 0
    visited = []
    while heap and found < wanted:
        _, i, j = heapq.heappop(heap)
        visited.append((i, j))
        found += held[i][j]
        reached[i] = j + 1
        # a pair is pushed once both pairs before it have been visited
        if i + 1 < len(d1) and (j == 0 or reached[i + 1] >= j) and reached[i + 1] <= j:
            heapq.heappush(heap, (d1[i + 1] + d2[j], i + 1, j))
        if j + 1 < len(d2) and (i == 0 or reached[i - 1] > j + 1):
            heapq.heappush(heap, (d1[i] + d2[j + 1], i, j + 1))
    at = np.array(visited, dtype=np.int64).reshape(-1, 2)
    taken[a[at[:, 0]], b[at[:, 1]]] = True
    return taken


def _matrix(column: pa.Array) -> np.ndarray:
    rows = len(column)
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), dtype=np.float64).reshape(rows, -1)


def nearest(
    vectors: DataFrame, queries: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
    centroids: int = CENTROIDS, share: float = SHARE, sample_rows: int = SAMPLE_ROWS, seed: int = 10,
) -> DataFrame:
    """The k nearest other rows of every row for which `queries` holds.

    Returns query_id, rank from 1, vec_id and score, the inner product in double precision; ties go to the
    smaller id. `share` is the share of all distinct vectors that a query's cells hold at least: 1 makes the
    search exact. Every query gets k rows, or all others if there are fewer. Vectors that are null, empty, zero or hold null or non-finite components take no part, nor do
    rows with a null id or with another length than most vectors. Of rows that repeat an id, the smallest
    vector stays. Repeated vectors under different ids are candidates of their own. Other columns play no
    part. No usable rows give an empty result.
    """
    spark = vectors.sparkSession
    out = "query_id long, rank int, vec_id long, score double"
    rows = (
        vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"), F.coalesce(queries, F.lit(False)).alias("query"))
        .where(F.col("id").isNotNull() & usable(F.col("v")))
        .groupBy("id").agg(F.min(F.struct(F.transform("v", lambda x: x.cast("double")).alias("v"), "query")).alias("r")).select("id", "r.v", "r.query")
    )
    rows = stored(rows)
    sizes = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    if not sizes:
        return spark.createDataFrame([], out)
    width = sizes[0]["n"]
    rows = rows.where(F.size("v") == width)
    half = max(1, width // 2)

    sample = rows.select("v").orderBy(F.xxhash64(F.lit(seed), "id"), "id").limit(sample_rows).toArrow()
    points = _matrix(sample.column("v").combine_chunks())
    books = [codebook(points[:, :half], centroids, seed), codebook(points[:, half:], centroids, seed + 1) if width > 1 else np.zeros((1, 0))]

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1))
            cells = [assign(x[:, :half], books[0]), assign(x[:, half:], books[1])]
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(c.astype(np.int32)) for c in cells)], names=["id", "v", "query", "i", "j"])

    indexed = stored(rows.mapInArrow(index, "id long, v array<double>, query boolean, i int, j int"))
    counts = np.zeros((len(books[0]), len(books[1])), dtype=np.int64)
    distinct = np.zeros_like(counts)
    per_cell = indexed.groupBy("i", "j", F.xxhash64("v").alias("h")).count().groupBy("i", "j").agg(F.sum("count"), F.count(F.lit(1)))
    for i, j, n, kinds in per_cell.collect():  # a row per cell
        counts[i, j], distinct[i, j] = n, kinds
    wanted = max(k + 1, int(np.ceil(share * distinct.sum())))
    # blocks per first-half centroid, so that a block's entries are bounded
    cuts = np.maximum(1, -(-counts.sum(1) // ENTRY_BLOCK)).tolist()
    asked = indexed.where("query").count()
    query_blocks = max(1, -(-asked // QUERY_BLOCK))

    def visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            q, ids = _matrix(batch.column(1)), batch.column(0).to_numpy()
            first, second = -(q[:, :half] @ books[0].T), -(q[:, half:] @ books[1].T)
            for r in range(len(q)):
                taken = np.packbits(traversal(first[r], second[r], distinct, wanted), axis=1)
                some = np.flatnonzero(taken.any(1))
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(some), ids[r])), pa.array([q[r]] * len(some), pa.list_(pa.float64())),
                    pa.array(some.astype(np.int32)), pa.array([taken[i].tobytes() for i in some], pa.binary())], names=["id", "v", "i", "cells"])

    blocks_of = F.array(*[F.lit(int(c)) for c in cuts])
    visited = indexed.where("query").select("id", "v").mapInArrow(visits, "id long, v array<double>, i int, cells binary")
    visited = visited.withColumn("b", F.explode(F.sequence(F.lit(0), blocks_of[F.col("i")] - 1)))
    visited = visited.withColumn("q", F.pmod(F.xxhash64("id"), F.lit(query_blocks)).cast("int"))
    entries = indexed.select("id", "v", "i", "j", F.pmod(F.xxhash64(F.lit(seed), "id"), blocks_of[F.col("i")].cast("long")).cast("int").alias("b"))
    entries = entries.withColumn("q", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))

    def rerank(asking: pa.Table, held: pa.Table) -> pa.Table:
        if not asking.num_rows or not held.num_rows:
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        ids, x = held.column("id").to_numpy(), _matrix(held.column("v").combine_chunks())
        j = held.column("j").to_numpy()
        own, q = asking.column("id").to_numpy(), _matrix(asking.column("v").combine_chunks())
        cells = np.unpackbits(np.frombuffer(b"".join(asking.column("cells").to_pylist()), dtype=np.uint8).reshape(len(own), -1), axis=1).astype(bool)
        best: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for at in range(0, len(own), 256):
            score = q[at : at + 256] @ x.T
            score[~cells[at : at + 256][:, j] | (own[at : at + 256, None] == ids[None, :])] = -np.inf
            if score.shape[1] > k:
                # all that tie with the k-th best stay here, so that ids decide
                floor = np.partition(score, score.shape[1] - k, axis=1)[:, score.shape[1] - k]
                r, c = np.nonzero((score >= floor[:, None]) & (score > -np.inf))
            else:
                r, c = np.nonzero(score > -np.inf)
            order = np.lexsort((ids[c], -score[r, c], r))
            r, c = r[order], c[order]
            place = np.arange(len(r)) - np.searchsorted(r, r)
            r, c = r[place < k], c[place < k]
            # einsum sums in one order whatever the block, as a product of matrices needn't
            best.append((own[at + r], ids[c], np.einsum("nd,nd->n", q[at + r], x[c])))
        parts = [np.concatenate(p) for p in zip(*best)]
        return pa.table({"query_id": parts[0], "vec_id": parts[1], "score": parts[2]})

    found = (
        visited.groupBy("i", "b", "q").cogroup(entries.groupBy("i", "b", "q")).applyInArrow(rerank, "query_id long, vec_id long, score double")
    )
    best = W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
