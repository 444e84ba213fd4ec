"""Quality by importance resampling: hashed n-gram models of target and raw text, and Gumbel top-k.

Texts are bags of hashed runs (words in their own case, runs of marks) and pairs of neighbouring runs;
a run repeated at once is one n-gram whatever the run. The target model counts documents labelled as good, the raw model all documents. A document's log weight is
the sum over its n-grams of the logarithm of target over raw probability. Sampling without replacement in
proportion to the weights takes the k largest sums of log weight and Gumbel noise, seeded by the id.

k defaults to the sum over documents of the weight, cut at 1: what the target model explains at least as
well as the raw one counts whole, so text like the target stays and the rest goes.

The target model learns from a bounded number of labelled documents; the raw model's counts come from every document: each task adds up one vector per model, and one row per bucket and
task is shuffled. The k-th largest sum is found by counting sums in ever finer intervals, not by sorting
everything in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from revisit.llm import words
from revisit.llm.common import stored

BUCKETS = 65_536
TARGET_ROWS = 50_000  # labelled documents the target model learns from, so that their ids can be broadcast
SMOOTHING = 1000.0
BINS = 4096


def ngrams(texts: list[bytes | None], buckets: int = BUCKETS) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For runs of texts: the first one's index, buckets of all n-grams, and the text each comes from."""
    salt, again = words.stream(2, 83) | np.uint64(1)
    for first, hashes, offsets in words.hashed_runs(texts):
        owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        pair = words.mix(hashes[:-1] * salt + hashes[1:])
        pair[hashes[1:] == hashes[:-1]] = again
        inside = owner[1:] == owner[:-1]
        both = np.concatenate((words.mix(hashes + salt), pair[inside]))
        yield first, (both >> np.uint64(32)) % np.uint64(buckets), np.concatenate((owner, owner[1:][inside]))


def counted(docs: DataFrame, good: Column, text_col: str, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """n-gram counts by bucket: of documents for which `good` holds, and of all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((2, buckets), dtype=np.int64)
        for batch in batches:
            is_good = np.array([bool(x) for x in batch.column(1).to_pylist()])
            for first, bucket, owner in ngrams(words.as_bytes(batch.column(0)), buckets):
                bucket = bucket.astype(np.int64)
                totals[1] += np.bincount(bucket, minlength=buckets)
                totals[0] += np.bincount(bucket[is_good[first + owner]], minlength=buckets)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(buckets, dtype=np.int32)), pa.array(totals[0]), pa.array(totals[1])], names=["bucket", "good", "every"])

    rows = docs.select(F.col(text_col), good).mapInArrow(run, "bucket int, good long, every long")
    summed = rows.groupBy("bucket").agg(F.sum("good").alias("good"), F.sum("every").alias("every")).toArrow()
    out = np.zeros((2, buckets), dtype=np.int64)
    at = summed.column("bucket").to_numpy()
    out[0, at], out[1, at] = summed.column("good").to_numpy(), summed.column("every").to_numpy()
    return out[0], out[1]


def log_ratio(target: np.ndarray, raw: np.ndarray, smoothing: float = SMOOTHING) -> np.ndarray:
    """Logarithm of target over raw probability per bucket. Both sides of the ratio get `smoothing` more
    occurrences, so that a bucket with few of them says little, whatever the corpus' size."""
    expected = raw * (target.sum() / max(1, raw.sum()))
    return np.log((target + smoothing) / (expected + smoothing))


def weighted(docs: DataFrame, ratio: np.ndarray, text_col: str = "text") -> DataFrame:
    """Adds `log_weight` to every row; 0 for an empty or null text."""
    docs = docs.drop("log_weight")
    schema = docs.withColumn("log_weight", F.lit(0.0)).schema
    at, buckets = docs.columns.index(text_col), len(ratio)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.zeros(batch.num_rows)
            for first, bucket, owner in ngrams(words.as_bytes(batch.column(at)), buckets):
                sums = np.bincount(owner, weights=ratio[bucket.astype(np.int64)])
                out[first : first + len(sums)] = sums
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out)], names=schema.names)

    return docs.mapInArrow(run, schema)


def gumbel(key: Column, seed: int) -> Column:
    """Standard Gumbel noise, the same for the same key."""
    uniform = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), key), 11) + F.lit(0.5)) / F.lit(float(1 << 53))
    return -F.log(-F.log(uniform))


def largest(rows: DataFrame, key: str, ties: list[str], k: int) -> DataFrame:
    """The k rows with the largest key, ties by `ties` ascending.

    Counts per interval narrow down where the k-th lies; only that last interval's rows are ranked.
    """
    n, low, high = rows.agg(F.count(F.lit(1)), F.min(key), F.max(key)).first()
    if k >= n:
        return rows
    if k <= 0:
        return rows.limit(0)
    above = 0  # rows that surely belong to the k
    for _ in range(4):
        step = (high - low) / BINS
        if not step > 0 or low + step <= low:
            break
        place = F.least(F.floor((F.col(key) - F.lit(low)) / F.lit(step)), F.lit(BINS - 1))
        inside = rows.where((F.col(key) >= F.lit(low)) & (F.col(key) <= F.lit(high)))
        found = dict(inside.groupBy(place.alias("bin")).count().collect())
        in_bin, left = sorted(found, reverse=True), k - above
        for b in in_bin:
            if found[b] >= left:
                break
            left -= found[b]
        edges = inside.where(place == b).agg(F.min(key), F.max(key)).first()
        low, high, above = edges[0], edges[1], k - left
        if found[b] <= 10_000:
            break
    order = W.orderBy(F.col(key).desc(), *ties)
    last = rows.where((F.col(key) >= F.lit(low)) & (F.col(key) <= F.lit(high)))
    last = last.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k - above).drop("place")
    return rows.where(F.col(key) > F.lit(high)).unionByName(last)


def resampled(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", k: int | None = None, seed: int = 5, carry: list[str] | None = None, target_rows: int = TARGET_ROWS) -> DataFrame:
    """The sampled rows of `docs`, with `log_weight` and `sample_key` added.

    `carry` names the columns of `docs` to return with them, all if None; the others are not written either.

    Target documents are those whose id is labelled 1; of more than `target_rows` such ids, a share
    that is chosen by hash, as many as that at most. All documents are counted, weighed and sampled. Null and empty texts have the log weight 0, null
    ids are never labelled, rows that repeat an id and text have equal keys and are ranked next to each
    other, and an empty table gives an empty result. Without any target document every row stays.
    Columns of the two added names are replaced.
    """
    docs = docs.drop("log_weight", "sample_key")
    tie = "sample_tie"
    while tie in docs.columns:
        tie += "_"
    good = labels.where((F.col(label_col) == 1) & F.col(id_col).isNotNull()).select(F.col(id_col).alias("good_id")).distinct()
    many = good.count()
    if many > target_rows:
        place = F.shiftrightunsigned(F.xxhash64(F.lit(seed + 1), "good_id"), 11)
        good = good.where(place < int(0.95 * target_rows / many * (1 << 53)))
    # about 0.95 * target_rows ids at most: the hash keeps them within a few times the square root of that
    listed = F.broadcast(good)
    marked = docs.select(F.col(id_col), F.col(text_col)).join(listed, F.col(id_col) == F.col("good_id"), "left")
    target, raw = counted(marked, F.col("good_id").isNotNull(), text_col)
    ratio = log_ratio(target, raw) if target.sum() else np.zeros(len(raw))
    rows = weighted(docs.withColumn(tie, F.md5(F.col(text_col).cast("binary"))), ratio, text_col)
    rows = rows.withColumn("sample_key", F.col("log_weight") + gumbel(F.col(id_col), seed))
    names = [*(docs.columns if carry is None else carry), "log_weight", "sample_key"]
    rows = stored(rows.select(*dict.fromkeys([*names, id_col, tie])))
    if not target.sum():
        return rows.select(names)
    if k is None:
        k = int(round(rows.agg(F.sum(F.exp(F.least(F.col("log_weight"), F.lit(0.0))))).first()[0] or 0))
    return largest(rows, "sample_key", [id_col, tie], k).select(names)
