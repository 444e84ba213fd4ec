"""Bottom-k sketches of word shingles as document fingerprints.

A text's shingles are the runs of up to five words that end at each of its words. The fingerprint holds
the k smallest of their distinct hashes. The k smallest of two fingerprints together are the fingerprint
of both texts together, so fingerprints of parts merge, and what two of them share estimates resemblance,
containment and the number of distinct shingles. Below k shingles the estimates are exact.

Printed, a fingerprint is its hashes' upper 48 bits in ascending order, big-endian, in base64.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from revisit.llm import words
from revisit.llm.common import stored

K = 128
WORDS = 5
SPACE_BITS = 48


def sketch(values: np.ndarray, k: int = K) -> np.ndarray:
    """The k smallest distinct hashes, ascending, as 48-bit numbers."""
    values = values >> np.uint64(64 - SPACE_BITS)
    if len(values) > 4 * k:
        part = np.unique(np.partition(values, 2 * k)[: 2 * k + 1])
        if len(part) >= k:
            return part[:k]
    return np.unique(values)[:k]


def merge(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    """The fingerprint of both texts together."""
    return np.union1d(a, b)[:k]


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated size of the intersection over that of the union; 1 for two empty texts."""
    both = np.concatenate((a, b))
    both.sort()
    twice = both[1:] == both[:-1]
    size = min(k, len(both) - int(twice.sum()))
    if not size:
        return 1.0
    distinct_before = np.arange(len(twice)) - (np.cumsum(twice) - twice)
    return float((twice & (distinct_before < size)).sum() / size)


def distinct_count(a: np.ndarray, k: int = K) -> float:
    """Estimated number of distinct shingles."""
    return float(len(a)) if len(a) < k else (k - 1) * 2.0**SPACE_BITS / (float(a[k - 1]) + 1.0)


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of a's shingles that b has too; 1 for an empty a."""
    if not len(a):
        return 1.0
    shared = resemblance(a, b, k) * distinct_count(merge(a, b, k), k)
    return min(1.0, shared / distinct_count(a, k))


def printed(a: np.ndarray) -> str:
    return base64.b64encode(a.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()).decode()


def parsed(text: str) -> np.ndarray:
    raw = np.frombuffer(base64.b64decode(text), dtype=np.uint8).reshape(-1, 6)
    wide = np.zeros((len(raw), 8), dtype=np.uint8)
    wide[:, 2:] = raw
    return wide.reshape(-1).view(">u8").astype(np.uint64)


def _ending_runs(hashes: np.ndarray, offsets: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the runs of up to n words that end at each word, aligned with the words."""
    place = np.arange(len(hashes)) - np.repeat(offsets[:-1], np.diff(offsets))
    salts = words.stream(n, 31) | np.uint64(1)
    out = np.zeros(len(hashes), dtype=np.uint64)
    for i in range(n):
        back = place >= i
        out[back] += (hashes[np.flatnonzero(back) - i] + np.uint64(1)) * salts[i]
    return words.mix(out)


def sketches(texts: list[bytes | None], k: int = K, n: int = WORDS) -> Iterator[np.ndarray]:
    """One sketch per text, in order."""
    for _, hashes, offsets in words.hashed(texts):
        runs = _ending_runs(hashes, offsets, n)
        for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
            yield sketch(runs[a:b], k)


def fingerprints(docs: DataFrame, text_col: str = "text", k: int = K) -> DataFrame:
    """Adds `fingerprint` to every row; null counts as empty, and an empty text's fingerprint is ''.

    A scan without a shuffle. A column of that name in the input is replaced.
    """
    docs = docs.drop("fingerprint")
    schema = docs.withColumn("fingerprint", F.lit("")).schema
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [printed(x) for x in sketches(words.as_bytes(batch.column(at)), k)]
            columns = [*batch.columns, pa.array(found, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.mapInArrow(run, schema)


def merged(prints: DataFrame, keys: list[str], k: int = K) -> DataFrame:
    """One fingerprint per key from the fingerprints of its parts; null parts count as empty.

    Every task first merges what it has, so that a hot key reaches the last step as a row per task.
    """
    schema = prints.select(*keys, F.col("fingerprint")).schema

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, np.ndarray] = {}

        def out() -> pa.RecordBatch:
            rows = [dict(zip(keys, key)) | {"fingerprint": printed(x)} for key, x in held.items()]
            held.clear()
            return pa.RecordBatch.from_pylist(rows, schema=arrow)

        arrow = None
        for batch in batches:
            arrow = batch.schema
            for row in batch.to_pylist():
                key = tuple(row[c] for c in keys)
                part = parsed(row["fingerprint"] or "")
                held[key] = merge(held[key], part, k) if key in held else part[:k]
                if len(held) >= 10_000:
                    yield out()
        if held:
            yield out()

    def last(table: pa.Table) -> pa.Table:
        total = np.zeros(0, dtype=np.uint64)
        for x in table.column("fingerprint").to_pylist():
            total = merge(total, parsed(x or ""), k)
        return pa.Table.from_pylist([table.slice(0, 1).to_pylist()[0] | {"fingerprint": printed(total)}], schema=table.schema)

    return prints.select(*keys, "fingerprint").mapInArrow(fold, schema).groupBy(*keys).applyInArrow(last, schema)


# The operator over documents and what edits do to them ----------------------------------------

BLOCK_IDS = 4096


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K) -> DataFrame:
    """Every document's fingerprint beside that of its edited text and of the next document.

    The edited text has its last third replaced by the start of the next document in descending order of
    ids; after the last comes the first. Null texts count as empty, null ids come last, repeated ids are
    ordered by a hash of their texts, and a single document is its own next one. Only the two named
    columns play a part. An empty table gives an empty result.

    Texts are shuffled once, into blocks of ids; a block is read in order and ends with the first text of
    the block after it, so no task sees more than its own rows.
    """
    block = F.coalesce(F.floor(F.col(id_col).cast("long") / BLOCK_IDS), F.lit(-(1 << 62))).cast("long")
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        block.alias("block"),
    ).withColumn("tie", F.xxhash64("text"))
    tops = rows.groupBy("block").agg(F.max(F.struct("id", "tie")).alias("top"))
    down = W.orderBy(F.col("block").desc())
    ends = stored(
        tops.select(
            "block",
            F.coalesce(F.lead("top").over(down), F.first("top").over(down)).alias("top"),
        ).select(F.col("block").alias("for_block"), F.col("top.id").alias("top_id"), F.col("top.tie").alias("top_tie"))
    )
    # one row per block: a copy of its top row becomes the end of the block before it
    first = (
        rows.join(ends, rows["id"].eqNullSafe(ends["top_id"]) & (rows["tie"] == ends["top_tie"]))
        .groupBy("for_block")
        .agg(F.first("text").alias("text"))
        .select(F.lit(None).cast("long").alias("id"), "text", F.col("for_block").alias("block"), F.lit(0).cast("long").alias("tie"), F.lit(1).alias("end"))
    )
    ordered = (
        rows.withColumn("end", F.lit(0)).unionByName(first).repartition("block")
        .sortWithinPartitions("block", "end", F.col("id").desc_nulls_last(), F.col("tie").desc())
        .select("block", "end", "id", "text")
    )
    schema = f"{id_col} long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, n_distinct double"
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = None  # the last text of what was read, whose next one is still to come
        for batch in batches:
            ends_at, ids, texts = batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist()
            if waiting is not None:
                ends_at.insert(0, 0), ids.insert(0, waiting[0]), texts.insert(0, waiting[1])
            own = list(sketches([t.encode() for t in texts], k))
            edits, sums = [], []
            for text, after in zip(texts, texts[1:]):
                cut = len(text) // 3
                data = (text[: len(text) - cut] + after[:cut]).encode()
                edits.append(data)
                sums.append(hashlib.sha256(data).hexdigest())
            out = []
            for i, other in enumerate(sketches(edits, k)):
                if not ends_at[i]:
                    out.append((ids[i], len(texts[i]), sums[i], printed(own[i]), printed(other), resemblance(own[i], other, k), resemblance(own[i], own[i + 1], k), distinct_count(own[i], k)))
            waiting = None if ends_at[-1] else (ids[-1], texts[-1])
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) if j else pa.array(c, pa.int64()) for j, c in enumerate(zip(*out))], names=names)

    return ordered.mapInArrow(run, schema)
