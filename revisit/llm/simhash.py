"""SimHash near-duplicates by meet-in-the-middle ball hashing.

A fingerprint has a bit where more than half of the hashes of a text's three-word shingles, repeats
included, have it. Two fingerprints link at three differing bits or fewer.

To find links, every distinct fingerprint emits all variants within half the radius, and two that are within
the radius meet in a variant between them. Three bits have no middle: with balls of one changed bit on both
sides two fingerprints meet at a distance of two. So the 64 bits are cut in ranges and each range is left out
in turn, because of three differing bits one lies in some range, and without that range two are left at most.
With three ranges a fingerprint emits 3 + 128 variants instead of the 1 + 64 + 2016 of a ball of two bits.

Variants are shuffled and sorted; fingerprints that collide are verified bit by bit in their task. A variant's
fingerprints are not paired with each other: a search outwards from one of them finds each group that links
connect, and returns one link less than the group has members. A variant that more fingerprints share than
one task should hold hands them on to a second pass with sixteen ranges of four bits. There a variant
leaves only those four bits and one other one open, so that no more than 976 fingerprints share it whatever
the data. Components follow from the links; all copies of a fingerprint are one node throughout.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revisit.llm.common import shuffle_width, stored
from revisit.llm.jaccard import components

SEED = 42
SHINGLE = 3
RADIUS = 3
RANGES, FINE_RANGES = 3, 16
HELD = 4096  # fingerprints of one variant that a task compares
SLICE_WORDS = 1 << 16  # shingles hashed at once
TASK_VARIANTS = 4_000_000
OUT = "component_id"


def fingerprint(text: bytes | None, size: int = SHINGLE) -> int:
    """Unsigned 64 bits; 0 without words. Long texts are hashed in slices of shingles."""
    words = text.lower().split() if text else []  # of bytes: A-Z alone, and white space is 0x20 and 0x09 to 0x0D
    if not words:
        return 0
    n = max(1, len(words) - size + 1)
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, n, SLICE_WORDS):
        some = words[at : min(n, at + SLICE_WORDS) + size - 1]
        joined = b" ".join(some)
        ends = np.cumsum([len(w) + 1 for w in some])
        starts = (ends - [len(w) + 1 for w in some]).tolist()
        last = (ends - 1)[min(size, len(some)) - 1 :].tolist()
        hashes = np.array([xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, last)], dtype=np.uint64)
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and bits, the fingerprint as a signed long; a scan that takes texts one by one."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(x.as_py()) for x in batch.column(1)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=["id", "bits"])

    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, bits long")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def balls(ranges: int) -> list[tuple[int, int, int]]:
    """(shift, kept bits, what is added by exclusive or) of every variant of a fingerprint.

    Turned right by the shift, a fingerprint has the range that is left out at its low end. That is
    filled with the range's number, so that variants of different ranges never meet.
    """
    edges = [64 * i // ranges for i in range(ranges + 1)]
    out = []
    for i, (low, high) in enumerate(zip(edges, edges[1:])):
        kept = (1 << 64) - (1 << high - low)
        out += [(low, _signed(kept), _signed(flip | i)) for flip in [0, *(1 << b for b in range(high - low, 64))]]
    return out


def variants(distinct: DataFrame, ranges: int) -> DataFrame:
    """A row (k, bits) per fingerprint and variant within half the radius."""
    every = F.array(*[F.struct(F.lit(s).alias("s"), F.lit(a).cast("long").alias("kept"), F.lit(b).cast("long").alias("other")) for s, a, b in balls(ranges)])
    rows = distinct.select("bits", F.explode(every).alias("v"))
    return rows.selectExpr("((shiftrightunsigned(bits, v.s) | shiftleft(bits, 64 - v.s)) & v.kept) ^ v.other AS k", "bits")


def connections(members: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what links of these distinct fingerprints connect: a search outwards from one after the other."""
    left, right = [], []
    rest = members
    while len(rest) > 1:
        front, rest = rest[:1], rest[1:]
        while len(front) and len(rest):
            one, front = front[0], front[1:]
            near = np.bitwise_count(rest ^ one) <= radius
            found = rest[near]
            if len(found):
                left.append(np.full(len(found), one))
                right.append(found)
                rest, front = rest[~near], np.concatenate((front, found))
    nothing = np.zeros(0, dtype=members.dtype)
    return np.concatenate([nothing, *left]), np.concatenate([nothing, *right])


def _colliding(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """Links among the fingerprints of each variant of a sorted partition, as (a, b).

    Those of a variant that has more than `limit` come out as (a, null) instead, batch by batch.
    """
    key, held, many = None, [], 0

    def batch_of(a: np.ndarray, b: np.ndarray | None) -> pa.RecordBatch:
        left = pa.array(a.view(np.int64))
        return pa.RecordBatch.from_arrays([left, pa.nulls(len(a), pa.int64()) if b is None else pa.array(b.view(np.int64))], names=["a", "b"])

    def closed() -> Iterator[pa.RecordBatch]:
        if many > limit:
            if held:
                yield batch_of(np.concatenate(held), None)
        elif many > 1:
            yield batch_of(*connections(np.concatenate(held)))

    for batch in batches:
        k, bits = batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)
        edges = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1], [True]))) if len(k) else np.zeros(1, np.int64)
        runs = np.flatnonzero(np.diff(edges) > 1).tolist()
        if not len(k):
            continue
        # the first run may go on with what is held, and the last one stays open; of the others those of two or more matter
        for r in sorted({0, *runs, len(edges) - 2}):
            a, b = int(edges[r]), int(edges[r + 1])
            if k[a] != key:
                yield from closed()
                key, held, many = k[a], [], 0
            held.append(bits[a:b])
            many += b - a
            if many > limit:
                yield batch_of(np.concatenate(held), None)
                held = []
    yield from closed()


def links(distinct: DataFrame, ranges: int = RANGES, limit: int = HELD) -> DataFrame:
    """(a, b) of fingerprints at three bits or fewer that connect the same components as all links do. Written.

    `distinct` has each fingerprint once, as `bits`.
    """
    total = distinct.count() * len(balls(ranges))
    parts = int(max(shuffle_width(distinct.sparkSession), -(-total // TASK_VARIANTS)))
    dealt = variants(distinct, ranges).repartition(parts, "k").sortWithinPartitions("k")
    found = stored(dealt.mapInArrow(lambda batches: _colliding(batches, limit), "a long, b long").distinct())
    sure = found.where("b IS NOT NULL")
    if ranges < FINE_RANGES:
        hot = found.where("b IS NULL").select(F.col("a").alias("bits"))
        if not hot.isEmpty():
            sure = stored(sure.unionByName(links(hot, FINE_RANGES, 1 << 10)))
    return sure


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = HELD) -> DataFrame:
    """Every row's id, fingerprint in 16 lower-case hex digits, and component_id, the smallest id that links reach.

    Null and empty texts and such without words have the fingerprint zero and link like any other; a text of one
    or two words is one shingle. Rows that repeat an id are rows of their own; null ids are kept and never the
    smallest unless alone. Equal fingerprints share a component. An empty table gives an empty result. Other
    columns play no part.
    """
    rows = stored(fingerprints(docs, id_col, text_col))
    own = stored(rows.groupBy("bits").agg(F.min("id").alias("least")))
    found = components(links(own.select("bits"), limit=limit))
    classes = own.join(found, own["bits"] == found["node"], "left").select("bits", F.coalesce("component", "bits").alias("class"), "least")
    classes = stored(classes)
    names = classes.join(classes.groupBy("class").agg(F.min("least").alias(OUT)), "class").select("bits", OUT)
    return rows.join(names, "bits").select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), OUT)
