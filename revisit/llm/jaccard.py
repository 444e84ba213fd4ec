"""Exact Jaccard self-join of word-shingle sets with token-combination prefixes, and its components.

Tokens (shingle hashes) stand in one order: rarer ones first, by document frequency. Sets of x tokens that
reach similarity t with another share their first common token within the first x - ceil(t x) + 1. So rare
tokens of that prefix are indexed one by one. If the first common token is frequent, all common ones are;
the prefix extended by g tokens then holds g + 1 common tokens, of which two fall into the same of g hash
classes. So frequent tokens are indexed as pairs within a class, which few unrelated sets have in common.
g follows the set's size by powers of two, and sets near the next power are indexed for it too.

Equal sets are one set from the start. A token that only one set has can't be in common, so counts decide
what is kept, and two sets' overlap can be read from their tokens that other sets have too.

Candidates that share a key are not expanded into all pairs: first all sets of a key meet the key's most
ordinary set, the one with the fewest tokens of its own. A pair is a candidate only if its sizes, the number
of tokens each has in common with any other set and what both share with that ordinary set allow the
similarity. The join then compares all pairs that remain, in cells of bounded size where a key is hot, and
returns every link; components and numbers of links follow from these. Where components alone are asked
for, sets that links already connect need no further comparison; only sets that share a key and still lie
in different components are compared one by one, so no link between components is lost.

Tokens travel in blocks of bytes, dealt by ranges of hash into as many buckets as the corpus needs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from revisit.llm import words
from revisit.llm.common import shuffle_width, stored

SHINGLE = 5
PERCENT = 75
FREQUENT = 50
BUCKET_TOKENS = 2_000_000
FLUSH_TOKENS = 1_000_000
RECENT = 16
CELL_SETS = 1000  # a key of more sets is cut into blocks, and pairs of blocks meet in cells
BLOCK_PAIRS = 20_000
SMALL = 30  # sets up to this size, and those they can link with, index frequent tokens one by one
LOW48 = np.uint64((1 << 48) - 1)

HEAD = np.dtype([("key", "<u8"), ("n", "<u4"), ("many", "<u4")])


def _six(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _from_six(raw: bytes) -> np.ndarray:
    wide = np.zeros((len(raw) // 6, 8), dtype=np.uint8)
    wide[:, :6] = np.frombuffer(raw, dtype=np.uint8).reshape(-1, 6)
    return wide.reshape(-1).view("<u8")


def _set_keys(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.concatenate(([np.uint64(0)], np.cumsum(words.mix(values + np.uint64(7)), dtype=np.uint64)))
    return words.mix(sums[offsets[1:]] - sums[offsets[:-1]] + np.diff(offsets).astype(np.uint64))


def _sets(texts: list[bytes | None], size: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    for first, hashes, offsets in words.hashed(texts):
        yield first, *words.distinct(*words.shingled(hashes, offsets, size))


def shingle_sets(docs: DataFrame, id_col: str, text_col: str, size: int = SHINGLE) -> DataFrame:
    """id, n_shingles and a key that equal sets share; n_shingles 0 without words."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, keys = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            for first, values, offsets in _sets(words.as_bytes(batch.column(1)), size):
                n[first : first + len(offsets) - 1] = np.diff(offsets)
                keys[first : first + len(offsets) - 1] = _set_keys(values, offsets).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), pa.array(keys)], names=["id", "n_shingles", "key"])

    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, n_shingles long, key long")


def _dealt(keys: np.ndarray, n: np.ndarray, owner: np.ndarray, tokens: np.ndarray, bucket: np.ndarray, extra: np.ndarray | None = None) -> Iterator[tuple[int, bytes]]:
    """Tokens with their sets as one block of bytes per bucket. `owner` ascends."""
    order = np.argsort(bucket, kind="stable")
    bucket, owner, tokens = bucket[order], owner[order], tokens[order]
    extra = extra[order] if extra is not None else None
    edges = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1], [True]))) if len(bucket) else np.zeros(1, np.int64)
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
        own = owner[a:b]
        runs = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
        head = np.zeros(len(runs), dtype=HEAD)
        head["key"], head["n"], head["many"] = keys[own[runs]], n[own[runs]], np.diff(np.append(runs, b - a))
        yield int(bucket[a]), b"".join([np.int64(len(runs)).tobytes(), head.tobytes(), _six(tokens[a:b]), extra[a:b].tobytes() if extra is not None else b""])


def _read(blocks: list[bytes], with_extra: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Heads of all blocks, tokens' places among the heads, tokens, extras."""
    heads, tokens, extras = [np.zeros(0, dtype=HEAD)], [np.zeros(0, dtype=np.uint64)], [np.zeros(0, dtype=np.uint8)]
    for raw in blocks:
        m = int(np.frombuffer(raw, dtype=np.int64, count=1)[0])
        head = np.frombuffer(raw, dtype=HEAD, count=m, offset=8)
        many, at = int(head["many"].sum()), 8 + m * HEAD.itemsize
        heads.append(head)
        tokens.append(_from_six(raw[at : at + 6 * many]))
        if with_extra:
            extras.append(np.frombuffer(raw, dtype=np.uint8, count=many, offset=at + 6 * many))
    head = np.concatenate(heads)
    return head, np.repeat(np.arange(len(head)), head["many"]), np.concatenate(tokens), np.concatenate(extras)


def _rank_of(df: np.ndarray) -> np.ndarray:
    """Document frequency on a fine logarithmic scale of one byte; rare tokens stay below frequent ones."""
    return np.minimum(255, np.floor(8 * np.log2(df))).astype(np.uint8)


FREQUENT_RANK = int(np.floor(8 * np.log2(FREQUENT)))


def _classes(n: int) -> list[int]:
    """For how many hash classes a set is indexed: by its own power of two, and the next one if it can link there."""
    level = n.bit_length() - 1
    levels = [level] + ([level + 1] if n * 100 >= PERCENT << (level + 1) else [])
    return list(dict.fromkeys(max(16, 1 << max(0, lv - 5)) for lv in levels))


def index_keys(n: int, alone: int, tokens: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Keys of a set of n tokens, `alone` of them without any other set; the others in order."""
    need = -(-PERCENT * n // 100)
    prefix = max(0, n - need + 1 - alone)
    frequent = rank >= FREQUENT_RANK
    single = tokens[:prefix][~frequent[:prefix]]
    if n * PERCENT <= SMALL * 100:
        single = tokens[:prefix]
    out = [words.mix(single + np.uint64(0xA5))]
    if n > SMALL * PERCENT // 100:
        for g in _classes(n):
            held = tokens[: max(0, n - need + 1 + g - alone)]
            held = held[frequent[: len(held)]]
            if len(held) < 2:
                continue
            own = held % np.uint64(g)
            order = np.lexsort((held, own))
            held, own = held[order], own[order]
            starts = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1], [True])))
            for a, b in zip(starts[:-1].tolist(), starts[1:].tolist()):
                if b - a > 1:
                    i, j = np.triu_indices(b - a, 1)
                    out.append(words.mix(words.mix(held[a + i] + np.uint64(g)) * np.uint64(words.BASE) + held[a + j]))
    return np.unique(np.concatenate(out))


def indexed_sets(docs: DataFrame, text_col: str, total: int, size: int = SHINGLE) -> DataFrame:
    """Distinct sets that share an index key's tokens with others: key, n, index keys, tokens in common with others."""
    spark = docs.sparkSession
    buckets = int(max(shuffle_width(spark), -(-total // BUCKET_TOKENS)))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        many = 0

        def out() -> Iterator[pa.RecordBatch]:
            values = np.concatenate([v for v, _ in held])
            sizes = np.concatenate([np.diff(o) for _, o in held])
            offsets = np.concatenate(([0], np.cumsum(sizes)))
            keys = _set_keys(values, offsets)
            _, first = np.unique(keys, return_index=True)
            first = np.sort(first[sizes[first] > 0])
            values = values[words.ranges(offsets[first], sizes[first])]
            owner = np.repeat(np.arange(len(first)), sizes[first])
            bucket = (values >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
            rows = list(_dealt(keys[first], sizes[first], owner, values & LOW48, bucket.astype(np.int64)))
            held.clear()
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], names=["bucket", "block"])

        for batch in batches:
            for _, values, offsets in _sets(words.as_bytes(batch.column(0)), size):
                held.append((values, offsets))
                many += len(values)
                if many >= FLUSH_TOKENS:
                    yield from out()
                    many = 0
        if held:
            yield from out()

    def count(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        head, place, tokens, _ = _read(table.column("block").to_pylist(), False)
        order = np.argsort(tokens, kind="stable")
        ordered = tokens[order]
        same = np.concatenate(([False], ordered[1:] == ordered[:-1]))
        twice = same | np.append(same[1:], False)
        tokens, place = ordered[twice], place[order[twice]]
        keys = head["key"][place]
        order = np.lexsort((keys, tokens))  # equal sets from several tasks count once
        tokens, keys, place = tokens[order], keys[order], place[order]
        new = np.concatenate(([True], (tokens[1:] != tokens[:-1]) | (keys[1:] != keys[:-1]))) if len(tokens) else np.zeros(0, bool)
        tokens, place = tokens[new], place[new]
        starts = np.flatnonzero(np.concatenate(([True], tokens[1:] != tokens[:-1]))) if len(tokens) else np.zeros(0, np.int64)
        df = np.diff(np.append(starts, len(tokens)))
        rank = np.repeat(_rank_of(np.maximum(df, 1)), df)
        keep = np.repeat(df, df) > 1
        tokens, place, rank = tokens[keep], place[keep], rank[keep]
        keys, sizes = head["key"][place], head["n"][place]
        order = np.argsort(keys, kind="stable")
        tokens, keys, sizes, rank = tokens[order], keys[order], sizes[order], rank[order]
        new = np.concatenate(([True], keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, bool)
        owner = np.cumsum(new) - 1
        rows = list(_dealt(keys[new], sizes[new], owner, tokens, (keys % np.uint64(buckets)).astype(np.int64), rank))
        blocks = [np.int64(bucket).tobytes() + r[1] for r in rows]
        return pa.table({"home": pa.array([r[0] for r in rows], pa.int32()), "block": pa.array(blocks, pa.binary())})

    def index(table: pa.Table) -> pa.Table:
        parts = []
        for raw in table.column("block").to_pylist():
            head, place, tokens, rank = _read([raw[8:]], True)
            upper = np.frombuffer(raw, dtype=np.int64, count=1)[0].astype(np.uint64) << np.uint64(48)
            parts.append((head["key"][place], head["n"][place], tokens ^ upper, rank))
        keys, sizes, tokens, rank = (np.concatenate(x) for x in zip(*parts))
        order = np.lexsort((tokens, rank, keys))
        keys, sizes, tokens, rank = keys[order], sizes[order], tokens[order], rank[order]
        starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        ends = np.append(starts[1:], len(keys))
        got: tuple[list, list, list, list, list] = ([], [], [], [], [])
        for a, b in zip(starts.tolist(), ends.tolist()):
            n = int(sizes[a])
            found = index_keys(n, n - (b - a), tokens[a:b], rank[a:b])
            if len(found):
                got[0].append(int(keys[a].astype(np.int64)))
                got[1].append(n)
                got[2].append(found.view(np.int64))
                got[3].append(np.sort(tokens[a:b]).tobytes())
                got[4].append(b - a)
        lists = pa.ListArray.from_arrays(np.concatenate(([0], np.cumsum([len(x) for x in got[2]]))).astype(np.int32), np.concatenate([*got[2], np.zeros(0, np.int64)]))
        return pa.table({"key": pa.array(got[0], pa.int64()), "n": pa.array(got[1], pa.int32()), "c": pa.array(got[4], pa.int32()), "keys": lists, "tokens": pa.array(got[3], pa.binary())})

    return (
        docs.select(text_col).mapInArrow(deal, "bucket int, block binary")
        .groupBy("bucket").applyInArrow(count, "home int, block binary")
        .groupBy("home").applyInArrow(index, "key long, n int, c int, keys array<long>, tokens binary")
    )


def _can_link(n_a: str, c_a: str, n_b: str, c_b: str) -> Column:
    """An overlap of at most the smaller c reaches the similarity of sets of these sizes."""
    return F.least(c_a, c_b).cast("long") * (100 + PERCENT) >= (F.col(n_a).cast("long") + F.col(n_b)) * PERCENT


def measured(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) of sets with the size of their intersection and whether they link."""
    left = sets.select(F.col("key").alias("a"), F.col("n").alias("n_a"), F.col("tokens").alias("t_a"))
    right = sets.select(F.col("key").alias("b"), F.col("n").alias("n_b"), F.col("tokens").alias("t_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shared, linked = np.zeros(batch.num_rows, np.int32), np.zeros(batch.num_rows, dtype=bool)
            for i, (n_a, n_b, t_a, t_b) in enumerate(zip(*(batch.column(c).to_pylist() for c in (2, 3, 4, 5)))):
                both = np.concatenate((np.frombuffer(t_a, dtype=np.uint64), np.frombuffer(t_b, dtype=np.uint64)))
                both.sort(kind="stable")
                same = int((both[1:] == both[:-1]).sum())
                shared[i], linked[i] = same, 100 * same >= PERCENT * (n_a + n_b - same)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(shared), pa.array(linked)], names=["a", "b", "shared", "linked"])

    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "n_a", "n_b", "t_a", "t_b")
    return joined.mapInArrow(run, "a long, b long, shared int, linked boolean")


def components(links: DataFrame) -> DataFrame:
    """node and the smallest node connected with it, by alternating large and small stars.

    A step replaces links by links to the smallest neighbour; the number of steps grows with the
    logarithm of the size of a component, not of the corpus.
    """
    def larger_first(rows: DataFrame) -> DataFrame:
        return rows.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct()

    now = stored(larger_first(links))
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = larger_first(large)
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
        after = stored(larger_first(small))
        changed = after.exceptAll(now).limit(1).count() + now.exceptAll(after).limit(1).count()
        now = after
        if not changed:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component"))


def listed_sets(docs: DataFrame, text_col: str, total: int, size: int = SHINGLE) -> tuple[DataFrame, DataFrame]:
    """The indexed sets, and a row per set and key that several sets have, with the key's first and last set."""
    sets = stored(indexed_sets(docs, text_col, total, size))
    keyed = sets.select("key", "n", "c", F.explode("keys").alias("k"))
    ordinary, other = F.struct((F.col("n") - F.col("c")).alias("own"), "key", "n", "c"), F.struct("key", "n", "c")
    shared = keyed.groupBy("k").agg(F.min(ordinary).alias("first"), F.max(other).alias("last"), F.min("key").alias("low")).where("low != last.key").drop("low")
    return sets, stored(keyed.join(shared, "k"))


def star(hub: str, where: DataFrame) -> DataFrame:
    """Pairs of each set with its keys' first or last one."""
    rows = where.where((F.col("key") != F.col(f"{hub}.key")) & _can_link("n", "c", f"{hub}.n", f"{hub}.c"))
    return rows.select(F.col("key").alias("a"), F.col(f"{hub}.key").alias("b")).distinct()


def set_links(docs: DataFrame, text_col: str, total: int, size: int = SHINGLE) -> DataFrame:
    """Every link between distinct sets, once: a, b (a < b), n_a, n_b and shared, the size of their intersection."""
    sets, lists = listed_sets(docs, text_col, total, size)
    met = stored(measured(star("first", lists), sets))
    return stored(verified(stored(every_pair(lists, met)), sets))


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs that link. They are dealt by both sets' hashes, so a block reads a set's tokens once for many pairs."""
    side = int(np.ceil(np.sqrt(max(shuffle_width(pairs.sparkSession), -(-pairs.count() // BLOCK_PAIRS)))))
    cell = [F.pmod(F.xxhash64(F.lit(i), c), F.lit(side)).cast("int").alias(name) for i, c, name in ((0, "a", "x"), (1, "b", "y"))]
    dealt = pairs.select("a", "b", *cell)
    needed = dealt.select("x", "y", F.col("a").alias("key")).unionByName(dealt.select("x", "y", F.col("b").alias("key"))).distinct()
    needed = needed.join(sets.select("key", "n", "tokens"), "key").select(F.col("x").alias("u"), F.col("y").alias("v"), "key", "n", "tokens")

    def run(asked: pa.Table, held: pa.Table) -> pa.Table:
        key, n = held.column("key").to_numpy(), held.column("n").to_numpy().astype(np.int64)
        raw = held.column("tokens").to_pylist()
        many = np.array([len(t) // 8 for t in raw], dtype=np.int64)
        tokens, begins = np.frombuffer(b"".join(raw), dtype=np.uint64), np.cumsum(many) - many
        order = np.argsort(key)
        a, b = (order[np.searchsorted(key[order], asked.column(c).to_numpy())] for c in ("a", "b"))
        by = np.argsort(a, kind="stable")
        a, b = a[by], b[by]
        shared = np.zeros(len(a), np.int64)
        edges = np.flatnonzero(np.concatenate(([True], a[1:] != a[:-1], [True])))
        for low, high in zip(edges[:-1].tolist(), edges[1:].tolist()):
            own = tokens[begins[a[low]] : begins[a[low]] + many[a[low]]]
            for at in range(low, high, 256):
                some = b[at : min(high, at + 256)]
                others = tokens[words.ranges(begins[some], many[some])]
                hit = own[np.minimum(np.searchsorted(own, others), len(own) - 1)] == others
                shared[at : at + len(some)] = np.add.reduceat(hit, np.cumsum(many[some]) - many[some], dtype=np.int64)
        ok = 100 * shared >= PERCENT * (n[a] + n[b] - shared)
        a, b, shared = a[ok], b[ok], shared[ok]
        return pa.table([pa.array(v) for v in (key[a], key[b], n[a], n[b], shared)], names=["a", "b", "n_a", "n_b", "shared"])

    return dealt.groupBy("x", "y").cogroup(needed.groupBy("u", "v")).applyInArrow(run, "a long, b long, n_a long, n_b long, shared long")


def linked_sets(docs: DataFrame, text_col: str, total: int, size: int = SHINGLE) -> DataFrame:
    """node, component for the distinct sets that link with another one, without making every link."""
    sets, lists = listed_sets(docs, text_col, total, size)
    met = stored(measured(star("first", lists), sets))
    links = met.where("linked").select("a", "b")
    for step in ("last", "every"):
        found = components(links)
        named = lists.join(found.select(F.col("node").alias("key"), "component"), "key", "left").withColumn("component", F.coalesce("component", "key"))
        apart = named.groupBy("k").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low != high").select("k")
        open_ = named.join(apart, "k")
        if step == "last":
            more = star("last", open_)
        else:
            more = across(open_, met)
        links = stored(links.unionByName(measured(more, sets).where("linked").select("a", "b")))
    return components(links)


def with_bounds(open_: DataFrame, met: DataFrame) -> DataFrame:
    """The rows with what their set shares with the key's first set, the key's number of sets, and recent keys.

    What two sets have in common lies in the key's first set or outside it. Where both have met that set,
    the smaller overlap with it and the smaller rest of what each has in common with others bound theirs.

    Every row carries the keys that come before its own in its set, at most RECENT of them, in one order of
    all keys: those of many sets first. A pair whose recent keys overlap was made under one of these, or
    earlier still; so it is made under its first common key, and seldom again.
    """
    hub = F.col("first.key")
    many = open_.groupBy("k").agg(F.count(F.lit(1)).alias("many"))
    before = W.partitionBy("key").orderBy(F.desc("many"), "k").rowsBetween(-RECENT, -1)
    known = met.select(F.col("a").alias("key"), F.col("b").alias("hub"), "shared")
    rows = open_.withColumn("hub", hub).drop("first", "last").join(known, ["key", "hub"], "left")
    rows = rows.join(many, "k").withColumn("recent", F.collect_list("k").over(before))
    return stored(rows.withColumn("shared", F.when(F.col("key") == F.col("hub"), F.col("c")).otherwise(F.col("shared"))))


def may_link() -> Column:
    """Two rows of a key, the second one's columns with _b, may link and were not made under a recent key."""
    bound = F.least("shared", "shared_b") + F.least(F.col("c") - F.col("shared"), F.col("c_b") - F.col("shared_b"))
    enough = bound.cast("long") * (100 + PERCENT) >= (F.col("n").cast("long") + F.col("n_b")) * PERCENT
    return _can_link("n", "c", "n_b", "c_b") & F.coalesce(enough, F.lit(True)) & ~F.arrays_overlap("recent", "recent_b")


def across(open_: DataFrame, met: DataFrame) -> DataFrame:
    """Pairs of sets in different components that share a key and may link."""
    rows = with_bounds(open_, met)
    other = rows.select("k", *[F.col(c).alias(f"{c}_b") for c in ("key", "n", "c", "component", "shared", "recent")])
    apart = (F.col("component") != F.col("component_b")) & (F.col("key") < F.col("key_b"))
    pairs = rows.join(other, (rows["k"] == other["k"]) & apart & may_link())
    return pairs.select(F.col("key").alias("a"), F.col("key_b").alias("b")).distinct()


def every_pair(lists: DataFrame, met: DataFrame) -> DataFrame:
    """All pairs (a < b) of sets that share a key and may link.

    A hot key's sets are cut into blocks by hash; two blocks, or one with itself, meet in a cell of their own,
    so that no task holds all pairs of a key.
    """
    rows = with_bounds(lists, met).withColumn("blocks", F.ceil(F.col("many") / CELL_SETS).cast("int"))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks").cast("long")).cast("int"))
    held = ("key", "n", "c", "shared", "recent")
    left = rows.select("k", *held, F.col("block").alias("lo"), F.explode(F.sequence("block", F.col("blocks") - 1)).alias("hi"))
    right = rows.select("k", *[F.col(c).alias(f"{c}_b") for c in held], F.explode(F.sequence(F.lit(0), "block")).alias("lo"), F.col("block").alias("hi"))
    once = (F.col("lo") != F.col("hi")) | (F.col("key") < F.col("key_b"))
    pairs = left.join(right, ["k", "lo", "hi"]).where(once & may_link())
    return pairs.select(F.least("key", "key_b").alias("a"), F.greatest("key", "key_b").alias("b")).distinct()


def links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every link of at least 75 % between distinct sets, once.

    a and b are the sets' keys as in shingle_sets, a < b; n_a and n_b their sizes, copies_a and copies_b the
    numbers of rows that have them, least_a and least_b the smallest ids of these (null if none has one), and
    shared the size of the intersection, so the similarity is shared / (n_a + n_b - shared). Rows of one set
    link with each other and are not listed.
    """
    rows = stored(shingle_sets(docs, id_col, text_col))
    return _with_copies(_links_of(docs, text_col, rows), rows)


def _links_of(docs: DataFrame, text_col: str, rows: DataFrame) -> DataFrame:
    total = rows.agg(F.sum("n_shingles")).first()[0] or 0
    if not total:
        return docs.sparkSession.createDataFrame([], "a long, b long, n_a long, n_b long, shared long")
    return set_links(docs, text_col, total)


def _with_copies(found: DataFrame, rows: DataFrame) -> DataFrame:
    own = rows.where("n_shingles > 0").groupBy("key").agg(F.count(F.lit(1)).alias("copies"), F.min("id").alias("least"))
    for side in ("a", "b"):
        found = found.join(own.select(F.col("key").alias(side), F.col("copies").alias(f"copies_{side}"), F.col("least").alias(f"least_{side}")), side)
    return found.select("a", "b", "n_a", "n_b", "copies_a", "copies_b", "least_a", "least_b", "shared")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_links: bool = False) -> DataFrame:
    """Every row's id, n_shingles and component_id, the smallest id that links of at least 75 % reach.

    With `with_links`, the components come from every link, and n_links is added, the number of other rows a
    row links with, rows of the same set among them. Without, the same components come without making links
    between sets that others connect.

    Rows without words or text link with nothing and are their own component. Rows that repeat an id are
    rows of their own; null ids are kept and never the smallest unless alone. Equal texts share a
    component. An empty table gives an empty result. Other columns play no part.
    """
    rows = stored(shingle_sets(docs, id_col, text_col))
    total = rows.agg(F.sum("n_shingles")).first()[0] or 0
    own = rows.where("n_shingles > 0").groupBy("key").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("copies"))
    every = _links_of(docs, text_col, rows) if with_links else None
    if total:
        found = components(every.select("a", "b")) if with_links else linked_sets(docs, text_col, total)
        classes = own.join(found, own["key"] == found["node"], "left").select("key", F.coalesce("component", "key").alias("class"), "least")
        classes = stored(classes)
        names = classes.join(classes.groupBy("class").agg(F.min("least").alias("component_id")), "class").select("key", "component_id")
    else:
        names = own.select("key", F.col("least").alias("component_id"))
    if with_links:
        both = every.select("a", "b").unionByName(every.select(F.col("b").alias("a"), F.col("a").alias("b")))
        others = both.join(own.select(F.col("key").alias("b"), "copies"), "b").groupBy("a").agg(F.sum("copies").alias("others"))
        counted = own.join(others, own["key"] == others["a"], "left").select("key", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"))
        names = names.join(counted, "key")
    named = rows.join(names, "key", "left")
    n_links = [F.when(F.col("n_shingles") > 0, F.col("n_links")).otherwise(F.lit(0).cast("long")).alias("n_links")] if with_links else []
    return named.select(
        F.col("id").alias(id_col), "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"), *n_links
    )


#: The same in DuckDB's SQL, by counting what every two documents have in common; for small tables.
SQL = r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS MATERIALIZED (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ') ELSE array_to_string(w[i : i + 4], ' ') END AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM worded WHERE len(w) > 0)
), sizes AS MATERIALIZED (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS MATERIALIZED (
  SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * shared >= 75 * (p.n + q.n - shared)
), reached AS (
  SELECT doc_id AS a, doc_id AS b FROM sizes
  UNION
  SELECT a, y FROM reached JOIN links ON x = b
)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce((SELECT min(b) FROM reached WHERE a = d.doc_id), d.doc_id) AS component_id
FROM documents d LEFT JOIN sizes ON sizes.doc_id = d.doc_id
"""
