"""SimHash fingerprints and their components against plain Python."""

import random
from collections import Counter

import numpy as np
import pytest
import xxhash

from conftest import words_of
from revisit.llm import simhash


def slow_fingerprint(text):
    w = (text or "").encode().lower().split()
    shingles = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    hashes = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(bits):
    """The least index reachable from each one."""
    root = list(range(len(bits)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, x in enumerate(bits):
        for j in range(i):
            if (x ^ bits[j]).bit_count() <= 3:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(bits))]


def test_fingerprints_are_those_of_the_definition(monkeypatch):
    monkeypatch.setattr(simhash, "SLICE_WORDS", 7)
    for text in [None, "", " \t", "One", "one TWO", "a b c", "ä Ö x y", words_of(1, 6), words_of(2, 7), words_of(3, 8), words_of(4, 300), "x " * 40]:
        assert simhash.fingerprint(text.encode() if text is not None else None) == slow_fingerprint(text)


def test_spark_hashes_alike(spark):
    row = spark.sql("SELECT xxhash64('one two three') AS h").first()
    assert row.h % 2**64 == xxhash.xxh64(b"one two three", seed=42).intdigest()


def clustered(seed, centres, each, flips):
    rng = random.Random(seed)
    out = []
    for _ in range(centres):
        x = rng.getrandbits(64)
        out.append(x)
        for _ in range(each):
            for b in rng.sample(range(64), rng.randint(0, flips)):
                x ^= 1 << b
            out.append(x)
    return list(dict.fromkeys(out))


@pytest.mark.parametrize("limit", [4096, 2])
@pytest.mark.parametrize("flips", [3, 5])
def test_links_connect_what_brute_force_connects(spark, limit, flips):
    bits = [0, 1, 1 << 63, (1 << 64) - 1, *clustered(flips, 12, 25, flips)]
    frame = spark.createDataFrame([(int(np.uint64(b).astype(np.int64)),) for b in bits], "bits long")
    found = {(r.a % 2**64, r.b % 2**64) for r in simhash.links(frame, limit=limit).collect()}
    assert all((a ^ b).bit_count() <= 3 for a, b in found)
    place = {b: i for i, b in enumerate(bits)}
    root = list(range(len(bits)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in found:
        x, y = find(place[a]), find(place[b])
        root[max(x, y)] = min(x, y)
    assert [find(i) for i in range(len(bits))] == components(bits)


def test_every_triple_of_bits_meets():
    """Any three differing bits leave a variant that both have, with three and with sixteen ranges."""
    for ranges in (3, 16):
        balls = [(s, a % 2**64, b % 2**64) for s, a, b in simhash.balls(ranges)]
        keys = lambda x: {(x >> s | x << 64 - s) % 2**64 & a ^ b for s, a, b in balls}
        rng = random.Random(ranges)
        for _ in range(200):
            x = rng.getrandbits(64)
            y = x ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 3)))
            assert keys(x) & keys(y)
            assert len(keys(x)) == len(balls)  # a fingerprint's variants are different keys


def expected(rows):
    bits = [slow_fingerprint(text) for _, text in rows]
    distinct = list(dict.fromkeys(bits))
    group = dict(zip(distinct, components(distinct)))
    least = {}
    for (doc_id, _), b in zip(rows, bits):
        if doc_id is not None:
            least[group[b]] = min(doc_id, least.get(group[b], doc_id))
    return Counter((doc_id, f"{b:016x}", least.get(group[b])) for (doc_id, _), b in zip(rows, bits))


def test_odd_documents(spark, odd, nothing):
    rows = [tuple(r) for r in odd.select("doc_id", "text").collect()]
    got = simhash.near_duplicates(odd)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert Counter(tuple(r) for r in got.collect()) == expected(rows)
    assert simhash.near_duplicates(nothing).collect() == []


def test_near_texts(spark):
    rng, rows = random.Random(3), []
    for i in range(12):
        base = words_of(100 + i, 400).split()
        for _ in range(6):
            copy = list(base)
            copy[rng.randrange(400)] = "changed"
            rows.append((len(rows) * 7 % 71, " ".join(copy)))
    got = Counter(tuple(r) for r in simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == expected(rows)
    assert len({r[2] for r in got}) < len(rows)
