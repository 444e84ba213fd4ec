"""Hard negatives against plain Python."""

import math
import random
from collections import Counter

import numpy as np
import pytest

from revisit.llm import mining

TYPES = "vec_id long, embedding array<double>, label int, key int, score string, least double"


def brute(rows):
    items = []
    for vec_id, v, label in rows:
        if vec_id is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        items.append((vec_id, [math.floor(256 * x) for x in v], (label + 1) % 10 if vec_id % 7 == 0 else label))
    out = Counter()
    dot = lambda a, b: max(-(2**63), min(2**63 - 1, sum(x * y for x, y in zip(a, b))))
    for i, (anchor, v, label) in enumerate(items):
        if anchor % 50:
            continue
        scored = sorted((-dot(v, w), other, same == label) for j, (other, w, same) in enumerate(items) if j != i)
        for p, positive in [(-s, o) for s, o, same in scored if same][:5]:
            bad = [(-s, o) for s, o, same in scored if not same and 50 * p <= -100 * s <= 95 * p][:3]
            for r, (s, negative) in enumerate(bad, 1):
                out[(anchor, positive, r, negative, p, s)] += 1
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "s", 0.5) for r in rows], TYPES)


def vectors(seed, n, width, spread=1.0, labels=4):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(width)] for _ in range(6)]
    return [(i, [c + spread * rng.gauss(0, 1) for c in centres[rng.randrange(6)]], rng.randrange(labels)) for i in range(n)]


@pytest.mark.parametrize("seed, width, spread", [(1, 20, 1.0), (2, 3, 0.3), (3, 33, 4.0)])
def test_against_all_scores(spark, monkeypatch, seed, width, spread):
    monkeypatch.setattr(mining, "ROW_BLOCK", 90)
    monkeypatch.setattr(mining, "ANCHOR_BLOCK", 3)
    rows = vectors(seed, 400, width, spread)
    got = Counter(tuple(r) for r in mining.mined(frame(spark, rows)).collect())
    assert got == brute(rows) and got


def test_odd_vectors(spark):
    rng = random.Random(5)
    rows = [(i, [rng.random(), rng.random(), rng.random()], i % 3) for i in range(120)]
    rows += [(50, [1.0, 0.5, 0.25], 1), (50, [0.2, 0.9, 0.9], 1), (7, [0.5, 0.5, 0.5], 2), (7, [0.5, 0.5, 0.5], 2)]  # repeated ids, a repeated row
    rows += [(200 + i, [0.9, 0.1, 0.4], i % 2) for i in range(60)]  # many copies of one vector
    rows += [(300, None, 1), (350, [1.0, None, 1.0], 1), (400, [1.0, float("nan"), 0.0], 1), (450, [float("inf"), 0.0, 0.0], 1), (500, [1.0, 1.0, 1.0], None), (None, [1.0, 1.0, 1.0], 1)]
    rows += [(550, [0.0, 0.0, 0.0], 1), (600, [], 1), (650, [0.7], 2), (700, [0.3, 0.2, 0.1, 0.9], 0), (750, [-1.0, -1.0, -1.0], 9)]
    got = Counter(tuple(r) for r in mining.mined(frame(spark, rows)).collect())
    assert got == brute(rows) and got


def test_large_components(spark):
    rows = [(i * 25, [1e12 * (i + 1), -3e11 * i], i % 2) for i in range(12)] + [(i, [3e15, 1e16 * i], i % 3) for i in range(1, 9)]
    assert Counter(tuple(r) for r in mining.mined(frame(spark, rows)).collect()) == brute(rows)


def test_without_rows_or_anchors(spark):
    assert mining.mined(frame(spark, [])).collect() == []
    assert mining.mined(frame(spark, [(3, [1.0], 1), (4, [1.0], 1)])).collect() == []
    assert mining.mined(frame(spark, [(50, [1.0], 1)])).collect() == []


@pytest.mark.parametrize("least", [0, 500, 4000, 30_000])
def test_matches_are_all_rows_of_the_threshold(least):
    rng = np.random.default_rng(9)
    scale = 1 / np.arange(1, 41)
    x, q = (np.floor(200 * rng.normal(size=(n, 40)) * scale).astype(np.int64) for n in (500, 20))
    for i, (rows, score) in enumerate(mining.matches(q, np.full(20, least), x)):
        every = x @ q[i]
        assert sorted(rows.tolist()) == np.flatnonzero(every >= least).tolist() and (score == every[rows]).all()


def test_suffixes_below_the_threshold_are_not_indexed():
    rng = np.random.default_rng(4)
    x = np.floor(100 * rng.normal(size=(300, 40)) / np.arange(1, 41) ** 2)
    q = np.floor(100 * rng.normal(size=40) / np.arange(1, 41) ** 2)
    looks = [*range(0, 40, mining.STEP), 40]
    rest = mining.suffix_norms(q[None, :], looks)[0]
    index = mining.Index(x, rest / 5000)
    assert 0 < index.many[0] < 300 and index.many[1] < index.many[0] and index.many[-1] == 0
    found = index.candidates(q, rest, 5000)
    assert set(np.flatnonzero(x @ q >= 5000)) <= set(index.order[found]) and len(found) < 300
