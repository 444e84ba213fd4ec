"""Every class of texts has a model of its own in op1, however many there are."""

import math
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

from revisit.llm import scoring

PIECES = public_tokenizers.path("piece_bpe_32k.model")


def texts():
    """Eleven classes with words, one without, one beyond the floats' range when spelled and the null class; held-out rows at last."""
    rng = np.random.default_rng(3)
    rows = []
    for k in range(11):
        own = [f"k{k}w{i}" for i in range(6)] + ["the", "of", "Thing"]
        rows += [(" ".join(rng.choice(own, 20)), f"class{k}") for _ in range(1 + (11 - k) // 2)]
    rows += [("", "silent"), (None, "silent"), ("the " + "q-z9" * 700 + " k3w1", "long"), ("of of k1w1 alone", None)]
    held = ["the of k9w1 k9w2 k9w3", "new words k10w5", "", None, "q-z9" * 700, "k0w1 " * 300, "alone"]
    return [(i, t, k, True) for i, (t, k) in enumerate(rows)] + [(1000 + i, t, "class0", False) for i, t in enumerate(held)]


def slow(rows):
    """Texts' log10 probabilities: the sum over all classes, each from its own counts."""
    pieces = scoring.vocabulary(PIECES)
    lattice, score = scoring.Lattice(pieces), np.full(len(pieces), -np.log(len(pieces)))
    words = lambda t: (t or "").lower().encode().split()
    counts, sizes, everything = defaultdict(Counter), Counter(k for _, _, k, train in rows if train), Counter()
    for _, t, k, train in rows:
        if train:
            counts[k].update(words(t))
            everything.update(words(t))
    found, n = list(everything), np.array(list(everything.values()), dtype=float)
    for _ in range(scoring.ROUNDS):
        uses = scoring.expected(lattice, score, found, n)
        score = np.log((uses + 0.01) / (uses.sum() + 0.01 * len(pieces)))
    all_words = sorted({w for _, t, _, _ in rows for w in words(t)})
    spelling = dict(zip(all_words, scoring.log_probabilities(lattice, score, all_words)))

    def by_class(k, text):
        used = sum(counts[k].values())
        share = used / (used + sizes[k]) if used else 0.5
        rest = len(counts[k]) * scoring.DISCOUNT / used if used else 1.0
        out = math.log(sizes[k] / sum(sizes.values())) + math.log1p(-share)
        for w in words(text):
            spelled = spelling[w] + math.log(rest)
            out += math.log(share) + (np.logaddexp(math.log((counts[k][w] - scoring.DISCOUNT) / used), spelled) if counts[k][w] else spelled)
        return out

    return {i: np.logaddexp.reduce([by_class(k, t) for k in sizes]) / math.log(10) for i, t, _, _ in rows}


@pytest.mark.parametrize("limits", [{}, {"classes": 3, "hot_words": 12}, {"classes": 1, "hot_words": 0}, {"classes": 100}])
def test_all_classes_count(spark, limits):
    rows = texts()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, train boolean").repartition(3)
    got = {r.doc_id: r for r in scoring.scores(docs, scoring.F.col("train"), PIECES, **limits).collect()}
    want = slow(rows)
    assert {i: r.score for i, r in got.items()} == pytest.approx(want, rel=1e-9)
    assert {r.train_tokens for r in got.values()} == {sum(len((t or "").split()) + 1 for _, t, _, train in rows if train)}


def test_gains_are_summed_in_runs(monkeypatch):
    rng = np.random.default_rng(0)
    dense = rng.random((50, 7)) * (rng.random((50, 7)) < 0.4)  # places by classes
    place, class_ = np.nonzero(dense)
    first = np.searchsorted(place, np.arange(51))
    owner, at = np.sort(rng.integers(0, 9, 400)), rng.integers(0, 50, 400)
    want = np.zeros((10, 7))
    np.add.at(want, owner, dense[at])
    for held in (1, 10, 1 << 20):
        monkeypatch.setattr(scoring, "HELD_GAINS", held)
        offsets, classes, sums = scoring._gained(owner, at, first, class_, dense[place, class_], 10, 7)
        got = np.zeros((10, 7))
        got[np.repeat(np.arange(10), np.diff(offsets)), classes] = sums
        assert np.allclose(got, want)
