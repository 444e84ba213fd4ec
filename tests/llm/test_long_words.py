"""Words of any length, and pieces of any length, take part in op1's lattice whole."""

import itertools
import math
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from revisit.llm import scoring, words

PIECES = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def lattice():
    return scoring.Lattice(scoring.vocabulary(PIECES))


@pytest.fixture(scope="module")
def score():
    pieces = scoring.vocabulary(PIECES)
    return np.log(np.random.default_rng(0).dirichlet(np.ones(len(pieces))))


def letters(seed, n):
    return bytes(np.random.default_rng(seed).choice(np.frombuffer(b"eeetaoinshr.-/", dtype=np.uint8), n))


def segmentations(word, named):
    """All ways to write a word as pieces."""
    for n in range(1, len(word) + 1):
        if word[:n] in named:
            if n == len(word):
                yield [word]
            yield from ([word[:n], *rest] for rest in segmentations(word[n:], named))


def test_a_word_beyond_a_mebibyte_teaches_and_scores_whole(lattice, score):
    long = letters(1, (1 << 20) + 9)
    sizes = np.array([len(p) for p in scoring.vocabulary(PIECES)])
    uses = scoring.expected(lattice, score, [b"the", long], np.array([5.0, 2.0]))
    assert math.isclose((uses * sizes).sum(), 5 * 4 + 2 * (len(long) + 1), rel_tol=1e-6)
    # beyond half a mebibyte a word was cut and every part was given a space
    named, word = dict(zip(scoring.vocabulary(PIECES), score.tolist())), b" " + long
    alpha = [0.0]
    for j in range(1, len(word) + 1):
        terms = [alpha[i] + named[word[i:j]] for i in range(max(0, j - lattice.longest), j) if word[i:j] in named]
        alpha.append(max(terms) + math.log(sum(math.exp(t - max(terms)) for t in terms)))
    assert math.isclose(scoring.log_probabilities(lattice, score, [long])[0], alpha[-1], rel_tol=1e-9)


@pytest.mark.parametrize("window", [1, 7, 100, 5000])
def test_windows_equal_the_whole(lattice, score, monkeypatch, window):
    found = [b"the", b"a", b"", "éreau".encode(), "является".encode(), letters(2, 99), letters(3, 100), letters(4, 701), b"x" * 300]
    counts = np.arange(1.0, len(found) + 1)
    monkeypatch.setattr(scoring, "LONG_WORD", 10**9)
    whole = scoring.log_probabilities(lattice, score, found), scoring.expected(lattice, score, found, counts)
    monkeypatch.setattr(scoring, "LONG_WORD", 0)
    monkeypatch.setattr(scoring, "WINDOW", window)
    assert np.allclose(scoring.log_probabilities(lattice, score, found), whole[0])
    assert np.allclose(scoring.expected(lattice, score, found, counts), whole[1])


@pytest.mark.parametrize("alone", [0, 10**9])
def test_uses_are_those_of_all_segmentations(lattice, score, monkeypatch, alone):
    monkeypatch.setattr(scoring, "LONG_WORD", alone)
    pieces = scoring.vocabulary(PIECES)
    named = dict(zip(pieces, score.tolist()))
    for word in (b"thing", b"a", b"x.y"):
        ways = [(w, math.exp(sum(named[p] for p in w))) for w in segmentations(b" " + word, named)]
        total, uses = sum(p for _, p in ways), Counter()
        for way, p in ways:
            for piece in way:
                uses[piece] += p / total
        assert math.isclose(scoring.log_probabilities(lattice, score, [word])[0], math.log(total))
        assert np.allclose(scoring.expected(lattice, score, [word], np.ones(1)), [uses[p] for p in pieces])


def test_many_words_of_middling_length(lattice, score):
    found = [letters(i, 60) for i in range(9000)]  # more than CHUNK_BYTES together
    assert sum(map(len, found)) > words.CHUNK_BYTES
    some = [0, 4321, 8999]
    assert np.allclose(scoring.log_probabilities(lattice, score, found)[some], scoring.log_probabilities(lattice, score, [found[i] for i in some]))


def test_pieces_of_any_length_are_arcs(lattice, score):
    pieces = scoring.vocabulary(PIECES)
    long = " является".encode()
    assert len(long) == 17 and long in pieces
    one = np.where([p == long for p in pieces], 0.0, -50.0)
    assert scoring.log_probabilities(lattice, one, [long[1:]])[0] == pytest.approx(0.0, abs=1e-9)


def slow_scores(rows, pieces):
    """Natural logs of texts' probabilities, of all rows' own model with one class, from the lattice functions alone."""
    lattice, score = scoring.Lattice(pieces), np.full(len(pieces), -np.log(len(pieces)))
    counts = Counter(itertools.chain.from_iterable(t.lower().split() for t in rows))
    found, n = list(counts), np.array(list(counts.values()), dtype=float)
    for _ in range(scoring.ROUNDS):
        uses = scoring.expected(lattice, score, found, n)
        score = np.log((uses + 0.01) / (uses.sum() + 0.01 * len(pieces)))
    spelling, used = dict(zip(found, scoring.log_probabilities(lattice, score, found))), n.sum()
    share = used / (used + len(rows))
    rest = len(found) * scoring.DISCOUNT / used
    word = {w: np.logaddexp(np.log((c - scoring.DISCOUNT) / used), spelling[w] + np.log(rest)) + np.log(share) for w, c in counts.items()}
    return [sum(word[w] for w in t.lower().split()) + np.log1p(-share) for t in rows]


def test_texts_with_long_words_score_as_slowly(spark):
    middling = [letters(100 + i, 600) for i in range(1200)]  # a task's words are more than CHUNK_BYTES together
    rows = [letters(5, (1 << 20) + 50) + b" the end", b" ".join(middling), b"the end of the thing", b"A thing"]
    docs = spark.createDataFrame([(i, t.decode()) for i, t in enumerate(rows)], "doc_id long, text string")
    got = scoring.scores(docs, scoring.F.lit(True), PIECES, class_col=None).collect()
    want = slow_scores(rows, scoring.vocabulary(PIECES))
    assert [r.score for r in sorted(got, key=lambda r: r.doc_id)] == pytest.approx([x / math.log(10) for x in want], rel=1e-9)
