"""Operators over documents against brute force, on odd rows and on nothing."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

from revisit.llm import fingerprints, jaccard, mixing, packing, quality, scoring, toxicity, words

BYTES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def tokens(text):
    return (text or "").encode().lower().split()


def held_out(doc_id, modulus):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % modulus


def test_word_hashes_are_of_words():
    texts = [b"A b\tc  a", b"", None, b"c", b"y" * (words.CHUNK_BYTES + 5) + b" a", b" a b " * 900_000]
    seen = {}
    for first, hashes, offsets in words.hashed(texts):
        for i in range(len(offsets) - 1):
            own = (texts[first + i] or b"").lower().split()
            assert len(own) == offsets[i + 1] - offsets[i]
            for word, h in zip(own, hashes[offsets[i] : offsets[i + 1]].tolist()):
                assert seen.setdefault(word, h) == h
    assert len(set(seen.values())) == len(seen) == 4


def test_scoring(spark, odd, nothing):
    got = scoring.documents_scored(odd, PIECES).collect()
    counts, texts = Counter(), 0
    rows = odd.select("doc_id", "text").collect()
    for doc_id, text in rows:
        if held_out(doc_id, 7) != 2:
            counts.update(tokens(text))
            texts += 1
    n, v = sum(counts.values()) + texts, len(counts) + 1
    expected = Counter()
    for doc_id, text in rows:
        own = tokens(text)
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in own) + math.log10((texts + 1) / (n + v + 1))
        expected[doc_id, held_out(doc_id, 7) == 2, len(own) + 1, sum(counts[w] > 0 for w in own) + 1, n, round(base, 4)] += 1
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got) == expected
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)
    assert scoring.documents_scored(nothing, PIECES).collect() == []


def test_rare_words_score_as_hot_ones(spark, odd):
    key = lambda r: (str(r.doc_id), r.n_tokens, r.n_known)
    training = scoring.remainder(scoring.F.col("doc_id"), 7) != 2
    hot, cold = (sorted(scoring.scores(odd, training, PIECES, hot_words=n).collect(), key=key) for n in (100_000, 3))
    assert [key(r) for r in hot] == [key(r) for r in cold]
    assert np.allclose([r.score for r in hot], [r.score for r in cold]) and np.allclose([r.base_score for r in hot], [r.base_score for r in cold])


def test_lattice_sums_all_segmentations():
    pieces = scoring.vocabulary(PIECES)
    lattice, score = scoring.Lattice(pieces), np.log(np.random.default_rng(0).dirichlet(np.ones(len(pieces))))
    named = dict(zip(pieces, score))

    def slow(word):
        word, alpha = b" " + word, [1.0]
        for j in range(1, len(word) + 1):
            alpha.append(sum(alpha[i] * math.exp(named[word[i:j]]) for i in range(max(0, j - 16), j) if word[i:j] in named))
        return math.log(alpha[-1])

    found = [b"the", b"a", b"", "éreau".encode(), b"thingtion", b"x" * 30, b"hello,world!!"]
    assert np.allclose(scoring.log_probabilities(lattice, score, found), [slow(w) for w in found])
    # expected uses of all pieces cover each word's bytes exactly
    uses = scoring.expected(lattice, score, found, np.ones(len(found)))
    assert math.isclose((uses * [len(p) for p in pieces]).sum(), sum(len(w) + 1 for w in found))


def brute_components(rows):
    sets = []
    for _, text in rows:
        w = tokens(text)
        sets.append({tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if w else set())
    least = list(range(len(rows)))

    def find(x):
        while least[x] != x:
            x = least[x]
        return x

    holders = defaultdict(list)
    for i, s in enumerate(sets):
        shared = Counter(j for g in s for j in holders[g])
        for g in s:
            holders[g].append(i)
        for j, o in shared.items():
            if 100 * o >= 75 * (len(s) + len(sets[j]) - o):
                least[find(i)] = find(j)
    names = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        names[find(i)].append(doc_id)
    smallest = {k: min((x for x in v if x is not None), default=None) for k, v in names.items()}
    return Counter((rows[i][0], len(sets[i]), smallest[find(i)]) for i in range(len(rows)))


def near_rows():
    """Groups of copies edited more and less, sizes around the limits, and a passage many share."""
    rng, rows = np.random.default_rng(3), []
    passage = [f"p{i}" for i in range(40)]
    for group in range(12):
        base = [f"g{group}_{i}" for i in range(int(rng.integers(3, 160)))]
        for _ in range(int(rng.integers(2, 9))):
            own = list(base)
            for _ in range(int(rng.integers(0, 5))):
                own[int(rng.integers(len(own)))] = f"e{rng.integers(60)}"
            rows.append(" ".join(own))
    rows += [" ".join([f"u{i}_{j}" for j in range(int(rng.integers(0, 40)))] + passage) for i in range(80)]
    return list(enumerate(rows))


@pytest.mark.parametrize("frequent", [50, 3])
def test_jaccard_join(spark, odd, monkeypatch, frequent):
    monkeypatch.setattr(jaccard, "FREQUENT_RANK", int(np.floor(8 * np.log2(frequent))))
    rows = near_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert Counter(map(tuple, jaccard.near_duplicates(docs).collect())) == brute_components(rows)


def test_jaccard_join_on_odd_rows(spark, odd, nothing):
    rows = [tuple(r) for r in odd.select("doc_id", "text").collect()]
    assert Counter(map(tuple, jaccard.near_duplicates(odd).collect())) == brute_components(rows)
    assert jaccard.near_duplicates(nothing).collect() == []


def test_prefix_keys_lose_no_pair():
    """Any two sets that reach the similarity share a key, whatever is frequent."""
    rng = np.random.default_rng(5)
    for n in [1, 2, 3, 7, 20, 22, 23, 30, 31, 40, 41, 64, 100, 127, 300]:
        for _ in range(30):
            a = np.arange(n, dtype=np.uint64)
            cut = int(rng.integers(0, n // 4 + 1))
            b = np.concatenate((np.sort(rng.permutation(n)[cut:]), n + np.arange(int(rng.integers(0, cut + 1))))).astype(np.uint64)
            both = len(np.intersect1d(a, b))
            if 100 * both < 75 * (len(a) + len(b) - both):
                continue
            rank = rng.choice([10, 200], size=2 * n + 2).astype(np.uint8)
            keys = []
            for s in (a, b):
                order = np.lexsort((s, rank[s.astype(int)]))
                keys.append(jaccard.index_keys(len(s), 0, words.mix(s[order]), rank[s[order].astype(int)]))
            # the order among equal ranks must be that of the tokens themselves
            ordered = []
            for s in (a, b):
                t = words.mix(s)
                order = np.lexsort((t, rank[s.astype(int)]))
                ordered.append(jaccard.index_keys(len(s), 0, t[order], rank[s[order].astype(int)]))
            assert len(np.intersect1d(*ordered)) or n == 1


def test_fingerprints(spark, odd, nothing):
    rows = [tuple(r) for r in odd.select("doc_id", "text").collect()]
    got = fingerprints.edited_fingerprints(odd).collect()
    assert len(got) == len(rows)
    single = [(i, t or "") for i, t in rows if i is not None and [x for x, _ in rows].count(i) == 1]
    for doc_id, text in single:
        found = [r for r in got if r.doc_id == doc_id]
        assert len(found) == 1 and found[0].n_chars == len(text)
    ids = sorted({i for i, _ in rows if i is not None}, reverse=True)
    for doc_id, text in single:
        place = ids.index(doc_id)
        after = [t or "" for i, t in rows if i == (ids[place + 1] if place + 1 < len(ids) else None)]
        if len(after) == 1:
            cut = len(text) // 3
            edited = text[: len(text) - cut] + after[0][:cut]
            assert next(r for r in got if r.doc_id == doc_id).edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
    assert fingerprints.edited_fingerprints(nothing).collect() == []
    plain = fingerprints.fingerprints(odd).select("text", "fingerprint").collect()
    assert len({(r.text or "").lower() for r in plain}) >= len({r.fingerprint for r in plain})
    assert {r.fingerprint for r in plain if not (r.text or "").strip()} == {""}


def test_sketches_estimate_and_merge(spark):
    a = [f"a{i}" for i in range(3000)]
    b = a[:1500] + [f"b{i}" for i in range(1500)]
    x, y, both = fingerprints.sketches([" ".join(t).encode() for t in (a, b, a[:10])])
    assert abs(fingerprints.resemblance(x, y) - 1 / 3) < 0.15
    assert abs(fingerprints.containment(x, y) - 0.5) < 0.2
    assert abs(fingerprints.distinct_count(x) / 3000 - 1) < 0.3
    assert (fingerprints.parsed(fingerprints.printed(x)) == x).all()
    small = list(fingerprints.sketches([b"p q r s t u", b"p q r s t v"]))
    assert fingerprints.resemblance(*small) == 5 / 7 and fingerprints.distinct_count(small[0]) == 6
    parts = spark.createDataFrame([("k", fingerprints.printed(x)), ("k", fingerprints.printed(y)), ("k", None), (None, "")], "k string, fingerprint string")
    out = {r.k: r.fingerprint for r in fingerprints.merged(parts, ["k"]).collect()}
    assert out == {"k": fingerprints.printed(fingerprints.merge(x, y)), None: ""}


def test_quality(spark, odd, nothing, labelled):
    kept = quality.resampled(odd, labelled)
    ids = [r.doc_id for r in kept.collect()]
    assert {200 + i for i in range(30)} <= set(ids)
    assert set(odd.columns) <= set(kept.columns)
    assert quality.resampled(nothing, labelled).collect() == []
    assert quality.resampled(odd, labelled.limit(0)).count() == odd.count()
    narrow = quality.resampled(odd, labelled, carry=["doc_id"])
    assert narrow.columns == ["doc_id", "log_weight", "sample_key"]
    assert sorted(str(r.doc_id) for r in narrow.collect()) == sorted(map(str, ids))
    assert quality.resampled(odd, labelled, k=7, target_rows=20).count() == 7
    assert quality.resampled(odd, labelled, k=7).count() == 7 and quality.resampled(odd, labelled, k=0).count() == 0


def test_largest_takes_the_k_largest(spark):
    rows = [(i, float(x)) for i, x in enumerate(np.random.default_rng(1).normal(size=4000).round(2))]
    frame = spark.createDataFrame(rows, "id long, x double")
    for k in (1, 37, 2000, 3999, 5000):
        got = sorted(map(tuple, quality.largest(frame, "x", ["id"], k).collect()))
        assert got == sorted(sorted(rows, key=lambda r: (-r[1], r[0]))[:k])


def test_toxicity(spark, odd, nothing, labelled):
    got = {r.doc_id: r for r in toxicity.toxicity(odd, labelled).collect()}
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) and r.held_out == (held_out(r.doc_id, 5) == 0) for r in got.values())
    tested = [r for r in got.values() if r.held_out and r.doc_id]
    assert all(r.predicted == (100 <= r.doc_id < 120) for r in tested if r.doc_id >= 100)
    assert toxicity.toxicity(nothing, labelled).collect() == []
    assert {r.score for r in toxicity.toxicity(odd, labelled.limit(0)).collect()} == {0.5}


def test_ftrl_against_the_written_rule():
    rng = np.random.default_rng(2)
    rows = [np.unique(rng.integers(0, 12, 5)).astype(np.uint64) for _ in range(60)]
    labels = np.array([float(3 in r) for r in rows])
    names, w, bias = toxicity.ftrl(rows, labels, l1=0.4, epochs=2)
    z, n = np.zeros(13), np.zeros(13)

    def weight(i):
        l1 = 0.0 if i == 12 else 0.4
        return 0.0 if abs(z[i]) <= l1 else -(z[i] - math.copysign(l1, z[i])) / ((toxicity.BETA + math.sqrt(n[i])) / toxicity.ALPHA + toxicity.L2)

    for _ in range(2):
        for r, y in zip(rows, labels):
            used = [int(i) for i in r] + [12]
            own = {i: weight(i) for i in used}
            g = 1 / (1 + math.exp(-sum(own.values()))) - y
            for i in used:
                sigma = (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / toxicity.ALPHA
                z[i] += g - sigma * own[i]
                n[i] += g * g
    assert np.allclose([weight(int(i)) for i in names], w) and math.isclose(bias, weight(12))
    assert 3 in names.tolist()


def check_packing(rows, ids_of, length, segments, loss):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for doc_id, pieces in by_doc.items():
        ids = ids_of[doc_id]
        pieces.sort(key=lambda r: r.start)
        assert [r.start for r in pieces] == list(np.cumsum([0, *(r.length for r in pieces)])[:-1]) and sum(r.length for r in pieces) == len(ids)
        for r in pieces:
            assert r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], dtype="<u4").tobytes())
    for pieces in by_sequence.values():
        pieces.sort(key=lambda r: r.offset)
        total = sum(r.length for r in pieces)
        assert [r.offset for r in pieces] == list(np.cumsum([0, *(r.length for r in pieces)])[:-1])
        assert total <= length and total & (total - 1) == 0 and len(pieces) <= segments and sum(r.loss_tokens for r in pieces) <= loss


@pytest.mark.parametrize("length,segments,loss", [(1024, 32, 1024), (64, 3, 64), (64, 5, 20)])
def test_packing(spark, odd, nothing, length, segments, loss):
    from tokenizers import Tokenizer

    tool = Tokenizer.from_file(BYTES)
    tool.encode_special_tokens = True
    docs = odd.where("doc_id is not null").dropDuplicates(["doc_id"]).select("doc_id", "text")
    extra = spark.createDataFrame([(900, "a<|endoftext|>b"), (901, "　 x \x1c y "), (902, "it's  we'll\n\n 12")], docs.schema)
    docs = docs.unionByName(extra).cache()
    ids_of = {i: tool.encode(t or "", add_special_tokens=False).ids + [0] for i, t in docs.collect()}
    check_packing(packing.packed(docs, BYTES, length=length, segments=segments, loss=loss).collect(), ids_of, length, segments, loss)
    assert packing.packed(nothing, BYTES).collect() == []
    assert packing.packed(odd, BYTES).agg({"length": "sum"}).first()[0] > 0


def test_packing_with_prompts(spark):
    turns = spark.createDataFrame([(i, "ask " * (i % 7 + 1), "answer " * (i % 11)) for i in range(200)], "doc_id long, prompt string, text string")
    rows = packing.packed(turns, BYTES, prompt_col="prompt", length=128, segments=6, loss=40, with_ids=True).collect()
    by_sequence = defaultdict(int)
    for r in rows:
        by_sequence[r.sequence_id] += r.loss_tokens
        assert len(r.ids) == r.length
    assert max(by_sequence.values()) <= 40
    lengths = Counter(sum(x.length for x in rows if x.sequence_id == s) for s in by_sequence)
    assert all(n & (n - 1) == 0 for n in lengths)


def test_long_texts_are_tokenised_in_parts(monkeypatch):
    tool = packing.Ids(BYTES)
    text = " ".join(f"word{i}, é\n next" for i in range(3000))
    whole = tool([text])[0].tolist()
    monkeypatch.setattr(packing, "SLICE", 100)
    assert tool([text])[0].tolist() == whole


def test_mixing(spark, odd, nothing):
    rows = mixing.mix(odd).collect()
    sizes = [(r.doc_id, len(tokens(r.text)), r.source) for r in odd.collect()]
    total = Counter()
    for _, n, source in sizes:
        total[source] += n
    order = sorted((s for s in total if s is not None), key=lambda s: s.encode()) + [None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, free = {}, {s for s in total}
    left = 1.5 * sum(total.values())
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * level > 2 * total[s]}
        if not over:
            target |= {s: weight[s] * level for s in free}
            break
        for s in over:
            target[s] = 2.0 * total[s]
            left -= target[s]
        free -= over
    by_size = {(d, n, total[s], round(target[s], 3)) for d, n, s in sizes}
    assert {(r.doc_id, r["size"], r.source_size, round(r.target, 3)) for r in rows} == by_size and len(rows) == len(sizes)
    assert all(r.taken <= 2 * r["size"] for r in rows)
    taken = Counter()
    for r in rows:
        taken[r.source_size, r.target] += r.taken
    assert all(abs(n - t) <= 64 for (_, t), n in taken.items())
    assert sorted(map(str, rows)) == sorted(map(str, mixing.mix(odd.repartition(5)).collect()))
    assert mixing.mix(nothing).collect() == []


def test_quotas_by_highest_quotients(spark):
    rng = np.random.default_rng(4)
    for n, seats in ((1, 5), (7, 3), (20, 101), (20, 9)):
        votes = rng.integers(0, 50, n).astype(float)
        frame = spark.createDataFrame([(i, float(v)) for i, v in enumerate(votes)], "i long, votes double")
        got = {r.i: r.quota for r in mixing.apportioned(frame, [], ["i"], mixing.F.lit(float(seats))).collect()}
        won = Counter()
        if votes.sum():
            for _ in range(seats):
                best = max((i for i in range(n) if votes[i] > 0), key=lambda i: (votes[i] / (2 * won[i] + 1), -i))
                won[best] += 1
        assert got == {i: won[i] for i in range(n)}
