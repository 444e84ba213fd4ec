"""The manifest against trees built in plain Python."""

import hashlib
import zlib

import pytest

from revisit.llm import merkle

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, text):
    values = (row.doc_id, row.source, row.lang, row.n_chars, text)
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(level, at):
    """Siblings from the node up to the root, and the root."""
    siblings = []
    while len(level) > 1:
        run = level[at // 8 * 8 : at // 8 * 8 + 8]
        siblings.append((run[: at % 8], run[at % 8 + 1 :]))
        level = [sha("".join(level[i : i + 8])) for i in range(0, len(level), 8)]
        at //= 8
    return siblings, level[0]


def brute(rows):
    first = lambda v: (v is not None, v)
    groups = {}
    for row in rows:
        groups.setdefault(row.lang, []).append(row)
    langs = sorted(groups, key=lambda v: (v is not None, (v or "").encode()))
    for lang in langs:
        groups[lang].sort(key=lambda r: (first(r.doc_id), leaf(r, r.text)))
    leaves = {lang: [leaf(r, r.text) for r in groups[lang]] for lang in langs}
    subroots = [climb(leaves[lang], 0)[1] for lang in langs]
    out = []
    for i, lang in enumerate(langs):
        upper, root = climb(subroots, i)
        for j, row in enumerate(groups[lang]):
            siblings, subroot = climb(leaves[lang], j)
            hit = row.doc_id is not None and zlib.crc32(str(row.doc_id).encode()) % 3 == 0
            folded = leaf(row, row.text.translate(LOWER) if hit and row.text is not None else row.text)
            for left, right in siblings + upper:
                folded = sha("".join(left) + folded + "".join(right))
            proof = sha("".join("".join(left + right) for left, right in siblings + upper))
            out.append((row.doc_id, leaves[lang][j], subroot, root, proof, folded, folded == root))
    return out


def same(docs):
    got = [tuple(r) for r in merkle.proved(docs).collect()]
    key = lambda r: tuple(str(v) for v in r)
    assert sorted(got, key=key) == sorted(brute(docs.collect()), key=key)
    return got


def test_odd_documents(odd):
    same(odd)


@pytest.mark.parametrize("n, langs", [(1, 1), (8, 1), (9, 1), (17, 2), (65, 1), (150, 40), (600, 3)])
def test_sizes(spark, n, langs):
    rows = [(i * 3, f"Text {i % 50}", None if i % langs == 0 else f"l{i % langs}é", "s", i) for i in range(n)]
    got = same(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5))
    assert len(got) == n


def test_no_documents(nothing):
    assert merkle.proved(nothing).collect() == []


def test_a_run_of_one_is_hashed(spark):
    """The ninth leaf has no siblings in its run, which is hashed all the same."""
    rows = [(i, "a", "x", "s", 1) for i in range(9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    leaves = [leaf(r, r.text) for r in sorted(docs.collect(), key=lambda r: r.doc_id)]
    root = sha(sha("".join(leaves[:8])) + sha(leaves[8]))
    assert {r.root for r in merkle.proved(docs).collect()} == {root}


def test_a_changed_row_changes_the_root(spark):
    rows = [(i, f"a{i}", "x", "s", 1) for i in range(20)]
    types = "doc_id long, text string, lang string, source string, n_chars long"
    before = merkle.manifest(spark.createDataFrame(rows, types)).root
    rows[7] = (7, "other", "x", "s", 1)
    assert merkle.manifest(spark.createDataFrame(rows, types)).root != before
    assert merkle.manifest(spark.createDataFrame(rows[:7] + [(7, "a7", "x", "s", 1)] + rows[8:], types)).root == before
