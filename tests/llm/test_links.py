"""Every link of the Jaccard join against brute force."""

from collections import Counter, defaultdict

import pytest

from revisit.llm import jaccard
from test_texts import brute_components, near_rows, tokens


def brute_links(rows):
    """Links between distinct sets as (least id, least id, sizes, copies, shared), and each row's number of links."""
    sets = []
    for _, text in rows:
        w = tokens(text)
        sets.append(frozenset(tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))) if w else frozenset())
    copies, ids = Counter(s for s in sets if s), defaultdict(list)
    for (doc_id, _), s in zip(rows, sets):
        ids[s] += [doc_id] if doc_id is not None else []
    distinct, others, found = list(copies), Counter(), Counter()
    for i, s in enumerate(distinct):
        for t in distinct[:i]:
            both = len(s & t)
            if 100 * both >= 75 * len(s | t):
                others[s] += copies[t]
                others[t] += copies[s]
                ends = sorted(((min(ids[x], default=-1), len(x), copies[x]) for x in (s, t)))
                found[(*ends, both)] += 1
    return found, Counter((doc_id, copies[s] - 1 + others[s] if s else 0) for (doc_id, _), s in zip(rows, sets))


def as_found(rows):
    side = lambda r, x: (-1 if r[f"least_{x}"] is None else r[f"least_{x}"], r[f"n_{x}"], r[f"copies_{x}"])
    return Counter((*sorted((side(r, "a"), side(r, "b"))), r.shared) for r in rows)


@pytest.mark.parametrize("cell", [1000, 3])
def test_every_link_is_returned_once(spark, monkeypatch, cell):
    monkeypatch.setattr(jaccard, "CELL_SETS", cell)
    monkeypatch.setattr(jaccard, "BLOCK_PAIRS", 5)
    rows = near_rows()
    rows += [(1000 + i, text) for i, (_, text) in enumerate(rows[:9])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    expected, n_links = brute_links(rows)
    assert sum(expected.values()) > len(rows) / 2
    assert as_found(jaccard.links(docs).collect()) == expected
    got = jaccard.near_duplicates(docs, with_links=True).collect()
    assert Counter((r.doc_id, r.n_links) for r in got) == n_links
    assert Counter(tuple(r)[:3] for r in got) == brute_components(rows)


def test_links_of_odd_rows(spark, odd, nothing):
    rows = [tuple(r) for r in odd.select("doc_id", "text").collect()]
    expected, n_links = brute_links(rows)
    assert as_found(jaccard.links(odd).collect()) == expected
    assert Counter((r.doc_id, r.n_links) for r in jaccard.near_duplicates(odd, with_links=True).collect()) == n_links
    assert jaccard.links(nothing).collect() == [] and jaccard.near_duplicates(nothing, with_links=True).collect() == []
