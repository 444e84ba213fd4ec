"""Extraction from pages of many shapes, against the operator's parts one page at a time."""

import html
import random
from collections import Counter

import pytest

from conftest import words_of
from revisit.llm import dom, extraction

NAV = '<nav><ul><li><a href="/">Home</a></li><li><a href="/n">News</a></li></ul></nav>'
FOOT = '<footer><p>Copyright 2024 Example Ltd</p><a href="/i">Imprint</a></footer>'


def prose(seed, n=60):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghijklmnoprstuw") for _ in range(rng.randint(2, 9))) + ("." if i % 9 == 8 else "") for i in range(n))


def paragraphs(seed):
    return [prose(seed * 10 + i, 25 + seed % 7 * 10) for i in range(3)]


def blocks(seed):
    return "".join(f"<p>{html.escape(t)}</p>" for t in paragraphs(seed))


SHAPES = {
    "article": lambda s: f"<html><body>{NAV}<article>{blocks(s)}</article>{FOOT}</body></html>",
    "named div": lambda s: f'<body>{NAV}<div class="content">{blocks(s)}</div>{FOOT}</body>',
    "plain div": lambda s: f"<body>{NAV}<div>{blocks(s)}</div>{FOOT}</body>",
    "bare alone": lambda s: f"<body>{blocks(s)}</body>",
    "bare": lambda s: f"<body>{NAV}{blocks(s)}{FOOT}</body>",
    "bare without body": lambda s: f"{NAV}{blocks(s)}{FOOT}",
    "lines at the root": lambda s: "<br>".join(paragraphs(s)),
    "lines in the body": lambda s: f"<body>{NAV}{'<br>'.join(paragraphs(s))}{FOOT}</body>",
}
TYPES = "page_id long, url string, html string, text int, n_chars string, chars double"


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(100 * k + i, f"u{i}", shape(i)) for k, shape in enumerate(SHAPES.values()) for i in range(12)]
    rows += [(5000, "u", None), (5001, "u", ""), (5002, None, "<p>"), (100, "again", SHAPES["article"](3)), (None, "u", SHAPES["article"](4))]
    rows += [(5003, "u", f"<article>{''.join(f'<p>{words_of(i, 300)}</p>' for i in range(700))}</article>"), (5004, "u", "<div>" * 3000 + prose(1) + "</section>" * 3000)]
    rows += [(5005, "u", "<article><p>The sum of <math><mi>a</mi><mo>+</mo><mi>b</mi></math> is large, as was said before in this text.</p></article>")]
    return spark.createDataFrame([(*r, 7, "s", 0.5) for r in rows], TYPES).repartition(4)


@pytest.fixture(scope="module")
def found(pages):
    return extraction.extracted(pages).collect()


def test_shapes_keep_the_article_and_drop_the_rest(found):
    for k, name in enumerate(SHAPES):
        kept = wanted = 0
        for r in found:
            if r.page_id is not None and r.page_id // 100 == k and r.url != "again":
                expected = " ".join(paragraphs(r.page_id % 100)).split()
                wanted, kept = wanted + len(expected), kept + len(set(expected) & set(r.text.split()))
                assert not {"Home", "Imprint", "Copyright"} & set(r.text.split()), name
        assert kept >= 0.9 * wanted, name


def test_equals_the_parts_one_page_at_a_time(pages, found):
    """The same sample, model and decoding without Spark; whole pages, null and empty ones too."""
    rows = pages.selectExpr("html", "xxhash64(7, CAST(page_id AS STRING)) AS place", "md5(CAST(html AS BINARY)) AS tie").collect()
    chosen = sorted((r for r in rows if r.html), key=lambda r: (r.place, r.tie))[: extraction.SAMPLE_PAGES]
    runs = [t[: extraction.SAMPLE_CHARS] for r in chosen for _, t in dom.Page(r.html).runs[: extraction.SAMPLE_RUNS]]
    vocabulary, trees = extraction.train(runs)

    def slow(source):
        page = dom.Page(source or "")
        return extraction.main_text(page, trees.predict(dom.features(page, vocabulary)))

    got = Counter((r.html, r.text, r.n_chars) for r in found)
    assert got == Counter((r.html, slow(r.html), len(slow(r.html))) for r in rows)


def test_odd_pages(pages, found):
    assert Counter(r.page_id for r in found) == Counter(r.page_id for r in pages.collect())
    assert [c for c in extraction.extracted(pages).columns if c not in ("text", "n_chars")] == ["page_id", "url", "html", "chars"]
    by_id = {r.page_id: r for r in found}
    assert all((by_id[i].text, by_id[i].n_chars) == ("", 0) for i in (5000, 5001, 5002))
    assert len(by_id[5003].text.split()) == 210_000
    assert "a+b" in by_id[5005].text
    assert extraction.extracted(pages.limit(0)).collect() == []
