"""Revisits, extraction, neighbours and the pipeline's stages on small and odd tables."""

import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from revisit.llm import dom, extraction, neighbours, warc


def test_revisits_against_sql(spark):
    urls = ["http://www.A.org/x/?b=2&a=1#t", "https://a.org:443/x?a=1&b=2", "a.org/x?a=1&b=2", "http://b.org", "HTTP://B.org/", None, ""]
    rows = [(i, urls[i % len(urls)], None if i % 5 == 0 else f"<p>{i % 4}") for i in range(60)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    con = duckdb.connect()
    con.register("pages", pages.toArrow())
    expected = con.execute(warc.SQL).fetchall()
    names = [d[0] for d in con.description]
    assert sorted(map(str, (tuple(r[n] for n in names) for r in warc.page_revisits(pages).collect()))) == sorted(map(str, expected))
    assert warc.page_revisits(pages.limit(0)).collect() == []


def test_neighbours_against_brute_force(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(150, 6)).astype("float32")
    x[10:20] = x[9]
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)] + [(900, None), (920, [0.0] * 6), (940, [1.0, None] * 3), (960, [math.nan] * 6), (980, [1.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = neighbours.nearest(frame, F.col("vec_id") % 20 == 0, k=5, share=1.0, centroids=4).collect()
    wide = x.astype(float)
    for q in range(0, 150, 20):
        scores = wide @ wide[q]
        best = sorted((i for i in range(150) if i != q), key=lambda i: (-round(scores[i], 9), i))[:5]
        own = sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])
        assert [r.vec_id for r in own] == best and np.allclose([r.score for r in own], scores[best])
    assert {r.query_id for r in got} == set(range(0, 150, 20))
    assert neighbours.nearest(frame.limit(0), F.col("vec_id") % 20 == 0).collect() == []


def test_pages_are_read_as_blocks():
    page = dom.Page('<p>a<b>b</b>c <a href="x">l&amp;k</a><br>d<div class="adBox" hidden>t<ul><li>1<li>2</ul></div>tail < 3<script>if(a<b)</p></script>z')
    assert [t for _, t in page.runs] == ["abc l&k d", "t", "1", "2", "tail < 3z"]


def test_decoding_has_no_contradictions():
    page = dom.Page("<div><p>a</p><div><p>b</p></div></div><p>c</p>")
    rng = np.random.default_rng(3)
    for _ in range(200):
        keep = extraction.decoded(page, rng.normal(size=len(page.tag)) * 4)
        state = {0: "outside"}
        for i in range(1, len(page.tag)):
            above = state[page.parent[i]]
            state[i] = "article" if keep[i] else "excluded" if above != "outside" else "outside"
            assert not (keep[i] and above == "excluded")


@pytest.mark.parametrize("stage", [name for name, _ in corpus_pipeline.STAGES])
def test_stages_on_nothing_and_odd_rows(spark, odd, nothing, labelled, tmp_path, stage):
    labelled.write.parquet(f"{tmp_path}/labels.parquet")
    run = dict(corpus_pipeline.STAGES)[stage]
    assert run(spark, nothing, str(tmp_path)).collect() == []
    out = run(spark, odd, str(tmp_path))
    if stage != "packing":
        assert out.columns == odd.columns
    ids = [r.doc_id for r in out.select("doc_id").collect()]
    if stage == "toxicity":
        assert {200 + i for i in range(30)} <= set(ids) and not {100 + i for i in range(20)} & set(ids)
    if stage == "near_duplicates":
        assert 1 in ids and 2 not in ids and ids.count(11) == 2 and 7 not in ids
