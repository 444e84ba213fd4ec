"""The pipeline's stages: columns of their own names stay, and mixing against plain Python."""

from collections import Counter

import pytest

import corpus_pipeline
from conftest import words_of
from revisit.llm import mixing


@pytest.mark.parametrize("stage", ["toxicity", "quality", "near_duplicates", "mixing"])
def test_input_columns_keep_their_values(spark, labelled, tmp_path, stage):
    labelled.write.parquet(f"{tmp_path}/labels.parquet")
    rows = [(200 + i, words_of(90 + i, 40), "en", "a", 1, f"keep{i}", 7.5 + i, i, i * 3, f"k{i}", i, "p") for i in range(30)]
    names = "toxic_score string, log_weight double, sample_key long, near_row long, mix_key string, mix_row int, mix_part string"
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, " + names)
    out = dict(corpus_pipeline.STAGES)[stage](spark, docs, str(tmp_path))
    assert out.columns == docs.columns
    known = {r[0]: r[5:] for r in rows}
    got = out.collect()
    assert got and all(tuple(r)[5:] == known[r.doc_id] for r in got)


def test_mixing_makes_of_every_document_what_the_mix_takes(spark):
    rows = [(i % 40 if i % 7 else None, words_of(i, 3 + i % 9), "en", "abc"[i % 3] if i % 11 else None, 1) for i in range(150)]
    rows += [(5, words_of(1, 6), "en", "a", 1), (5, words_of(2, 6), "en", "b", 1), (5, words_of(2, 6), "en", "b", 1)] + [(6, None, "en", "a", 1), (7, "", "en", None, 1)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.mixed(spark, docs, "").collect()
    sizes, taken = Counter(), Counter()
    for _, text, _, source, _ in rows:
        sizes[source] += len((text or "").split())
    known = {(r[0], r[3]): [] for r in rows}
    for r in rows:
        known[r[0], r[3]].append(r[1])
    for r in got:
        of = known[r.doc_id, r.source]
        assert r.text in of or any(t and t.split()[: len(r.text.split())] == r.text.split() for t in of)
        taken[r.source] += len((r.text or "").split())
    targets = {r.source: r.target for r in mixing.mix(docs.withColumn("doc_id", docs.source)).selectExpr("doc_id AS source", "target").distinct().collect()}
    assert set(targets) == set(sizes) and all(abs(taken[s] - t) <= 64 for s, t in targets.items())
    # one share per row: no text is taken more than twice as often as it occurs
    often, whole = Counter((r[0], r[3], r[1]) for r in rows), Counter((r.doc_id, r.source, r.text) for r in got)
    assert all(whole[k] <= 2 * often[k] + 1 for k in often)
    assert Counter(map(tuple, got)) == Counter(map(tuple, corpus_pipeline.mixed(spark, docs.repartition(7), "").collect()))
    assert sum(r.text in (None, "") for r in got) == 4
