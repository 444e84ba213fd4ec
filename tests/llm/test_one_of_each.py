"""The pipeline's stage of near duplicates where ids are missing or repeat."""

from collections import Counter

import corpus_pipeline


def test_one_row_of_each_group_whatever_the_ids(spark):
    text = lambda name, n=60: " ".join(f"{name}{i}" for i in range(n))
    a, b, c, d = (text(x) for x in "abcd")
    rows = [
        (None, a), (None, a), (None, a + " more"),  # a group without ids
        (5, b), (5, b + " more"), (None, b),  # one id twice in a group
        (7, c), (3, c + " more"), (7, d),  # an id in two groups
        (8, ""), (8, ""), (None, ""), (None, None),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter((r.doc_id, (r.text or " ")[0]) for r in corpus_pipeline.one_of_each(spark, docs, "").collect())
    assert got == Counter({(None, "a"): 1, (5, "b"): 1, (3, "c"): 1, (7, "d"): 1, (8, " "): 1, (None, " "): 2})
