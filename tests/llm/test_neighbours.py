"""Neighbours at the registered parameters against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from revisit.llm import neighbours


def found(spark, x, every):
    frame = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "vec_id long, embedding array<double>")
    got = {}
    for r in neighbours.nearest(frame, F.col("vec_id") % every == 0).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    return got


@pytest.mark.parametrize("n", [5, 21, 25, 31])
def test_few_vectors_give_twenty_rows_or_all(spark, n):
    got = found(spark, np.random.default_rng(2).normal(size=(n, 8)), 1)
    assert sorted(got) == list(range(n)) and {len(v) for v in got.values()} == {min(20, n - 1)}


@pytest.mark.parametrize("copies", [0, 500])
def test_recall_at_the_registered_share(spark, copies):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(1000, 16))
    x = np.concatenate([x, np.repeat(x[:1] / 4, copies, axis=0)])  # short, so that others come before the copies
    got = found(spark, x, 10)
    hits = []
    for q in range(0, 1000, 10):
        score = np.round(x @ x[q], 9)
        best = [i for i in np.lexsort((np.arange(len(x)), -score)) if i != q][:20]
        assert len(got[q]) == 20
        hits.append(len(got[q] & set(best)) / 20)
    assert np.mean(hits) > 0.95
