import random

import pytest
from pyspark.sql import Row

TYPES = "doc_id long, text string, lang string, source string, n_chars long"


def words_of(seed: int, n: int, kinds: int = 400) -> str:
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(kinds)}" for _ in range(n))


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls, empty and long texts, repeated rows, near copies and columns with other operators' names."""
    base = words_of(1, 60)
    rows = [
        (1, base, "en", "a", 1), (2, base + " more", "en", "a", 1), (2, base + " more", "en", "a", 1), (3, None, None, None, None), (4, "", "en", "b", 0),
        (5, " \t\n ", "en", "b", 0), (None, words_of(2, 30), "en", None, 1), (6, "one two", "de", "c", 1), (7, "ONE\ttwo", "de", "c", 1), (8, words_of(3, 30_000, 10**9), "en", "a", 1),
        (9, "x" * 5000, "en", "a", 1), (10, "é  à b  ", "fr", "é", 1), (11, words_of(4, 80), "en", "a", 1), (11, words_of(5, 80), "en", "a", 1),
        *[(100 + i, words_of(50 + i, 40) + " bad idiot idiot", "en", "a", 1) for i in range(20)], *[(200 + i, words_of(90 + i, 40), "en", "b", 1) for i in range(30)],
    ]
    names = TYPES.split(", ")
    clash = "log_weight double, score string, fingerprint int, size long, key int, toxic_score int, n int"
    return spark.createDataFrame([r + (0.5, "s", 3, 9, 1, 1, 1) for r in rows], ", ".join(names) + ", " + clash)


@pytest.fixture(scope="session")
def nothing(spark, odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def labelled(spark):
    good = [Row(doc_id=200 + i, quality=1, toxic=0) for i in range(30)]
    bad = [Row(doc_id=100 + i, quality=0, toxic=1) for i in range(20)]
    return spark.createDataFrame(good + bad + [Row(doc_id=None, quality=1, toxic=1), Row(doc_id=1, quality=None, toxic=None), Row(doc_id=200, quality=1, toxic=0)], "doc_id long, quality int, toxic int")
