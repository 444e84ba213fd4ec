"""Revisits of captures whose ids repeat."""

from datetime import datetime

from revisit.llm import warc

TYPES = "record_id string, url string, captured_at timestamp, kind string, digest string, body string, headers map<string,string>"


def test_a_body_comes_from_the_response_itself(spark):
    at = lambda h: datetime(2024, 1, 1, h)
    rows = [
        ("r1", "http://a.org/a", at(1), "response", "d1", "aa", {"etag": '"1"', "x": "a"}),
        ("r1", "http://a.org/b", at(1), "response", "d2", "zz", {"etag": '"2"', "x": "b"}),
        ("r1", "http://a.org/b", at(3), "response", "d3", "new", {"etag": '"3"'}),
        ("v1", "http://a.org/b", at(2), "revisit", None, None, {"etag": '"2"'}),
        ("v2", "http://a.org/b", at(4), "revisit", None, None, {"etag": '"3"'}),
        ("v3", "http://a.org/a", at(4), "revisit", None, None, {"etag": '"1"', "date": "today"}),
        ("v4", "http://a.org/a", None, "revisit", None, None, {"etag": '"1"'}),
        ("v5", None, at(4), "revisit", None, None, {"etag": '"1"'}),
    ]
    rows += [("r2", "http://a.org/c", at(1), "response", None, body, None) for body in ("b", "a")] + [("v6", "http://a.org/c", at(2), "revisit", None, None, None)]
    got = {r.record_id: (r.status, r.body) for r in warc.resolved(spark.createDataFrame(rows, TYPES)).collect()}
    assert got == {
        "v1": ("resolved", "zz"), "v2": ("resolved", "new"), "v3": ("resolved", "aa"), "v4": ("no_earlier_response", None),
        "v5": ("no_earlier_response", None), "v6": ("validator_mismatch", None),
    }
