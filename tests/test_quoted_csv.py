"""Files whose fields hold line breaks, cut at any place, read as Python's csv module reads them."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from revisit.sources.readers import read_quoted_csv, read_text_csv


@pytest.fixture
def blocks_of(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {c: spark.conf.get(c) for c in names}

    def use(size):
        for name in names:
            spark.conf.set(name, str(size))

    yield use
    for name, value in before.items():
        spark.conf.set(name, value)


def written(rows, end="\n"):
    out = io.StringIO()
    csv.writer(out, lineterminator=end).writerows(rows)
    return out.getvalue()


def rows_of(df):
    return sorted([tuple(r) for r in df.collect()], key=str)


def some_rows(seed, n):
    rng = random.Random(seed)
    pieces = ["a", '"', '""', "\n", "\n\n", ",", "é", "x y", '",\n"', "long " * 9]
    return [(str(i), "".join(rng.choices(pieces, k=rng.randrange(1, 7))) + ".", rng.choice(["", "z", "\n.", '"\n"'])) for i in range(n)]


@pytest.mark.parametrize("size", [37, 64, 101, 500])
def test_any_cut(spark, tmp_path, blocks_of, size):
    rows = some_rows(size, 120)
    for part in (0, 1):
        (tmp_path / f"p{part}.csv").write_text(written([("id", "text", "more"), *rows[part::2]]))
    blocks_of(size)
    df = read_quoted_csv(spark, str(tmp_path), ["id", "text", "more"])
    assert rows_of(df) == sorted([tuple(v if v != "" else None for v in row) for row in rows], key=str)
    tasks = spark.read.text(str(tmp_path)).rdd.getNumPartitions()
    assert tasks >= 8


def test_a_field_over_many_blocks_and_doubled_quotes_at_every_cut(spark, tmp_path, blocks_of):
    rows = [("1", '"' * 40), ("2", ("line\n" * 60) + '"'), ("3", '\n"\n' * 30), ("4", "end")]
    (tmp_path / "p.csv").write_text(written([("id", "text"), *rows]))
    for size in (16, 17, 19):
        blocks_of(size)
        assert rows_of(read_quoted_csv(spark, str(tmp_path), ["id", "text"])) == rows


def test_same_as_one_task_per_file(spark, tmp_path):
    rows = some_rows(3, 80)
    (tmp_path / "p.csv").write_text(written([("id", "text", "more"), *rows]))
    columns = ["id", "text", "more"]
    assert rows_of(read_quoted_csv(spark, str(tmp_path), columns)) == rows_of(read_text_csv(spark, str(tmp_path), columns, quoted_newlines=True))


def test_line_ends_blank_lines_and_a_header_with_a_break(spark, tmp_path):
    text = written([("id", "two\nlines"), ("1", "a\nb"), ("2", "c")], "\r\n") + "\r\n\r\n" + '3,"d"'
    (tmp_path / "p.csv").write_bytes(text.encode())
    assert rows_of(read_quoted_csv(spark, str(tmp_path), ["id", "two\nlines"])) == [("1", "a\nb"), ("2", "c"), ("3", "d")]


def test_wrong_headers_and_open_quotes_raise(spark, tmp_path):
    (tmp_path / "h.csv").write_text("id,other\n1,a\n")
    with pytest.raises(Exception, match="unexpected header"):
        read_quoted_csv(spark, str(tmp_path / "h.csv"), ["id", "text"]).collect()
    (tmp_path / "q.csv").write_text('id,text\n1,"a\n')
    with pytest.raises(Exception, match="never closed"):
        read_quoted_csv(spark, str(tmp_path / "q.csv"), ["id", "text"]).collect()


def test_a_file_without_rows(spark, tmp_path):
    (tmp_path / "p.csv").write_text("id,text\n")
    assert read_quoted_csv(spark, str(tmp_path), ["id", "text"]).agg(F.count("*")).first()[0] == 0
