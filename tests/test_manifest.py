"""Exports are checked from their files: order across files and blocks, and content by column."""

import datetime
import decimal
import hashlib
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revisit.sources.writers import checksum, export_csv, export_manifest, export_summary

SCHEMA = T.StructType([T.StructField("n", T.IntegerType()), T.StructField("word", T.StringType())])


@pytest.fixture
def small_blocks(spark):
    before = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    for name in before:
        spark.conf.set(name, "512")
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def summary(spark, path):
    return {r.column_name: r for r in export_summary(export_manifest(spark, str(path), SCHEMA)).collect()}


def by_hand(name, values):
    return sum(int(hashlib.md5(f"{name}:{v}".encode()).hexdigest()[:8], 16) for v in values if v is not None)


def test_a_sorted_export_over_files_and_blocks(spark, tmp_path, small_blocks):
    rows = [(i * 37 % 1000 if i % 50 else None, None if i % 7 == 0 else f"w{i % 90}, \"q\"") for i in range(1000)]
    export_csv(spark.createDataFrame(rows, SCHEMA), str(tmp_path / "e"))
    assert export_manifest(spark, str(tmp_path / "e"), SCHEMA).count() > 8
    found = summary(spark, tmp_path / "e")
    for i, name in enumerate(SCHEMA.fieldNames()):
        values = [row[i] for row in rows]
        got = found[name]
        assert (got.rows, got.filled_cells, got.checksum) == (1000, sum(v is not None for v in values), by_hand(name, values))
        assert got.in_order
    whole = spark.createDataFrame(rows, SCHEMA).repartition(5).agg(checksum(["n", "word"]).alias("c")).first().c
    assert whole == sum(r.checksum for r in found.values())


@pytest.mark.parametrize(
    ("files", "in_order"),
    [
        ({"part-0": "1,a\n2,b\n", "part-1": "2,b\n3,a\n"}, True),
        ({"part-0": "1,a\n2,b\n", "part-1": "2,a\n3,a\n"}, False),  # across files
        ({"part-0": "1,a\n3,b\n2,b\n", "part-1": "4,a\n"}, False),  # inside
        ({"part-0": "9,a\n10,a\n,a\n", "part-1": ",b\n,\n"}, True),  # by number, NULL last
        ({"part-0": ",a\n", "part-1": "1,a\n"}, False),
    ],
)
def test_planted_order(spark, tmp_path, files, in_order):
    for name, text in files.items():
        (tmp_path / f"{name}.csv").write_text("n,word\n" + text)
    assert {r.in_order for r in summary(spark, tmp_path).values()} == {in_order}


def test_changed_cells_and_empty_exports(spark, tmp_path):
    one, other = tmp_path / "one", tmp_path / "other"
    export_csv(spark.createDataFrame([(1, "a"), (2, "b")], SCHEMA), str(one))
    export_csv(spark.createDataFrame([(1, "b"), (2, "b")], SCHEMA), str(other))
    left, right = summary(spark, one), summary(spark, other)
    assert left["n"] == right["n"] and left["word"].checksum != right["word"].checksum
    export_csv(spark.createDataFrame([], SCHEMA), str(tmp_path / "none"))
    assert summary(spark, tmp_path / "none") == {}


def test_a_manifest_shuffles_no_rows(spark, tmp_path, small_blocks):
    export_csv(spark.range(1000).select(F.col("id").cast("int").alias("n"), F.format_string("w%d", "id").alias("word")), str(tmp_path / "e"))
    manifest = export_manifest(spark, str(tmp_path / "e"), SCHEMA)
    plan = manifest._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan
    found = manifest.orderBy("file", "start").collect()
    assert [r.first.col1.value for r in found][0] == 0 and [r.last.col2.value for r in found][-1] == "w999"


def test_order_of_every_type(spark, tmp_path):
    """Blocks come one after another in a task here; NaN is above all numbers and below NULL."""
    day, nan = datetime.date(2020, 1, 1), float("nan")
    schema = "b boolean, d date, x double, y decimal(9,2), n bigint, at timestamp"
    rows = [
        (b, day + datetime.timedelta(d), x, decimal.Decimal(y) if y else None, n, datetime.datetime(2020, 1, 1, 10))
        for b in (False, True, None) for d in (0, 9) for x in (-1.5, 10.0, nan, None) for y in ("2.50", "10.00", None) for n in (9, 10)
    ]
    df = spark.createDataFrame(rows, schema)
    for name, frame in (("up", df.repartition(3)), ("down", None)):
        path = str(tmp_path / name)
        if frame is None:
            df.coalesce(1).selectExpr("*", "monotonically_increasing_id() AS i").sort(F.desc("i")).drop("i").coalesce(1).write.option("header", True).csv(path)
        else:
            export_csv(frame, path)
        blocks = export_manifest(spark, path, df.schema).collect()
        got = export_summary(export_manifest(spark, path, df.schema)).collect()
        assert {r.in_order for r in got} == {name == "up"} and {r.rows for r in got} == {len(rows)}
        assert sum(r.disorder for r in blocks) == (0 if name == "up" else len(rows) - 1)


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {n for i in range(files.size()) if (n := files.apply(i).getName()).startswith("shuffle_")}


def test_an_export_leaves_no_shuffle_files(spark, tmp_path):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, setting = shuffle_files(spark), spark.conf.get(name)
    export_csv(spark.range(10_000).selectExpr("id * 7919 % 10007 AS id"), str(tmp_path / "e"))
    until = time.monotonic() + 20
    while shuffle_files(spark) - before and time.monotonic() < until:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    assert spark.conf.get(name) == setting


@pytest.mark.parametrize("known", [True, False])
def test_checksum_hashes_values_and_not_cells(spark, known):
    """No digest per cell in the plan; the sums are those of the cells' texts as Spark writes them."""
    schema = "a int, `b.c` bigint, s string, x double, y decimal(9,2), d date, t boolean"
    day = datetime.date(2020, 1, 2)
    rows = [(-3, 2**40, "\u00e4:", 1e-7, decimal.Decimal("2.50"), day, True), (None, -7, "", 2.0, None, None, False), (-3, 2**40, None, None, decimal.Decimal("2.50"), day, True)] * 50
    df = spark.createDataFrame(rows, schema).repartition(3)
    total = df.agg(checksum(df.columns, df.schema if known else None).alias("c"))
    plan = total._jdf.queryExecution().executedPlan().toString()
    assert "md5(" not in plan and "conv(" not in plan
    texts = df.select(*[F.col(f"`{c}`").cast("string") for c in df.columns]).collect()
    assert total.first().c == sum(by_hand(c, [row[i] for row in texts]) for i, c in enumerate(df.columns))
    nothing = df.where("a > 0").agg(checksum(df.columns, df.schema if known else None).alias("c"), checksum([]).alias("none")).first()
    assert (nothing.c, nothing.none) == (0, 0)
