"""Replacing tables: a failed build changes nothing, and nothing is left behind."""

import os

import pytest
from pyspark.sql import functions as F

from revisit.session import remove, scratch_folder, shared_folder, wide_rows
from revisit.sources import writers


def below(root):
    return sorted(n for n in os.listdir(root) if not n.startswith("."))


def test_a_failed_build_leaves_the_old_tables(spark, tmp_path):
    root = str(tmp_path / "t")
    writers.replace_tables(spark, {"one": lambda: spark.range(3), "two": lambda: spark.range(4)}, root)
    bad = lambda: spark.range(5).select(F.raise_error(F.lit("no")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="no"):
        writers.replace_tables(spark, {"one": lambda: spark.range(9), "two": bad}, root)
    assert below(root) == ["one", "two"]
    assert [spark.read.parquet(f"{root}/{n}").count() for n in ("one", "two")] == [3, 4]
    assert spark.table("one").count() == 3


def test_a_build_may_read_the_table_it_replaces(spark, tmp_path):
    root = str(tmp_path / "t")
    writers.replace_tables(spark, {"grow": lambda: spark.range(3)}, root)
    for n in (6, 12):
        tables = writers.replace_tables(spark, {"grow": lambda: spark.read.parquet(f"{root}/grow").unionByName(spark.read.parquet(f"{root}/grow"))}, root)
        assert tables["grow"].count() == n and below(root) == ["grow"]


def test_an_end_between_the_renames_is_mended(spark, tmp_path):
    root = str(tmp_path / "t")
    writers.replace_tables(spark, {"one": lambda: spark.range(3)}, root)
    os.rename(f"{root}/one", f"{root}/one__before")
    writers.take_back(spark, f"{root}/one")
    assert spark.read.parquet(f"{root}/one").count() == 3 and below(root) == ["one"]
    os.makedirs(f"{root}/one__before")
    assert writers.replace_tables(spark, {"one": lambda: spark.range(7)}, root)["one"].count() == 7 and below(root) == ["one"]


def test_scratch_goes_whatever_happens(spark):
    with scratch_folder(spark) as folder:
        spark.range(3).write.parquet(f"{folder}/x")
    assert not os.path.exists(folder)
    with pytest.raises(ValueError), scratch_folder(spark) as folder:
        spark.range(3).write.parquet(f"{folder}/x")
        raise ValueError
    assert not os.path.exists(folder)
    remove(spark, folder)


class Elsewhere:
    """A session whose master is a cluster of local processes."""

    def __init__(self, spark):
        self.sparkContext = type("Context", (), {"applicationId": "other", "master": "local-cluster[2,1,1024]"})
        self.conf = type("Conf", (), {"get": staticmethod(lambda name, other=None: other)})


def test_clusters_of_processes_need_a_shared_folder(spark):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(Elsewhere(spark))


def test_settings_shared_by_steps_side_by_side_are_put_back(spark):
    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name)
    one, other = wide_rows(spark), wide_rows(spark)
    one.__enter__()
    other.__enter__()
    one.__exit__(None, None, None)
    assert spark.conf.get(name) == "8000"  # the other one is still under way
    other.__exit__(None, None, None)
    assert spark.conf.get(name) == before


def test_tables_are_written_with_compiled_projections(spark, tmp_path):
    name, seen = "spark.sql.codegen.hugeMethodLimit", []
    before = spark.conf.get(name)
    writers.replace_tables(spark, {"one": lambda: seen.append(spark.conf.get(name)) or spark.range(3)}, str(tmp_path / "t"))
    assert seen == ["8000"] and spark.conf.get(name) == before
