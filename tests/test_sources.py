import os

import pytest

from checks.build import write_lines
from revisit.plans import vocabulary as V
from revisit.plans.staging import staged_encounters, staged_lookups
from revisit.session import shared_folder
from revisit.sources import readers, writers


def put(path, text):
    path.write_text(text)
    return str(path)


def test_everything_is_text_and_empty_is_null(spark, tmp_path):
    path = put(tmp_path / "a.csv", 'id,x,y\n1,,"a, ""b"""\n02, 3 ,NULL\n')
    df = readers.read_text_csv(spark, path, ["id", "x", "y"])
    assert [tuple(r) for r in df.collect()] == [("1", None, 'a, "b"'), ("02", " 3 ", "NULL")]


def test_header_must_match(spark, tmp_path):
    path = put(tmp_path / "a.csv", "id,z\n1,2\n")
    with pytest.raises(Exception, match="header does not conform"):
        readers.read_text_csv(spark, path, ["id", "x"]).collect()


def test_quoted_newlines_on_request(spark, tmp_path):
    path = put(tmp_path / "a.csv", 'id,x\n1,"a\nb"\n')
    assert [tuple(r) for r in readers.read_text_csv(spark, path, ["id", "x"], quoted_newlines=True).collect()] == [("1", "a\nb")]


def test_stacked_sections(spark, tmp_path):
    text = 'admission_type_id,description\n1,Emergency\n6,NULL\n,\ndischarge_disposition_id,description\n1, Home\n2,"a, b"\n3\n'
    df = staged_lookups(spark, put(tmp_path / "ids.csv", text))
    assert [tuple(r) for r in df.collect()] == [
        ("1", "Emergency"), ("6", "NULL"), (None, None), ("discharge_disposition_id", "description"), ("1", " Home"),
        ("2", "a, b"), ("3", None),
    ]


def test_staging_renames_and_moves_to_the_end(spark, tmp_path):
    values = ",".join(f"v{i}" for i in range(len(V.RAW_COLUMNS)))
    df = staged_encounters(spark, put(tmp_path / "e.csv", ",".join(V.RAW_COLUMNS) + "\n" + values + "\n"))
    assert df.columns[-5:] == list(V.HYPHENATED.values()) and df.columns[-6] == "readmitted" and len(df.columns) == 50
    assert df.first().glyburide_metformin == f"v{V.RAW_COLUMNS.index('glyburide-metformin')}"


def test_ordered_export_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(2, " b "), (1, None), (None, "z"), (2, "a")], "id int, x string")
    writers.export_csv(df, str(tmp_path / "out"), single_file=True)
    part = next(f for f in os.listdir(tmp_path / "out") if f.endswith(".csv"))
    assert (tmp_path / "out" / part).read_text() == "id,x\n1,\n2, b \n2,a\n,z\n"


def test_distributed_export_keeps_order_over_files(spark, tmp_path):
    writers.export_csv(spark.range(1000).repartition(7).toDF("id"), str(tmp_path / "out"))
    parts = sorted(f for f in os.listdir(tmp_path / "out") if f.endswith(".csv"))
    ids = [int(line) for f in parts for line in (tmp_path / "out" / f).read_text().splitlines() if line != "id"]
    assert ids == list(range(1000))


def test_replace_is_repeatable(spark, tmp_path):
    for _ in range(2):
        tables = writers.replace_tables(spark, {"t_one": lambda: spark.range(5).toDF("id")}, str(tmp_path))
    assert tables["t_one"].count() == 5 and spark.table("t_one").count() == 5


def test_find_tables():
    assert writers.find_tables(["a_x", "dq_y", "ab", "dim_z"], "a_*", "dq_*") == ["a_x", "dq_y"]


def test_namespace(spark, tmp_path):
    writers.replace_tables(spark, {"a_one": lambda: spark.range(5).toDF("id")}, str(tmp_path))
    try:
        for _ in range(2):
            writers.publish_tables(spark, ["a_one"], str(tmp_path), "readmissions_test")
        assert spark.catalog.currentDatabase() == "readmissions_test"
        names = [t.name for t in spark.catalog.listTables("readmissions_test") if not t.isTemporary]
        assert writers.find_tables(names, "a_*") == ["a_one"]
        assert spark.table("readmissions_test.a_one").count() == 5
    finally:
        spark.catalog.setCurrentDatabase("default")
        spark.sql("DROP DATABASE IF EXISTS readmissions_test CASCADE")


def test_modulus_sample(spark):
    df = spark.createDataFrame([("698", " x"), ("7", "?"), ("8", "y")], "id string, v string")
    assert [tuple(r) for r in readers.modulus_sample(df, "id", 691, 7).collect()] == [("7", "?"), ("698", " x")]


def test_lines_keep_their_order(spark, tmp_path):
    write_lines(spark, [str(i) for i in range(50)], str(tmp_path / "t"))
    assert [r.value for r in spark.read.text(str(tmp_path / "t")).collect()] == [str(i) for i in range(50)]


def test_shared_folder_follows_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        assert shared_folder(spark).startswith(root)
