from pyspark.sql import functions as F

from revisit.operators import reconcile as X

SCHEMA = "id int, n int, score double, label string"
LEFT = [(1, 5, 1.0, "a"), (2, 5, 100.0, None), (3, 5, 1.0, "c"), (4, None, None, "d"), (6, 1, 2.0, "f")]
RIGHT = [(1, 5, 1.0 + 1e-7, "a"), (2, 5, 100.001, "b"), (4, None, None, "d"), (5, 1, 1.0, "e"), (6, None, 2.0, "f")]


def differences(spark, left, right):
    found = X.cell_differences(spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA), ["id"])
    return {(r.id, r.column_name, r.problem) for r in found.collect()}


def test_tolerance_nulls_missing_and_extra_rows(spark):
    assert differences(spark, LEFT, RIGHT) == {
        (2, "score", "value"), (2, "label", "value"), (3, None, "missing_right"), (5, None, "missing_left"), (6, "n", "value"),
    }


def test_equal_tables_have_no_differences(spark):
    assert differences(spark, LEFT, LEFT) == set()


def test_copies_of_a_key_are_reported_and_never_paired(spark):
    hot = [(1, 5, 1.0, "a")] * 20_000
    found = X.cell_differences(spark.createDataFrame(hot, SCHEMA), spark.createDataFrame(hot, SCHEMA), ["id"]).collect()
    assert [(r.problem, r.left_value, r.right_value) for r in found] == [("repeated_key", "20000", "20000")]
    plan = X.compare_rows(spark.createDataFrame(hot, SCHEMA), spark.createDataFrame(hot, SCHEMA), ["id"])
    assert "Join" not in plan._jdf.queryExecution().executedPlan().toString()


def test_counts_and_summary(spark):
    left, right = spark.createDataFrame(LEFT, SCHEMA), spark.createDataFrame(RIGHT, SCHEMA)
    counts = X.reconcile_counts({"t": left, "u": left}, {"t": right, "u": right.limit(2)})
    assert sorted(map(tuple, counts.collect())) == [("t", 5, 5, True), ("u", 5, 2, False)]
    assert X.all_counts_match(counts).first()[0] is False
    summary = X.reconcile_cells({"t": left}, {"t": right}, {"t": ["id"]}).first()
    assert tuple(summary) == ("t", 5, 5, 3, 1, 1, 0)


def test_one_row_tables_need_no_key(spark):
    left, right = spark.createDataFrame([(1, 2)], "a int, b int"), spark.createDataFrame([(1, 3)], "a int, b int")
    assert [(r.column_name, r.left_value, r.right_value) for r in X.cell_differences(left, right, []).collect()] == [("b", "2", "3")]


def test_first_differences(spark):
    left, right = spark.createDataFrame(LEFT, SCHEMA), spark.createDataFrame(RIGHT, SCHEMA)
    first = X.first_differences(X.cell_differences(left, right, ["id"]), ["id"], 2).collect()
    assert [(r.id, r.column_name) for r in first] == [(2, "label"), (2, "score")]


def test_columns_of_one_side_and_other_types(spark):
    left = spark.createDataFrame([(1, 5, 1.0, "a"), (2, 6, 2.5, None)], SCHEMA).withColumn("only_left", F.lit(1))
    text = spark.createDataFrame([("1", "5.0", "1", "a"), ("2", "6", "2.50", None)], "id string, n string, score string, label string")
    found = {(r.id, r.column_name, r.problem) for r in X.cell_differences(left, text.withColumn("only_right", F.lit("x")), ["id"]).collect()}
    assert found == {(None, "only_left", "column_missing_right"), (None, "only_right", "column_missing_left")}
    assert X.cell_differences(left.drop("only_left"), text, ["id"]).count() == 0
