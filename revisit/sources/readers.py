"""CSV sources. Nothing is inferred: every column is read as text and typed by the cleaning rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T


def text_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in columns])


def read_text_csv(
    spark: SparkSession, path: str, columns: Sequence[str], quoted_newlines: bool = False
) -> DataFrame:
    """A headed CSV with all columns as STRING; an empty field is NULL.

    The header is checked against ``columns``. Files split across tasks unless fields may hold
    line breaks, which needs ``quoted_newlines`` and then one task per file; :func:`read_quoted_csv` splits those too.
    """
    return (
        spark.read.schema(text_schema(columns))
        .option("header", True)
        .option("enforceSchema", False)
        .option("escape", '"')
        .option("multiLine", quoted_newlines)
        .csv(path)
    )


def _records(lines: DataFrame) -> DataFrame:
    """CSV records from lines with ``file``, ``start`` (of the line's block), ``at`` and ``value``; adds ``header`` (first of its file).

    A line break is inside a field where an odd number of quotes precedes it. Quotes are counted within blocks, then over a
    row per block, so that every block knows whether it begins inside a field, and in which block that record began.
    """
    place, block = ["file", "start"], W.partitionBy("file", "start").orderBy("at")
    earlier = W.partitionBy("file").orderBy("start").rowsBetween(W.unboundedPreceding, -1)
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    counted = lines.withColumn("quotes", quotes)
    before = F.coalesce(F.sum("quotes").over(block.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    counted = counted.withColumn("before", before)
    blocks = counted.groupBy(*place).agg(F.sum("quotes").alias("quotes"), F.max(F.col("before") % 2).alias("turns"))
    blocks = blocks.withColumn("inside", F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2)
    blocks = blocks.withColumn("begun", F.last(F.when((F.col("inside") == 0) | (F.col("turns") == 1), F.col("start")), True).over(earlier))
    blocks = blocks.withColumn("odd", F.sum("quotes").over(W.partitionBy("file")) % 2)
    unclosed = F.raise_error(F.concat(F.lit("a quote is never closed in "), F.col("file"))).cast("bigint")
    blocks = blocks.select(*place, F.when(F.col("odd") == 0, F.col("inside")).otherwise(unclosed).alias("inside"), "begun")
    placed = counted.join(blocks, place)
    opens = (F.col("before") + F.col("inside")) % 2 == 0
    closes = (F.col("before") + F.col("quotes") + F.col("inside")) % 2 == 0
    placed = placed.withColumns({"opens": opens, "closes": closes})
    nth = F.sum(F.col("opens").cast("int")).over(block)
    placed = placed.withColumns({"nth": nth, "later": F.sum(F.col("opens").cast("int")).over(W.partitionBy(*place)) - nth})
    header = F.col("opens") & (F.col("start") == 0) & (F.col("nth") == 1)
    whole = placed.where(F.col("opens") & F.col("closes")).select("file", F.col("value").alias("record"), header.alias("header"))
    begun = F.when(F.col("nth") == 0, F.col("begun")).otherwise(F.col("start")).alias("begun")
    last = F.when(F.col("nth") == 0, 0).otherwise(F.col("later")).alias("later")  # a record that goes on is the last of its block
    pieces = placed.where(~(F.col("opens") & F.col("closes"))).select("file", begun, last, F.struct("start", "at", "value").alias("line"), header.alias("header"))
    joined = pieces.groupBy("file", "begun", "later").agg(F.array_sort(F.collect_list("line")).alias("lines"), F.max("header").alias("header"))
    return whole.unionByName(joined.select("file", F.array_join("lines.value", "\n").alias("record"), "header"))


def read_quoted_csv(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """As :func:`read_text_csv`, for files of any size whose fields may hold line breaks; a file splits across tasks.

    Quotes must only enclose fields and be doubled inside, as :func:`writers.export_csv` writes them; a file that ends inside
    a field raises. Lines meet by block of the file, records of several lines by record. Blank lines between records are skipped.
    """
    text = spark.read.option("lineSep", "\n").text(path)
    lines = text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("at"), "value")
    found = _records(lines).withColumn("record", F.regexp_replace("record", "\r$", "")).where("record <> ''")
    schema = ", ".join(f"c{i} STRING" for i in range(len(columns)))
    parsed = found.withColumn("row", F.from_csv("record", F.lit(schema), {"escape": '"', "multiLine": "true"}))
    names: Column = F.struct(*[F.lit(name).alias(f"c{i}") for i, name in enumerate(columns)])
    wrong = F.raise_error(F.concat(F.lit("unexpected header in "), F.col("file"))).cast("boolean")
    data = F.when(~F.col("header"), True).when(F.to_json("row") == F.to_json(names), False).otherwise(wrong)
    return parsed.where(data).select(*[F.col(f"row.c{i}").alias(name) for i, name in enumerate(columns)])


def read_stacked_csv(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """A CSV that stacks several sections: repeated headers stay as rows, short rows are padded with NULL."""
    return (
        spark.read.schema(text_schema(columns))
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("escape", '"')
        .csv(path)
    )


def rename_to_end(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """All other columns as they are, then the listed ones under their new names."""
    kept = [F.col(f"`{name}`") for name in df.columns if name not in names]
    return df.select(*kept, *[F.col(f"`{old}`").alias(new) for old, new in names.items()])


def modulus_sample(df: DataFrame, key: str, modulus: int, remainder: int) -> DataFrame:
    """Repeatable sample: rows whose numeric key leaves the given remainder, values verbatim, by key."""
    number = F.col(key).cast("bigint")
    return df.where(number % modulus == remainder).orderBy(number)
