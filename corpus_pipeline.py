"""A training corpus from `documents`: five stages, each an operator of revisit.llm with its decisions carried out.

Every stage takes (spark, docs, sf_dir) and returns a frame that is written and reread as the next one's
docs. All but the last return the columns of documents. Empty tables pass through.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from revisit.llm import jaccard, mixing, packing, quality, toxicity
from revisit.llm.common import WORD, stored, table, unused
from revisit.operators.keys import sequence


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier gives less than 0.5; null and empty texts stay."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    score = unused(docs, "toxic_score")
    return toxicity.scored(docs, model, score_col=score).where(F.col(score) < 0.5).select(docs.columns)


def like_target(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling takes. Columns of its own names are put aside meanwhile."""
    aside = {c: unused(docs, f"own_{c}") for c in docs.columns if c.lower() in ("log_weight", "sample_key")}
    taken = quality.resampled(docs.withColumnsRenamed(aside), table(spark, sf_dir, "labels"))
    return taken.select([F.col(aside.get(c, c)).alias(c) for c in docs.columns])


def with_row_key(docs: DataFrame, name: str) -> DataFrame:
    """Adds a key of every row: its file and place there, or, for rows that come from no files, a number that is written with them."""
    try:
        return docs.select("*", F.concat_ws(":", F.col("_metadata.file_path"), F.col("_metadata.row_index").cast("string")).alias(name))
    except AnalysisException:
        return stored(docs.withColumn(name, F.monotonically_increasing_id()))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that with the smallest id, those without an id last.

    Rows are told apart by a key of their own, so ids may be missing or repeat. Of equal ids in a group the
    smallest hash of the text decides. Documents without words stay; of repeated ones with an id, one.
    """
    row = unused(docs, "near_row")
    keyed = with_row_key(docs, row)
    found = jaccard.near_duplicates(keyed, id_col=row).withColumnRenamed(row, "row")
    named = keyed.select(F.col(row).alias("row"), "doc_id", F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("text_key")).join(found, "row")
    alone = (F.col("n_shingles") == 0) & F.col("doc_id").isNotNull()
    group = [F.when(~alone, F.col("component_id")).alias("g"), F.when(alone, F.col("doc_id")).alias("g_id"), F.when(alone, F.col("text_key")).alias("g_text")]
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_key", "row"))
    keep = named.groupBy(*group).agg(first.alias("first")).select(F.col("first.row").alias(row))
    return keyed.join(keep, row, "left_semi").select(docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; a last part holds the first words of the text.

    A cut text has single spaces between its words. Documents the mix takes nothing of go, those without
    words stay as they are. Documents are told apart by id, source and text, so rows that repeat an id get
    shares of their own; rows equal in all three are alike to the mix and take what it gives them in any order.
    """
    key, row, part = (unused(docs, name) for name in ("mix_key", "mix_row", "mix_part"))
    values = [F.coalesce(F.concat(F.length(c), F.lit(":"), c), F.lit("-")) for c in (F.col(n).cast("string") for n in ("doc_id", "source", "text"))]
    keyed = stored(docs.withColumn(key, F.md5(F.concat(*values).cast("binary"))).withColumn(row, F.monotonically_increasing_id()))
    named = keyed.select(F.col(key).alias("key"), F.col(row).alias("row"), "text", "source")
    counts = mixing.mix(named, id_col="key").groupBy("key", "size", "taken").agg(F.count(F.lit(1)).alias("copies"))
    through = F.sum("copies").over(W.partitionBy("key").orderBy(F.desc("taken")))
    shares = counts.select(F.col("key").alias("of"), "size", "taken", (through - F.col("copies")).alias("after"), through.alias("through"))
    placed = sequence(named.select("key", "row"), "key", "row", "nth")
    placed = placed.join(shares, (F.col("key") == F.col("of")) & (F.col("nth") > F.col("after")) & (F.col("nth") <= F.col("through")))
    times = F.expr("CASE WHEN size = 0 THEN 1 ELSE taken div size END").cast("int")
    rest = F.expr("CASE WHEN size = 0 THEN 0 ELSE taken % size END").cast("int")
    parts = F.concat(F.array_repeat(F.lit(0), times), F.when(rest > 0, F.array(rest)).otherwise(F.array().cast("array<int>")))
    rows = keyed.join(placed.select(F.col("row").alias(row), parts.alias(part)), row).withColumn(part, F.explode(part))
    cut = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), 1, F.col(part)), " ")
    rows = rows.withColumn("text", F.when(F.col(part) > 0, cut).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.when(F.col(part) > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return rows.select(docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", without_toxic),
    ("quality", like_target),
    ("near_duplicates", one_of_each),
    ("mixing", mixed),
    ("packing", packed),
]

#: Classifiers, sampling and tokenizers are beyond SQL; tests compare the operators, and the stage of near duplicates, with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each one's result is a written table."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
