"""The registered queries of this subpackage: each operator over its whole table, and SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revisit.llm import extraction, fingerprints, jaccard, merkle, mining, mixing, neighbours, packing, quality, scoring, simhash, toxicity, warc
from revisit.llm.common import table

PIECES = "piece_bpe_32k.model"
BYTE_TOKENS = "byte_bpe_50k.json"


def op1_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.documents_scored(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECES))


def op2_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.page_revisits(table(spark, sf_dir, "pages"))


def op3_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(table(spark, sf_dir, "documents"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.resampled(docs, table(spark, sf_dir, "labels"), carry=["doc_id"])


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extraction.extracted(pages).select("page_id", "url", "text", "n_chars")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_TOKENS))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op10_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mining.mined(table(spark, sf_dir, "embeddings"))


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.proved(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_scoring, op2_revisits, op3_jaccard, op4_fingerprints, op5_quality, op6_toxicity, op7_extraction, op8_packing, op9_mixing, op10_neighbours,
        op11_simhash, op12_negatives, op13_manifest,
    )
}
ORACLE_SQL: dict[str, str] = {
    "op2_revisits": warc.SQL, "op3_jaccard": jaccard.SQL, "op9_mixing": mixing.SQL, "op12_negatives": mining.SQL, "op13_manifest": merkle.SQL,
}
