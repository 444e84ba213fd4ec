"""Raw files to all-text staging tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from revisit.plans import vocabulary as V
from revisit.sources.readers import read_stacked_csv, read_text_csv, rename_to_end


def staged_encounters(spark: SparkSession, path: str) -> DataFrame:
    """The encounter file as text, hyphenated drug columns renamed and moved to the end."""
    return rename_to_end(read_text_csv(spark, path, V.RAW_COLUMNS), V.HYPHENATED)


def staged_lookups(spark: SparkSession, path: str) -> DataFrame:
    """The stacked id lookups as two text columns."""
    return read_stacked_csv(spark, path, V.LOOKUP_COLUMNS)
