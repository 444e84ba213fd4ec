"""What the operators share: input columns, written intermediates, keys that SQL and Spark agree on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revisit.session import fresh_folder, write_table

WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame) -> DataFrame:
    """The frame as a written table in the shared folder, so that lost executors cost a reread only."""
    return write_table(df, fresh_folder(df.sparkSession))


def remainder(key: Column, modulus: int) -> Column:
    """crc32 of the key as text, modulo; a null key counts as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % modulus


def unused(df: DataFrame, name: str) -> str:
    """The name, with underscores added until no column of the frame has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
