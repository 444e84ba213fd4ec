"""The built tables of one data folder, made once per Spark application and folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.encounters import lookup_lines, raw_sql
from revisit.plans import refresh
from revisit.session import fresh_folder, wide_rows

_BUILT: dict[tuple[str, str], Built] = {}
_RAW: dict[tuple[str, str], tuple[str, str]] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def write_lines(spark: SparkSession, lines: list[str], path: str) -> None:
    """A small text file with its lines in order."""
    numbered = F.posexplode(F.array(*[F.lit(line) for line in lines])).alias("n", "value")
    spark.range(1).select(numbered).repartition(1).sortWithinPartitions("n").select("value").write.text(path)


def write_csv(df: DataFrame, path: str) -> None:
    """Compressed files, small enough for as many tasks to read them."""
    options = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    options |= {"compression": "gzip", "maxRecordsPerFile": 50_000}
    with wide_rows(df.sparkSession):
        df.write.options(**options).csv(path)


def raw_encounters(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    orders.createOrReplaceTempView("orders")
    return spark.sql(raw_sql())


def raw_files(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Paths of the raw CSV files derived from the folder's tables."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _RAW:
        root = fresh_folder(spark)
        write_csv(raw_encounters(spark, sf_dir), f"{root}/encounters")
        write_lines(spark, lookup_lines(), f"{root}/lookups")
        _RAW[key] = (f"{root}/encounters", f"{root}/lookups")
    return _RAW[key]


class Built(dict[str, DataFrame]):
    """Tables of one folder; asking for one runs the refresh up to the stage that makes it."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        super().__init__()
        self.spark, self.sf_dir, self.root = spark, sf_dir, fresh_folder(spark)

    def __missing__(self, name: str) -> DataFrame:
        if "stg_encounters" not in self:
            self.update(refresh.stage(self.spark, *raw_files(self.spark, self.sf_dir), self.root))
        for last, step in (("cln_encounters", refresh.clean), ("fact_encounter", refresh.model)):
            if name not in self and last not in self:
                step(self, self.root)
        if name not in self:
            raise KeyError(name)
        return self[name]


def built(spark: SparkSession, sf_dir: str) -> Built:
    """Staged, cleaned and modelled tables, made once per application and folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _BUILT:
        _BUILT[key] = Built(spark, sf_dir)
    return _BUILT[key]
