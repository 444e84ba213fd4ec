"""Sinks: replaceable tables, ordered CSV export, namespaces."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from decimal import Decimal
from fnmatch import fnmatchcase
from hashlib import md5
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.util import inheritable_thread_target

from revisit.session import released_shuffles, remove, wide_rows, write_table
from revisit.sources.readers import read_text_csv


Build = Callable[[], DataFrame]


def write_tables(spark: SparkSession, builds: Mapping[str, Build], at_once: int = 8) -> dict[str, DataFrame]:
    """Plan and write independent tables by path. Their jobs run side by side, so small ones do not queue."""
    write = inheritable_thread_target(spark)(lambda path: write_table(builds[path](), path))
    with wide_rows(spark), released_shuffles(spark), ThreadPoolExecutor(at_once) as pool:
        return dict(zip(builds, pool.map(write, builds)))


def _paths(spark: SparkSession, *names: str):
    """The names as paths, and the file system of the first."""
    paths = [spark._jvm.org.apache.hadoop.fs.Path(name) for name in names]
    return paths[0].getFileSystem(spark._jsc.hadoopConfiguration()), *paths


def put_in_place(spark: SparkSession, staged: str, path: str) -> None:
    """Make a wholly written folder the one at ``path``; what was there goes only once the new one is in its place."""
    files, new, now, before = _paths(spark, staged, path, f"{path}__before")
    take_back(spark, path)
    if files.exists(now) and not files.rename(now, before):
        raise OSError(f"{path} can't be put aside")
    files.mkdirs(now.getParent())
    if not files.rename(new, now):
        files.rename(before, now)
        raise OSError(f"{staged} can't be moved to {path}")
    files.delete(before, True)


def take_back(spark: SparkSession, path: str) -> None:
    """After an end between the two renames of ``put_in_place``: the old folder again. Otherwise only its remains go."""
    files, now, before = _paths(spark, path, f"{path}__before")
    if files.exists(before):
        if files.exists(now):
            files.delete(before, True)
        else:
            files.rename(before, now)


def replace_tables(spark: SparkSession, builds: Mapping[str, Build], root: str, extra: Mapping[str, Build] | None = None) -> dict[str, DataFrame]:
    """Create or replace ``<root>/<name>`` and the view of that name; running it again gives the same.

    Tables are written below ``<root>/__next-…`` first and put in place when all of them are complete, so a build
    that fails leaves every old table as it was, and a build may read the table that it replaces. ``extra`` are
    paths that are written next to them; they are returned under their paths and get no view.
    """
    staging = f"{root}/__next-{uuid.uuid4().hex}"
    for name in builds:
        take_back(spark, f"{root}/{name}")
    try:
        written = write_tables(spark, {f"{staging}/{name}": build for name, build in builds.items()} | dict(extra or {}))
        for name in builds:
            put_in_place(spark, f"{staging}/{name}", f"{root}/{name}")
    finally:
        remove(spark, staging)
    tables: dict[str, DataFrame] = {}
    register(tables, {name: spark.read.schema(written[f"{staging}/{name}"].schema).parquet(f"{root}/{name}") for name in builds})
    return tables | {path: written[path] for path in extra or {}}


def register(tables: dict[str, DataFrame], written: Mapping[str, DataFrame]) -> None:
    """Add written tables to a set and name a view after each."""
    tables.update(written)
    for name, table in written.items():
        table.createOrReplaceTempView(name)


def sort_order(df: DataFrame) -> list[Column]:
    return [F.col(f"`{name}`").asc_nulls_last() for name in df.columns]


def ordered(df: DataFrame) -> DataFrame:
    """Rows sorted by every column, left to right, NULL last."""
    return df.orderBy(*sort_order(df))


def export_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Headed CSV in the order of :func:`ordered`; NULL is an empty field and blanks are kept.

    Part files follow the order of a range-partitioned sort. ``single_file`` sorts in one task and
    is for report-sized tables only.
    """
    rows = df.repartition(1).sortWithinPartitions(*sort_order(df)) if single_file else ordered(df)
    with released_shuffles(df.sparkSession):
        (
            rows.write.mode("overwrite")
            .option("header", True)
            .option("nullValue", "")
            .option("emptyValue", "")
            .option("escape", '"')
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
            .csv(path)
        )


def export_tables(tables: Mapping[str, DataFrame], names: Iterable[str], root: str, single_file: bool = False) -> list[str]:
    """Export the named tables below ``root``; returns the paths."""
    paths = []
    for name in names:
        path = f"{root}/{name}"
        export_csv(tables[name], path, single_file)
        paths.append(path)
    return paths


def _cell_numbers(name: str, cells: pa.Array) -> np.ndarray:
    """32 bits of the MD5 of a cell's column and text, 0 for NULL; any engine that has MD5 gets the same.

    Cells are texts or whole numbers. A value is hashed once per batch, however often it occurs there.
    """
    coded, start = cells.dictionary_encode(), f"{name}:".encode()
    texts = coded.dictionary.cast(pa.string()) if pa.types.is_integer(cells.type) else coded.dictionary
    found = [int.from_bytes(md5(start + text).digest()[:4], "big") for text in texts.cast(pa.large_binary()).to_pylist()]
    return np.array([*found, 0], np.int64)[coded.indices.fill_null(len(found)).to_numpy()]


PLAIN_TYPES = (T.StringType(), T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType())


def checksum(columns: Iterable[str], schema: T.StructType | None = None) -> Column:
    """Aggregate over all cells of the columns that does not depend on the order of rows, and adds up over parts.

    With the ``schema``, whole numbers are made text once per value and not once per cell.
    """
    names = [*columns]
    plain = {f.name for f in schema or [] if f.dataType in PLAIN_TYPES}

    @F.arrow_udf(T.LongType())
    def of_row(*cells: pa.Array) -> pa.Array:
        return pa.array(sum(_cell_numbers(name, column) for name, column in zip(names, cells)))

    rows = of_row(*[F.col(f"`{c}`") if c in plain else F.col(f"`{c}`").cast("string") for c in names]) if names else F.lit(0)
    return F.coalesce(F.sum(rows.cast("decimal(28,0)")), F.lit(0)).cast("decimal(38,0)")


def _compared(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Of each value but the first: is it smaller than the one before, and is it the same; NULL comes last, NaN before it."""
    before, now = column[:-1], column[1:]
    flags = lambda found: pc.fill_null(found, False).to_numpy(zero_copy_only=False)
    none = column.is_null().to_numpy(zero_copy_only=False)
    smaller = flags(pc.less(now, before)) | (none[:-1] & ~none[1:])
    same = flags(pc.equal(now, before)) | (none[:-1] & none[1:])
    if pa.types.is_floating(column.type):
        odd = flags(pc.is_nan(column))
        smaller |= odd[:-1] & ~odd[1:] & ~none[1:]
        same |= odd[:-1] & odd[1:]
    return smaller, same


class _Block:
    """What is known of a block of an export while its rows pass by."""

    def __init__(self, file: str, start: int, names: Sequence[str]) -> None:
        self.place, self.names = (file, start), names
        self.rows = self.disorder = 0
        self.first: list[bytes | None] = []
        self.last: list[bytes | None] = []
        self.typed: list[pa.Array] = []
        self.filled, self.sums = [0] * len(names), [0] * len(names)

    def add(self, texts: list[pa.Array], typed: list[pa.Array]) -> None:
        """The next rows, as the texts of the file and as the values that they are ordered by."""
        row = lambda at: [text[at : at + 1].cast(pa.large_binary())[0].as_py() for text in texts]
        n = len(texts[0])
        self.first, self.last = self.first or row(0), row(n - 1)
        for i, (name, text) in enumerate(zip(self.names, texts)):
            self.filled[i] += n - text.null_count
            self.sums[i] += int(_cell_numbers(name, text).sum())
        late, tied = 0, True
        for i, column in enumerate(typed):
            smaller, same = _compared(pa.concat_arrays([self.typed[i], column]) if self.rows else column)
            late, tied = late | (tied & smaller), tied & same
            if not np.any(tied):
                break
        self.disorder += int(np.sum(late))
        self.typed = [column[n - 1 :] for column in typed]
        self.rows += n


BLOCK_SCHEMA = pa.schema(
    [
        ("file", pa.string()), ("start", pa.int64()), ("rows", pa.int64()), ("first", pa.list_(pa.binary())), ("last", pa.list_(pa.binary())),
        ("disorder", pa.int64()), ("filled", pa.list_(pa.int64())), ("sums", pa.list_(pa.decimal128(38, 0))),
    ]
)
BLOCK_COLUMNS = "file string, start bigint, rows bigint, first array<binary>, last array<binary>, disorder bigint, filled array<bigint>, sums array<decimal(38,0)>"


def _found(block: _Block) -> pa.RecordBatch:
    sums = [Decimal(n) for n in block.sums]
    row = [*block.place, block.rows, block.first, block.last, block.disorder, block.filled, sums]
    return pa.record_batch([pa.array([value], field.type) for value, field in zip(row, BLOCK_SCHEMA)], schema=BLOCK_SCHEMA)


def _blocks(batches: Iterable[pa.RecordBatch], names: Sequence[str], typed: Sequence[int]) -> Iterator[pa.RecordBatch]:
    """A row per block from rows that come block by block: its file and start, a text per column, and the typed values next to them.

    ``typed`` says which column holds the values that column ``i`` is ordered by.
    """
    block: _Block | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        files, starts = batch.column(0).dictionary_encode(), batch.column(1).to_numpy()
        turns = np.flatnonzero((np.diff(files.indices.to_numpy()) != 0) | (np.diff(starts) != 0)) + 1
        for low, high in pairwise([0, *turns.tolist(), batch.num_rows]):
            place = files[low].as_py(), int(starts[low])
            if block is None or block.place != place:
                if block is not None:
                    yield _found(block)
                block = _Block(*place, names)
            columns = [column[low:high] for column in batch.columns]
            block.add(columns[2 : 2 + len(names)], [columns[at] for at in typed])
    if block is not None:
        yield _found(block)


def export_manifest(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """What an export holds, from its files: a row per block that a task reads, in ``file`` and ``start``.

    ``rows``, ``first`` and ``last`` row, ``disorder`` (rows that are smaller than the one before, in the order of
    :func:`ordered`), and per column ``filled`` cells and their ``sum``. A task sees a block's rows in their order, so none
    is shuffled. In CSV empty text and NULL are one; both count as NULL here.
    """
    text, names = read_text_csv(spark, path, schema.fieldNames()), schema.fieldNames()
    place = [F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("start")]
    others = [i for i, f in enumerate(schema) if f.dataType != T.StringType()]
    values = [F.col(f"`{names[i]}`").cast(schema[i].dataType).alias(f"v{i}") for i in others]
    at = {i: 2 + len(names) + n for n, i in enumerate(others)}
    typed = [at.get(i, 2 + i) for i in range(len(names))]
    rows = text.select(*place, *[F.col(f"`{c}`").alias(f"t{i}") for i, c in enumerate(names)], *values)
    blocks = rows.mapInArrow(lambda batches: _blocks(batches, names, typed), BLOCK_COLUMNS)

    def row(texts: str) -> Column:
        cells = [F.col(texts)[i].cast("string").cast(f.dataType) for i, f in enumerate(schema)]
        return F.struct(*[F.struct(cell.isNull().alias("none"), cell.alias("value")).alias(f"col{i}") for i, cell in enumerate(cells, start=1)])

    columns = [F.struct(F.lit(c).alias("name"), F.col("filled")[i].alias("filled"), F.col("sums")[i].alias("sum")) for i, c in enumerate(names)]
    return blocks.select("file", "start", "rows", row("first").alias("first"), row("last").alias("last"), "disorder", F.array(*columns).alias("columns"))


def export_summary(manifest: DataFrame) -> DataFrame:
    """Per column of an export: rows, filled cells, checksum, and whether all rows are in order, across files too.

    The window runs over a row per block of the files. An export without rows has no columns here.
    """
    before = F.lag("last").over(W.orderBy("file", "start"))
    blocks = manifest.withColumn("disorder", F.col("disorder") + F.coalesce((F.col("first") < before).cast("int"), F.lit(0)))
    cells = blocks.select("rows", "disorder", F.explode("columns").alias("c"))
    return cells.groupBy(F.col("c.name").alias("column_name")).agg(
        F.sum("rows").alias("rows"), F.sum("c.filled").alias("filled_cells"), F.sum("c.sum").cast("decimal(38,0)").alias("checksum"), (F.sum("disorder") == 0).alias("in_order")
    )


def find_tables(tables: Iterable[str], *patterns: str) -> list[str]:
    """Names that match one of the patterns (``a_*``), sorted."""
    return sorted(name for name in tables if any(fnmatchcase(name, p) for p in patterns))


def use_namespace(spark: SparkSession, name: str) -> None:
    """Create the database where it is missing and make it current."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")
    spark.catalog.setCurrentDatabase(name)


def publish_tables(spark: SparkSession, names: Iterable[str], root: str, namespace: str) -> None:
    """Make written tables known in a database by their location; their files stay where they are."""
    use_namespace(spark, namespace)
    for name in names:
        spark.catalog.dropTempView(name)
        spark.sql(f"DROP TABLE IF EXISTS `{namespace}`.`{name}`")
        spark.catalog.createTable(f"{namespace}.{name}", path=f"{root}/{name}", source="parquet")
