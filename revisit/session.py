"""Session set-up and the shared folder that holds intermediate tables."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import DataFrame, SparkSession

_LOCAL_FOLDERS: dict[str, str] = {}
_HELD: dict[tuple[int, str], tuple[int, str | None]] = {}  # uses under way and the value before, by session and setting
_HOLD = threading.Lock()


def local_session(cores: int | str = "*", app_name: str = "revisit") -> SparkSession:
    """A single-machine session for tests and the benchmark; a cluster brings its own.

    A refresh compiles a few hundred pieces of generated code. The default cache holds 100, so that
    every run would compile them again; this is a start-up setting worth having on a cluster too.
    """
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.codegen.cache.maxEntries", "2000")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """Folder for written intermediates, below the one the cluster names in ``spark.checkpoint.dir``.

    Only a local session may go without that setting; it then gets a fresh temporary folder.
    """
    app = spark.sparkContext.applicationId
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return f"{root.rstrip('/')}/revisit/{app}"
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    if app not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[app] = tempfile.mkdtemp(prefix="revisit-")
    return _LOCAL_FOLDERS[app]


def fresh_folder(spark: SparkSession) -> str:
    """A new, unused folder name inside the shared folder."""
    return f"{shared_folder(spark)}/{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system it lies; a missing one is no error."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def scratch_folder(spark: SparkSession) -> Iterator[str]:
    """A fresh folder for intermediates of one step, removed when the step has ended, well or not."""
    folder = fresh_folder(spark)
    try:
        yield folder
    finally:
        remove(spark, folder)


def write_table(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as parquet and return the written table.

    A lost executor later rereads the files instead of recomputing the lineage, and every reader
    prunes to the columns it needs. The file sizes also tell the planner which side to broadcast.
    """
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def _held(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A setting that steps running side by side share; the last one to end puts it back."""
    key = (id(spark), name)
    with _HOLD:
        uses, before = _HELD.get(key, (0, None))
        if not uses:
            before = spark.conf.get(name, None)
            spark.conf.set(name, value)
        _HELD[key] = (uses + 1, before)
    try:
        yield
    finally:
        with _HOLD:
            uses, before = _HELD.pop(key)
            if uses > 1:
                _HELD[key] = (uses - 1, before)
            elif before is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, before)


def wide_rows(spark: SparkSession) -> AbstractContextManager[None]:
    """Settings for stages that project many computed columns, put back afterwards.

    The JVM does not compile methods above 8,000 bytes. Without this limit the whole projection
    becomes one such method and runs interpreted, three times slower.
    """
    return _held(spark, "spark.sql.codegen.hugeMethodLimit", "8000")


def released_shuffles(spark: SparkSession) -> AbstractContextManager[None]:
    """Shuffle files of what is written in here go when its job has ended.

    Otherwise they stay until the driver happens to collect garbage, and all steps of a refresh lie on disk at once.
    """
    return _held(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
