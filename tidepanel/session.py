"""Tables that cut lineage: written to the cluster's shared checkpoint folder, never to executor-local storage."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from pathlib import Path
from threading import Lock

from pyspark.sql import Column, DataFrame, Observation, SparkSession

_FOLDER_KEY = "tidepanel.tables.dir"
_TABLES = "tidepanel_bucketed_"


def shared_folder(spark: SparkSession) -> str:
    """Folder for materialised tables: ``spark.checkpoint.dir``; a temporary one only in local mode."""
    known = spark.conf.get(_FOLDER_KEY, None)
    if known:
        return known
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="tidepanel-")
        spark.conf.set("spark.checkpoint.dir", root)
    folder = f"{root.rstrip('/')}/tidepanel-{uuid.uuid4().hex}"
    spark.conf.set(_FOLDER_KEY, folder)
    return folder


def materialise(df: DataFrame, *partition_by: str, folder: str | None = None) -> DataFrame:
    """Evaluate once, write as parquet and read back.

    The copy outlives lost executors, prunes columns on every later read and carries its true size, so Catalyst
    broadcasts it only when the files are below ``spark.sql.autoBroadcastJoinThreshold`` and shuffles otherwise. Shuffle files
    of the write are given up as soon as it is done.
    """
    spark = df.sparkSession
    path = f"{folder or shared_folder(spark)}/{uuid.uuid4().hex}"
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with _shuffles_given_up(spark):
        writer.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._table = path
    return table


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_writes: list[str | None] = []  # what the setting was before each of the writes that are under way
_writes_lock = Lock()


@contextmanager
def _shuffles_given_up(spark: SparkSession) -> Iterator[None]:
    with _writes_lock:
        _writes.append(_writes[0] if _writes else spark.conf.get(_CLEANUP, None))
        spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        with _writes_lock:
            before = _writes.pop()
            if not _writes:
                spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


def condensed(spark: SparkSession, make: Callable[[], DataFrame]) -> DataFrame:
    """``materialise(make())``; the tables that ``make`` wrote on the way are deleted."""
    outer = shared_folder(spark)
    with own_tables(spark):
        return materialise(make(), folder=outer)


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per Spark context, so that their Python workers can import it."""
    context = spark.sparkContext
    if getattr(context, "_tidepanel_sent", False):
        return
    root = Path(__file__).resolve().parent
    target = Path(os.path.realpath(tempfile.mkdtemp(prefix="tidepanel-"))) / "tidepanel.zip"
    with zipfile.ZipFile(target, "w") as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, str(file.relative_to(root.parent)))
    context.addPyFile(str(target))
    context._tidepanel_sent = True


TASK_ROWS = 100_000  # rows of a wide panel that a task sorts in memory


def dealt(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """``df`` hashed by ``keys`` into as many tasks as ``rows`` rows need, so that windows over the keys don't spill.

    Partitions sized by their shuffled bytes hold several times as many rows once windows have widened these. A few rows are
    left to Spark.
    """
    tasks = -(-rows // TASK_ROWS)
    return df.repartition(tasks, *keys) if tasks > 1 else df


def observed(df: DataFrame, metrics: Mapping[str, Column]) -> tuple[DataFrame, dict]:
    """``materialise`` and, from the same pass, aggregates over the rows written."""
    watch = Observation()
    table = materialise(df.observe(watch, *[c.alias(name) for name, c in metrics.items()]))
    return table, watch.get


def bucketed(df: DataFrame, key: str, sort: Sequence[str] = (), *, buckets: int | None = None) -> DataFrame:
    """``materialise`` into a table bucketed by ``key`` and sorted within buckets.

    Tables with the same buckets join on the key, and take windows over it, without an exchange; for a join on the key
    and further columns, see ``copartitioned``. By default there are as many buckets as shuffle partitions.
    """
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"{_TABLES}{uuid.uuid4().hex}"
    path = f"{shared_folder(spark)}/{name}"
    dealt = df.repartition(n, key)  # one file per bucket
    dealt.write.bucketBy(n, key).sortBy(key, *sort).option("path", path).format("parquet").saveAsTable(name)
    table = spark.table(name)
    table._table = path
    return table


def copartitioned(spark: SparkSession) -> None:
    """Let a join on (key, more) use tables that are bucketed by the key alone."""
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")


def discard(table: DataFrame) -> None:
    """Delete a table made by ``materialise`` that nothing reads any more."""
    _delete(table.sparkSession, table._table)


def release(spark: SparkSession) -> None:
    """Delete every table written by this session and drop its cached relations."""
    for table in spark.catalog.listTables(pattern=f"{_TABLES}*"):
        spark.sql(f"DROP TABLE IF EXISTS {table.name}")
    _delete_tables(spark)
    spark.catalog.clearCache()


@contextmanager
def own_tables(spark: SparkSession) -> Iterator[None]:
    """Tables materialised inside go to a folder of their own, which is deleted at the end; others stay."""
    outer = spark.conf.get(_FOLDER_KEY, None)
    spark.conf.unset(_FOLDER_KEY)
    try:
        yield
    finally:
        _delete_tables(spark)
        if outer:
            spark.conf.set(_FOLDER_KEY, outer)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, on whatever file system the path names."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def _delete_tables(spark: SparkSession) -> None:
    folder = spark.conf.get(_FOLDER_KEY, None)
    if folder:
        _delete(spark, folder)
        spark.conf.unset(_FOLDER_KEY)


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
