"""Reading and writing relations."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidepanel.operators.ingest import upsert_latest
from tidepanel.operators.windows import Keys, key_list
from tidepanel.session import discard, exists, materialise
from tidepanel.sources.schema import TABLES


def scan(spark: SparkSession, path: str, columns: Iterable[str] | None = None, *, fmt: str = "parquet") -> DataFrame:
    """Projected scan of a file relation."""
    df = spark.read.format(fmt).load(path)
    return df.select(*columns) if columns else df


def scan_base(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Base table with its declared schema."""
    return spark.read.schema(TABLES[name]).parquet(f"{root}/{name}")


def scan_jdbc(
    spark: SparkSession, url: str, table: str, *, split_on: str, lower, upper, parts: int,
    properties: Mapping[str, str] | None = None, columns: Iterable[str] | None = None,
) -> DataFrame:
    """Live database table, read in ``parts`` ranges of a numeric, date or timestamp column."""
    reader = spark.read.format("jdbc").options(
        url=url, dbtable=table, partitionColumn=split_on, lowerBound=str(lower), upperBound=str(upper),
        numPartitions=str(parts), **dict(properties or {}),
    )
    df = reader.load()
    return df.select(*columns) if columns else df


def save_panel(
    df: DataFrame, path: str, *, entity: str = "entity", ts: str = "d", mode: str = "overwrite", rows_per_file: int = 1_000_000
) -> None:
    """Write a panel partitioned by year and month of its time, so that date filters prune directories.

    Rows are dealt by ranges of (year, month, entity): a month of any size is written by as many tasks as it needs, a
    file holds neighbouring entities, and none holds more than ``rows_per_file`` rows.
    """
    dated = df.withColumns({"year": F.year(ts), "month": F.month(ts)})
    tasks = max(1, -(-df.count() // rows_per_file))
    ranged = dated.repartitionByRange(tasks, "year", "month", entity).sortWithinPartitions("year", "month", entity, ts)
    ranged.write.mode(mode).option("maxRecordsPerFile", rows_per_file).partitionBy("year", "month").parquet(path)


def upsert_partitions(spark: SparkSession, path: str, incoming: DataFrame, key: Keys, version: str, partition: str) -> list:
    """Upsert into a table partitioned by ``partition``, in which the highest ``version`` of a key wins.

    Copy on write: only partitions that ``incoming`` has rows for are read, merged and replaced; files of others stay as
    they are. A key must not change its partition. Returns the partitions written; there are few of them.
    """
    touched = [r[0] for r in incoming.select(partition).distinct().collect()]
    if not touched:
        return []
    if not exists(spark, path):
        merged = upsert_latest(incoming.limit(0), incoming, [*key_list(key), partition], version)
    else:
        known = spark.read.parquet(path).select(*[F.col(c).cast(t).alias(c) for c, t in incoming.dtypes])
        merged = upsert_latest(known.where(F.col(partition).isin(touched)), incoming, [*key_list(key), partition], version)
    table = materialise(merged)  # the files being read are about to be replaced
    dealt = table.repartitionByRange(partition, *key_list(key))
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)
    discard(table)
    return sorted(touched)


def export(results: Mapping[str, DataFrame], root: str, *, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """One directory per named result."""
    for name, df in results.items():
        writer = df.write.mode(mode).format(fmt)
        if fmt == "csv":
            writer = writer.option("header", True)
        writer.save(f"{root}/{name}")
