"""Incremental ingest of landed JSON files into parquet base tables.

Files may come late or twice: every write is an append of keys not yet stored, so replaying a file or a whole
micro-batch changes nothing. A day is loaded once both feeds have a page for it, in whichever batches they came; until then
its items are in the stream's state (``pairing``). A day whose second feed never comes is reported in ``unpaired_days``,
which keeps its items, and a page that does not parse goes to ``quarantine``. Facts are partitioned by month. One query per
table set must be the only writer of its tables.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from tidepanel.operators.ingest import dimension_rows, insert_ignore, nulls_to_zero, referenced
from tidepanel.session import exists, materialise, own_tables
from tidepanel.sources.landed import faulty, index_rows, parsed, rate_rows, sound, stock_rows
from tidepanel.sources.schema import INDEX_VALUES, PRIMARY_KEYS, STOCK_VALUES, TABLES
from tidepanel.streaming.pairing import FAULTY, PAIRED, SEEN, UNPAIRED, page_events, paired_days, pages_of


MONTH = "month"
NO_DATA_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"
FACTS = ("index_data", "stock_data", "currency_exchange_rates")


def stored(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A base table, empty as long as nothing has been written to it."""
    if not exists(spark, f"{root}/{name}"):
        return spark.createDataFrame([], TABLES[name])
    known = spark.read.schema(TABLES[name]).parquet(f"{root}/{name}")
    return known if name in FACTS else known.select(*TABLES[name].names)


def _month(ts: str = "timestamp") -> Column:
    return F.date_format(ts, "yyyy-MM").alias(MONTH)


def _of_months(known: DataFrame, rows: DataFrame) -> DataFrame:
    """Stored facts that new ones can meet: those of their months, of which there are few, so only these folders are read."""
    months = [r[0] for r in rows.select(_month()).distinct().collect()]
    return known.where(F.col(MONTH).isin(months)) if MONTH in known.columns else known


def append_new(spark: SparkSession, root: str, name: str, rows: DataFrame) -> None:
    """Append the rows whose key is not stored yet."""
    typed = rows.select(*[rows[f.name].cast(f.dataType).alias(f.name) for f in TABLES[name].fields])
    known = stored(spark, root, name)
    # evaluated before the write: the files of the table being read must not change under the query
    fresh = materialise(insert_ignore(_of_months(known, typed) if name in FACTS else known, typed, PRIMARY_KEYS[name]))
    if name in FACTS:
        dated = fresh.withColumn(MONTH, _month()).repartitionByRange(MONTH, *PRIMARY_KEYS[name])
        dated.write.mode("append").partitionBy(MONTH).parquet(f"{root}/{name}")
    else:
        fresh.write.mode("append").parquet(f"{root}/{name}")


def load_summaries(spark: SparkSession, root: str, stock: DataFrame, index: DataFrame) -> None:
    """Load bars: dimensions, then facts of days for which both feeds have rows, here or loaded before."""

    def days(rows: DataFrame, name: str) -> DataFrame:
        return rows.select("timestamp").union(_of_months(stored(spark, root, name), both).select("timestamp")).distinct()

    both = materialise(stock.select("timestamp").union(index.select("timestamp")).distinct())
    stock, index = (
        materialise(stock.join(days(index, "index_data"), "timestamp", "left_semi")),
        materialise(index.join(days(stock, "stock_data"), "timestamp", "left_semi")),
    )
    append_new(spark, root, "index_profiles", index.selectExpr("index_profile AS index_code").distinct())
    names = dimension_rows(stock, "stock_profile", ["stock_name", "remarks", "delisting_date"], order="timestamp")
    append_new(spark, root, "stock_profiles", names.withColumnRenamed("stock_profile", "stock_code"))
    index_dim = stored(spark, root, "index_profiles").withColumnRenamed("index_code", "index_profile")
    stock_dim = stored(spark, root, "stock_profiles").withColumnRenamed("stock_code", "stock_profile")
    append_new(spark, root, "index_data", nulls_to_zero(referenced(index, index_dim, "index_profile"), INDEX_VALUES))
    append_new(spark, root, "stock_data", nulls_to_zero(referenced(stock, stock_dim, "stock_profile"), STOCK_VALUES))


def load_rates(spark: SparkSession, root: str, rates: DataFrame) -> None:
    codes = rates.selectExpr("explode(array(primary_code, secondary_code)) AS currency_code").distinct()
    append_new(spark, root, "currencies", codes)
    days = stored(spark, root, "time_dimensions")
    append_new(spark, root, "currency_exchange_rates", referenced(rates, days, "timestamp"))


def _texts(spark: SparkSession, folder: str) -> DataFrame:
    files = spark.readStream.format("text").option("wholetext", True).load(folder)
    return files.select("value", F.col("_metadata.file_name").alias("file"))


UNPAIRED_DAYS = T.StructType().add("day", "date").add("kind", "string").add("items", "string")
QUARANTINE = T.StructType().add("kind", "string").add("file", "string").add("reason", "string").add("value", "string")


def _side_table(spark: SparkSession, root: str, name: str, schema: T.StructType) -> DataFrame:
    path = f"{root}/{name}"
    return spark.read.schema(schema).parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)


def unpaired_days(spark: SparkSession, root: str) -> DataFrame:
    """(day, kind, items): pages of days whose other feed had not come when the wait was over, and has not come since."""
    waiting = _side_table(spark, root, "unpaired_days", UNPAIRED_DAYS)
    for name, ts in (("stock_data", "timestamp"), ("index_data", "timestamp")):
        waiting = waiting.join(stored(spark, root, name).select(F.to_date(ts).alias("day")).distinct(), "day", "left_anti")
    return waiting


def quarantined(spark: SparkSession, root: str) -> DataFrame:
    """(kind, file, reason, value): pages that did not parse."""
    return _side_table(spark, root, "quarantine", QUARANTINE)


def seen_days(spark: SparkSession, root: str) -> DataFrame:
    """(d): days that need not be asked for again, that is, days of sound pages but for those reported as unpaired."""
    days = stored(spark, root, "time_dimensions").select(F.to_date("timestamp").alias("d")).distinct()
    return days.join(unpaired_days(spark, root).select(F.col("day").alias("d")).distinct(), "d", "left_anti")


def _append_side(spark: SparkSession, root: str, name: str, schema: T.StructType, rows: DataFrame) -> None:
    known = _side_table(spark, root, name, schema)
    digest = F.sha2(F.to_json(F.struct(*schema.names)), 256).alias("_key")
    fresh = materialise(rows.select(*schema.names).distinct().select("*", digest).join(known.select(digest), "_key", "left_anti"))
    fresh.select(*schema.names).write.mode("append").parquet(f"{root}/{name}")


def _with_partners(spark: SparkSession, root: str, expired: DataFrame) -> DataFrame:
    """Of days whose wait is over: those whose other feed was loaded or reported before, together with what was reported."""
    known = _side_table(spark, root, "unpaired_days", UNPAIRED_DAYS)
    days = expired.select("day").distinct()
    both = expired.select(*UNPAIRED_DAYS.names).unionByName(known.join(days, "day", "left_semi"))
    loaded = stored(spark, root, "index_data").select(F.to_date("timestamp").alias("day")).distinct()
    complete = both.groupBy("day").agg(F.count_distinct("kind").alias("n")).where("n = 2").select("day").unionByName(
        days.join(loaded, "day", "left_semi")
    )
    return both.join(complete.distinct(), "day", "left_semi")


def load_pages(spark: SparkSession, root: str, events: DataFrame) -> None:
    """Write what one batch of ``paired_days`` says."""

    def having(status: str) -> DataFrame:
        return events.where(F.col("status") == status)

    bad = having(FAULTY).select("kind", "file", "reason", F.col("items").alias("value"))
    _append_side(spark, root, "quarantine", QUARANTINE, bad)
    days = having(SEEN).select(F.col("day").cast("timestamp").alias("timestamp")).where("timestamp IS NOT NULL")
    append_new(spark, root, "time_dimensions", days.distinct())
    expired = having(UNPAIRED)
    rescued = materialise(_with_partners(spark, root, expired))
    alone = expired.join(rescued.select("day").distinct(), "day", "left_anti")
    _append_side(spark, root, "unpaired_days", UNPAIRED_DAYS, alone)
    ready = having(PAIRED).select("day", "kind", "items").unionByName(rescued.select("day", "kind", "items"))
    index, stock = index_rows(pages_of(ready, "index")), stock_rows(pages_of(ready, "stock"))
    load_summaries(spark, root, stock, index)


def ingest_summaries(
    spark: SparkSession, landing: str, root: str, state: str, *, wait: timedelta = timedelta(days=7)
) -> StreamingQuery:
    """Load the files in ``landing/stock`` and ``landing/index`` that the query state has not seen.

    A day counts as seen once a sound page of it came; a date (yyyyMMdd) in a file name stands for a page without rows.
    """
    feeds = [page_events(parsed(_texts(spark, f"{landing}/{kind}"), kind), kind) for kind in ("stock", "index")]

    def load(batch: DataFrame, _: int) -> None:
        with own_tables(batch.sparkSession):
            load_pages(batch.sparkSession, root, materialise(batch))

    before = spark.conf.get(NO_DATA_BATCHES)
    spark.conf.set(NO_DATA_BATCHES, "false")  # with them, a query whose state waits on the clock would never end
    try:
        return (
            paired_days(feeds[0].unionByName(feeds[1]), wait)
            .writeStream.foreachBatch(load)
            .outputMode("append")
            .option("checkpointLocation", f"{state}/summaries")
            .trigger(availableNow=True)
            .start()
        )
    finally:
        spark.conf.set(NO_DATA_BATCHES, before)


def ingest_rates(
    spark: SparkSession, landing: str, root: str, state: str, *, primary: str = "USD", secondary: str = "IDR"
) -> StreamingQuery:
    def load(batch: DataFrame, _: int) -> None:
        with own_tables(batch.sparkSession):
            pages = materialise(batch)
            _append_side(batch.sparkSession, root, "quarantine", QUARANTINE, faulty(pages, "rate"))
            load_rates(batch.sparkSession, root, rate_rows(sound(pages, "rate"), primary=primary, secondary=secondary))

    return (
        parsed(_texts(spark, f"{landing}/rate"), "rate")
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", f"{state}/rates")
        .trigger(availableNow=True)
        .start()
    )
