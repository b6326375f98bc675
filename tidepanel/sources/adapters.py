"""Trade-like tables to panel relations: bars per (entity, day), index and rate series, prediction scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidepanel.functions.scalar import ratio
from tidepanel.operators.relate import with_constants
from tidepanel.session import dealt, materialise

COMPOSITE = "COMPOSITE"
_ORDER = ["l_orderkey","l_linenumber", "l_partkey", "l_extendedprice", "l_quantity"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as trades of a supplier: d, price p, quotes around it."""
    return _trades(_dated(spark, sf_dir))


def _dated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").withColumn("d", F.to_date("l_shipdate"))


def _trades(rows: DataFrame) -> DataFrame:
    p = F.col("l_extendedprice") / F.col("l_quantity")
    return rows.select(
        "l_suppkey",
        "d",
        F.struct(*_ORDER).alias("ord"),
        p.alias("p"),
        F.col("l_quantity").alias("qty"),
        F.col("l_extendedprice").alias("ext"),
        (p * (1 - F.col("l_discount"))).alias("bid"),
        (p * (1 + F.col("l_tax"))).alias("offer"),
        "l_linestatus",
        "l_returnflag",
    )


def _quantity_where(c: str, value: str) -> Column:
    return F.sum(F.when(F.col(c) == value, F.col("qty")).otherwise(F.lit(0.0)))


_SUMS = ["volume", "value", "bid_volume", "offer_volume", "foreign_buy", "foreign_sell", "non_regular_volume"]


def supplier_days(trades: DataFrame) -> DataFrame:
    """Mergeable daily summary per supplier: extremes of the trade order, of price and quotes, and sums."""
    return trades.groupBy("l_suppkey", "d").agg(
        F.min("ord").alias("first"),
        F.max("ord").alias("last"),
        F.max("p").alias("high"),
        F.min("p").alias("low"),
        F.min("bid").alias("bid"),
        F.max("offer").alias("offer"),
        F.sum("qty").alias("volume"),
        F.sum("ext").alias("value"),
        _quantity_where("l_linestatus", "O").alias("bid_volume"),
        _quantity_where("l_linestatus", "F").alias("offer_volume"),
        _quantity_where("l_returnflag", "A").alias("foreign_buy"),
        _quantity_where("l_returnflag", "R").alias("foreign_sell"),
        _quantity_where("l_returnflag", "N").alias("non_regular_volume"),
    )


def _dealt_days(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, int]:
    """Supplier days, and a number that they don't exceed. The trades of a supplier's day are dealt to one task first, so
    that no task sorts more than its share of them and the raw columns move, not the wider sums."""
    rows = _dated(spark, sf_dir)
    trades = rows.count()
    return supplier_days(_trades(dealt(rows, trades, "l_suppkey", "d"))), trades


def days_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supplier days as a table for bars of suppliers and index series: of the first and last trade only the price is kept."""
    ends = {end: F.struct(f"{end}.l_extendedprice", f"{end}.l_quantity") for end in ("first", "last")}
    return materialise(_dealt_days(spark, sf_dir)[0].withColumns(ends))


def _merged(days: DataFrame, *keys: str) -> DataFrame:
    return days.groupBy(*keys).agg(
        F.min("first").alias("first"), F.max("last").alias("last"), F.max("high").alias("high"),
        F.min("low").alias("low"), F.min("bid").alias("bid"), F.max("offer").alias("offer"),
        *[F.sum(c).alias(c) for c in _SUMS],
    )


def bars(spark: SparkSession, sf_dir: str, by: str = "supplier", *, days: DataFrame | None = None) -> DataFrame:
    """Daily bars per supplier or nation (entity bigint, d date): at most one row per calendar day of an entity.

    ``days`` is a table of ``supplier_days``, for callers that build more than the bars from it.
    """
    if days is None:
        days, most = _dealt_days(spark, sf_dir)
    else:
        most = days.count()
    if by == "nation":
        home = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
        days = _merged(days.join(home, "l_suppkey"), "s_nationkey", "d").withColumnRenamed("s_nationkey", "entity")
    else:
        days = days.withColumnRenamed("l_suppkey", "entity")
    whole = Window.partitionBy("entity")
    priced = days.select(
        F.col("entity").cast("bigint").alias("entity"), "d", _price("first").alias("open_price"), _price("last").alias("close"),
        "high", "low", *_SUMS, "bid", "offer",
    )  # the windows' own column of entities, or windows on the result would shuffle the rows again
    return dealt(priced, most, "entity").select(
        "*",
        F.coalesce(F.lag("close", 1).over(whole.orderBy("d")), F.lit(0.0)).alias("previous"),
        F.sum("volume").over(whole).alias("tradeble_shares"),
    )


def _price(end: str) -> Column:
    return F.col(f"{end}.l_extendedprice") / F.col(f"{end}.l_quantity")


def _series_columns(days: DataFrame) -> DataFrame:
    return days.select(
        "index_profile", "d", ratio("value", "volume").alias("close"), F.col("high").alias("highest"),
        F.col("low").alias("lowest"), "volume", "value",
    )


def index_series(spark: SparkSession, sf_dir: str, profile: str | None = None, *, days: DataFrame | None = None) -> DataFrame:
    """Index rows per (index_profile, d): one profile per nation and COMPOSITE over everything, or ``profile`` alone.

    Lots are read once: COMPOSITE is rolled up from the days of nations, and by itself it needs no nation at all.
    ``days`` is a table of ``supplier_days`` to be used instead of the lots.
    """
    trades = lots(spark, sf_dir) if days is None else days
    merge = [
        F.max("high").alias("high"), F.min("low").alias("low"), F.sum("volume").alias("volume"), F.sum("value").alias("value")
    ]
    raw = [F.max("p").alias("high"), F.min("p").alias("low"), F.sum("qty").alias("volume"), F.sum("ext").alias("value")]
    sums = raw if days is None else merge
    if profile == COMPOSITE:
        return _series_columns(with_constants(trades.groupBy("d").agg(*sums), {"index_profile": COMPOSITE}))
    home = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("name"))
    if profile is not None:
        nation = nation.where(F.col("name") == profile)
    how = "left" if profile is None else "inner"  # lots without a nation count in COMPOSITE
    sold = trades.groupBy("l_suppkey", "d").agg(*sums) if days is None else days
    nation_days = sold.join(home.join(nation, "s_nationkey"), "l_suppkey", how).groupBy("name", "d").agg(*merge)
    if profile is not None:
        return _series_columns(nation_days.withColumnRenamed("name", "index_profile"))
    both = F.explode(F.array_compact(F.array(F.col("name"), F.lit(COMPOSITE))))
    return _series_columns(nation_days.withColumn("index_profile", both).groupBy("index_profile", "d").agg(*merge))


def rate_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rate rows per (primary_code, secondary_code, d)."""
    daily = table(spark, sf_dir, "orders").groupBy(F.to_date("o_orderdate").alias("d")).agg(
        F.avg("o_totalprice").alias("secondary_value")
    )
    return with_constants(daily, {"primary_value": 1.0, "primary_code": "USD", "secondary_code": "IDR"})


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long frame (entity, run, target, model, pred): mean event value per user, quarter of the day and event type.

    Means are rounded, so that equal means tie whatever the order of summation.
    """
    kinds = {
        "signup": ("return", "net"), "view": ("return", "tree"), "click": ("vol", "net"), "purchase": ("vol", "tree"),
        "error": ("drawdown", "net"),
    }
    kind = F.col("event_type")
    target = F.create_map(*[F.lit(x) for k, (t, _) in kinds.items() for x in (k, t)])[kind]
    model = F.create_map(*[F.lit(x) for k, (_, m) in kinds.items() for x in (k, m)])[kind]
    means = table(spark, sf_dir, "events").groupBy(
        F.col("user_id").alias("entity"), F.floor(F.hour("ts") / 6).cast("bigint").alias("run"), "event_type"
    ).agg(F.round(F.avg("value"), 6).alias("pred"))
    return means.select("entity", "run", target.alias("target"), model.alias("model"), "pred")
