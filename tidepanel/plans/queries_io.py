"""Named queries of readers, loading, stores, sketches and blocked panels."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidepanel.config import RECENT_RANKING_DAYS, STATE_FEATURES, TARGETS, RankingParams, SCALED_FEATURES
from tidepanel.operators.ingest import both_present, dimension_rows
from tidepanel.operators.portfolio import unknown_states
from tidepanel.operators.scaling import lower_quantiles, rank_error, sketched_quantiles
from tidepanel.operators.split import reunited, split_rows, train, validation
from tidepanel.plans import ranking_panel as ranking, risk_panel
from tidepanel.plans.queries import KEYS, neat, query
from tidepanel.session import discard, materialise, shared_folder
from tidepanel.sources.adapters import COMPOSITE, bars, days_table, index_series, lots, rate_series, supplier_days, table
from tidepanel.sources.landed import faulty, index_rows, rate_rows, read_pages, sound, stock_rows
from tidepanel.sources.tables import export, save_panel, scan, upsert_partitions


def _folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/{uuid.uuid4().hex}"


# ---- landed pages: written as text from the tables, some of them damaged, and read again -----------------------------


def _damaged(text: Column, mark: Column) -> Column:
    """Every seventh page is cut off, every eleventh is an error message."""
    cut = F.substring(text, F.lit(1), F.length(text) - 3)
    return F.when(mark % 7 == 0, cut).when(mark % 11 == 0, F.lit('{"message": "too many requests"}')).otherwise(text)


def _landed(spark: SparkSession, texts: DataFrame, kind: str) -> DataFrame:
    path = _folder(spark)
    texts.select("value").write.text(path)
    return read_pages(spark, path, kind, lines=True)


def _stock_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Eight pages a day, by supplier."""
    item = F.struct(
        F.date_format("d", "yyyy-MM-dd'T'HH:mm:ss").alias("Date"), F.col("l_suppkey").cast("string").alias("StockCode"),
        F.lit("").alias("DelistingDate"), F.col("high").alias("High"), F.col("volume").alias("Volume"),
    )
    days = supplier_days(lots(spark, sf)).select("d", (F.col("l_suppkey") % 8).alias("chunk"), item.alias("item"))
    page = F.to_json(F.struct(F.collect_list("item").alias("data")))
    pages = days.groupBy("d", "chunk").agg(page.alias("page"))
    return _landed(spark, pages.select(_damaged(F.col("page"), F.dayofyear("d") + F.col("chunk")).alias("value")), "stock")


def _index_pages(spark: SparkSession, sf: str) -> DataFrame:
    item = F.struct(
        F.date_format("d", "yyyy-MM-dd'T'HH:mm:ss").alias("Date"), F.col("index_profile").alias("IndexCode"),
        F.col("highest").alias("Highest"), F.col("volume").alias("Volume"),
    )
    pages = index_series(spark, sf).groupBy("d").agg(F.to_json(F.struct(F.collect_list(item).alias("data"))).alias("page"))
    return _landed(spark, pages.select(_damaged(F.col("page"), F.dayofyear("d")).alias("value")), "index")


def _rate_pages(spark: SparkSession, sf: str) -> DataFrame:
    """One page a month."""
    entry = F.struct(F.date_format("d", "yyyy-MM-dd"), F.create_map(F.lit("IDR"), "secondary_value"))
    pages = rate_series(spark, sf).groupBy(F.year("d").alias("y"), F.month("d").alias("m")).agg(
        F.to_json(F.struct(F.map_from_entries(F.collect_list(entry)).alias("rates"))).alias("page")
    )
    return _landed(spark, pages.select(_damaged(F.col("page"), F.col("y") + F.col("m")).alias("value")), "rate")


@query
def landed_stock(spark: SparkSession, sf: str) -> DataFrame:
    rows = stock_rows(sound(_stock_pages(spark, sf), "stock"))
    return neat(rows.select("stock_profile", F.to_date("timestamp").alias("d"), "high", "volume", "delisting_date").drop("delisting_date"))


@query
def landed_index(spark: SparkSession, sf: str) -> DataFrame:
    rows = index_rows(sound(_index_pages(spark, sf), "index"))
    return neat(rows.select("index_profile", F.to_date("timestamp").alias("d"), F.col("highest").alias("high"), "volume"))


@query
def landed_rates(spark: SparkSession, sf: str) -> DataFrame:
    rows = rate_rows(sound(_rate_pages(spark, sf), "rate"))
    return neat(rows.select("primary_code", "secondary_code", F.to_date("timestamp").alias("d"), "primary_value", "secondary_value"))


@query
def quarantined_pages(spark: SparkSession, sf: str) -> DataFrame:
    pages = {"stock": _stock_pages(spark, sf), "index": _index_pages(spark, sf), "rate": _rate_pages(spark, sf)}
    bad = None
    for kind, read in pages.items():
        more = faulty(read, kind).select("kind", "reason")
        bad = more if bad is None else bad.unionByName(more)
    return bad.groupBy("kind", "reason").agg(F.count(F.lit(1)).alias("pages"))


@query
def both_feeds(spark: SparkSession, sf: str) -> DataFrame:
    """Rows per feed of the days that both shipments and orders have."""
    shipped = table(spark, sf, "lineitem").select(F.to_date("l_shipdate").alias("d"))
    ordered = table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("d"))
    left, right = both_present(shipped, ordered, ts="d")
    both = left.withColumn("feed", F.lit("lineitem")).unionByName(right.withColumn("feed", F.lit("orders")))
    return both.groupBy("feed", "d").agg(F.count(F.lit(1)).alias("n"))


@query
def dimension_rows_(spark: SparkSession, sf: str) -> DataFrame:
    facts = table(spark, sf, "orders").select("o_custkey", "o_orderdate", "o_orderpriority", "o_orderstatus")
    return dimension_rows(facts, "o_custkey", ["o_orderpriority", "o_orderstatus"], order="o_orderdate")


@query
def unknown_state(spark: SparkSession, sf: str) -> DataFrame:
    """Order states as risk states: one of the three is not among those that have an exposure."""
    names = F.create_map(*[F.lit(x) for pair in (("F", "RISK_OFF"), ("O", "RISK_ON"), ("P", "PENDING")) for x in pair])
    return unknown_states(table(spark, sf, "orders").select(names[F.col("o_orderstatus")].alias("risk_state")))


@query
def reunited_sets(spark: SparkSession, sf: str) -> DataFrame:
    state = split_rows(risk_panel.market_state(index_series(spark, sf, COMPOSITE)), 0.8, entity="index_profile")
    rows = materialise(state.select("d", "is_val", "ret_1d"))
    return neat(reunited(train(rows), validation(rows)))


@query
def upsert_corrections(spark: SparkSession, sf: str) -> DataFrame:
    """Orders by month, then corrections to old ones: only the months that these are in are written again."""
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_totalprice", F.lit(1).cast("bigint").alias("version"), F.date_format("o_orderdate", "yyyy-MM").alias("month")
    )
    path = _folder(spark)
    upsert_partitions(spark, path, orders, "o_orderkey", "version", "month")
    fixes = orders.where("o_orderkey % 50 = 0 AND month < '1994-07'").withColumns(
        {"o_totalprice": F.col("o_totalprice") * 2, "version": F.lit(2).cast("bigint")}
    )
    upsert_partitions(spark, path, fixes, "o_orderkey", "version", "month")
    return neat(spark.read.parquet(path).select("o_orderkey", "o_totalprice", "version", F.col("month").cast("string").alias("month")))


@query
def panel_export(spark: SparkSession, sf: str) -> DataFrame:
    """The panel written by ranges of month and entity, and read back."""
    path = _folder(spark)
    save_panel(materialise(bars(spark, sf).select(*KEYS, "close", "volume")), path, rows_per_file=20_000)
    return neat(scan(spark, path, [*KEYS, "close", "volume"]))


@query
def result_export(spark: SparkSession, sf: str) -> DataFrame:
    """Two results exported to a directory each, and read back."""
    path, by_nation = _folder(spark), bars(spark, sf, "nation")
    results = {"sizes": by_nation.groupBy("entity").agg(F.count(F.lit(1)).alias("n")), "days": by_nation.groupBy("d").agg(F.count(F.lit(1)).alias("n"))}
    export(results, path, fmt="csv")
    back = None
    for name in results:
        read = spark.read.option("header", True).csv(f"{path}/{name}").agg(F.count(F.lit(1)).alias("rows"), F.sum(F.col("n").cast("bigint")).alias("total"))
        part = read.select(F.lit(name).alias("result"), "rows", "total")
        back = part if back is None else back.unionByName(part)
    return back


# ---- blocks, chains and sketches -------------------------------------------------------------------------------------


def _blocked(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    days = days_table(spark, sf)
    market = materialise(ranking.market_context(index_series(spark, sf, COMPOSITE, days=days), rate_series(spark, sf)))
    blocked = ranking.panel_in_blocks(bars(spark, sf, days=days), market, rows=200)
    discard(days)  # everything above reads tables made from it
    return blocked


@query
def panel_blocks(spark: SparkSession, sf: str) -> DataFrame:
    return neat(_blocked(spark, sf)["panel"].select(*KEYS, *[f"{c}_n" for c in SCALED_FEATURES]))


@query
def targets_blocks(spark: SparkSession, sf: str) -> DataFrame:
    return neat(_blocked(spark, sf)["targets"])


@query
def panel_chain(spark: SparkSession, sf: str) -> DataFrame:
    """Prune, look back, targets and labelled sets: size and span of every relation of the chain."""
    days = days_table(spark, sf)
    chain = ranking.build(
        materialise(bars(spark, sf, days=days)), index_series(spark, sf, COMPOSITE, days=days), rate_series(spark, sf),
        RankingParams(lookback_days=RECENT_RANKING_DAYS),
    )
    out = None
    for name, rows in chain.items():
        val = F.count_if("is_val") if name in TARGETS else F.lit(0).cast("bigint")
        part = rows.agg(
            F.lit(name).alias("relation"), F.count(F.lit(1)).alias("n"), F.count_distinct("entity").alias("entities"),
            F.min("d").alias("first_day"), F.max("d").alias("last_day"), val.alias("n_val"),
        )
        out = part if out is None else out.unionByName(part)
    return out


@query
def fast_quantiles(spark: SparkSession, sf: str) -> DataFrame:
    """Quartiles of the state of every profile, exact, and whether the rank of the sketched one is within its bound."""
    state = materialise(risk_panel.market_state(index_series(spark, sf)).select("index_profile", *STATE_FEATURES))
    exact = lower_quantiles(state, STATE_FEATURES, by="index_profile")
    quick = sketched_quantiles(state, STATE_FEATURES, by="index_profile")
    probs = {"q1": 0.25, "median": 0.5, "q3": 0.75}
    guess = materialise(quick.unpivot(["index_profile", "feature", "n"], list(probs), "quantile", "guess"))
    values = state.unpivot(["index_profile"], STATE_FEATURES, "feature", "value").where("value IS NOT NULL")
    ranks = values.join(guess, ["index_profile", "feature"]).groupBy("index_profile", "feature", "quantile", "n").agg(
        F.count_if(F.col("value") < F.col("guess")).alias("below"), F.count_if(F.col("value") <= F.col("guess")).alias("upto")
    )
    q = F.create_map(*[F.lit(x) for pair in probs.items() for x in pair])[F.col("quantile")]
    slack = rank_error() + 1 / F.col("n")
    within = (F.col("below") / F.col("n") <= q + slack) & (F.col("upto") / F.col("n") >= q - slack)
    long = exact.unpivot(["index_profile", "feature"], list(probs), "quantile", "value")
    joined = long.join(ranks.select("index_profile", "feature", "quantile", within.alias("within")), ["index_profile", "feature", "quantile"])
    return neat(joined)
