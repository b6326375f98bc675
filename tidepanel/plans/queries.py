"""Named queries: every operator over the whole driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidepanel.config import (
    ALPHA_FEATURES, BookParams, FRAMES, HORIZONS, RATE, SCALED_FEATURES, STATE_FEATURES, TARGETS, RankingParams,
)
from tidepanel.functions.flow import book_ratios, flow_ratios, price_action
from tidepanel.functions.scalar import calendar_cycles, empty_to_null, normalised, repaired_open
from tidepanel.models.boosted import BoostParams
from tidepanel.models.huber import fit_huber
from tidepanel.models.pairwise import ranked_pairs
from tidepanel.operators import backtest as bt, quality as dq
from tidepanel.operators.cross import (
    combined_score, ndcg, percent_ranks, robust_delta, score_summary, top_k,
)
from tidepanel.operators.ingest import insert_ignore, missing_days, nulls_to_zero, referenced, upsert_first
from tidepanel.operators.normalise import zscore_past
from tidepanel.operators.order import dense_ids, null_safe_join
from tidepanel.operators.portfolio import capped_rank_weights, decisions, rank_weights, unknown_states
from tidepanel.operators.relate import current_entities, lookback, with_context
from tidepanel.operators.risk import recommended_exposure, risk_state
from tidepanel.operators.scaling import lower_quantiles
from tidepanel.operators.sequences import latest_sequences, sequences
from tidepanel.operators.split import split_by_dates, split_entity_tail, split_rows, train
from tidepanel.operators.targets import forward_trade_return, up_label
from tidepanel.operators.windows import (
    active_over, after_warmup, beta, change, drop_from_high, lagged_return, relative_volume, rolling, rolling_quantile,
    timeline, trailing, with_enough_history,
)
from tidepanel.plans import daily_store as store, fitted, ranking_panel as ranking, risk_panel, strategy
from tidepanel.session import bucketed, condensed, copartitioned, materialise
from tidepanel.sources.adapters import (
    COMPOSITE, bars, days_table, index_series, lots, predictions, rate_series, supplier_days, table,
)

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
KEYS = ("entity", "d")


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__.rstrip("_")] = fn
    return fn


PRICES = {"open_price", "close", "high", "low", "bid", "offer", "previous", "target"}


def neat(df: DataFrame) -> DataFrame:
    """Doubles to 6 decimals (prices, which often end exactly half way, to 9) without negative zero; integers to bigint."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DoubleType):
            c = F.round(c, 9 if f.name in PRICES else 6) + F.lit(0.0)
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType)):
            c = c.cast("bigint")
        out.append(c.alias(f.name))
    return df.select(*out)


# ---- bars, returns, rolling statistics --------------------------------------


@query
def bars_daily(spark: SparkSession, sf: str) -> DataFrame:
    return neat(bars(spark, sf))


@query
def simple_returns(spark: SparkSession, sf: str) -> DataFrame:
    return neat(lagged_return(bars(spark, sf).select(*KEYS, "close"), "close", (1, 3, 5)))


@query
def log_returns(spark: SparkSession, sf: str) -> DataFrame:
    return neat(lagged_return(bars(spark, sf).select(*KEYS, "close"), "close", HORIZONS, log=True))


@query
def rolling_std_pop(spark: SparkSession, sf: str) -> DataFrame:
    rets = lagged_return(bars(spark, sf).select(*KEYS, "close"), "close", (1,))
    return neat(rolling(rets, {f"volatility_{n}d": ("std_pop", "ret_1d", 1 - n, 0) for n in (5, 10)}).drop("close"))


@query
def rolling_std_samp(spark: SparkSession, sf: str) -> DataFrame:
    w = timeline()
    rets = lagged_return(bars(spark, sf).select(*KEYS, "close"), "close", (1,), log=True)
    vols = {f"vol_{n}d": F.ln(trailing("std_samp", "ret_1d", n, w) + F.lit(1e-8)) for n in FRAMES}
    return neat(rets.withColumns(vols).drop("close"))


@query
def rolling_mean_spread(spark: SparkSession, sf: str) -> DataFrame:
    w = timeline("index_profile")
    rets = index_series(spark, sf).select("index_profile", "d", "close", change("close", 1, w).alias("ret_1d"))
    return neat(
        rets.select(
            "index_profile",
            "d",
            *[trailing("mean", "close", n, w).alias(f"ma_{n}") for n in FRAMES],
            (trailing("mean", "close", 20, w) - trailing("mean", "close", 60, w)).alias("trend"),
            *[(F.col("ret_1d") - trailing("mean", "ret_1d", n, w)).alias(f"mr_{n}d") for n in FRAMES],
        )
    )


@query
def rolling_drawdown(spark: SparkSession, sf: str) -> DataFrame:
    w = timeline()
    return neat(bars(spark, sf).select(*KEYS, *[drop_from_high("close", n, w).alias(f"drawdown_{n}d") for n in FRAMES]))


@query
def peak_drawdown(spark: SparkSession, sf: str) -> DataFrame:
    w = timeline("index_profile")
    return neat(index_series(spark, sf).select("index_profile", "d", drop_from_high("close", None, w).alias("drawdown")))


@query
def activity_flags(spark: SparkSession, sf: str) -> DataFrame:
    w = timeline()
    booked = F.col("bid_volume") + F.col("offer_volume")
    flags = [active_over(booked, n, w).alias(f"is_active_{n}d") for n in (5, 20, 60)]
    return neat(bars(spark, sf).select(*KEYS, book_ratios()["is_active"].alias("is_active"), *flags))


@query
def log_rel_volume(spark: SparkSession, sf: str) -> DataFrame:
    return neat(bars(spark, sf).select(*KEYS, relative_volume("volume", 10, timeline()).alias("volume_ratio_10d")))


@query
def calendar_cycles_(spark: SparkSession, sf: str) -> DataFrame:
    days = table(spark, sf, "lineitem").select(F.to_date("l_shipdate").alias("d")).distinct()
    return neat(days.select("d", *[c.alias(n) for n, c in calendar_cycles("d").items()]))


@query
def flow_ratios_(spark: SparkSession, sf: str) -> DataFrame:
    exprs = book_ratios() | price_action() | flow_ratios()
    return neat(bars(spark, sf, "nation").select(*KEYS, *[c.alias(n) for n, c in exprs.items()]))


@query
def gap_repair(spark: SparkSession, sf: str) -> DataFrame:
    fixed = bars(spark, sf, "nation").withColumn("open_price", repaired_open("open_price", "previous"))
    gap_open = F.try_divide(F.col("open_price"), F.lag("close", 1).over(timeline())) - 1
    return neat(fixed.select(*KEYS, "open_price", price_action()["gap"].alias("gap"), gap_open.alias("gap_open")))


# ---- market context and joins ------------------------------------------------


def _market(spark: SparkSession, sf: str) -> DataFrame:
    return ranking.market_context(index_series(spark, sf, COMPOSITE), rate_series(spark, sf))


def _joined(spark: SparkSession, sf: str) -> DataFrame:
    return ranking.panel_base(ranking.entity_features(bars(spark, sf)), _market(spark, sf))


def _base(spark: SparkSession, sf: str) -> DataFrame:
    """The joined feature panel, written once where targets and normalisation both read it."""
    return materialise(_joined(spark, sf))


@query
def market_context(spark: SparkSession, sf: str) -> DataFrame:
    return neat(_market(spark, sf))


@query
def panel_with_market(spark: SparkSession, sf: str) -> DataFrame:
    w = timeline()
    rets = bars(spark, sf).select(*KEYS, "close", change("close", 1, w).alias("ret_1d"))
    market = _market(spark, sf).select("d", "idx_ret_1d", "idx_close_pos", f"{RATE}_ret_1d")
    return neat(with_context(rets, market))


@query
def excess_returns(spark: SparkSession, sf: str) -> DataFrame:
    features = ranking.entity_features(bars(spark, sf)).select(*KEYS, *[f"ret_{k}d" for k in HORIZONS])
    market = _market(spark, sf).select("d", *[f"idx_ret_{k}d" for k in HORIZONS])
    return neat(ranking.panel_base(features, market).select(*KEYS, *[f"excess_ret_{k}d" for k in HORIZONS]))


@query
def left_join_index(spark: SparkSession, sf: str) -> DataFrame:
    rets = lagged_return(bars(spark, sf).select(*KEYS, "close"), "close", (1, 3))
    return neat(store.with_index(rets, store.index_returns(index_series(spark, sf, COMPOSITE))).drop("close"))


@query
def rolling_beta(spark: SparkSession, sf: str) -> DataFrame:
    rets = lagged_return(bars(spark, sf).select(*KEYS, "close"), "close", (1, 3))
    joined = store.with_index(rets, store.index_returns(index_series(spark, sf, COMPOSITE)))
    return neat(joined.select(*KEYS, beta("ret_1d", "index_ret_1d", 60, timeline()).alias("beta_60d")))


# ---- lookback, pruning, warm-up ----------------------------------------------


@query
def last_n_dates(spark: SparkSession, sf: str) -> DataFrame:
    return neat(lookback(materialise(bars(spark, sf).select(*KEYS, "close")), 500))


@query
def stale_prune(spark: SparkSession, sf: str) -> DataFrame:
    return neat(current_entities(materialise(bars(spark, sf).select(*KEYS, "close"))))


@query
def min_history(spark: SparkSession, sf: str) -> DataFrame:
    return neat(with_enough_history(bars(spark, sf).select(*KEYS), 0.2, 64))


@query
def drop_warmup(spark: SparkSession, sf: str) -> DataFrame:
    rets = lagged_return(bars(spark, sf).select(*KEYS, "close"), "close", (1, 60))
    return neat(after_warmup(rets.dropna(subset=["ret_60d"]), 60).drop("close"))


# ---- normalisation, targets, labels ------------------------------------------


@query
def zscore_past_(spark: SparkSession, sf: str) -> DataFrame:
    return neat(ranking.normalised_panel(_joined(spark, sf)).select(*KEYS, *[f"{c}_n" for c in SCALED_FEATURES]))


def _slim_base(spark: SparkSession, sf: str) -> DataFrame:
    """Only what the targets read."""
    features = ranking.entity_features(bars(spark, sf)).select(*KEYS, "close", "ret_1d")
    return materialise(with_context(features, _market(spark, sf).select("d")))


@query
def forward_targets(spark: SparkSession, sf: str) -> DataFrame:
    from tidepanel.operators.targets import forward_targets as ahead

    return neat(ahead(_slim_base(spark, sf)).select(*KEYS, *TARGETS))


@query
def zscore_cross(spark: SparkSession, sf: str) -> DataFrame:
    return neat(ranking.targets(_slim_base(spark, sf)))


@query
def class5(spark: SparkSession, sf: str) -> DataFrame:
    """Panel and targets come from tables bucketed by entity, so that their join and the split need no exchange."""
    copartitioned(spark)
    base = _slim_base(spark, sf)
    panel = bucketed(zscore_past(base, ["ret_1d"], keep=KEYS, full_only=True), "entity", ["d"])
    labelled = ranking.labelled(panel, bucketed(ranking.targets(base), "entity", ["d"]), "future_return")
    return neat(labelled.select(*KEYS, "ret_1d_n", "future_return", "future_return_class"))


def _features(spark: SparkSession, sf: str) -> DataFrame:
    """The daily feature store; bars and index come from one scan of the lots. The index is a table, so that its true size
    tells Catalyst how to join it: as an estimate of all days it would be shuffled with all features beyond a few MB of lots."""
    days = days_table(spark, sf)
    index = materialise(index_series(spark, sf, COMPOSITE, days=days))
    return store.feature_store(bars(spark, sf, days=days), index)


_LABELLED = (*KEYS, "fwd_ret_3d", *ALPHA_FEATURES)
_SIGNALS = ("ret_5d", "ret_1d", "foreign_flow_ratio")


def _store(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    """The columns of the store that a query reads, written once."""
    return materialise(_features(spark, sf).select(*dict.fromkeys([*KEYS, *columns])))


@query
def feature_store_daily(spark: SparkSession, sf: str) -> DataFrame:
    features = _features(spark, sf)
    return neat(features.select(*KEYS, *ALPHA_FEATURES, "rel_ret_3d", "beta_60d", "fwd_ret_3d", "fwd_ret_5d"))


@query
def ntile_label(spark: SparkSession, sf: str) -> DataFrame:
    return neat(store.alpha_dataset(_store(spark, sf, "fwd_ret_3d"), features=()).select(*KEYS, "label"))


@query
def regime_label(spark: SparkSession, sf: str) -> DataFrame:
    state = risk_panel.market_state(index_series(spark, sf))
    return neat(state.select("index_profile", "d", "trend", "vol_20", "drawdown", "volume_change", "regime"))


@query
def crash_label(spark: SparkSession, sf: str) -> DataFrame:
    series = index_series(spark, sf)
    crash = risk_panel.market_state(series).select("index_profile", "d", "crash", "future_vol")
    up = series.select("index_profile", "d", up_label("close", 3, timeline("index_profile")).alias("risk_on_label"))
    return neat(crash.join(up, ["index_profile", "d"]))


@query
def risk_dataset(spark: SparkSession, sf: str) -> DataFrame:
    return neat(store.risk_dataset(index_series(spark, sf, COMPOSITE)))


@query
def fwd_ret_compat(spark: SparkSession, sf: str) -> DataFrame:
    w = timeline()
    return neat(
        bars(spark, sf).select(
            *KEYS,
            *[forward_trade_return(k, w, compat=True).alias(f"compat_{k}d") for k in (3, 5)],
            *[forward_trade_return(k, w).alias(f"fwd_ret_{k}d") for k in (3, 5)],
        )
    )


# ---- splits, scaling, sequences ----------------------------------------------


@query
def split_dates(spark: SparkSession, sf: str) -> DataFrame:
    return neat(split_by_dates(materialise(bars(spark, sf).select(*KEYS, "close")), 0.8))


@query
def split_entity_tail_(spark: SparkSession, sf: str) -> DataFrame:
    return neat(split_entity_tail(bars(spark, sf).select(*KEYS), 0.2))


def _state(spark: SparkSession, sf: str) -> DataFrame:
    return split_rows(risk_panel.market_state(index_series(spark, sf, COMPOSITE)), 0.8, entity="index_profile")


@query
def split_rows_(spark: SparkSession, sf: str) -> DataFrame:
    return neat(_state(spark, sf).select("d", "row_idx", "is_val", "ret_1d"))


@query
def lower_quantiles_(spark: SparkSession, sf: str) -> DataFrame:
    return neat(lower_quantiles(train(_state(spark, sf)), STATE_FEATURES))


@query
def robust_scale(spark: SparkSession, sf: str) -> DataFrame:
    scaled = risk_panel.scaled_state(index_series(spark, sf, COMPOSITE))
    return neat(scaled.select("d", "is_val", *STATE_FEATURES, "crash", "regime"))


_SEQ = ["hl_range", "order_imbalance", "log_close"]


def _steps(spark: SparkSession, sf: str) -> DataFrame:
    return bars(spark, sf).select(
        *KEYS, "close", flow_ratios()["hl_range"].alias("hl_range"), book_ratios()["order_imbalance"].alias("order_imbalance"),
        F.ln("close").alias("log_close"),
    )


def _sequence_total(c: str):
    return F.aggregate(F.flatten(c), F.lit(0.0), lambda acc, x: acc + x)


@query
def seq_windows(spark: SparkSession, sf: str) -> DataFrame:
    seqs = sequences(_steps(spark, sf), _SEQ, "close")
    return neat(
        seqs.select(
            *KEYS,
            F.size("sequence").alias("steps"),
            F.element_at("sequence", 1)[2].alias("oldest_log_close"),
            F.element_at("sequence", -1)[1].alias("newest_imbalance"),
            _sequence_total("sequence").alias("total"),
            F.col("close").alias("target"),
        )
    )


@query
def seq_latest(spark: SparkSession, sf: str) -> DataFrame:
    seqs = latest_sequences(_steps(spark, sf), _SEQ)
    return neat(
        seqs.select(
            *KEYS,
            F.size("sequence").alias("steps"),
            F.element_at("sequence", 1)[2].alias("oldest_log_close"),
            _sequence_total("sequence").alias("total"),
            *[F.col("latest")[i].alias(f"latest_{c}") for i, c in enumerate(_SEQ)],
        )
    )


# ---- ranks, risk, portfolio ----------------------------------------------------


@query
def pct_rank_avg(spark: SparkSession, sf: str) -> DataFrame:
    preds = predictions(spark, sf)
    ranked = percent_ranks(preds, "pred", {"rank_up": True, "rank_down": False}, by=["run", "target", "model"])
    ids = materialise(dense_ids(preds, "entity", out="entity_id"))
    return neat(ranked.join(ids, "entity"))


@query
def combined_score_(spark: SparkSession, sf: str) -> DataFrame:
    scores = combined_score(predictions(spark, sf), ascending={"return": True, "vol": False, "drawdown": False})
    return neat(score_summary(scores, runs=[0, 1, 2, 3]))


@query
def ndcg_at_k(spark: SparkSession, sf: str) -> DataFrame:
    scored = materialise(store.alpha_dataset(_store(spark, sf, "fwd_ret_3d", "ret_5d"), features=("ret_5d",)).select(*KEYS, "ret_5d", "label"))
    return neat(ndcg(scored, "ret_5d", "label"))


@query
def rolling_quantile_(spark: SparkSession, sf: str) -> DataFrame:
    w = timeline("index_profile")
    features = store.series_features(index_series(spark, sf))
    return neat(features.select("index_profile", "d", "vol_10d", rolling_quantile("vol_10d", 0.95, 252, 60, w).alias("vol_limit")))


def _risk(spark: SparkSession, sf: str, profile: str | None = None, *, days: DataFrame | None = None) -> DataFrame:
    """Risk state per (series, day), from a logistic score of the three-day return."""
    features = store.series_features(index_series(spark, sf, profile, days=days)).dropna(subset=["ret_5d", "vol_10d"])
    scored = features.withColumn("risk_prob", 1 / (1 + F.exp(-50 * F.col("ret_3d"))))
    return risk_state(scored, entity="index_profile")


@query
def risk_state_(spark: SparkSession, sf: str) -> DataFrame:
    return neat(_risk(spark, sf).select("index_profile", "d", "risk_prob", "crash_flag", "risk_exposure", "risk_state"))


@query
def exposure_rule(spark: SparkSession, sf: str) -> DataFrame:
    features = store.series_features(index_series(spark, sf)).dropna(subset=["ret_5d", "vol_10d"])
    scored = features.select(
        "index_profile",
        "d",
        (1 / (1 + F.exp(50 * F.col("ret_1d")))).alias("crash_prob"),
        normalised(F.array(F.exp(F.col("ret_5d")), F.lit(1.0), F.exp(-F.col("ret_5d")))).alias("_p"),
        F.col("vol_5d").alias("predicted_vol"),
        F.col("vol_10d").alias("realised_vol"),
    ).withColumn("bear_prob", F.element_at("_p", 3))
    return neat(
        recommended_exposure(scored).select(
            "index_profile", "d", "crash_prob", "bear_prob", "volatility_ratio", "recommended_exposure"
        )
    )


@query
def mad_delta(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("user_id", "event_type", "value")
    fitted_means = materialise(events.groupBy("user_id").agg(F.avg("value").alias("pred")))
    residuals = events.join(fitted_means, "user_id").select("event_type", (F.col("value") - F.col("pred")).alias("residual"))
    errors = residuals.groupBy("event_type").agg(F.avg(F.abs("residual")).alias("mae"))
    return neat(null_safe_join(errors, robust_delta(residuals, "residual", by="event_type"), ["event_type"]))


def _signals(rows: DataFrame) -> DataFrame:
    """Three strategies that score the same panel."""
    signals = {"momentum": F.col("ret_5d"), "reversal": -F.col("ret_1d"), "flow": F.col("foreign_flow_ratio")}
    wide = rows.select(*KEYS, *[c.alias(n) for n, c in signals.items()])
    return wide.unpivot(list(KEYS), list(signals), "strategy", "alpha_score")


def _daily_risk(spark: SparkSession, sf: str) -> DataFrame:
    return materialise(_risk(spark, sf, COMPOSITE).select("d", "risk_state", "risk_exposure"))


@query
def topk_weights(spark: SparkSession, sf: str) -> DataFrame:
    chosen = decisions(_signals(_store(spark, sf, *_SIGNALS)), _daily_risk(spark, sf))
    return neat(rank_weights(chosen, by=["strategy", "d"]).select("strategy", *KEYS, "alpha_score", "rank", "raw_weight"))


@query
def capped_weights(spark: SparkSession, sf: str) -> DataFrame:
    chosen = decisions(_signals(_store(spark, sf, *_SIGNALS)), _daily_risk(spark, sf))
    return neat(capped_rank_weights(chosen, by=["strategy", "d"]).select("strategy", *KEYS, "rank", "target_weight"))


def _walk(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    rows = _store(spark, sf, "open_price", "close", *_SIGNALS)
    return strategy.walk_forward(rows.select(*KEYS, "open_price", "close"), _signals(rows), _daily_risk(spark, sf))


@query
def cohort_returns(spark: SparkSession, sf: str) -> DataFrame:
    return neat(_walk(spark, sf)["cohorts"])


@query
def cohort_marks(spark: SparkSession, sf: str) -> DataFrame:
    return neat(_walk(spark, sf)["marks"])


@query
def equity_curve(spark: SparkSession, sf: str) -> DataFrame:
    return neat(_walk(spark, sf)["equity"].drop("drawdown"))


@query
def equity_drawdown(spark: SparkSession, sf: str) -> DataFrame:
    return neat(_walk(spark, sf)["equity"].drop("equity"))


@query
def perf_summary(spark: SparkSession, sf: str) -> DataFrame:
    return neat(bt.performance(_walk(spark, sf)["equity"]))


# ---- ingest and quality ----------------------------------------------------------


def _order_days(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("d"))


@query
def missing_days_(spark: SparkSession, sf: str) -> DataFrame:
    return missing_days(_order_days(spark, sf))


def _stored_orders(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    return orders.where(F.col("o_orderstatus") == "F"), orders


@query
def insert_ignore_(spark: SparkSession, sf: str) -> DataFrame:
    existing, orders = _stored_orders(spark, sf)
    dearer = orders.withColumn("o_totalprice", F.col("o_totalprice") * 2)
    return neat(insert_ignore(existing, dearer.unionByName(orders), "o_orderkey", "o_totalprice"))


@query
def upsert_first_(spark: SparkSession, sf: str) -> DataFrame:
    existing, orders = _stored_orders(spark, sf)
    return neat(upsert_first(existing, orders.withColumn("o_totalprice", F.col("o_totalprice") * 2), "o_orderkey"))


@query
def fk_semi(spark: SparkSession, sf: str) -> DataFrame:
    _, orders = _stored_orders(spark, sf)
    solvent = table(spark, sf, "customer").where(F.col("c_acctbal") >= 0).select(F.col("c_custkey").alias("o_custkey"))
    return neat(referenced(orders, solvent, "o_custkey"))


@query
def null_coerce(spark: SparkSession, sf: str) -> DataFrame:
    _, orders = _stored_orders(spark, sf)
    solvent = table(spark, sf, "customer").where(F.col("c_acctbal") >= 0)
    joined = orders.join(solvent.select(F.col("c_custkey").alias("o_custkey"), "c_acctbal"), "o_custkey", "left")
    blanked = joined.withColumn("o_orderstatus", empty_to_null(F.regexp_replace("o_orderstatus", "P", "")))
    return neat(nulls_to_zero(blanked, ["c_acctbal"]))


@query
def quality_report(spark: SparkSession, sf: str) -> DataFrame:
    """Lots are read once; row checks are counted while their relations are written."""
    trades = materialise(lots(spark, sf))
    days = materialise(supplier_days(trades))
    _, of_risk = dq.watched(
        _risk(spark, sf, days=days).select("risk_exposure", "risk_state", "vol_limit"),
        {
            "exposure_bounds": dq.outside("risk_exposure", 0.0, 1.0),
            "known_state": dq.not_among("risk_state", ["RISK_ON", "NEUTRAL", "RISK_OFF"]),
            "quantile_present": dq.not_null("vol_limit"),
        },
    )
    rows, of_bars = dq.watched(
        bars(spark, sf, days=days).select(*KEYS, "close", "volume", "foreign_buy"),
        {"flow_within_volume": F.col("foreign_buy") >= F.col("volume"), "positive_close": F.col("close") <= 0},
    )
    return neat(
        dq.report(
            of_risk.withColumn("check", F.concat(F.lit("risk."), "check")),
            of_bars.withColumn("check", F.concat(F.lit("bars."), "check")),
            dq.group_size_check(rows, "d", 20, name="bars.group_size"),
            dq.unique_check(rows, KEYS, name="bars.unique_key"),
            dq.unique_check(trades.select("ord.l_orderkey", "ord.l_linenumber"), ["l_orderkey", "l_linenumber"], name="lineitem.unique_key"),
        )
    )


@query
def json_props(spark: SparkSession, sf: str) -> DataFrame:
    parsed = table(spark, sf, "events").select("event_type", F.from_json("props", "k int")["k"].cast("bigint").alias("k"))
    return parsed.groupBy("event_type").agg(
        F.count("k").alias("n"), F.sum("k").alias("sum_k"), F.min("k").alias("min_k"), F.max("k").alias("max_k")
    )


# ---- fitted models ------------------------------------------------------------------


@query
def risk_gbt(spark: SparkSession, sf: str) -> DataFrame:
    return fitted.risk_on(store.risk_dataset(index_series(spark, sf, COMPOSITE)))["scores"]


@query
def risk_gbt_importance(spark: SparkSession, sf: str) -> DataFrame:
    return fitted.risk_on(store.risk_dataset(index_series(spark, sf, COMPOSITE)))["importance"]


@query
def rank_gbt(spark: SparkSession, sf: str) -> DataFrame:
    return fitted.ranker(_ranking_rows(spark, sf))["scores"]


def _ranking_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The table of a ranking fit; the store and its parts are deleted once it is written."""
    return condensed(spark, lambda: fitted.ranking_rows(store.alpha_dataset(_store(spark, sf, *_LABELLED))))


def _model_rows(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """The rows of all fits, and those of the whole panel, both from one table; bars are read twice, once for the targets alone."""

    def made() -> DataFrame:
        days = days_table(spark, sf)
        market = materialise(ranking.market_context(index_series(spark, sf, COMPOSITE, days=days), rate_series(spark, sf)))
        entities = ranking.entity_features(bars(spark, sf, days=days))
        slim = with_context(entities.select(*KEYS, "close", "ret_1d"), market.select("d"))
        return fitted.rows_of_models(ranking.labelled_panel(ranking.panel_base(entities, market), slim))

    panel = condensed(spark, made)
    return panel.where("known").drop("known"), panel


@query
def rank_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return fitted.pair_ranker(_ranking_rows(spark, sf))["scores"]


@query
def ranking_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs at fixed offsets in the order of a day, counted and weighted per day; a ranker learns from all pairs."""
    pairs = ranked_pairs(store.alpha_dataset(_store(spark, sf, "fwd_ret_3d"), features=()), "label")
    return neat(pairs.groupBy("d").agg(F.count(F.lit(1)).alias("pairs"), F.sum("weight").alias("weight"), F.max("low").alias("last")))


@query
def huber_linear(spark: SparkSession, sf: str) -> DataFrame:
    return fitted.huber(_model_rows(spark, sf)[0], "future_return")["scores"]


@query
def huber_at_threshold(spark: SparkSession, sf: str) -> DataFrame:
    """Price against quantity at three thresholds: the coefficients, and the threshold in effect."""
    trades = materialise(table(spark, sf, "lineitem").select(
        array_to_vector(F.array("l_quantity")).alias("features"), (F.col("l_extendedprice") / 1e4).alias("y")
    ))
    rows = []
    for asked in (0.5, 2.0, 10.0):
        fit = fit_huber(trades, "y", asked, max_iter=80, tol=1e-9)
        rows.append((asked, fit.delta, float(fit.model.coefficients[0]), float(fit.model.intercept), fit.settled))
    return neat(spark.createDataFrame(rows, "asked double, in_effect double, slope double, intercept double, settled boolean"))


@query
def ensemble_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Four runs of both models on the three targets. Trees make the default's total step, 10,000 rounds of 1e-4, in 40
    rounds of 2.5e-2."""
    rows, panel = _model_rows(spark, sf)
    boost = BoostParams(max_rounds=40, learning_rate=2.5e-2, stop_after=20, rounds_per_fit=20)
    return fitted.ensemble(rows, panel, params=boost)["scores"]


@query
def model_errors(spark: SparkSession, sf: str) -> DataFrame:
    """Validation errors of every target, model and run against the constant; the trees take all rounds that they may."""
    rows, panel = _model_rows(spark, sf)
    fits = fitted.ensemble(rows, panel, params=BoostParams())
    found = fitted.model_errors(rows, fits["errors"])
    better = (F.col("mae") <= F.col("base_mae") * F.when(F.col("model") == "tree", 1.0).otherwise(1.05)).alias("no_worse")
    return neat(found.select("target", "model", "run", "n_train", "n_val", "base_mae", better, (F.col("delta") > 0).alias("has_threshold")))


def _fitted_walk(spark: SparkSession, sf: str) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Fitted market risk -> risk states -> fitted ranking -> weights and backtest."""
    days = days_table(spark, sf)
    index = materialise(index_series(spark, sf, COMPOSITE, days=days))
    rows = materialise(store.feature_store(bars(spark, sf, days=days), index).select(*dict.fromkeys([*_LABELLED, "open_price", "close"])))
    fitted_risk = fitted.risk_on(store.risk_dataset(index))["scores"]
    risk = materialise(risk_state(fitted_risk.withColumn("index_profile", F.lit(COMPOSITE)), entity="index_profile"))
    scores = fitted.pair_ranker(store.alpha_dataset(rows))["scores"]
    alpha = materialise(scores.select(F.lit("fitted").alias("strategy"), *KEYS, "alpha_score"))
    walk = strategy.walk_forward(rows.select(*KEYS, "open_price", "close"), alpha, risk.select("d", "risk_state", "risk_exposure"))
    return alpha, walk | {"risk": risk}


@query
def fitted_backtest(spark: SparkSession, sf: str) -> DataFrame:
    return neat(bt.performance(_fitted_walk(spark, sf)[1]["equity"]))


@query
def latest_portfolio(spark: SparkSession, sf: str) -> DataFrame:
    alpha, walk = _fitted_walk(spark, sf)
    return neat(strategy.latest_portfolio(walk["weights"], alpha))


@query
def portfolio_checks(spark: SparkSession, sf: str) -> DataFrame:
    """What must hold for the weights and the account of the fitted chain, whatever was fitted."""
    alpha, walk = _fitted_walk(spark, sf)
    weights = materialise(walk["weights"].select(*KEYS, "exposure", "names", "target_weight"))
    daily = materialise(weights.groupBy("d").agg(F.sum("target_weight").alias("held"), F.max("exposure").alias("exposure"), F.count(F.lit(1)).alias("names")))
    params = BookParams()
    return neat(
        dq.report(
            dq.row_checks(weights, {"weight_bounds": dq.outside("target_weight", 0.0, params.cap, 1e-9)}).where("check <> 'non_empty'"),
            dq.row_checks(
                daily,
                {
                    "exposure_bound": ~(F.col("held") <= F.col("exposure") + 1e-9), "position_bound": F.col("names") > params.max_positions,
                    "allowed_days": dq.outside("exposure", 0.0, 1.0),
                },
            ),
            dq.unique_check(weights, KEYS, name="one_weight"),
            dq.unique_check(walk["equity"], ["strategy", "d"], name="one_equity"),
            dq.row_checks(walk["equity"], {"drawdown_bounds": dq.outside("drawdown", -1.0, 0.0), "positive_equity": ~(F.col("equity") > 0)}).where("check <> 'non_empty'"),
            unknown_states(walk["risk"]).agg(F.count(F.lit(1)).alias("violations")).select(F.lit("known_states").alias("check"), "violations"),
        )
    )


@query
def market_models(spark: SparkSession, sf: str) -> DataFrame:
    return fitted.market_models(risk_panel.scaled_state(index_series(spark, sf, COMPOSITE)))["scores"]
