"""Daily feature store, alpha-ranking labels and the market risk dataset."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidepanel.config import ALPHA_FEATURES, RISK_FEATURES, StoreParams
from tidepanel.functions.flow import flow_ratios
from tidepanel.functions.scalar import ratio, repaired_open
from tidepanel.operators.cross import in_large_groups, ntile_labels
from tidepanel.operators.moments import with_beta
from tidepanel.operators.relate import lookback, with_context
from tidepanel.operators.targets import forward_trade_return, up_label
from tidepanel.operators.windows import change, relative_volume, timeline, trailing

LAGS = (1, 3, 5)


def daily_features(bars: DataFrame) -> DataFrame:
    """Returns, ranges, volatilities, relative volume and flow ratios per bar."""
    w = timeline()
    repaired = bars.withColumn("open_price", repaired_open("open_price", "previous"))
    base = repaired.withColumns(
        {f"ret_{k}d": change("close", k, w) for k in LAGS}
        | {"gap_open": ratio("open_price", F.lag("close", 1).over(w)) - 1}
        | flow_ratios()
    )
    return base.withColumns(
        {f"volatility_{n}d": trailing("std_pop", "ret_1d", n, w) for n in (5, 10)}
        | {"volume_ratio_10d": relative_volume("volume", 10, w)}
    )


def index_returns(index: DataFrame, *, profile: str = "COMPOSITE") -> DataFrame:
    w = timeline("index_profile")
    return index.where(F.col("index_profile") == profile).select(
        "d", change("close", 1, w).alias("index_ret_1d"), change("close", 3, w).alias("index_ret_3d")
    )


def with_index(features: DataFrame, index: DataFrame) -> DataFrame:
    """Left join of the index; days without it keep their rows."""
    joined = with_context(features, index, how="left")
    return joined.withColumn("rel_ret_3d", F.col("ret_3d") - F.col("index_ret_3d"))


def feature_store(bars: DataFrame, index: DataFrame, params: StoreParams = StoreParams(), *, compat: bool = False) -> DataFrame:
    """All daily features and forward returns, complete rows only."""
    if params.lookback_days is not None:
        bars, index = lookback(bars, params.lookback_days), lookback(index, params.lookback_days)
    w = timeline()
    full = with_index(daily_features(bars), index_returns(index)).withColumns(
        {f"fwd_ret_{k}d": forward_trade_return(k, w, compat=compat) for k in (3, 5)}
    )
    full = with_beta(full, "ret_1d", "index_ret_1d", params.beta_rows, out="beta_60d")
    return full.dropna(subset=["ret_5d", "volatility_10d", "beta_60d", "fwd_ret_3d"])


def alpha_dataset(store: DataFrame, params: StoreParams = StoreParams(), *, features: Sequence[str] = tuple(ALPHA_FEATURES)) -> DataFrame:
    """Relevance labels by forward return within each day that has enough names, with the ranking features.

    ``store`` is read several times and should be a table. ``features`` are those that move with the rows.
    """
    known = store.where(F.col("fwd_ret_3d").isNotNull()).select("d", "entity", "fwd_ret_3d", *features)
    return ntile_labels(in_large_groups(known, params.min_names), params.buckets, ["fwd_ret_3d", "entity"]).drop("fwd_ret_3d")


def series_features(index: DataFrame) -> DataFrame:
    """Risk features of every index profile."""
    w = timeline("index_profile")
    base = index.select("index_profile", "d", "close", "volume", *[change("close", k, w).alias(f"ret_{k}d") for k in LAGS])
    return base.withColumns(
        {f"vol_{n}d": trailing("std_pop", "ret_1d", n, w) for n in (5, 10)}
        | {"volume_ratio_10d": relative_volume("volume", 10, w)}
    )


def risk_dataset(index: DataFrame, params: StoreParams = StoreParams(), *, profile: str = "COMPOSITE") -> DataFrame:
    """Risk features of one index with the label "higher three days on", complete rows only."""
    if params.lookback_days is not None:
        index = lookback(index, params.lookback_days)
    w = timeline("index_profile")
    full = series_features(index.where(F.col("index_profile") == profile)).withColumns(
        {"fwd_ret_3d": ratio(F.lead("close", 3).over(w), "close") - 1, "risk_on_label": up_label("close", 3, w)}
    )
    known = full.dropna(subset=["ret_5d", "vol_10d", "fwd_ret_3d"])
    return known.select("index_profile", "d", *RISK_FEATURES, "fwd_ret_3d", "risk_on_label")
