"""Market-state features, targets and robust scaling of the market risk models."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidepanel.config import CYCLE_FEATURES, STATE_FEATURES, RiskParams
from tidepanel.functions.scalar import calendar_cycles, regime
from tidepanel.operators.scaling import apply_robust, fit_robust
from tidepanel.operators.split import split_rows, train
from tidepanel.operators.targets import crash_label
from tidepanel.operators.windows import after_warmup, change, drop_from_high, timeline, trailing
from tidepanel.session import materialise

SERIES = "index_profile"


def market_state(index: DataFrame, params: RiskParams = RiskParams()) -> DataFrame:
    """Per (series, day): state features, future volatility, next-day crash, regime. All profiles at once."""
    w = timeline(SERIES)
    base = index.select(
        SERIES,
        "d",
        change("close", 1, w).alias("ret_1d"),
        change("close", 5, w).alias("ret_5d"),
        (trailing("mean", "close", 20, w) - trailing("mean", "close", 60, w)).alias("trend"),
        drop_from_high("close", None, w).alias("drawdown"),
        "volume",
        change("volume", 1, w).alias("volume_change"),
        *[c.alias(n) for n, c in calendar_cycles("d").items()],
    )
    vols = base.withColumns({f"vol_{n}": trailing("std_samp", "ret_1d", n, w) for n in (20, 60)})
    full = vols.withColumns(
        {
            "future_vol": F.lead("vol_20", 5).over(w),
            "crash": crash_label("ret_1d", params.crash_threshold, w),
            "regime": regime("trend", "vol_20", vol_bull=params.vol_bull, vol_bear=params.vol_bear),
        }
    )
    known = after_warmup(full, 60, entity=SERIES).where(F.col("future_vol").isNotNull())
    return known.select(SERIES, "d", *STATE_FEATURES, *CYCLE_FEATURES, "future_vol", "crash", "regime")


def scaled_state(index: DataFrame, params: RiskParams = RiskParams(), *, profile: str = "COMPOSITE") -> DataFrame:
    """State rows of one index with ``is_val``, scaled by the quartiles of the training rows.

    ``realised_vol`` keeps the unscaled 60-day volatility.
    """
    rows = split_rows(market_state(index.where(F.col(SERIES) == profile), params), params.train_ratio, entity=SERIES)
    state = materialise(rows.withColumn("realised_vol", F.col("vol_60")))
    return apply_robust(state, fit_robust(train(state), STATE_FEATURES), STATE_FEATURES)
