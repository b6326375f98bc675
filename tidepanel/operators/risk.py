"""Risk state of a market series and the exposure that follows from model scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidepanel.config import RiskParams
from tidepanel.functions.scalar import ColumnOrName, as_col, clip, ratio
from tidepanel.operators.windows import Keys, rolling_quantile, timeline


def crash_flag(ret: ColumnOrName, vol: ColumnOrName, vol_limit: ColumnOrName, threshold: float) -> Column:
    """A deep fall or an extreme volatility; unknown parts count as no."""
    fall, extreme = as_col(ret) <= threshold, as_col(vol) >= as_col(vol_limit)
    return F.coalesce(fall, F.lit(False)) | F.coalesce(extreme, F.lit(False))


def risk_state(
    df: DataFrame, *, prob: str = "risk_prob", ret: str = "ret_5d", vol: str = "vol_10d", entity: Keys = "entity",
    ts: str = "d", params: RiskParams = RiskParams(),
) -> DataFrame:
    """Add vol_limit, crash_flag, risk_exposure and risk_state to scored days."""
    w = timeline(entity, ts)
    limit = rolling_quantile(vol, params.crash_quantile, params.quantile_rows, params.quantile_min_rows, w)
    flagged = df.withColumn("vol_limit", limit).withColumn(
        "crash_flag", crash_flag(ret, vol, "vol_limit", params.crash_threshold)
    )
    exposed = flagged.withColumn("risk_exposure", F.when(F.col("crash_flag"), F.lit(0.0)).otherwise(clip(prob, 0.0, 1.0)))
    state = (
        F.when(F.col("risk_exposure") >= params.on_at, "RISK_ON")
        .when(F.col("risk_exposure") <= params.off_at, "RISK_OFF")
        .otherwise("NEUTRAL")
    )
    return exposed.withColumn("risk_state", state)


def recommended_exposure(
    df: DataFrame, *, crash: str = "crash_prob", bear: str = "bear_prob", predicted_vol: str = "predicted_vol",
    realised_vol: str = "realised_vol",
) -> DataFrame:
    """Add volatility_ratio and recommended_exposure, in [0.1, 1]."""
    vr = clip(ratio(predicted_vol, F.col(realised_vol) + F.lit(1e-8)), 0.5, 3.0)
    out = df.withColumn("volatility_ratio", vr)
    exposure = (
        (1 - 0.7 * clip(crash, 0.0, 1.0)) * (1 - 0.4 * F.col(bear)) * clip(ratio(F.lit(1.0), "volatility_ratio"), 0.3, 1.2)
    )
    return out.withColumn("recommended_exposure", clip(exposure, 0.1, 1.0))
