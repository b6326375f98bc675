"""Rank-weighted, capped portfolios, one per date (or per strategy and date)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidepanel.config import BookParams
from tidepanel.functions.scalar import clip, lookup
from tidepanel.operators.cross import top_k
from tidepanel.operators.windows import Keys, key_list


def total_exposure(state: str, score: str, params: BookParams = BookParams()) -> Column:
    """Exposure allowed by a state and a score; null for an unknown state, 0 when nothing may be held."""
    base = lookup(state, params.exposure)
    allowed = clip(base * F.col(score), F.lit(0.0), base)
    return F.when((F.col(state) == "RISK_OFF") | (F.col(score) <= 0), F.lit(0.0)).otherwise(allowed)


def decisions(alpha: DataFrame, risk: DataFrame, *, ts: str = "d", params: BookParams = BookParams()) -> DataFrame:
    """Alpha rows of the days that have a risk row allowing a position, with ``exposure``. ``risk``: a row per day.

    A day whose state the exposure map doesn't know allows nothing; ``unknown_states`` counts such days, and
    ``known_states`` rejects them.
    """
    allowed = risk.select(ts, total_exposure("risk_state", "risk_exposure", params).alias("exposure"))
    return alpha.join(allowed.where(F.col("exposure") > 0), ts)


def unknown_states(risk: DataFrame, params: BookParams = BookParams()) -> DataFrame:
    """(risk_state, days): rows of ``risk`` whose state, null included, has no place in the exposure map."""
    states = risk.sparkSession.createDataFrame([(s,) for s in params.exposure], "risk_state string")
    return risk.join(states, "risk_state", "left_anti").groupBy("risk_state").agg(F.count(F.lit(1)).alias("days"))


def known_states(risk: DataFrame, params: BookParams = BookParams()) -> DataFrame:
    """``risk`` as it is; a row with an unknown state ends the job with an error that names the state."""
    message = F.concat(F.lit("unknown risk state: "), F.coalesce("risk_state", F.lit("null")))
    known = F.coalesce(F.col("risk_state").isin(list(params.exposure)), F.lit(False))
    return risk.withColumn("risk_state", F.when(known, F.col("risk_state")).otherwise(F.raise_error(message)))


def rank_weights(
    df: DataFrame, *, score: str = "alpha_score", by: Keys = "d", tie: Keys = "entity", params: BookParams = BookParams()
) -> DataFrame:
    """Top names per group with weights proportional to n, n-1, ... 1 and summing to ``exposure``."""
    best = top_k(df, params.max_positions, score, by=by, tie=tie)
    names = F.count(F.lit(1)).over(Window.partitionBy(*key_list(by)))
    n, r = F.col("names"), F.col("rank")
    return best.withColumn("names", names).withColumn(
        "raw_weight", (n - r + 1) / (n * (n + 1) / 2) * F.col("exposure")
    )


def capped_rank_weights(
    df: DataFrame, *, score: str = "alpha_score", by: Keys = "d", tie: Keys = "entity", params: BookParams = BookParams()
) -> DataFrame:
    """``rank_weights`` with a cap; what the cap cuts off goes to the names below it in proportion to their rank.

    Caps bind from the top, and with m names capped the best free name gets 2 (exposure - m cap) / (n - m + 1). The
    first m for which that stays within the cap (or n) is where the redistribution settles.
    """
    weighted = rank_weights(df, score=score, by=by, tie=tie, params=params)
    n, r, exposure, cap = F.col("names"), F.col("rank"), F.col("exposure"), F.lit(params.cap)
    settled = F.filter(
        F.sequence(F.lit(0), n.cast("int")), lambda m: (m >= n) | (2 * (exposure - m * cap) <= cap * (n - m + 1))
    )
    m = F.col("_m")
    free = (n - m) * (n - m + 1) / 2
    weight = F.when(r <= m, cap).otherwise(F.try_divide((n - r + 1) * (exposure - m * cap), free))
    return weighted.withColumn("_m", F.element_at(settled, 1)).withColumn("target_weight", F.greatest(weight, F.lit(0.0))).drop("_m")
