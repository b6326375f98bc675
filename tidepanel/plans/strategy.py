"""Decisions to equity: weights, cohorts and the account of each strategy."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidepanel.config import BookParams
from tidepanel.operators import backtest as bt
from tidepanel.operators.portfolio import capped_rank_weights, decisions, known_states
from tidepanel.session import materialise


def walk_forward(
    prices: DataFrame, alpha: DataFrame, risk: DataFrame, params: BookParams = BookParams()
) -> dict[str, DataFrame]:
    """``alpha``: (strategy, d, entity, alpha_score); ``risk``: one row per d with risk_state and risk_exposure.

    A risk row with a state that the exposure map doesn't know ends the job. Only the top names of a day leave the alpha relation, so everything after the weights is small; the filled
    cohorts are written once because returns and marks both read them.
    """
    weights = capped_rank_weights(decisions(alpha, known_states(risk, params), params=params), by=[bt.STRATEGY, bt.DAY], params=params)
    days = materialise(bt.trading_days(alpha, hold=params.hold))
    filled = materialise(
        bt.fills(prices, weights.select(bt.STRATEGY, bt.DAY, bt.NAME, "target_weight"), days)
    )
    cohorts = bt.cohort_returns(filled, cost=params.cost)
    marks = bt.cohort_marks(filled, prices, cost=params.cost)
    curve = bt.with_drawdown(bt.equity_curve(days, cohorts, marks, params=params))
    return {"weights": weights, "cohorts": cohorts, "marks": marks, "equity": curve}


def latest_portfolio(weights: DataFrame, alpha: DataFrame) -> DataFrame:
    """Target weights of each strategy's newest scored day; none where that day allows no position."""
    newest = alpha.groupBy(bt.STRATEGY).agg(F.max(bt.DAY).alias(bt.DAY))
    return weights.join(newest, [bt.STRATEGY, bt.DAY]).select(bt.STRATEGY, bt.DAY, bt.NAME, "alpha_score", "rank", "target_weight")
