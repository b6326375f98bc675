"""Weights and backtest, the latter against a plain day-by-day account."""

import random
from datetime import date, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidepanel.config import BookParams, EXPOSURE_BY_STATE
from tidepanel.operators import backtest as bt
from tidepanel.operators.portfolio import capped_rank_weights, decisions, rank_weights, total_exposure
from tidepanel.operators.risk import recommended_exposure, risk_state
from tidepanel.plans.strategy import walk_forward

D = date(2024, 1, 1)


def ranked(spark, n, exposure):
    rows = [(i, D, float(n - i), exposure) for i in range(n)]
    return spark.createDataFrame(rows, "entity long, d date, alpha_score double, exposure double")


@pytest.mark.parametrize(
    "n,exposure,want",
    [
        (5, 1.0, [0.30, 0.28, 0.21, 0.14, 0.07]),
        (4, 1.0, [0.30, 0.30, 0.266667, 0.133333]),
        (3, 1.0, [0.30] * 3),
        (2, 1.0, [0.30] * 2),
        (1, 1.0, [0.30]),
        (5, 0.5, [0.166667, 0.133333, 0.10, 0.066667, 0.033333]),
        (3, 0.5, [0.25, 0.166667, 0.083333]),
        (2, 0.5, [0.30, 0.20]),
        (1, 0.5, [0.30]),
    ],
)
def test_capped_weights_golden(spark, n, exposure, want):
    got = [r["target_weight"] for r in capped_rank_weights(ranked(spark, n, exposure)).orderBy("rank").collect()]
    assert got == pytest.approx(want, abs=1e-6)


def test_weights_stay_within_cap_and_exposure(spark):
    rng = random.Random(5)
    rows = []
    for day in range(60):
        exposure = rng.random()
        rows += [(i, D + timedelta(day), rng.random(), exposure) for i in range(rng.randint(1, 9))]
    df = spark.createDataFrame(rows, "entity long, d date, alpha_score double, exposure double")
    got = capped_rank_weights(df).toPandas()
    sums = got.groupby("d").agg(w=("target_weight", "sum"), e=("exposure", "first"), n=("entity", "size"), top=("target_weight", "max"))
    assert (sums.w <= sums.e + 1e-9).all() and (sums.top <= 0.3 + 1e-12).all() and (sums.n <= 5).all()
    full = sums[sums.e <= 0.3 * sums.n]
    assert full.w.to_numpy() == pytest.approx(full.e.to_numpy())
    raw = rank_weights(df).groupBy("d").agg(F.sum("raw_weight").alias("w"), F.first("exposure").alias("e")).toPandas()
    assert raw.w.to_numpy() == pytest.approx(raw.e.to_numpy())


def test_exposure_of_states(spark):
    rows = [("RISK_OFF", 0.9), ("NEUTRAL", 0.5), ("RISK_ON", 2.0), ("RISK_ON", -0.1), ("OTHER", 0.5)]
    df = spark.createDataFrame(rows, "s string, x double")
    assert [r[0] for r in df.select(total_exposure("s", "x")).collect()] == [0.0, 0.5, 1.0, 0.0, None]


def test_risk_state_overrides(spark):
    rows = [(1, D + timedelta(i), r, 0.01 * (i % 3), p) for i, (r, p) in enumerate([(0.0, 0.7), (-0.05, 0.9), (None, 0.5), (0.0, 0.4)])]
    df = spark.createDataFrame(rows, "entity int, d date, ret_5d double, vol_10d double, risk_prob double")
    got = risk_state(df).orderBy("d").collect()
    assert [r["risk_state"] for r in got] == ["RISK_ON", "RISK_OFF", "NEUTRAL", "RISK_OFF"]
    assert [r["crash_flag"] for r in got] == [False, True, False, False]
    assert got[1]["risk_exposure"] == 0.0


def test_recommended_exposure_bounds(spark):
    df = spark.createDataFrame(
        [(0.0, 0.0, 0.1, 0.1), (1.0, 1.0, 9.0, 1.0), (0.5, 0.5, 1.0, 1.0)],
        "crash_prob double, bear_prob double, predicted_vol double, realised_vol double",
    )
    got = recommended_exposure(df).collect()
    assert [r["volatility_ratio"] for r in got] == pytest.approx([1.0, 3.0, 1.0], abs=1e-6)
    assert [r["recommended_exposure"] for r in got] == pytest.approx([1.0, 0.1, 0.65 * 0.8], abs=1e-6)


def account(days, prices, weights, hold, cost):
    """Value per day of one account that follows the rules one day at a time."""
    cash, held, leave, curve = 1.0, {}, None, []
    for i, today in enumerate(days):
        if leave == today:
            value = sum(n * prices[today, e][1] for e, n in held.items() if (today, e) in prices)
            cash, held, leave = cash + value * (1 - cost), {}, None
        curve.append((today, cash + sum(n * prices[today, e][1] for e, n in held.items() if (today, e) in prices)))
        if held:
            continue
        if i + hold >= len(days):
            break
        if not weights.get(today):
            continue
        leave, spent = days[i + hold], 0.0
        for e, w in weights[today].items():
            entry = prices.get((days[i + 1], e), (0.0, 0.0))[0]
            if entry > 0:
                held[e] = cash * w / entry
                spent += cash * w
        cash -= spent * (1 + cost)
    return curve


@pytest.mark.parametrize("seed", range(3))
def test_walk_forward_equals_a_daily_account(spark, seed):
    rng = random.Random(seed)
    days = [D + timedelta(i) for i in range(40)]
    names = range(8)
    prices = {
        (d, e): (0.0 if rng.random() < 0.1 else rng.uniform(5, 15), rng.uniform(5, 15))
        for d in days for e in names if rng.random() < 0.7
    }
    alpha = {s: [(s, d, e, rng.random()) for d in days for e in names if rng.random() < 0.5] for s in ("one", "two")}
    risk = [(d, rng.choice(list(EXPOSURE_BY_STATE)), rng.random()) for d in days if rng.random() < 0.8]
    params = BookParams()
    alpha_df = spark.createDataFrame([r for rows in alpha.values() for r in rows], "strategy string, d date, entity int, alpha_score double")
    risk_df = spark.createDataFrame(risk, "d date, risk_state string, risk_exposure double")
    price_df = spark.createDataFrame([(d, e, o, c) for (d, e), (o, c) in prices.items()], "d date, entity int, open_price double, close double")
    out = walk_forward(price_df, alpha_df, risk_df, params)
    got = out["equity"].toPandas()
    weights = out["weights"].toPandas()
    for s, rows in alpha.items():
        chosen = {}
        for r in weights[weights.strategy == s].itertuples():
            chosen.setdefault(r.d, {})[r.entity] = r.target_weight
        calendar = sorted({d for _, d, _, _ in rows})
        want = account(calendar, prices, chosen, params.hold, params.cost)
        mine = got[got.strategy == s].sort_values("d")
        assert mine.d.tolist() == [d for d, _ in want]
        assert mine.equity.tolist() == pytest.approx([v for _, v in want])
        peak = mine.equity.cummax()
        assert mine.drawdown.tolist() == pytest.approx(((mine.equity - peak) / peak).tolist())


def flat_days(growths, hold):
    """(position, equity) of the flat days of one account, one day at a time."""
    i, equity, out = 0, 1.0, []
    while i < len(growths):
        out.append((i, equity))
        if i + hold >= len(growths):
            break
        equity *= 1.0 if growths[i] is None else growths[i]
        i += 1 if growths[i] is None else hold
    return out


def calendar_of(spark, growths):
    """Calendar and cohorts of strategies whose growth per day is given (null: nothing bought); no marks."""
    rows = [(s, i, len(g), x) for s, g in growths.items() for i, x in enumerate(g)]
    both = spark.createDataFrame(rows, "strategy string, i int, n int, growth double").withColumn(
        "d", F.date_add(F.lit(D), F.col("i"))
    )
    marks = spark.createDataFrame([], "strategy string, d date, mark_day date, mark double")
    return both.drop("growth"), both.where("growth IS NOT NULL").select("strategy", "d", "growth"), marks


@pytest.mark.parametrize("block_days", [1, 4, 7, 64])
def test_account_in_blocks_equals_one_walk(spark, block_days):
    rng = random.Random(block_days)
    growths = {
        f"s{k}": [None if rng.random() < 0.4 else rng.uniform(0.9, 1.1) for _ in range(n)] for k, n in enumerate([1, 2, 3, 4, 29, 64, 65, 200])
    }
    growths["never"] = [None] * 50
    got = bt.equity_curve(*calendar_of(spark, growths), block_days=block_days).toPandas()
    for s, g in growths.items():
        mine = got[got.strategy == s].sort_values("d")
        want = flat_days(g, BookParams().hold)
        assert mine.d.tolist() == [D + timedelta(i) for i, _ in want]
        assert mine.equity.tolist() == pytest.approx([e for _, e in want])


def test_account_over_a_very_long_calendar(spark):
    """200,000 days: no plan holds the calendar in one array, and the rounds grow with the logarithm of the blocks."""
    n = 200_000
    days = spark.range(n).select(
        F.lit("s").alias("strategy"), F.date_add(F.lit(date(1600, 1, 1)), F.col("id").cast("int")).alias("d"), F.col("id").cast("int").alias("i"),
        F.lit(n).alias("n"),
    )
    cohorts = days.where("i % 5 <> 0").select("strategy", "d", (1 + (F.col("i") % 7 - 3) / 1e4).alias("growth"))
    marks = spark.createDataFrame([], "strategy string, d date, mark_day date, mark double")
    got = bt.equity_curve(days, cohorts, marks).select(F.datediff("d", F.lit(date(1600, 1, 1))).alias("i"), "equity").toPandas().sort_values("i")
    want = flat_days([1 + (i % 7 - 3) / 1e4 if i % 5 else None for i in range(n)], BookParams().hold)
    assert got.i.tolist() == [i for i, _ in want]
    assert got.equity.tolist() == pytest.approx([e for _, e in want], rel=1e-9)


def test_performance_against_pandas(spark):
    rng = random.Random(3)
    values = [1.0]
    for _ in range(50):
        values.append(values[-1] * (1 if rng.random() < 0.3 else 1 + rng.uniform(-0.05, 0.05)))
    curve = spark.createDataFrame([("s", D + timedelta(i), v) for i, v in enumerate(values)], "strategy string, d date, equity double")
    got = {r["metric"]: r["value"] for r in bt.performance(bt.with_drawdown(curve)).collect()}
    equity = pd.Series(values)
    moves = equity.pct_change()
    active = moves[moves != 0]
    assert got["Total Return"] == pytest.approx(values[-1] / values[0] - 1)
    assert got["Max Drawdown"] == pytest.approx((equity / equity.cummax() - 1).min())
    assert got["Sharpe"] == pytest.approx(252**0.5 * active.mean() / active.std())
    flat = spark.createDataFrame([("s", D, 1.0), ("s", D + timedelta(1), 1.0)], "strategy string, d date, equity double")
    assert {r["metric"]: r["value"] for r in bt.performance(bt.with_drawdown(flat)).collect()}["Sharpe"] == 0.0


def test_no_decision_without_a_risk_row(spark):
    alpha = spark.createDataFrame([("s", D, 1, 1.0), ("s", D + timedelta(1), 1, 1.0)], "strategy string, d date, entity int, alpha_score double")
    risk = spark.createDataFrame([(D, "RISK_ON", 0.5)], "d date, risk_state string, risk_exposure double")
    assert [r["d"] for r in decisions(alpha, risk).collect()] == [D]
