import math
from datetime import date, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidepanel.operators.blocks import in_blocks
from tidepanel.operators.moments import frame_moments, population_deviation, sample_deviation
from tidepanel.operators.normalise import zscore_past
from tidepanel.operators.targets import crash_label, forward_targets, forward_trade_return, up_label
from tidepanel.operators.windows import (
    active_over, after_warmup, beta, change, drop_from_high, lagged_return, last_rows, over_rows, relative_volume, rolling,
    rolling_quantile, timeline, trailing, with_enough_history,
)

START = date(2024, 1, 1)


def panel(spark, **columns):
    """One entity, one row per day."""
    n = len(next(iter(columns.values())))
    rows = [(1, START + timedelta(days=i), *[None if v[i] is None else float(v[i]) for v in columns.values()]) for i in range(n)]
    return spark.createDataFrame(rows, "entity long, d date, " + ", ".join(f"{c} double" for c in columns))


def values(df, column):
    return [r["x"] for r in df.withColumn("x", column).orderBy("d").collect()]


def random_panel(spark, entities=3, rows=150, seed=7):
    rng = np.random.default_rng(seed)
    data = []
    for e in range(entities):
        for i in range(rows - 20 * e):
            x = None if rng.random() < 0.1 else float(rng.normal())
            y = 1.0 if i < 90 else float(rng.normal())
            data.append((e, START + timedelta(days=i), x, y))
    return spark.createDataFrame(data, "entity long, d date, x double, y double")


def test_returns_and_drawdowns(spark):
    df = panel(spark, c=[2, 4, 3, 0, 6])
    w = timeline()
    assert values(df, change("c", 1, w)) == [None, 1.0, -0.25, -1.0, None]
    assert values(df, drop_from_high("c", 2, w)) == [0.0, 0.0, -0.25, -1.0, 0.0]
    assert values(df, drop_from_high("c", None, w)) == [0.0, 0.0, -0.25, -1.0, 0.0]
    logs = values(lagged_return(df, "c", [1], log=True).drop("c"), F.col("ret_1d"))
    assert logs[0] is None and math.isclose(logs[1], math.log(2)) and logs[3] is None and logs[4] is None


def test_population_and_sample_deviation(spark):
    df = panel(spark, c=[1, 2, 4])
    w = timeline()
    assert math.isclose(values(df, trailing("std_pop", "c", 3, w))[-1], 1.24721913, rel_tol=1e-8)
    assert math.isclose(values(df, trailing("std_samp", "c", 3, w))[-1], 1.52752523, rel_tol=1e-8)
    assert values(df, trailing("std_samp", "c", 3, w))[0] is None
    assert rolling(df, {"m": ("mean", "c", -1, 0)}).orderBy("d").select("m").collect()[2]["m"] == 3.0


def test_forward_frames(spark):
    df = panel(spark, c=[0, 1, 2, 3])
    w = timeline()
    std = values(df, over_rows("std_samp", "c", 1, 3, w))
    assert std[0] == 1.0 and math.isclose(std[1], 0.70710678, rel_tol=1e-8) and std[2:] == [None, None]
    assert values(df, over_rows("min", "c", 1, 3, w)) == [1.0, 2.0, 3.0, None]


def test_forward_targets(spark):
    close = [1, 2, 4, 8, 16]
    df = panel(spark, close=close, ret_1d=[0.1, 0.2, 0.3, 0.4, 0.5])
    got = forward_targets(df, horizon=3).orderBy("d").collect()
    assert math.isclose(got[0]["future_return"], math.log(4)) and got[2]["future_return"] is None
    assert math.isclose(got[0]["future_vol"], math.log(np.std([0.2, 0.3, 0.4], ddof=1) + 1e-8))
    assert got[0]["future_drawdown"] == 0.0


def test_forward_trade_return_forms(spark):
    df = panel(spark, close=[1, 1, 1, 9], open_price=[1, 3, 1, 1])
    w = timeline()
    assert values(df, forward_trade_return(3, w))[0] == 2.0
    assert values(df, forward_trade_return(3, w, compat=True))[0] == 4.5


def test_labels_at_the_end_of_the_series(spark):
    df = panel(spark, c=[1.0, 2.0, 3.0, 0.5], r=[0.0, -0.04, 0.0, -0.5])
    w = timeline()
    assert values(df, up_label("c", 1, w)) == [1, 1, 0, 0]
    assert values(df, crash_label("r", -0.03, w)) == [1, 0, 1, 0]


def test_rolling_quantile_matches_pandas(spark):
    df = panel(spark, c=[0, 1, 2, 3, 4, 5])
    assert values(df, rolling_quantile("c", 0.95, 4, 1, timeline())) == pytest.approx([0, 0.95, 1.9, 2.85, 3.85, 4.85])
    rng = np.random.default_rng(1)
    series = [None if rng.random() < 0.2 else float(x) for x in rng.normal(size=120)]
    want = pd.Series(series, dtype=float).rolling(30, min_periods=10).quantile(0.95)
    got = values(panel(spark, c=series), rolling_quantile("c", 0.95, 30, 10, timeline()))
    assert [g is None for g in got] == want.isna().tolist()
    assert [g for g in got if g is not None] == pytest.approx(want.dropna().tolist())


def test_activity_and_relative_volume(spark):
    df = panel(spark, v=[0, 0, 4, 0, 0])
    w = timeline()
    assert values(df, active_over("v", 2, w)) == [0, 0, 1, 1, 0]
    rel = values(df, relative_volume("v", 2, w))
    assert rel[0] is None and math.isclose(rel[2], math.log(2)) and rel[3] is None


def test_beta_forms(spark):
    y = [0.1, -0.2, 0.3, 0.05, -0.1]
    df = panel(spark, x=[2 * v for v in y], y=y)
    assert values(df, beta("x", "y", 5, timeline()))[-1] == pytest.approx(2.0)
    gap = panel(spark, x=[None, 1.0, 2.0, 4.0], y=[9.0, 1.0, 2.0, 4.0])
    assert values(gap, beta("x", "y", 4, timeline(), paired=True))[-1] == pytest.approx(1.0)
    assert values(gap, beta("x", "y", 4, timeline()))[-1] != pytest.approx(1.0)


def test_row_filters(spark):
    df = random_panel(spark)
    assert after_warmup(df, 60).count() == (150 - 60) + (130 - 60) + (110 - 60)
    assert last_rows(df, 5).count() == 15
    kept = with_enough_history(df, 0.2, 25)
    assert {r["entity"] for r in kept.select("entity").distinct().collect()} == {0, 1}


@pytest.mark.parametrize("n,end", [(60, 1), (20, 0), (7, 2), (200, 1)])
def test_merged_moments_equal_sliding_frames(spark, n, end):
    df = random_panel(spark)
    got = frame_moments(df, ["x", "y"], n, end=end).select(
        "entity", "d", *[e.alias(f"{k}_{c}") for c in "xy" for k, e in
                         (("m", F.col(f"_m_{c}")), ("s", sample_deviation(c)), ("p", population_deviation(c)))]
    ).orderBy("entity", "d").toPandas()
    w = timeline().rowsBetween(-(n - 1 + end), -end)
    want = df.select(
        "entity", "d", *[e.over(w).alias(f"{k}_{c}") for c in "xy" for k, e in
                         (("m", F.avg(c)), ("s", F.stddev_samp(c)), ("p", F.stddev_pop(c)))]
    ).orderBy("entity", "d").toPandas()
    for c in want.columns[2:]:
        np.testing.assert_allclose(got[c].to_numpy(float), want[c].to_numpy(float), rtol=1e-9, atol=1e-12, equal_nan=True)


def test_zscore_of_a_jump_after_a_constant_past(spark):
    df = panel(spark, c=[0.1] * 60 + [1.1])
    assert zscore_past(df, ["c"], full_only=True).first()["c_n"] == pytest.approx(1e8)


def test_zscore_reads_only_the_past(spark):
    df = random_panel(spark, entities=1, rows=100)
    changed = df.withColumn("y", F.when(F.col("d") == START + timedelta(days=80), F.lit(50.0)).otherwise(F.col("y")))
    before = zscore_past(df, ["y"], n=30).orderBy("d").toPandas()["y_n"]
    after = zscore_past(changed, ["y"], n=30).orderBy("d").toPandas()["y_n"]
    differs = [i for i in range(100) if not (before[i] == after[i] or (pd.isna(before[i]) and pd.isna(after[i])))]
    assert differs[0] == 80 and set(range(81, 100)) <= set(differs)


def test_blocks_change_nothing(spark):
    df = random_panel(spark)

    def build(frame, keys):
        return zscore_past(frame, ["x"], n=10, entity=keys, keep=["entity", "d", "_block", "_own", "y"]).withColumn(
            "ahead", F.lead("y", 2).over(timeline(keys))
        )

    split = in_blocks(df, build, before=10, after=2, rows=12).orderBy("entity", "d").toPandas()
    whole = build(df.withColumns({"_block": F.lit(0), "_own": F.lit(True)}), ["entity"]).drop("_block", "_own")
    whole = whole.orderBy("entity", "d").toPandas()
    pd.testing.assert_frame_equal(split[whole.columns], whole, check_exact=False, rtol=1e-9)
