import math
from datetime import date, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidepanel.operators.cross import (
    combined_score, in_large_groups, ndcg, ntile_labels, percent_ranks, robust_delta, score_summary, top_k, zscore_cross,
)
from tidepanel.operators.order import dense_ids, positions, quantiles, running_total

D = date(2024, 1, 1)


def hot(spark, rows=3000, seed=3):
    """One date holds most rows and one value a third of them."""
    rng = np.random.default_rng(seed)
    data = []
    for i in range(rows):
        d = D if i < rows * 2 // 3 else D + timedelta(days=int(rng.integers(1, 6)))
        v = 0.0 if rng.random() < 0.33 else float(np.round(rng.normal(), 2))
        data.append((i, d, None if rng.random() < 0.05 else v))
    return spark.createDataFrame(data, "entity long, d date, v double")


def test_percent_rank_golden(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([3.0, 1.0, 1.0, 2.0, None])], "i int, v double")
    got = percent_ranks(df, "v", {"up": True, "down": False}).orderBy("i").collect()
    assert [r["up"] for r in got] == [1.0, 0.375, 0.375, 0.75, None]
    assert [r["down"] for r in got] == [0.25, 0.875, 0.875, 0.5, None]


def test_percent_ranks_equal_pandas_on_a_hot_group(spark):
    df = hot(spark)
    got = percent_ranks(df, "v", {"up": True, "down": False}, by="d").toPandas().sort_values("entity")
    want = df.toPandas().sort_values("entity")
    assert len(got) == len(want)
    for out, up in (("up", True), ("down", False)):
        expected = want.groupby("d")["v"].rank(pct=True, ascending=up)
        np.testing.assert_allclose(got[out].to_numpy(float), expected.to_numpy(float), equal_nan=True)


def test_positions_and_totals_on_a_hot_group(spark):
    df = hot(spark).fillna(0.0)
    got = positions(df, "d", ["v", "entity"], total="n").toPandas().sort_values(["d", "v", "entity"])
    assert (got["position"].to_numpy() == got.groupby("d").cumcount().to_numpy() + 1).all()
    assert (got["n"] == got.groupby("d")["v"].transform("size")).all()
    sums = running_total(df, "d", ["entity"], "v").toPandas().sort_values(["d", "entity"])
    np.testing.assert_allclose(sums["upto"], sums.groupby("d")["v"].cumsum(), atol=1e-9)
    assert len(sums) == len(got) == 3000


def test_ntile_golden_and_hot_group(spark):
    df = spark.createDataFrame([(i, D, float(i)) for i in range(1, 8)], "entity long, d date, v double")
    assert [r["label"] for r in ntile_labels(df, 5, ["v", "entity"]).orderBy("entity").collect()] == [0, 0, 1, 1, 2, 3, 4]
    few = df.where("entity <= 3")
    assert [r["label"] for r in ntile_labels(few, 5, ["v", "entity"]).orderBy("entity").collect()] == [0, 1, 2]
    big = hot(spark).fillna(0.0)
    big.createOrReplaceTempView("big")
    want = spark.sql("SELECT entity, ntile(5) OVER (PARTITION BY d ORDER BY v, entity) - 1 AS label FROM big").toPandas()
    got = ntile_labels(big, 5, ["v", "entity"]).select("entity", "label").toPandas()
    pd.testing.assert_frame_equal(
        got.sort_values("entity", ignore_index=True), want.sort_values("entity", ignore_index=True), check_dtype=False
    )


@pytest.mark.parametrize("lower", [True, False])
def test_quantiles_equal_numpy(spark, lower):
    df = hot(spark)
    probs = {"a": 0.25, "b": 0.5, "c": 0.95}
    got = quantiles(df, "v", probs, by="d", lower=lower).toPandas().set_index("d")
    frame = df.toPandas().dropna()
    for d, group in frame.groupby("d"):
        for name, q in probs.items():
            want = np.quantile(group["v"], q, method="lower" if lower else "linear")
            assert got.loc[d, name] == pytest.approx(want)
    assert len(got) == frame["d"].nunique()
    whole = quantiles(df, "v", {"m": 0.5}).first()["m"]
    assert whole == pytest.approx(float(np.median(frame["v"])))


def test_robust_delta(spark):
    df = hot(spark).dropna()
    frame = df.toPandas()
    mad = np.median(np.abs(frame["v"] - np.median(frame["v"])))
    assert robust_delta(df, "v").first()["delta"] == pytest.approx(1.345 * 1.4826 * mad)
    by = robust_delta(df, "v", by="d").toPandas()
    assert len(by) == frame["d"].nunique()


def test_dense_ids(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("a",), (None,)], "k string")
    assert {r["k"]: r["id"] for r in dense_ids(df, "k").collect()} == {"a": 0, "b": 1, "c": 2}


def test_zscore_cross(spark):
    df = hot(spark).fillna(0.0)
    got = zscore_cross(df, ["v"]).toPandas()
    frame = df.toPandas()
    want = frame.groupby("d")["v"].transform(lambda s: (s - s.mean()) / s.std(ddof=0))
    np.testing.assert_allclose(
        got.sort_values("entity")["v"].to_numpy(), want[np.argsort(frame["entity"])].to_numpy(), atol=1e-9
    )
    flat = spark.createDataFrame([(1, D, 2.0), (2, D, 2.0)], "entity long, d date, v double")
    assert [r["v"] for r in zscore_cross(flat, ["v"]).collect()] == [0.0, 0.0]


def test_top_k_and_group_filter(spark):
    df = spark.createDataFrame([(i, D, float(i % 2)) for i in range(6)] + [(9, D + timedelta(1), 1.0)], "entity long, d date, v double")
    best = top_k(df, 2, "v").where(F.col("d") == D).orderBy("rank").collect()
    assert [(r["entity"], r["rank"]) for r in best] == [(1, 1), (3, 2)]
    assert in_large_groups(df, 2).count() == 6


def test_ndcg(spark):
    df = spark.createDataFrame(
        [(1, D, 0.9, 0), (2, D, 0.8, 2), (3, D, 0.1, 1), (4, D + timedelta(1), 0.5, 0), (5, D + timedelta(1), 0.4, 0)],
        "entity long, d date, s double, label int",
    )
    got = {r["d"]: r for r in ndcg(df, "s", "label", ks=(2, 3)).collect()}
    best3 = 3 / math.log2(2) + 1 / math.log2(3)
    assert got[D]["ndcg_3"] == pytest.approx((3 / math.log2(3) + 1 / math.log2(4)) / best3)
    assert got[D + timedelta(1)]["ndcg_2"] == 1.0


def test_combined_score(spark):
    rows = []
    for run in (0, 1):
        for target in ("r", "v"):
            for model in ("a", "b"):
                rows += [(e, run, target, model, float(e)) for e in (1, 2)]
    df = spark.createDataFrame(rows, "entity long, run int, target string, model string, pred double")
    scores = score_summary(combined_score(df, ascending={"r": True, "v": False}), runs=[0, 1]).orderBy("entity").collect()
    assert [(r["result_score0"], r["score"], r["score_std"]) for r in scores] == [(0.75, 0.75, 0.0)] * 2
