"""Huber regression and trees, learning to rank from pairs: against plain numpy, and on data with a known answer."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from tidepanel.models.boosted import BoostParams, fit_boosted, leaf_values
from tidepanel.models.huber import fit_huber
from tidepanel.models.pairwise import fit_pairs, ranked_pairs
from tidepanel.operators.cross import ndcg
from tidepanel.session import materialise


def assembled(df, cols):
    return materialise(VectorAssembler(inputCols=list(cols), outputCol="features").transform(df))


@pytest.fixture(scope="module")
def line(spark):
    """y = 3 x1 - 2 x2 + 1, with a tenth of the rows far off to one side."""
    rng = np.random.default_rng(0)
    x = rng.normal(size=(2000, 2))
    y = 3 * x[:, 0] - 2 * x[:, 1] + 1 + rng.normal(size=2000) * 0.1 + (rng.random(2000) < 0.1) * 50
    rows = [(float(a), float(b), float(c)) for (a, b), c in zip(x, y)]
    return x, y, assembled(spark.createDataFrame(rows, "x1 double, x2 double, y double"), ["x1", "x2"])


@pytest.mark.parametrize("delta", [0.05, 0.3, 4.0, 100.0])
def test_huber_fit_is_the_minimum_at_the_threshold_asked_for(line, delta):
    x, y, rows = line
    fit = fit_huber(rows, "y", delta, tol=1e-8, max_iter=200)
    assert fit.delta == delta and fit.settled
    theta = np.append(fit.model.coefficients.toArray(), fit.model.intercept)
    design = np.column_stack([x, np.ones(len(y))])
    residual = y - design @ theta
    gradient = design.T @ np.clip(residual, -delta, delta) / len(y)
    assert np.abs(gradient).max() < 1e-5 * max(1, delta)  # of the Huber loss, which has one minimum
    if delta < 1:
        assert theta == pytest.approx([3, -2, 1], abs=0.05)
    again = fit_huber(rows, "y", delta, tol=1e-8, max_iter=200, start=fit.model)
    assert again.iterations <= 2 and np.append(again.model.coefficients.toArray(), again.model.intercept) == pytest.approx(theta, abs=1e-5)


def test_huber_fit_refuses_no_threshold_and_leaves_out_unlabelled_rows(spark, line):
    _, _, rows = line
    with pytest.raises(ValueError):
        fit_huber(rows, "y", 0.0)
    more = rows.unionByName(rows.limit(50).withColumn("y", F.lit(None).cast("double")))
    assert fit_huber(more, "y", 0.3).model.coefficients.toArray() == pytest.approx(fit_huber(rows, "y", 0.3).model.coefficients.toArray())


@pytest.fixture(scope="module")
def steps(spark):
    """A step function of two features with heavy tails; the last fifth of the rows is for validation."""
    rng = np.random.default_rng(1)
    x = rng.uniform(-1, 1, size=(4000, 3))
    y = np.where(x[:, 0] > 0, 2.0, -1.0) + np.where(x[:, 1] > 0.5, 1.5, 0.0) + rng.standard_t(2, size=4000) * 0.3
    rows = [(*map(float, r), float(v), i >= 3200) for i, (r, v) in enumerate(zip(x, y))]
    return assembled(spark.createDataFrame(rows, "a double, b double, c double, y double, is_val boolean"), "abc")


SMALL = dict(depth=3, min_rows=20, feature_share=1.0, learning_rate=0.5)


@pytest.mark.parametrize("leaf", ["mean", "median"])
def test_trees_learn_and_the_error_of_the_best_round_is_that_of_the_model(steps, leaf):
    model = fit_boosted(steps, "y", 0.5, params=BoostParams(max_rounds=12, rounds_per_fit=1, leaf=leaf, **SMALL))
    assert len(model.errors) == 13 and model.errors[model.best_round] == min(model.errors)
    assert model.errors[model.best_round] < 0.45 < 1.0 < model.errors[0]
    scored = model.transform(steps).where("is_val").agg(F.avg(F.abs(F.col("y") - F.col("prediction")))).first()[0]
    assert scored == pytest.approx(model.errors[model.best_round])
    assert model.importances().argmax() == 0


def test_boosting_stops_after_rounds_without_gain(spark, steps):
    noise = materialise(steps.withColumn("y", F.randn(3)))
    params = BoostParams(max_rounds=500, rounds_per_fit=4, stop_after=6, min_gain=0.05, **SMALL)
    model = fit_boosted(noise, "y", 1.0, params=params)
    assert model.best_round == 0 and 6 <= len(model.errors) - 1 <= 8
    scored = model.transform(noise).select("prediction").distinct().collect()
    assert [r[0] for r in scored] == pytest.approx([model.base])  # the constant of the training rows


def test_boosting_keeps_rounds_in_a_table_only_once_in_a_while(steps, monkeypatch):
    from tidepanel.models import boosted

    written = []
    kept = boosted.materialise
    monkeypatch.setattr(boosted, "materialise", lambda df: (written.append(df.columns), kept(df))[1])
    params = BoostParams(max_rounds=9, rounds_per_fit=3, **SMALL)
    free = fit_boosted(steps, "y", 0.5, params=params)
    assert not written
    monkeypatch.setattr(boosted, "FORESTS", 1)
    tight = fit_boosted(steps, "y", 0.5, params=params)
    assert len(written) == 3 and tight.errors == pytest.approx(free.errors, rel=1e-2)  # sampled rows follow partitions


def test_defaults_are_the_full_number_of_rounds():
    params = BoostParams()
    assert (params.max_rounds, params.learning_rate, params.stop_after, params.min_gain, params.min_rows) == (10_000, 1e-4, 100, 1e-5, 100)


def test_leaf_values_by_hand(spark):
    rows = [([0, 1], 1.0), ([0, 0], 2.0), ([2, 0], -9.0), ([2, 0], 0.5), ([2, 0], 0.7)]
    df = spark.createDataFrame(rows, "leaf array<int>, r double")
    mean = leaf_values(df, "leaf", "r", 1.0, "mean")
    assert mean[0] == pytest.approx([1.0, 0.0, (-1 + 0.5 + 0.7) / 3]) and mean[1] == pytest.approx([(1 - 1 + 0.5 + 0.7) / 4, 1.0])
    median = leaf_values(df, "leaf", "r", 1.0, "median")
    assert median[0][2] == pytest.approx(0.5 + (-1 + 0 + 0.2) / 3)


def test_pairs_stand_at_fixed_offsets(spark):
    rows = [(1, e, label) for e, label in enumerate([4, 3, 3, 2, 1, 1, 0, 0, 0, 0])] + [(2, 0, 1), (2, 1, 1), (3, 0, 2)]
    pairs = ranked_pairs(spark.createDataFrame(rows, "d int, entity int, label int"), "label", shares=(0.1, 0.5)).collect()
    order = [4, 3, 3, 2, 1, 1, 0, 0, 0, 0]
    want = {(1, i + 1, i + 1 + s) for i in range(10) for s in (1, 5) if i + s < 10 and order[i] > order[i + s]}
    assert {(r["d"], r["high"], r["low"]) for r in pairs} == want and len(pairs) == len(want)
    assert all(r["weight"] > 0 for r in pairs)


@pytest.mark.parametrize("n", [1, 7, 150, 1013])
def test_pairs_with_columns_are_the_same_and_rows_move_about_once(spark, monkeypatch, n):
    from tidepanel.models import pairwise

    moved = []
    met = pairwise._met
    monkeypatch.setattr(pairwise, "_met", lambda *a: (moved.append(met(*a)), moved[-1])[1])
    rng = np.random.default_rng(n)
    rows = [(d, None if e == 3 else e // 2, int(rng.integers(0, 5)), float(e)) for d in (1, 2, None) for e in range(n)]
    df = materialise(spark.createDataFrame(rows, "d int, entity int, label int, x double"))
    plain = sorted(ranked_pairs(df, "label").collect())
    wide = ranked_pairs(df, "label", keep=["x"])
    assert sorted(wide.select("d", "high", "low", "weight").collect()) == plain
    assert wide.where("x_high IS NULL OR x_low IS NULL").isEmpty()
    assert moved[0].count() <= max(1.2 * len(rows), 6 * PART_ROWS)
    text = wide._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(d" in text and "low" not in "".join(x for x in text.splitlines() if "Exchange" in x)


PART_ROWS = 700  # of so few rows, copies in every part don't matter


def test_pairs_rank_better_than_a_pointwise_fit(spark):
    """Every day shifts the features of all its rows, so their level says nothing and only differences within a day do."""
    rng = np.random.default_rng(7)
    rows = []
    for d in range(60):
        signal = rng.normal(size=50)
        shift = rng.normal() * 10
        label = np.argsort(np.argsort(signal + rng.normal(size=50) * 0.3)) // 10
        rows += [(d, e, float(signal[e] + shift), float(rng.normal()), int(label[e]), d >= 48) for e in range(50)]
    df = assembled(spark.createDataFrame(rows, "d int, entity int, x double, z double, label int, is_val boolean"), ["x", "z"])

    def quality(model):
        held = model.transform(df).where("is_val")
        return held.transform(lambda h: ndcg(h, "prediction", "label")).agg(F.avg((F.col("ndcg_3") + F.col("ndcg_5")) / 2)).first()[0]

    point = GBTRegressor(labelCol="label", maxIter=20, maxDepth=5, stepSize=0.1, minInstancesPerNode=20, seed=1).fit(df.where("not is_val"))
    pairs = fit_pairs(df, "label")
    assert quality(pairs) == pytest.approx(pairs.ndcg)
    assert quality(pairs) > quality(point) + 0.1
    assert pairs.ndcg == max(q for _, q in pairs.path)
