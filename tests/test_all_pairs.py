"""The fit of a ranker looks at every pair of a day: against sums over the pairs themselves."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tidepanel.models.allpairs import AllPairs, Rows, Slope
from tidepanel.models import allpairs
from tidepanel.models.pairwise import bent, fit_pairs
from tidepanel.session import materialise


def by_pairs(days, weights):
    """Weight, loss, gradient and second moments over all pairs of (grade, x) in the falling order of their day."""
    weight, loss, slope, moments = 0.0, 0.0, 0.0, 0.0
    for grade, x in days:
        discount, score = 1 / np.log2(np.arange(len(grade)) + 2), x @ weights
        for i in range(len(grade)):
            worse = grade < grade[i]
            each = (2.0 ** grade[i] - 2.0 ** grade[worse]) * (discount[i] - discount[worse])
            ahead, apart = score[i] - score[worse], x[i] - x[worse]
            weight, loss = weight + each.sum(), loss + (each * np.logaddexp(0, -ahead)).sum()
            slope = slope - ((each * np.exp(-np.logaddexp(0, ahead)))[:, None] * apart).sum(0)
            moments = moments + (apart * each[:, None]).T @ apart
    return weight, loss, slope, moments


def day(rng, n, features=3):
    grade = np.sort(rng.integers(0, 5, n))[::-1].astype(float)
    return grade, rng.normal(size=(n, features)) * np.array([1.0, 8.0, 0.01]) + 5


def test_loss_over_all_pairs_of_days_that_come_whole_and_in_parts(spark):
    rng = np.random.default_rng(0)
    days = {1: day(rng, 150), 2: day(rng, 40), 3: day(rng, 1), 4: (np.full(9, 2.0), rng.normal(size=(9, 3)))}
    rows = [(d, float(g), i + 1, len(grade), v[:2].tolist(), [int(v[2] > 5)]) for d, (grade, x) in days.items() for i, (g, v) in enumerate(zip(grade, x))]
    values = [[0.25, -1.5]]
    days = [(grade, np.column_stack([x[:, :2], np.where(x[:, 2] > 5, -1.5, 0.25)])) for grade, x in days.values()]
    df = spark.createDataFrame(rows, "_day int, _grade double, _at int, _n int, _x array<double>, _leaf array<int>")
    for frame in (df.coalesce(1), df.repartition(3)):  # whole days, and parts of each
        pairs = AllPairs(materialise(frame), values)
        for weights in (np.zeros(3), np.array([0.7, -0.3, 2.0])):
            weight, loss, slope, _ = by_pairs(days, weights)
            got, towards = pairs.at(weights)
            assert pairs.weight == pytest.approx(weight, rel=1e-12) and got == pytest.approx(loss / weight, rel=1e-11)
            assert towards == pytest.approx(slope / weight, rel=1e-9)


def test_far_scores_and_small_kernels_are_the_same(monkeypatch):
    rng = np.random.default_rng(1)
    grade, x = day(rng, 60)
    rows, weights = Rows(grade, 1 / np.log2(np.arange(60) + 2), x), np.array([30.0, -50.0, 400.0])
    _, loss, slope, _ = by_pairs([(grade, x)], weights)
    monkeypatch.setattr(allpairs, "KERNEL", 1 << 14)
    for got in (Slope(weights).whole(rows), Slope(weights).total(Slope(weights).part(rows))):
        assert got == pytest.approx(np.append(loss, slope), rel=1e-9)


def test_fit_is_the_minimum_over_all_pairs(spark):
    rng = np.random.default_rng(2)
    rows = []
    for d in range(12):
        signal = rng.normal(size=(40, 2))
        label = np.argsort(np.argsort(signal @ [1.0, -0.5] + rng.normal(size=40))) // 8
        rows += [(d, e, *map(float, signal[e]), int(label[e]), d >= 9) for e in range(40)]
    df = spark.createDataFrame(rows, "d int, entity int, x double, z double, label int, is_val boolean")
    df = materialise(VectorAssembler(inputCols=["x", "z"], outputCol="features").transform(df))
    model = fit_pairs(df, "label", penalties=(0.1,), min_rows=20)
    train = bent(df.where("not is_val"), model.forest, model.values).orderBy("d", F.col("label").desc(), "entity").toPandas()
    days = [(g["label"].to_numpy(float), np.stack(g["_bent"].to_list())) for _, g in train.groupby("d")]
    weights = np.array(model.weights)
    weight, _, slope, moments = by_pairs(days, weights)
    unit = np.sqrt(np.diag(moments) / weight)
    kept = unit > 1e-9
    assert kept[:2].all() and np.abs(weights[:2]).min() > 1e-3
    assert slope[kept] / weight / unit[kept] + 0.1 * weights[kept] * unit[kept] == pytest.approx(0, abs=1e-4)
