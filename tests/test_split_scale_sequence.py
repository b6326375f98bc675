from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidepanel.operators.scaling import apply_robust, fit_robust, lower_quantiles
from tidepanel.operators.sequences import latest_sequences, sequences
from tidepanel.operators.split import reunited, split_by_dates, split_entity_tail, split_rows, train, validation

D = date(2024, 1, 1)


def panel(spark, lengths=(70, 10, 65)):
    rows = [(e, D + timedelta(i + (70 - n if e != 2 else 0)), float(i), float(-i)) for e, n in enumerate(lengths) for i in range(n)]
    return spark.createDataFrame(rows, "entity int, d date, x double, y double")


@pytest.mark.parametrize("split", [split_by_dates, split_entity_tail, split_rows])
def test_splits_are_disjoint_complete_and_ordered(spark, split):
    df = panel(spark)
    done = split(df)
    assert train(done).count() + validation(done).count() == df.count()
    assert reunited(train(done), validation(done)).count() == df.count()
    bounds = done.groupBy("entity").agg(
        F.max(F.when(~F.col("is_val"), F.col("d"))).alias("last"), F.min(F.when(F.col("is_val"), F.col("d"))).alias("first")
    )
    assert bounds.where(F.col("last") >= F.col("first")).count() == 0


def test_split_points(spark):
    df = panel(spark, (10,))
    assert validation(split_by_dates(df, 0.8)).count() == 1  # the split date itself belongs to training
    assert validation(split_entity_tail(df, 0.25)).count() == 3  # half away from zero
    assert validation(split_rows(df, 0.8)).count() == 2


def test_lower_quantiles_and_scaling(spark):
    rng = np.random.default_rng(0)
    x, flat = rng.normal(size=41), np.ones(41)
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(zip(x, flat))], "i int, x double, flat double")
    got = {r["feature"]: r for r in lower_quantiles(df, ["x", "flat"]).collect()}
    for name, q in (("q1", 0.25), ("median", 0.5), ("q3", 0.75)):
        assert got["x"][name] == np.sort(x)[int(q * 40)]
    scaled = apply_robust(df, fit_robust(df, ["x", "flat"]), ["x", "flat"]).orderBy("i").toPandas()
    q1, q2, q3 = (np.quantile(x, q, method="lower") for q in (0.25, 0.5, 0.75))
    np.testing.assert_allclose(scaled["x"], (x - q2) / (q3 - q1))
    assert scaled["flat"].isna().all()


def test_sequences_are_the_rows_before(spark):
    got = sequences(panel(spark), ["x", "y"], "x", window=60).orderBy("entity", "d").collect()
    assert len(got) == 10 + 5
    for r in got:
        assert len(r["sequence"]) == 60
        assert [s[0] for s in r["sequence"]] == [r["x"] - 60 + i for i in range(60)]


def test_latest_sequences(spark):
    # entity 1 is too short and entity 2 ends before the newest date
    got = latest_sequences(panel(spark), ["x", "y"], window=60).collect()
    assert [r["entity"] for r in got] == [0]
    assert got[0]["latest"] == [69.0, -69.0] and got[0]["sequence"][0] == [10.0, -10.0]
