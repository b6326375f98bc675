"""What stays on disk: no shuffle files of written tables, no tables that nothing reads, no copies of tables, no columns of a day."""

import time

import numpy as np
import pytest
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tidepanel import session
from tidepanel.config import CYCLE_FEATURES, RATE
from tidepanel.models.huber import fit_huber
from tidepanel.plans import queries_io, ranking_panel as ranking


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for name in (files.apply(i).getName() for i in range(files.length())) if name.startswith("shuffle_")}


def test_a_written_table_leaves_no_shuffle_files(spark):
    before, key = shuffle_files(spark), session._CLEANUP
    setting = spark.conf.get(key, None)
    table = session.materialise(spark.range(1000).repartition(3, "id").groupBy((F.col("id") % 7).alias("k")).count())
    end = time.time() + 20
    while shuffle_files(spark) - before and time.time() < end:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    assert table.count() == 7 and spark.conf.get(key, None) == setting


def test_condensed_keeps_the_table_alone(spark):
    made = []

    def make():
        made.append(session.materialise(spark.range(10)))
        return made[0].where("id > 3")

    table = session.condensed(spark, make)
    assert table.count() == 6
    assert session.exists(spark, table._table) and not session.exists(spark, made[0]._table)
    assert table._table.startswith(session.shared_folder(spark))


def test_huber_keeps_no_copy_of_its_rows_on_disk(spark, monkeypatch):
    rows = session.materialise(spark.range(200).select(array_to_vector(F.array(F.col("id").cast("double"))).alias("features"), (F.col("id") * 2.0).alias("y")))
    levels = []
    kept = type(rows).persist
    monkeypatch.setattr(type(rows), "persist", lambda df, level=None: (levels.append(level), kept(df, *[x for x in (level,) if x]))[1])
    fit = fit_huber(rows, "y", 1.0)
    assert levels == [StorageLevel.MEMORY_ONLY] and fit.model.coefficients.toArray() == pytest.approx(np.array([2.0]))


def test_columns_of_a_day_are_not_dealt_to_blocks(spark, sf, monkeypatch):
    seen = []
    monkeypatch.setattr(ranking, "dealt", lambda df, *a: (seen.append(df.columns), session.dealt(df, *a))[1])
    columns = queries_io._blocked(spark, sf)["base"].columns
    assert len(seen) == 1 and not [c for c in seen[0] if c.startswith(("idx_", RATE, "excess_")) or c in CYCLE_FEATURES]
    assert {"idx_ret_1d", f"{RATE}_ret_1d", "excess_ret_1d", *CYCLE_FEATURES} <= set(columns)
