"""What grows with the tables: widths that move, frames that are not started over, tasks that fit into memory."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidepanel import session
from tidepanel.operators.blocks import in_blocks
from tidepanel.operators.moments import with_beta
from tidepanel.operators.windows import beta, timeline
from tidepanel.plans import daily_store as store, queries as plan_queries, queries_io, ranking_panel as ranking
from tidepanel.sources.adapters import bars, index_series

DAY = dt.date(2024, 1, 1)


def lineitem(spark, path, suppliers=6, days=90):
    rng = random.Random(3)
    rows = [
        (100 * s + i, i % 9, s, 1, float(rng.randint(1, 50)), rng.uniform(900, 2000), 0.05, 0.02, "ANR"[i % 3], "OF"[i % 2],
         dt.datetime(2024, 1, 1) + dt.timedelta(days=i % days))
        for s in range(suppliers) for i in range(days + 20)
    ]
    names = "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, " \
        "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"
    spark.createDataFrame(rows, names).write.parquet(f"{path}/lineitem.parquet")
    return str(path)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_store_shuffles_the_bars_once_and_starts_no_long_frame_over(spark, tmp_path):
    sf = lineitem(spark, tmp_path)
    text = plan(store.feature_store(bars(spark, sf), index_series(spark, sf, "COMPOSITE")))
    assert text.count("Exchange hashpartitioning") == 2  # supplier and day, then supplier
    assert "-59, currentrow" not in text


def test_dealt_bars_are_the_same(spark, tmp_path, monkeypatch):
    sf = lineitem(spark, tmp_path)
    few = bars(spark, sf).orderBy("entity", "d").toPandas()
    monkeypatch.setattr(session, "TASK_ROWS", 50)
    many = bars(spark, sf)
    assert "REPARTITION_BY_NUM" in plan(many)
    assert many.orderBy("entity", "d").toPandas().equals(few)


@pytest.mark.parametrize("n", [2, 7, 60])
def test_beta_by_blocks_equals_the_sliding_frame(spark, n):
    rng = random.Random(n)
    rows = [(e, DAY + dt.timedelta(days=i), None if rng.random() < 0.1 else rng.gauss(0, 1), None if rng.random() < 0.1 else rng.gauss(0, 1))
            for e in range(3) for i in range(130)]
    df = spark.createDataFrame(rows, "entity long, d date, x double, y double")
    got = with_beta(df.withColumn("want", beta("x", "y", n, timeline())), "x", "y", n, out="got").collect()
    assert len(got) == len(rows)
    for r in got:
        assert r["got"] == (r["want"] if r["want"] is None else pytest.approx(r["want"], rel=1e-6, abs=1e-9))


def test_blocks_count_times_not_whole_rows(spark, monkeypatch):
    from tidepanel.operators import blocks

    seen = []
    kept = blocks.positions
    monkeypatch.setattr(blocks, "positions", lambda df, *a, **k: (seen.append(df.columns), kept(df, *a, **k))[1])
    rows = [(e, None if i == 0 else DAY + dt.timedelta(days=i), float(i * i % 17), "wide") for e in (1, 2, None) for i in range(47)]
    df = spark.createDataFrame(rows, "entity long, d date, x double, note string")

    def build(frame, keys):
        w = timeline(keys)
        return frame.withColumns({"back": F.sum("x").over(w.rowsBetween(-5, 0)), "ahead": F.sum("x").over(w.rowsBetween(1, 3))})

    split = in_blocks(df, build, before=5, after=3, rows=8).orderBy("entity", "d").toPandas()
    whole = build(df, ["entity"]).orderBy("entity", "d").toPandas()
    assert seen == [["entity", "d"]]
    assert split[list(whole.columns)].equals(whole)


def test_labels_move_no_features(spark, tmp_path):
    sf = lineitem(spark, tmp_path)
    rows = session.materialise(store.feature_store(bars(spark, sf), index_series(spark, sf, "COMPOSITE")))
    slim = store.alpha_dataset(rows, features=())
    assert slim.columns == ["d", "entity", "label"]
    wide = store.alpha_dataset(rows).select("d", "entity", "label")
    assert sorted(slim.collect()) == sorted(wide.collect()) and slim.count() > 0


def test_targets_are_made_beside_the_features_without_moving_these(spark, tmp_path):
    sf = lineitem(spark, tmp_path, suppliers=4, days=400)
    days = session.materialise(bars(spark, sf).where("entity <> 3 OR d < '2024-06-01'"))  # one entity has not enough history
    rates = days.groupBy("d").agg(F.avg("close").alias("secondary_value")).withColumns(
        {"primary_value": F.lit(1.0), "primary_code": F.lit("USD"), "secondary_code": F.lit("IDR")}
    )
    market = session.materialise(ranking.market_context(index_series(spark, sf, "COMPOSITE"), rates))
    base = ranking.panel_base(ranking.entity_features(days.repartition(4, "entity")), market)
    panel = ranking.labelled_panel(base, base.select("entity", "d", "close", "ret_1d"))
    assert plan(panel).count("Exchange hashpartitioning") == 1  # that of the bars
    whole = ranking.normalised_panel(base)
    want = ranking.labelled_all(whole, ranking.targets(session.materialise(base))).orderBy("entity", "d").toPandas()
    got = panel.where("known").orderBy("entity", "d").toPandas()
    assert len(got) == len(want) > 0 and panel.count() == whole.count() > len(got)
    for c in got.columns.drop("known"):
        a, b = got[c], want[c]
        assert a.equals(b) if a.dtype == object or a.dtype == bool else a.tolist() == pytest.approx(b.tolist(), rel=1e-9, abs=1e-9, nan_ok=True), c


@pytest.mark.parametrize("made, plan", [
    (lambda spark, sf: plan_queries._features(spark, sf), store),
    (lambda spark, sf: queries_io._blocked(spark, sf), ranking),
], ids=["store", "blocks"])
def test_series_of_a_day_join_as_tables(spark, sf, monkeypatch, made, plan):
    """What is joined to all rows by day is sized by its own rows, not by the lots behind it, or it would be shuffled with them."""
    class Seen(Exception):
        pass

    def spy(df, context, **how):
        raise Seen(context._jdf.queryExecution().optimizedPlan().toString())

    monkeypatch.setattr(plan, "with_context", spy)
    with pytest.raises(Seen) as seen:
        made(spark, sf)
    assert "Aggregate" not in str(seen.value)
