"""Queries against their SQL on the smallest tables, and properties of plans."""

import glob
import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tidepanel.models.boosted import BoostParams
from tidepanel.plans.fitted import huber, model_rows, risk_on, tree
from tidepanel.plans.daily_store import risk_dataset
from tidepanel.plans.queries import neat
from tidepanel.plans import ranking_panel
from tidepanel.sources.adapters import bars, index_series, rate_series, table

FAST = [
    "bars_daily", "simple_returns", "rolling_std_pop", "rolling_mean_spread", "market_context", "excess_returns",
    "left_join_index", "drop_warmup", "forward_targets", "ntile_label", "regime_label", "split_dates", "lower_quantiles",
    "robust_scale", "seq_latest", "pct_rank_avg", "combined_score", "rolling_quantile", "mad_delta", "capped_weights",
    "perf_summary", "missing_days", "insert_ignore", "quality_report", "json_props", "landed_stock", "landed_index", "landed_rates",
    "quarantined_pages", "both_feeds", "dimension_rows", "unknown_state", "reunited_sets", "upsert_corrections", "panel_export",
    "result_export", "fast_quantiles", "ranking_pairs", "last_n_dates", "panel_chain",
]


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def order(row):
    return tuple((v is None, "" if v is None else str(v)) for v in row)


@pytest.mark.parametrize("name", FAST)
def test_query_equals_sql(spark, sf, duck, name):
    df = queries()[name](spark, sf)
    columns = sorted(df.columns)
    got = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=order)
    cursor = duck.execute(oracle_sql()[name])
    at = [d[0] for d in cursor.description]
    assert sorted(at) == columns
    want = sorted((tuple(r[at.index(c)] for c in columns) for r in cursor.fetchall()), key=order)
    assert len(got) == len(want) > 0
    for a, b in zip(got, want):
        assert a == pytest.approx(b, abs=2e-6) if all(isinstance(x, float) for x in a) else list(a) == [
            pytest.approx(y, abs=2e-6) if isinstance(y, float) else y for y in b
        ]


def test_entry(spark):
    assert entry(spark).count() == 10


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scans_are_pruned_and_filters_pushed(spark, sf):
    text = plan(table(spark, sf, "orders").where("o_orderstatus = 'F'").select("o_orderkey"))
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,F)]" in text
    closes = plan(bars(spark, sf).select("entity", "d", "close"))
    assert "l_discount" not in closes and "l_returnflag" not in closes


@pytest.mark.parametrize("name", ["market_context", "split_rows", "peak_drawdown"])
def test_market_series_read_lots_once(spark, sf, name):
    optimised = queries()[name](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert optimised.count("l_shipdate") > 0 and optimised.count("Relation [l_") == 1


def test_profiles_of_the_market_series(spark, sf):
    every = index_series(spark, sf)
    for profile in ("COMPOSITE", "FRANCE"):
        want = {r["d"]: r for r in every.where(every["index_profile"] == profile).collect()}
        got = index_series(spark, sf, profile).collect()
        assert len(got) == len(want)
        for row in got:
            assert row["value"] == pytest.approx(want[row["d"]]["value"]) and row["highest"] == want[row["d"]]["highest"]


def lineitem_scans(df):
    """Lineitem relations in the plan that is left when everything written before has been written."""
    return df._jdf.queryExecution().optimizedPlan().toString().count("l_shipdate")


@pytest.mark.parametrize("name", ["quality_report", "last_n_dates", "split_dates", "feature_store_daily", "panel_blocks"])
def test_lineitem_is_scanned_once(spark, sf, name, monkeypatch):
    from tidepanel import session
    from tidepanel.sources import adapters

    scans = []
    monkeypatch.setattr(adapters, "table", lambda s, d, n: (scans.append(n), table(s, d, n))[1])
    df = queries()[name](spark, sf)
    assert scans.count("lineitem") == 1 and lineitem_scans(df) == 0 and session.shared_folder(spark)
    assert "SinglePartition" not in plan(df) or name == "quality_report"


def test_bucketed_tables_join_without_an_exchange(spark, sf):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(queries()["class5"](spark, sf))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in text and "Exchange" not in text


def test_feature_windows_share_one_exchange(spark, sf):
    text = plan(ranking_panel.entity_features(bars(spark, sf)))
    assert text.count("Exchange hashpartitioning") == 2  # bars per (entity, day), then entity
    assert "SinglePartition" not in text and "Python" not in text


def test_fitted_models(spark, sf):
    out = risk_on(risk_dataset(index_series(spark, sf)), trees=5)
    assert 0.0 <= out["auc"] <= 1.0
    assert out["scores"].where("risk_prob NOT BETWEEN 0 AND 1").count() == 0
    features = ["ret_1d_n", "vol_20d_n"]
    base = ranking_panel.panel_base(
        ranking_panel.entity_features(bars(spark, sf)), ranking_panel.market_context(index_series(spark, sf), rate_series(spark, sf))
    )
    panel = ranking_panel.normalised_panel(base).select("entity", "d", *features)
    ahead = base.select("entity", "d", "ret_5d").withColumnRenamed("ret_5d", "future_return")
    rows = model_rows(ranking_panel.labelled(panel, ahead, "future_return"), ["future_return"], features)
    fit = huber(rows, "future_return")
    assert fit["error"].first()["mae"] > 0 and fit["delta"] > 0
    assert fit["scores"].count() == rows.count()
    boosted = tree(rows, "future_return", fit["delta"], features=features, params=BoostParams(max_rounds=6, learning_rate=0.1, rounds_per_fit=3))
    assert {r["feature"] for r in boosted["importance"].collect()} == set(features)
    assert boosted["error"].first()["mae"] <= boosted["model"].errors[0]


def test_neat_has_no_negative_zero(spark):
    row = neat(spark.createDataFrame([(-1e-9, 3)], "x double, i int")).first()
    assert str(row["x"]) == "0.0" and row["i"] == 3


def test_market_models_use_the_unscaled_volatility(spark, sf):
    from tidepanel.plans.fitted import market_models
    from tidepanel.plans.risk_panel import scaled_state

    got = market_models(scaled_state(index_series(spark, sf)), trees=2)["scores"].toPandas()
    assert len(got) > 0 and (got.realised_vol > 0).all()
    assert got.recommended_exposure.between(0.1, 1.0).all()
    assert (got.bull_prob + got.bear_prob + got.neutral_prob.fillna(0)).round(6).eq(1).all()
