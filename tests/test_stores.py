"""Bucketed and partitioned stores, copy-on-write upserts, observed writes, sketches and blocked panels."""

import os
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tidepanel.config import SCALED_FEATURES, TARGETS, RankingParams
from tidepanel.operators import quality as dq
from tidepanel.operators.portfolio import known_states, unknown_states
from tidepanel.operators.scaling import lower_quantiles, rank_error, sketched_quantiles
from tidepanel.operators.split import split_date
from tidepanel.plans import ranking_panel
from tidepanel.session import bucketed, copartitioned, discard, materialise, observed, release
from tidepanel.sources.adapters import bars, index_series, rate_series
from tidepanel.sources.tables import save_panel, upsert_partitions

D = date(2024, 1, 1)


def files(root):
    return {
        os.path.relpath(os.path.join(at, f), root): os.stat(os.path.join(at, f)).st_mtime_ns
        for at, _, names in os.walk(root) for f in names if f.endswith(".parquet")
    }


def test_upsert_leaves_untouched_partitions_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([(k, f"m{k % 4}", float(k), 1) for k in range(40)], "k int, m string, v double, t int")
    assert upsert_partitions(spark, path, first, "k", "t", "m") == ["m0", "m1", "m2", "m3"]
    before = files(path)
    fixes = spark.createDataFrame(
        [(1, "m1", -1.0, 2), (5, "m1", -5.0, 0), (99, "m1", 99.0, 1), (99, "m1", 98.0, 2), (3, "m3", -3.0, 2)], "k int, m string, v double, t int"
    )
    assert upsert_partitions(spark, path, fixes, "k", "t", "m") == ["m1", "m3"]
    after = files(path)
    for name in ("m0", "m2"):
        kept = {f: t for f, t in before.items() if f.startswith(f"m={name}")}
        assert kept and kept == {f: t for f, t in after.items() if f.startswith(f"m={name}")}
    got = {r["k"]: r["v"] for r in spark.read.parquet(path).collect()}
    want = {k: float(k) for k in range(40)} | {1: -1.0, 99: 98.0, 3: -3.0}  # the older version of 5 loses
    assert got == want
    assert upsert_partitions(spark, path, fixes.limit(0), "k", "t", "m") == []
    upsert_partitions(spark, path, fixes, "k", "t", "m")
    assert {r["k"]: r["v"] for r in spark.read.parquet(path).collect()} == want  # a replay changes nothing


def test_panel_files_are_bounded_and_months_are_split(spark, tmp_path):
    rows = spark.range(6000).select((F.col("id") % 200).alias("entity"), F.date_add(F.lit(D), (F.col("id") / 200).cast("int")).alias("d"), F.col("id").alias("x"))
    save_panel(rows, str(tmp_path / "p"), rows_per_file=500)
    back = spark.read.parquet(str(tmp_path / "p"))
    assert back.count() == 6000 and back.select("year", "month").distinct().count() == 1
    sizes = [r["n"] for r in back.groupBy(F.input_file_name().alias("f")).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert max(sizes) <= 500 and len(sizes) >= 12  # one month, many files
    spans = back.groupBy(F.input_file_name().alias("f")).agg((F.max("entity") - F.min("entity")).alias("w")).collect()
    assert sum(r["w"] for r in spans) < 200 + len(sizes)  # a file holds neighbouring entities


def test_bucketed_tables_meet_without_an_exchange(spark):
    copartitioned(spark)
    a = bucketed(spark.range(1000).selectExpr("id % 50 AS entity", "id AS d", "id AS x"), "entity", ["d"], buckets=4)
    b = bucketed(spark.range(1000).selectExpr("id % 50 AS entity", "id AS d", "-id AS y"), "entity", ["d"], buckets=4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = a.join(b, ["entity", "d"])
        text = joined._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in text and "SortMergeJoin" in text
        assert joined.agg(F.sum("x"), F.sum("y"), F.count(F.lit(1))).first() == (499500, -499500, 1000)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    names = [t.name for t in spark.catalog.listTables()]
    assert any(n.startswith("tidepanel_bucketed_") for n in names)
    release(spark)
    assert not any(t.name.startswith("tidepanel_bucketed_") for t in spark.catalog.listTables())


def test_observed_write_counts_what_it_writes(spark):
    df = spark.createDataFrame([(1, 0.5), (2, 1.5), (3, None)], "k int, x double")
    table, found = observed(df, {"n": F.count(F.lit(1)), "total": F.sum("x")})
    assert found == {"n": 3, "total": 2.0} and table.count() == 3
    checks = {"bounds": dq.outside("x", 0, 1), "null": dq.not_null("x")}
    for rows in (df, df.limit(0)):
        written, got = dq.watched(rows, checks)
        assert {tuple(r) for r in got.collect()} == {tuple(r) for r in dq.row_checks(rows, checks).collect()}
        assert written.count() == rows.count()
    discard(table)
    with pytest.raises(Exception):
        table.count()


def test_sketched_quantiles_stay_within_their_bound(spark):
    df = spark.range(200_000).select((F.col("id") % 3).alias("g"), F.randn(5).alias("x"), (F.col("id") / 7).alias("y"), F.lit(None).cast("double").alias("z"))
    df = materialise(df)
    quick = {(r["g"], r["feature"]): r for r in sketched_quantiles(df, ["x", "y", "z"], by="g").collect()}
    assert set(quick) == {(g, f) for g in range(3) for f in "xy"} and 0 < rank_error() < 0.01 < rank_error(200)
    for (g, f), r in quick.items():
        for q, name in ((0.25, "q1"), (0.5, "median"), (0.75, "q3")):
            rank = df.where((F.col("g") == g) & (F.col(f) <= r[name])).count() / r["n"]
            assert abs(rank - q) <= rank_error() + 1 / r["n"]
    small = spark.createDataFrame([(i % 2, float(i)) for i in range(40)], "g int, x double")
    exact = {r["g"]: (r["q1"], r["q3"]) for r in lower_quantiles(small, ["x"], by="g").collect()}
    for r in sketched_quantiles(small, ["x"], by="g").collect():
        assert abs(r["q1"] - exact[r["g"]][0]) <= 2 and abs(r["q3"] - exact[r["g"]][1]) <= 2


def test_split_date_needs_no_single_task(spark):
    df = spark.createDataFrame([(D + timedelta(i % 10),) for i in range(50)] + [(None,)], "d date")
    date_plan = split_date(df, 0.8)
    assert date_plan.first()["split_at"] == D + timedelta(8)
    assert "SinglePartition" not in date_plan._jdf.queryExecution().executedPlan().toString()


def test_unknown_states(spark):
    risk = spark.createDataFrame([(D, "RISK_ON"), (D, "PANIC"), (D, "PANIC"), (D, None)], "d date, risk_state string")
    assert {(r["risk_state"], r["days"]) for r in unknown_states(risk).collect()} == {("PANIC", 2), (None, 1)}
    assert known_states(risk.where("risk_state = 'RISK_ON'")).count() == 1
    with pytest.raises(Exception, match="unknown risk state: PANIC"):
        known_states(risk.where("risk_state = 'PANIC'")).collect()
    with pytest.raises(Exception, match="unknown risk state: null"):
        known_states(risk.where("risk_state IS NULL")).collect()


@pytest.mark.parametrize("rows", [130, 400])
def test_panel_in_blocks_equals_the_panel(spark, sf, rows):
    some = materialise(bars(spark, sf).where("entity <= 3"))
    index, rates = materialise(index_series(spark, sf, "COMPOSITE")), materialise(rate_series(spark, sf))
    params = RankingParams(val_ratio=0.5)
    whole = ranking_panel.build(some, index, rates, params)
    blocked = ranking_panel.panel_in_blocks(some, ranking_panel.market_context(index, rates), params, rows=rows)
    for name, columns in (("base", ["close", "vol_60d", "ret_60d"]), ("panel", [f"{c}_n" for c in SCALED_FEATURES]), ("targets", ["total_step", *TARGETS])):
        a, b = (x[name].select("entity", "d", *columns).toPandas().sort_values(["entity", "d"]).reset_index(drop=True) for x in (whole, blocked))
        assert len(a) == len(b) > 0 and (a[["entity", "d"]] == b[["entity", "d"]]).all(axis=None)
        for c in columns:
            assert a[c].isna().equals(b[c].isna())
            assert a[c].dropna().to_numpy() == pytest.approx(b[c].dropna().to_numpy(), rel=1e-6, abs=1e-6)
