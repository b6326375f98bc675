import json
import time
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidepanel.operators import quality as dq
from tidepanel.operators.ingest import (
    both_present, days_to_request, dimension_rows, insert_ignore, last_closed_day, missing_days, nulls_to_zero, referenced,
    upsert_first, upsert_latest,
)
from tidepanel.operators.relate import current_entities, first_of_last_dates, lookback, newest_only, with_context
from tidepanel.session import materialise, release
from tidepanel.sources.landed import faulty, index_rows, parsed, rate_rows, read_pages, sound, stock_rows
from tidepanel.sources.schema import PRIMARY_KEYS, STOCK_VALUES, TABLES, landed_name
from tidepanel.sources.tables import export, save_panel, scan, scan_base
from tidepanel.streaming.ingest import ingest_rates, ingest_summaries, quarantined, seen_days, unpaired_days


def stock(code, day, close, delisted=""):
    item = {landed_name(c): 1.0 for c in STOCK_VALUES}
    return item | {"StockCode": code, "StockName": f"{code} Inc", "Remarks": "-", "Date": f"{day}T00:00:00", "Close": close,
                   "DelistingDate": delisted, "persen": None, "percentage": None, "No": 1, "IDStockSummary": 5}


def index(code, day, close=10.0):
    return {"IndexCode": code, "Date": f"{day}T00:00:00", "Close": close, "Highest": 11.0, "No": 1}


def land(folder, kind, name, items):
    target = folder / kind
    target.mkdir(parents=True, exist_ok=True)
    page = {"draw": 0, "recordsTotal": len(items), "recordsFiltered": len(items), "data": items}
    (target / name).write_text(json.dumps(page, indent=1))


def test_landed_names():
    assert landed_name("tradeble_shares") == "TradebleShares" and landed_name("persen") == "persen"
    assert set(PRIMARY_KEYS) == set(TABLES)


def test_pages_to_rows(spark, tmp_path):
    land(tmp_path, "stock", "a.json", [stock("AAA", "2024-01-02", 5.0), stock("BBB", "2024-01-02", None, "2024-05-01T00:00:00")])
    land(tmp_path, "index", "a.json", [index("COMPOSITE", "2024-01-02")])
    rows = stock_rows(read_pages(spark, str(tmp_path / "stock"), "stock")).orderBy("stock_profile").collect()
    assert [(r["stock_profile"], r["close"], r["delisting_date"]) for r in rows] == [
        ("AAA", 5.0, None), ("BBB", None, datetime(2024, 5, 1))
    ]
    assert rows[0]["timestamp"] == datetime(2024, 1, 2)
    only = index_rows(read_pages(spark, str(tmp_path / "index"), "index")).first()
    assert (only["index_profile"], only["close"], only["market_capital"]) == ("COMPOSITE", 10.0, None)


def test_rates_to_rows(spark, tmp_path):
    (tmp_path / "r.json").write_text(json.dumps({"rates": {"2024-01-02": {"IDR": 15000.0}, "2024-01-03": {"IDR": 15100.0}}}))
    rows = rate_rows(read_pages(spark, str(tmp_path), "rate")).orderBy("timestamp").collect()
    assert [(r["secondary_value"], r["primary_value"], r["primary_code"]) for r in rows] == [(15000.0, 1.0, "USD"), (15100.0, 1.0, "USD")]


def counts(spark, root):
    return {name: scan_base(spark, root, name).count() for name in ("time_dimensions", "stock_profiles", "stock_data", "index_data")}


def test_stream_is_idempotent(spark, tmp_path):
    landing, root, state = tmp_path / "landing", str(tmp_path / "tables"), str(tmp_path / "state")
    land(landing, "stock", "20240102.json", [stock("AAA", "2024-01-02", 5.0), stock("BBB", "2024-01-02", None)])
    land(landing, "index", "20240102.json", [index("COMPOSITE", "2024-01-02")])
    land(landing, "stock", "20240103.json", [stock("AAA", "2024-01-03", 6.0)])  # the index feed of this day is missing
    land(landing, "index", "20240106.json", [])  # a day without data still counts as requested
    ingest_summaries(spark, str(landing), root, state).awaitTermination()
    first = counts(spark, root)
    assert first == {"time_dimensions": 3, "stock_profiles": 2, "stock_data": 2, "index_data": 1}
    assert scan_base(spark, root, "stock_data").where("stock_profile = 'BBB'").first()["close"] == 0.0
    assert scan_base(spark, root, "stock_data").where("percentage IS NULL").count() == 2

    land(landing, "stock", "again.json", [stock("AAA", "2024-01-02", 99.0), stock("AAA", "2024-01-04", 7.0)])
    land(landing, "index", "again.json", [index("COMPOSITE", "2024-01-02", 99.0), index("COMPOSITE", "2024-01-04")])
    ingest_summaries(spark, str(landing), root, state).awaitTermination()
    second = counts(spark, root)
    assert second == {"time_dimensions": 4, "stock_profiles": 2, "stock_data": 3, "index_data": 2}
    assert scan_base(spark, root, "stock_data").where("close = 99").count() == 0

    ingest_summaries(spark, str(landing), root, str(tmp_path / "lost")).awaitTermination()  # replay of everything
    assert counts(spark, root) == second

    (landing / "rate").mkdir()
    (landing / "rate" / "r.json").write_text(json.dumps({"rates": {"2024-01-02": {"IDR": 1.5}, "2030-01-01": {"IDR": 2.0}}}))
    for lost in ("state", "elsewhere"):
        ingest_rates(spark, str(landing), root, str(tmp_path / lost)).awaitTermination()
    assert [r["secondary_value"] for r in scan_base(spark, root, "currency_exchange_rates").collect()] == [1.5]
    assert scan_base(spark, root, "currencies").count() == 2


def test_late_feed_completes_its_day(spark, tmp_path):
    landing, root, state = tmp_path / "landing", str(tmp_path / "tables"), str(tmp_path / "state")
    land(landing, "stock", "a.json", [stock("AAA", "2024-01-02", 5.0), stock("AAA", "2024-01-03", 6.0)])
    (landing / "index").mkdir()
    ingest_summaries(spark, str(landing), root, state).awaitTermination()
    assert scan_base(spark, root, "stock_data").count() == 0
    land(landing, "index", "b.json", [index("COMPOSITE", "2024-01-02")])
    ingest_summaries(spark, str(landing), root, state).awaitTermination()
    assert [(r["timestamp"].day, r["close"]) for r in scan_base(spark, root, "stock_data").collect()] == [(2, 5.0)]
    assert counts(spark, root) == {"time_dimensions": 2, "stock_profiles": 1, "stock_data": 1, "index_data": 1}


def test_first_of_differing_duplicates_in_any_partitioning(spark):
    rows = spark.range(2000).selectExpr("id % 7 AS k", "cast(null AS string) AS s", "id AS v", "-id AS t")
    empty = rows.limit(0)
    for n in (1, 3, 8):
        got = insert_ignore(empty, rows.repartition(n), "k", "t")
        assert sorted((r["k"], r["v"]) for r in got.collect()) == sorted((v % 7, v) for v in range(1993, 2000))
    assert sorted(r["v"] for r in insert_ignore(empty, rows.repartition(5), "k").collect()) == list(range(7))


def test_insert_and_upserts(spark):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "k int, v string, t int")
    new = spark.createDataFrame([(2, "x", 2), (3, "c", 2), (3, "c", 2)], "k int, v string, t int")
    assert [r["k"] for r in insert_ignore(old, new, "k").collect()] == [3]
    assert {r["k"]: r["v"] for r in upsert_first(old, new, "k").collect()} == {1: "a", 2: "b", 3: "c"}
    assert {r["k"]: r["v"] for r in upsert_latest(old, new, "k", "t").collect()} == {1: "a", 2: "x", 3: "c"}
    replay = insert_ignore(upsert_first(old, new, "k"), new, "k")
    assert replay.count() == 0


def test_reference_nulls_and_batches(spark):
    facts = spark.createDataFrame([(1, None), (2, 2.0), (None, 3.0)], "k int, v double")
    dim = spark.createDataFrame([(1,), (5,)], "k int")
    assert [r["v"] for r in nulls_to_zero(referenced(facts, dim, "k"), ["v"]).collect()] == [0.0]
    a = spark.createDataFrame([(1,), (2,)], "timestamp int")
    b = spark.createDataFrame([(2,), (3,)], "timestamp int")
    assert [[r[0] for r in x.collect()] for x in both_present(a, b)] == [[2], [2]]
    codes = spark.createDataFrame([("x", 2, "late"), ("x", 1, "early")], "code string, t int, name string")
    assert dimension_rows(codes, "code", ["name"], order="t").first()["name"] == "early"


def test_calendar_gaps(spark):
    seen = spark.createDataFrame([(date(2024, 1, 1),), (date(2024, 1, 4),)], "d date")
    assert [r["d"].day for r in missing_days(seen).orderBy("d").collect()] == [2, 3]
    assert last_closed_day(datetime(2024, 1, 5, 16)) == date(2024, 1, 4)
    assert last_closed_day(datetime(2024, 1, 5, 17)) == date(2024, 1, 5)
    wanted = days_to_request(seen, datetime(2024, 1, 5, 18), back=4).orderBy("d").collect()
    assert [r["d"].day for r in wanted] == [2, 3, 5]
    assert missing_days(seen.limit(0)).count() == 0


def test_lookback_and_pruning(spark):
    df = spark.createDataFrame([(e, date(2024, 1, day)) for e, day in [(1, 1), (1, 2), (1, 3), (2, 1), (2, 2)]], "entity int, d date")
    assert first_of_last_dates(df, 2).first()["min_ts"] == date(2024, 1, 2)
    assert lookback(df, 2).count() == 3
    assert {r["entity"] for r in current_entities(df).collect()} == {1}
    assert newest_only(df).count() == 1
    context = spark.createDataFrame([(date(2024, 1, 1), 7)], "d date, c int")
    assert with_context(df, context, how="left").where("c IS NULL").count() == 3


def test_quality_checks(spark):
    df = spark.createDataFrame([(1, 0.5, "A"), (1, 1.5, "B"), (2, None, None)], "k int, x double, s string")
    got = dq.report(
        dq.row_checks(df, {"bounds": dq.outside("x", 0, 1), "state": dq.not_among("s", ["A"]), "null": dq.not_null("x")}),
        dq.group_size_check(df, "k", 2),
        dq.unique_check(df, ["k"]),
    )
    assert {r["check"]: r["violations"] for r in got.collect()} == {
        "non_empty": 0, "bounds": 2, "state": 2, "null": 1, "group_size": 1, "unique_key": 1
    }
    empty = dq.row_checks(df.limit(0), {"bounds": dq.outside("x", 0, 1)})
    assert {r["check"]: r["violations"] for r in empty.collect()} == {"non_empty": 1, "bounds": 0}


def test_sinks_and_materialised_tables(spark, tmp_path):
    df = spark.createDataFrame([(1, date(2024, 1, 5), 2.0), (1, date(2024, 2, 5), 3.0)], "entity int, d date, x double")
    save_panel(df, str(tmp_path / "panel"))
    back = spark.read.parquet(str(tmp_path / "panel")).where(F.col("month") == 2)
    assert back.count() == 1 and "PartitionFilters: [isnotnull(month" in back._jdf.queryExecution().toString()
    export({"one": df, "two": df.select("x")}, str(tmp_path / "out"), fmt="csv")
    assert spark.read.option("header", True).csv(str(tmp_path / "out" / "two")).count() == 2
    assert scan(spark, str(tmp_path / "panel"), ["x"]).columns == ["x"]
    kept = materialise(df)
    assert kept.count() == 2 and spark.conf.get("spark.checkpoint.dir") in kept.inputFiles()[0]
    release(spark)
    with pytest.raises(Exception):
        spark.read.parquet(kept.inputFiles()[0])


def test_page_that_does_not_parse_is_quarantined_and_its_day_stays_missing(spark, tmp_path):
    landing, root, state = tmp_path / "landing", str(tmp_path / "tables"), str(tmp_path / "state")
    land(landing, "stock", "20240102.json", [stock("AAA", "2024-01-02", 5.0)])
    land(landing, "index", "20240102.json", [index("COMPOSITE", "2024-01-02")])
    for name, text in {
        "20240103.json": "<html>too many requests</html>", "20240104.json": '{"message": "error"}', "20240105.json": "\n",
        "20240106.json": '{"data": [{"Date": "2024-01-06T00:00:00"}]}', "20240107.json": '{"data": [{"StockCode": "AAA", "Date": "soon"}]}',
    }.items():
        (landing / "stock" / name).write_text(text)
    for _ in range(2):  # a replay adds nothing
        ingest_summaries(spark, str(landing), root, state).awaitTermination()
        state += "_lost"
    bad = {r["file"]: r["reason"] for r in quarantined(spark, root).collect()}
    assert bad == {
        "20240103.json": "unreadable", "20240104.json": "no items", "20240105.json": "no items",
        "20240106.json": "item without code or day", "20240107.json": "item without code or day",
    }
    assert quarantined(spark, root).where("file = '20240103.json'").first()["value"] == "<html>too many requests</html>"
    assert counts(spark, root) == {"time_dimensions": 1, "stock_profiles": 1, "stock_data": 1, "index_data": 1}
    wanted = days_to_request(seen_days(spark, root), datetime(2024, 1, 4, 18), back=2)
    assert [r["d"].day for r in wanted.orderBy("d").collect()] == [3, 4]


def test_feed_that_never_comes_is_reported(spark, tmp_path):
    landing, root, state = tmp_path / "landing", str(tmp_path / "tables"), str(tmp_path / "state")
    wait = timedelta(seconds=1)
    (landing / "index").mkdir(parents=True)

    def run():
        ingest_summaries(spark, str(landing), root, state, wait=wait).awaitTermination()

    def reported():
        return sorted((r["day"].day, r["kind"]) for r in unpaired_days(spark, root).collect())

    land(landing, "stock", "20240102.json", [stock("AAA", "2024-01-02", 5.0)])
    run()
    assert reported() == []
    time.sleep(1.5)
    land(landing, "stock", "20240103.json", [stock("AAA", "2024-01-03", 6.0)])
    land(landing, "index", "20240103.json", [index("COMPOSITE", "2024-01-03")])
    run()
    assert reported() == [(2, "stock")]  # its index page never came
    assert [r["timestamp"].day for r in scan_base(spark, root, "stock_data").collect()] == [3]
    wanted = days_to_request(seen_days(spark, root), datetime(2024, 1, 3, 18), back=1)
    assert [r["d"].day for r in wanted.collect()] == [2]

    land(landing, "index", "20240102_again.json", [index("COMPOSITE", "2024-01-02")])  # long after the report
    run()
    time.sleep(1.5)
    land(landing, "stock", "20240104.json", [stock("AAA", "2024-01-04", 7.0)])
    run()
    assert reported() == []
    assert sorted(r["timestamp"].day for r in scan_base(spark, root, "stock_data").collect()) == [2, 3]


def test_read_pages_by_line_and_faults(spark, tmp_path):
    good = json.dumps({"data": [stock("AAA", "2024-01-02", 5.0, "never")]})
    (tmp_path / "pages.jsonl").write_text(f"{good}\nnot a page\n")
    pages = read_pages(spark, str(tmp_path), "stock", lines=True)
    assert [(r["stock_profile"], r["delisting_date"]) for r in stock_rows(sound(pages, "stock")).collect()] == [("AAA", None)]
    assert [(r["kind"], r["reason"], r["value"]) for r in faulty(pages, "stock").collect()] == [("stock", "unreadable", "not a page")]
    rates = spark.createDataFrame([('{"rates": {"2024-01-02": {"IDR": 1.0}}}', "a"), ('{"rates": {"x": {"IDR": 1.0}}}', "b"), ("{}", "c")], "value string, file string")
    assert [r["reason"] for r in faulty(parsed(rates, "rate"), "rate").orderBy("file").collect()] == ["rate without a day", "no rates"]
