import math
from datetime import date

from pyspark.sql import functions as F

from tidepanel.config import CLASS_CUTS, MODEL_FEATURES, PLAIN_FEATURES, SCALED_FEATURES
from tidepanel.functions.flow import book_ratios, price_action
from tidepanel.functions.scalar import (
    calendar_cycles, class_bins, clip, empty_to_null, log_ratio, lookup, normalised, ratio, ratio_or, regime, repaired_open,
)


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {t}" for k, t in _types(values)))
    return row.select(column.alias("x")).first()["x"]


def _types(values):
    kinds = {float: "double", int: "int", str: "string", date: "date", list: "array<double>", type(None): "double"}
    return [(k, kinds[type(v)]) for k, v in values.items()]


def test_feature_lists():
    assert len(SCALED_FEATURES) == 37 and len(PLAIN_FEATURES) == 12 and len(set(MODEL_FEATURES)) == 49


def test_guarded_ratios(spark):
    assert one(spark, ratio("a", "b"), a=1.0, b=0.0) is None
    assert one(spark, ratio_or("a", "b", 0.5), a=1.0, b=0.0) == 0.5
    assert one(spark, ratio_or("a", "b", 0.5), a=1.0, b=4.0) == 0.25
    assert one(spark, log_ratio("a", "b"), a=-1.0, b=2.0) is None
    assert one(spark, log_ratio("a", "b"), a=0.0, b=2.0) is None


def test_class_bins_boundaries(spark):
    rows = spark.createDataFrame([(-1.6,), (-1.5,), (-0.8,), (0.8,), (1.5,), (None,)], "x double")
    assert [r[0] for r in rows.select(class_bins("x", CLASS_CUTS)).collect()] == [0, 1, 2, 3, 4, 4]


def test_regimes(spark):
    rows = spark.createDataFrame([(1.0, 0.01), (-1.0, 0.04), (1.0, 0.04), (None, None)], "t double, v double")
    assert [r[0] for r in rows.select(regime("t", "v", vol_bull=0.02, vol_bear=0.03)).collect()] == [0, 1, 2, 2]


def test_clip_and_lookup(spark):
    assert one(spark, clip("x", 0.0, 1.0), x=2.0) == 1.0
    assert one(spark, clip("x", 0.0, 1.0), x=None) is None
    assert one(spark, lookup("s", {"A": 0.2, "B": 1.0}), s="A") == 0.2
    assert one(spark, lookup("s", {"A": 0.2, "B": 1.0}), s="Z") is None
    assert one(spark, empty_to_null("s"), s="") is None


def test_normalised(spark):
    assert one(spark, normalised("p"), p=[1.0, 1.0, 2.0]) == [0.25, 0.25, 0.5]


def test_calendar(spark):
    row = spark.createDataFrame([(date(2024, 1, 7),), (date(2024, 12, 30),)], "d date").select(
        "d", F.dayofweek("d").alias("dow"), F.weekofyear("d").alias("woy"), calendar_cycles("d")["dow_sin"].alias("s")
    ).orderBy("d").collect()
    assert row[0]["dow"] == 1 and row[1]["woy"] == 1
    assert math.isclose(row[0]["s"], math.sin(2 * math.pi / 7))


def test_open_repair_and_gap(spark):
    assert one(spark, repaired_open("o", "p"), o=0.0, p=5.0) == 5.0
    assert one(spark, repaired_open("o", "p"), o=0.0, p=0.0) == 0.0
    bar = spark.createDataFrame(
        [(0.0, 5.0, 7.0, 7.0, 7.0)], "open_price double, previous double, high double, low double, close double"
    )
    got = bar.select(*[c.alias(n) for n, c in price_action().items()]).first()
    assert (got["gap"], got["intraday_range"], got["close_position"]) == (0.0, 0.0, 0.5)


def test_book_ratio_defaults(spark):
    names = ["bid_volume", "offer_volume", "volume", "tradeble_shares", "foreign_buy", "foreign_sell", "offer", "bid",
             "close", "non_regular_volume"]
    bar = spark.createDataFrame([(0.0,) * len(names)], ", ".join(f"{n} double" for n in names))
    got = bar.select(*[c.alias(n) for n, c in book_ratios().items()]).first().asDict()
    assert got.pop("spread_proxy") is None
    assert all(v == 0 for v in got.values())
