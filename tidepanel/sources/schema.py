"""Declared schemas of the base tables and of the landed JSON files."""

from __future__ import annotations

from pyspark.sql import types as T

# ---- fixed values: columns of the base tables and fields of the landed files ----
INDEX_VALUES = [
    "previous", "highest", "lowest", "close", "number_of_stock", "change", "volume", "value", "frequency",
    "market_capital",
]
STOCK_VALUES = [
    "previous", "open_price", "first_trade", "high", "low", "close", "change", "volume", "value", "frequency",
    "index_individual", "offer", "offer_volume", "bid", "bid_volume", "listed_shares", "tradeble_shares",
    "weight_for_index", "foreign_sell", "foreign_buy", "non_regular_volume", "non_regular_value",
    "non_regular_frequency",
]
STOCK_OPTIONAL = ["persen", "percentage"]
# ---------------------------------------------------------------------------------


def landed_name(column: str) -> str:
    """Field name in the landed files: the column in Pascal case, except for the two lower-case ones."""
    return column if column in STOCK_OPTIONAL else "".join(part.capitalize() for part in column.split("_"))


def _doubles(names: list[str]) -> list[T.StructField]:
    return [T.StructField(n, T.DoubleType()) for n in names]


def _table(keys: list[T.StructField], values: list[str]) -> T.StructType:
    return T.StructType(keys + _doubles(values))


def _key(name: str, kind: T.DataType) -> T.StructField:
    return T.StructField(name, kind, False)


TIME_DIMENSIONS = T.StructType([_key("timestamp", T.TimestampType())])
INDEX_PROFILES = T.StructType([_key("index_code", T.StringType())])
STOCK_PROFILES = T.StructType(
    [
        _key("stock_code", T.StringType()),
        T.StructField("stock_name", T.StringType()),
        T.StructField("remarks", T.StringType()),
        T.StructField("delisting_date", T.TimestampType()),
    ]
)
INDEX_DATA = _table([_key("index_profile", T.StringType()), _key("timestamp", T.TimestampType())], INDEX_VALUES)
STOCK_DATA = _table(
    [_key("stock_profile", T.StringType()), _key("timestamp", T.TimestampType())], STOCK_VALUES + STOCK_OPTIONAL
)
CURRENCIES = T.StructType([_key("currency_code", T.StringType())])
RATES = T.StructType(
    [
        _key("primary_code", T.StringType()),
        _key("secondary_code", T.StringType()),
        *_doubles(["primary_value", "secondary_value"]),
        _key("timestamp", T.TimestampType()),
    ]
)

PRIMARY_KEYS = {
    "time_dimensions": ["timestamp"],
    "index_profiles": ["index_code"],
    "stock_profiles": ["stock_code"],
    "index_data": ["index_profile", "timestamp"],
    "stock_data": ["stock_profile", "timestamp"],
    "currencies": ["currency_code"],
    "currency_exchange_rates": ["primary_code", "secondary_code", "timestamp"],
}
TABLES = {
    "time_dimensions": TIME_DIMENSIONS,
    "index_profiles": INDEX_PROFILES,
    "stock_profiles": STOCK_PROFILES,
    "index_data": INDEX_DATA,
    "stock_data": STOCK_DATA,
    "currencies": CURRENCIES,
    "currency_exchange_rates": RATES,
}


def _page(item: T.StructType) -> T.StructType:
    return T.StructType(
        [
            T.StructField("draw", T.LongType()),
            T.StructField("recordsTotal", T.LongType()),
            T.StructField("recordsFiltered", T.LongType()),
            T.StructField("data", T.ArrayType(item)),
        ]
    )


def _strings(names: list[str]) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


STOCK_PAGE = _page(
    T.StructType(
        _strings(["Date", "StockCode", "StockName", "Remarks", "DelistingDate"])
        + _doubles([landed_name(c) for c in STOCK_VALUES + STOCK_OPTIONAL])
    )
)
INDEX_PAGE = _page(T.StructType(_strings(["Date", "IndexCode"]) + _doubles([landed_name(c) for c in INDEX_VALUES])))
RATE_PAGE = T.StructType(
    [T.StructField("rates", T.MapType(T.StringType(), T.MapType(T.StringType(), T.DoubleType())))]
)
