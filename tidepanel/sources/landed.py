"""Landed JSON pages to rows of the base tables.

Pages are read as text and parsed by schema, so a page that does not parse is never lost: it keeps its text, and
``faulty`` lists it with the reason while ``sound`` passes the others on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidepanel.functions.scalar import empty_to_null
from tidepanel.sources.schema import (
    INDEX_PAGE, INDEX_VALUES, RATE_PAGE, STOCK_OPTIONAL, STOCK_PAGE, STOCK_VALUES, landed_name,
)

CORRUPT = "_corrupt"
CODES = {"stock": "StockCode", "index": "IndexCode"}


def page_schema(kind: str) -> T.StructType:
    return {"stock": STOCK_PAGE, "index": INDEX_PAGE, "rate": RATE_PAGE}[kind]


def parsed(texts: DataFrame, kind: str) -> DataFrame:
    """Pages from rows (value, file): the page's fields, its text, its file and ``_corrupt`` (text that did not parse)."""
    schema = T.StructType([*page_schema(kind).fields, T.StructField(CORRUPT, T.StringType())])
    page = F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    return texts.select(page.alias("_page"), "value", "file").select("_page.*", "value", "file")


def read_pages(spark: SparkSession, path: str, kind: str, *, lines: bool = False) -> DataFrame:
    """Landed pages of one kind, ``stock``, ``index`` or ``rate``: a page per file, or with ``lines`` a page per line."""
    texts = spark.read.text(path, wholetext=not lines)
    return parsed(texts.select("value", F.col("_metadata.file_name").alias("file")), kind)


def fault(kind: str) -> Column:
    """Why a page can't be used; null for a sound one. A page without items is sound."""
    bad = F.when(F.col(CORRUPT).isNotNull(), F.lit("unreadable"))
    if kind == "rate":
        unread = F.exists(F.map_keys("rates"), lambda day: F.try_to_timestamp(day).isNull())
        return bad.when(F.col("rates").isNull(), F.lit("no rates")).when(unread, F.lit("rate without a day"))
    unkeyed = F.exists("data", lambda i: i.isNull() | i[CODES[kind]].isNull() | F.try_to_timestamp(i["Date"]).isNull())
    return bad.when(F.col("data").isNull(), F.lit("no items")).when(unkeyed, F.lit("item without code or day"))


def sound(pages: DataFrame, kind: str) -> DataFrame:
    return pages.where(fault(kind).isNull())


def faulty(pages: DataFrame, kind: str) -> DataFrame:
    """(kind, file, reason, value) of the pages that can't be used."""
    return pages.select(F.lit(kind).alias("kind"), "file", fault(kind).alias("reason"), "value").where("reason IS NOT NULL")


def _renamed(columns: list[str]) -> list[Column]:
    return [F.col(f"i.{landed_name(c)}").alias(c) for c in columns]


def stock_rows(pages: DataFrame) -> DataFrame:
    """Bars plus the name columns of their stock."""
    items = pages.select(F.explode("data").alias("i"))
    return items.select(
        F.col("i.StockCode").alias("stock_profile"),
        F.try_to_timestamp("i.Date").alias("timestamp"),
        *_renamed(STOCK_VALUES + STOCK_OPTIONAL),
        F.col("i.StockName").alias("stock_name"),
        F.col("i.Remarks").alias("remarks"),
        F.try_to_timestamp(empty_to_null("i.DelistingDate")).alias("delisting_date"),
    )


def index_rows(pages: DataFrame) -> DataFrame:
    items = pages.select(F.explode("data").alias("i"))
    return items.select(
        F.col("i.IndexCode").alias("index_profile"), F.try_to_timestamp("i.Date").alias("timestamp"), *_renamed(INDEX_VALUES)
    )


def rate_rows(pages: DataFrame, *, primary: str = "USD", secondary: str = "IDR") -> DataFrame:
    """One row per day of the rates map."""
    days = pages.select(F.explode("rates").alias("day", "values"))
    return days.select(
        F.lit(primary).alias("primary_code"),
        F.lit(secondary).alias("secondary_code"),
        F.lit(1.0).alias("primary_value"),
        F.element_at("values", secondary).alias("secondary_value"),
        F.try_to_timestamp("day").alias("timestamp"),
    )
