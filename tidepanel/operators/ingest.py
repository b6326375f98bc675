"""Idempotent loading: what a batch adds to a table that already holds some of it."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, functions as F

from tidepanel.operators.windows import Keys, key_list


def last_closed_day(now: datetime, *, close_hour: int = 17) -> date:
    """Today once the market has closed, else yesterday."""
    return (now if now.hour >= close_hour else now - timedelta(days=1)).date()


def calendar(df: DataFrame, start: str = "start", end: str = "end", *, out: str = "d") -> DataFrame:
    """Every day between two date columns."""
    return df.select(F.explode(F.sequence(F.col(start), F.col(end), F.expr("interval 1 day"))).alias(out))


def missing_days(seen: DataFrame, *, ts: str = "d", start: date | None = None, end: date | None = None) -> DataFrame:
    """Calendar days without a row, from ``start`` to ``end`` (default: the span of ``seen``)."""
    low = F.lit(start) if start else F.min(ts)
    high = F.lit(end) if end else F.max(ts)
    span = seen.agg(low.cast("date").alias("start"), high.cast("date").alias("end")).where(F.col("start").isNotNull())
    return calendar(span, out=ts).join(seen.select(ts).distinct(), ts, "left_anti")


def days_to_request(seen: DataFrame, now: datetime, *, back: int = 800, ts: str = "d", close_hour: int = 17) -> DataFrame:
    """Missing days of the last ``back`` days up to the last closed one."""
    end = last_closed_day(now, close_hour=close_hour)
    return missing_days(seen, ts=ts, start=end - timedelta(days=back), end=end)


def first_rows(df: DataFrame, key: Keys, order: Keys = ()) -> DataFrame:
    """One row per key: the least by ``order`` and then by the other columns, so that reruns and other partitionings
    agree. Kept by aggregation, so that a hot key is reduced before the shuffle."""
    keys = key_list(key)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    lead = [c for c in key_list(order) if c in rest]
    row = F.struct(*lead, *[c for c in rest if c not in lead])
    least = df.groupBy(*keys).agg(F.min(row).alias("_row"))
    return least.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def insert_ignore(existing: DataFrame, incoming: DataFrame, key: Keys, order: Keys = ()) -> DataFrame:
    """Rows to append: one per new key, the first by ``order`` and then by the other columns."""
    keys = key_list(key)
    return first_rows(incoming, keys, order).join(existing.select(*keys), keys, "left_anti").select(*incoming.columns)


def upsert_first(existing: DataFrame, incoming: DataFrame, key: Keys, order: Keys = ()) -> DataFrame:
    """Whole table after an upsert in which the stored row wins."""
    return existing.unionByName(insert_ignore(existing, incoming, key, order))


def upsert_latest(existing: DataFrame, incoming: DataFrame, key: Keys, version: str) -> DataFrame:
    """Whole table after an upsert in which the highest ``version`` wins. Kept by aggregation, so a key with very
    many versions is reduced before the shuffle."""
    keys = key_list(key)
    both = existing.unionByName(incoming)
    row = F.struct(version, *[c for c in both.columns if c != version])
    newest = both.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(F.max(row).alias("_row"))
    return newest.select(*[F.col(f"_row.{c}").alias(c) for c in both.columns])


def referenced(df: DataFrame, dimension: DataFrame, on: Keys) -> DataFrame:
    """Rows whose key exists in the dimension."""
    keys = key_list(on)
    return df.join(dimension.select(*keys), keys, "left_semi")


def nulls_to_zero(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(0.0)) for c in columns})


def both_present(left: DataFrame, right: DataFrame, *, ts: str = "timestamp") -> tuple[DataFrame, DataFrame]:
    """Rows of either feed at times that the other feed has too."""
    return (
        left.join(right.select(ts).distinct(), ts, "left_semi"),
        right.join(left.select(ts).distinct(), ts, "left_semi"),
    )


def dimension_rows(facts: DataFrame, code: str, attributes: Iterable[str] = (), *, order: str | None = None) -> DataFrame:
    """One row per code: the least by ``order``, if given, and then by the attributes, in any partitioning."""
    attributes = list(attributes)
    lead = [order] if order and order not in attributes else []
    return first_rows(facts.select(code, *attributes, *lead), code, order or ()).select(code, *attributes)


