"""Joins, lookback and pruning between a panel and its context."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from tidepanel.session import materialise


def with_context(panel: DataFrame, context: DataFrame, *, on: str = "d", how: str = "inner") -> DataFrame:
    """Join a relation with one row per time to a panel.

    The context is materialised first: it is usually read again, and its real size then decides between a broadcast
    and a shuffle.
    """
    return panel.join(materialise(context), on, how)


def excess(ks: Mapping[str, tuple[str, str]]) -> dict[str, Column]:
    """``{out: (own, market)}`` differences."""
    return {out: F.col(own) - F.col(market) for out, (own, market) in ks.items()}


def first_of_last_dates(df: DataFrame, n: int, *, ts: str = "d") -> DataFrame:
    """One row: the oldest of the newest n distinct times."""
    return df.select(ts).distinct().orderBy(F.col(ts).desc()).limit(n).agg(F.min(ts).alias("min_ts"))


def since(df: DataFrame, bound: DataFrame, *, ts: str = "d") -> DataFrame:
    """Rows at or after the single value of ``bound``, which runs once as a scalar subquery."""
    return df.where(F.col(ts) >= bound.scalar())


def lookback(df: DataFrame, n: int, *, ts: str = "d", dates_of: DataFrame | None = None) -> DataFrame:
    """Rows within the newest n distinct times of ``dates_of`` (default: of the frame itself)."""
    return since(df, first_of_last_dates(dates_of if dates_of is not None else df, n, ts=ts), ts=ts)


def current_entities(df: DataFrame, *, entity: str = "entity", ts: str = "d") -> DataFrame:
    """Keep entities that have a row at the newest time of all."""
    live = df.where(F.col(ts) == df.agg(F.max(ts)).scalar()).select(entity).distinct()
    return df.join(materialise(live), entity, "left_semi")


def newest_only(df: DataFrame, *, ts: str = "d") -> DataFrame:
    """Rows at the newest time."""
    return df.where(F.col(ts) == df.agg(F.max(ts)).scalar())


def with_constants(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.withColumns({name: F.lit(v) for name, v in values.items()})
