"""Exact positions, running totals and quantiles of groups too large for one task.

A plain ``row_number().over(partitionBy(g).orderBy(x))`` puts a whole group in one task. Here the rows are range
partitioned on (group, order), so a hot group spreads over many tasks; each range knows its rows, and a small table of
row counts per (group, range) supplies what lies before it. The sorted rows are written once, because range bounds are
sampled and must not be drawn twice.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidepanel.operators.windows import Keys, key_list
from tidepanel.session import materialise

_ROW_BITS = 33  # monotonically_increasing_id keeps the partition above these bits


def null_safe_join(left: DataFrame, right: DataFrame, keys: Iterable[str], how: str = "inner") -> DataFrame:
    """Join on keys that may be null; the right side's key columns are dropped."""
    keys = list(keys)
    renamed = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    on = [left[c].eqNullSafe(renamed[f"_r_{c}"]) for c in keys]
    return left.join(renamed, reduce(Column.__and__, on), how).drop(*[f"_r_{c}" for c in keys])


def _ranged(df: DataFrame, by: list[str], order: list[Column]) -> DataFrame:
    keys = [F.col(c).asc() for c in by] + order
    ranged = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return materialise(
        ranged.withColumn("_mid", F.monotonically_increasing_id()).select(
            *df.columns,
            F.shiftright("_mid", _ROW_BITS).cast("int").alias("_range"),
            F.col("_mid").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)).alias("_at"),
        )
    )


def _before(ranges: DataFrame, by: list[str], amounts: Mapping[str, str]) -> DataFrame:
    """Sum of each amount over the earlier ranges of a group, and over the whole group."""
    group = Window.partitionBy(*by)
    earlier = group.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    out = {}
    for name, amount in amounts.items():
        out[f"_before_{name}"] = F.coalesce(F.sum(amount).over(earlier), F.lit(0))
        out[f"_total_{name}"] = F.sum(amount).over(group)
    return materialise(ranges.withColumns(out).drop(*amounts.values()))


def positions(
    df: DataFrame, by: Keys | None, order: Iterable[Column | str], *, out: str = "position", total: str | None = None
) -> DataFrame:
    """Row number 1..n within ``by`` along ``order``; ``total`` names a column for n.

    ``order`` should be total within a group, or the numbers among equals are arbitrary.
    """
    by = key_list(by)
    order = [F.col(o).asc() if isinstance(o, str) else o for o in order]
    rows = _ranged(df, by, order)
    ranges = rows.groupBy(*by, "_range").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    located = null_safe_join(rows, _before(ranges, by, {"rows": "_rows"}), by + ["_range"])
    columns = df.columns + [(F.col("_before_rows") + F.col("_at") - F.col("_first") + 1).alias(out)]
    if total:
        columns.append(F.col("_total_rows").alias(total))
    return located.select(*columns)


def running_total(df: DataFrame, by: Keys | None, order: Iterable[str], amount: str) -> DataFrame:
    """Add ``upto`` (sum of ``amount`` up to and including the row) and ``overall`` (sum of the group)."""
    by = key_list(by)
    order = list(order)
    rows = _ranged(df, by, [F.col(o).asc() for o in order])
    ranges = rows.groupBy(*by, "_range").agg(F.sum(amount).alias("_sum"))
    located = null_safe_join(rows, _before(ranges, by, {"sum": "_sum"}), by + ["_range"])
    local = Window.partitionBy(*by, "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return located.select(
        *df.columns,
        (F.col("_before_sum") + F.sum(amount).over(local)).alias("upto"),
        F.col("_total_sum").alias("overall"),
    )


def value_counts(df: DataFrame, value: str, by: Keys | None = None) -> DataFrame:
    """Distinct non-null values per group with their running counts: value, n, upto, overall."""
    by = key_list(by)
    counts = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("n"))
    return running_total(counts, by, [value], "n")


def quantiles(
    df: DataFrame, value: str, probs: Mapping[str, float], *, by: Keys | None = None, lower: bool = False
) -> DataFrame:
    """Exact quantiles ``{out: q}`` of the non-null values of each group.

    Linear interpolation between the neighbours of q*(n-1), or the lower neighbour alone. Equal values are counted
    before they are sorted, and no group is ever held by one task.
    """
    by = key_list(by)
    ranked = value_counts(df, value, by)
    first = F.col("upto") - F.col("n")

    def at(k: Column) -> Column:
        return F.max(F.when((first <= k) & (k < F.col("upto")), F.col(value)))

    picks = {}
    for name, q in probs.items():
        spot = F.lit(float(q)) * (F.col("overall") - 1)
        low = F.floor(spot)
        picks[f"_lo_{name}"] = at(low)
        if not lower:
            picks[f"_hi_{name}"] = at(F.ceil(spot))
            picks[f"_w_{name}"] = F.max(spot - low)
    picked = ranked.groupBy(*by).agg(*[c.alias(k) for k, c in picks.items()])
    out = []
    for name in probs:
        low = F.col(f"_lo_{name}")
        out.append((low if lower else low + (F.col(f"_hi_{name}") - low) * F.col(f"_w_{name}")).alias(name))
    return picked.select(*by, *out)


def dense_ids(df: DataFrame, key: str, *, out: str = "id") -> DataFrame:
    """Mapping key -> 0..n-1 in key order, over the distinct non-null keys."""
    keys = df.select(key).where(F.col(key).isNotNull()).distinct()
    return positions(keys, None, [key], out="_p").select(key, (F.col("_p") - 1).alias(out))
