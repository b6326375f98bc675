"""Window expressions and operators along time, per entity.

``entity`` may be one column or several (for instance entity and block, see ``blocks``). All expressions built on one
``timeline`` share a partitioning and an order, so Catalyst plans one exchange and one sort for all of them.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from tidepanel.functions.scalar import ColumnOrName, as_col, log_ratio, ratio

Keys = str | Iterable[str]


def key_list(keys: Keys | None) -> list[str]:
    if keys is None:
        return []
    return [keys] if isinstance(keys, str) else list(keys)


def timeline(entity: Keys = "entity", ts: str = "d") -> WindowSpec:
    return Window.partitionBy(*key_list(entity)).orderBy(ts)


def change(c: ColumnOrName, k: int, w: WindowSpec) -> Column:
    """Simple return over k rows."""
    return ratio(c, F.lag(as_col(c), k).over(w)) - 1


def log_change(c: ColumnOrName, k: int, w: WindowSpec) -> Column:
    return log_ratio(c, F.lag(as_col(c), k).over(w))


AGGREGATES = {
    "mean": F.avg,
    "sum": F.sum,
    "min": F.min,
    "max": F.max,
    "count": F.count,
    "std_pop": F.stddev_pop,
    "std_samp": F.stddev_samp,
}


def over_rows(agg: str, c: ColumnOrName, low: int, high: int, w: WindowSpec) -> Column:
    """Aggregate of the rows from ``low`` to ``high`` relative to the current one."""
    return AGGREGATES[agg](as_col(c)).over(w.rowsBetween(low, high))


def trailing(agg: str, c: ColumnOrName, n: int, w: WindowSpec) -> Column:
    """Aggregate of the last n rows, the current one included."""
    return over_rows(agg, c, 1 - n, Window.currentRow, w)


def drop_from_high(c: ColumnOrName, n: int | None, w: WindowSpec) -> Column:
    """Relative distance to the highest of the last n rows, or of all rows so far."""
    low = Window.unboundedPreceding if n is None else 1 - n
    return ratio(c, over_rows("max", c, low, Window.currentRow, w)) - 1


def relative_volume(c: ColumnOrName, n: int, w: WindowSpec) -> Column:
    """Log of a volume against its trailing mean; null when there is no volume."""
    return log_ratio(c, trailing("mean", c, n, w))


def active_over(c: ColumnOrName, n: int, w: WindowSpec) -> Column:
    """1 if the trailing sum is non-zero."""
    return F.when(trailing("sum", c, n, w) != 0, F.lit(1)).otherwise(F.lit(0))


def rolling_quantile(c: ColumnOrName, q: float, n: int, min_rows: int, w: WindowSpec) -> Column:
    """Linear-interpolated quantile of the last n rows once ``min_rows`` of them are not null.

    The frame is gathered as an array and sorted, which is bounded by n and much cheaper than a percentile aggregate
    that starts over for every row.
    """
    values = F.sort_array(F.collect_list(as_col(c)).over(w.rowsBetween(1 - n, Window.currentRow)))

    def pick(v: Column) -> Column:
        spot = F.lit(q) * (F.size(v) - 1)
        low, high = F.floor(spot).cast("int"), F.ceil(spot).cast("int")
        return F.when(F.size(v) >= min_rows, v[low] + (v[high] - v[low]) * (spot - low))

    return F.transform(F.array(values), pick)[0]


def beta(x: ColumnOrName, y: ColumnOrName, n: int, w: WindowSpec, *, paired: bool = False) -> Column:
    """Slope of x on y over the last n rows.

    Each mean is taken over the rows where its own operand is known; with ``paired``, over the rows where both are.
    """
    x, y = as_col(x), as_col(y)
    frame = w.rowsBetween(1 - n, Window.currentRow)
    if paired:
        return ratio(F.covar_pop(x, y).over(frame), F.var_pop(F.when(x.isNotNull(), y)).over(frame))
    mean_x, mean_y = F.avg(x).over(frame), F.avg(y).over(frame)
    return ratio(F.avg(x * y).over(frame) - mean_x * mean_y, F.avg(y * y).over(frame) - mean_y * mean_y)


def rolling(
    df: DataFrame, specs: Mapping[str, tuple[str, str, int, int]], *, entity: Keys = "entity", ts: str = "d"
) -> DataFrame:
    """Add ``{out: (aggregate, column, low, high)}`` in one projection."""
    w = timeline(entity, ts)
    return df.withColumns({out: over_rows(a, c, lo, hi, w) for out, (a, c, lo, hi) in specs.items()})


def lagged_return(
    df: DataFrame, value: str, ks: Iterable[int], *, entity: Keys = "entity", ts: str = "d", log: bool = False,
    prefix: str = "ret",
) -> DataFrame:
    """Add ``{prefix}_{k}d`` for every k."""
    w = timeline(entity, ts)
    step = log_change if log else change
    return df.withColumns({f"{prefix}_{k}d": step(value, k, w) for k in ks})


def numbered(
    df: DataFrame, *, entity: Keys = "entity", ts: str = "d", newest_first: bool = False, out: str = "step_count"
) -> DataFrame:
    """Row number along time."""
    w = Window.partitionBy(*key_list(entity)).orderBy(F.col(ts).desc() if newest_first else F.col(ts))
    return df.withColumn(out, F.row_number().over(w).cast("bigint"))


def after_warmup(df: DataFrame, n: int, *, entity: Keys = "entity", ts: str = "d") -> DataFrame:
    """Drop the first n rows of each entity."""
    return numbered(df, entity=entity, ts=ts, out="_row").where(F.col("_row") > n).drop("_row")


def last_rows(df: DataFrame, n: int, *, entity: Keys = "entity", ts: str = "d") -> DataFrame:
    """Newest n rows of each entity (pruned before the shuffle by the window group limit)."""
    return numbered(df, entity=entity, ts=ts, newest_first=True, out="_row").where(F.col("_row") <= n).drop("_row")


def with_enough_history(df: DataFrame, ratio_: float, min_rows: int, *, entity: Keys = "entity") -> DataFrame:
    """Keep entities of which round(ratio * rows) exceeds ``min_rows``; adds ``total_step``."""
    total = F.count(F.lit(1)).over(Window.partitionBy(*key_list(entity)))
    return df.withColumn("total_step", total).where(F.round(F.col("total_step") * F.lit(ratio_)) > min_rows)
