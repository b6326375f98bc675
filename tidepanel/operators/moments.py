"""Mean and deviation of many columns over a moving row frame, at a cost per row that does not grow with the frame.

A sliding frame is evaluated anew for every row, which for tens of columns and 60 rows dwarfs everything else. Cut an
entity's rows into blocks as long as the frame: any frame is then the tail of one block followed by the head of the
next. Heads and tails are running aggregates, and two sets of (count, mean, variance) merge without cancellation.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidepanel.functions.scalar import ratio
from tidepanel.operators.windows import Keys, key_list


def frame_moments(
    df: DataFrame, cols: Iterable[str], n: int, *, end: int = 0, entity: Keys = "entity", ts: str = "d",
    keep: Iterable[str] | None = None, full_only: bool = False, spread: bool = True,
) -> DataFrame:
    """``keep`` and ``cols`` plus ``_n_``, ``_m_`` and ``_v_`` (count, mean, sum of squared deviations) per column.

    The frame is the n rows that end ``end`` rows before the current one. ``full_only`` leaves out the rows whose
    frame starts before the entity does. Without ``spread`` there are no ``_v_``.
    """
    cols = list(cols)
    keep = [c for c in df.columns if c not in cols] if keep is None else list(keep)
    keys = key_list(entity)
    along = Window.partitionBy(*keys).orderBy(ts)
    block = Window.partitionBy(*keys, "_chunk")

    def stats(w, name: str) -> Column:
        w = w.rowsBetween(Window.unboundedPreceding, 0)
        parts = []
        for i, c in enumerate(cols):
            parts += [F.count(c).over(w).alias(f"n{i}"), F.avg(c).over(w).alias(f"m{i}")]
            if spread:
                parts.append(F.var_pop(c).over(w).alias(f"v{i}"))
        return F.struct(*parts).alias(name)

    carried = list(dict.fromkeys([*keys, ts, *keep, *cols]))
    placed = df.select(*carried, F.floor((F.row_number().over(along) - 1) / n).cast("int").alias("_chunk"))
    tails = placed.select("*", stats(block.orderBy(F.col(ts).desc()), "_tail"))
    heads = tails.select("*", stats(block.orderBy(ts), "_head"))
    # blocks increase with time, so this order is the order of time and needs no further sort
    ordered = Window.partitionBy(*keys).orderBy("_chunk", ts)
    paired = heads.select(
        *carried,
        F.lag("_tail", end + n - 1).over(ordered).alias("_tail"),
        F.lag(F.struct("_chunk", "_head"), end).over(ordered).alias("_last"),
        F.lag("_chunk", end + n - 1).over(ordered).alias("_first_chunk"),
    )
    apart = ~F.col("_last._chunk").eqNullSafe(F.col("_first_chunk"))
    if full_only:
        paired = paired.where(F.col("_first_chunk").isNotNull())
    paired = paired.withColumn("_head", F.when(apart, F.col("_last._head")))

    out = []
    for i, c in enumerate(cols):
        n1, n2 = F.coalesce(F.col(f"_tail.n{i}"), F.lit(0)), F.coalesce(F.col(f"_head.n{i}"), F.lit(0))
        m1, m2 = F.col(f"_tail.m{i}"), F.col(f"_head.m{i}")
        share = F.try_divide(n2, n1 + n2)
        out += [(n1 + n2).alias(f"_n_{c}"), F.coalesce(m1 + (m2 - m1) * share, m1, m2).alias(f"_m_{c}")]
        if spread:
            within = [F.coalesce(F.col(f"{s}.v{i}") * k, F.lit(0.0)) for s, k in (("_tail", n1), ("_head", n2))]
            between = F.coalesce((m2 - m1) * (m2 - m1) * n1 * share, F.lit(0.0))
            out.append((within[0] + within[1] + between).alias(f"_v_{c}"))
    return paired.select(*dict.fromkeys([*keep, *cols]), *out)


def sample_deviation(c: str) -> Column:
    """Sample standard deviation from the moments of column c; null below two values."""
    n = F.col(f"_n_{c}")
    return F.when(n > 1, F.sqrt(F.col(f"_v_{c}") / (n - 1)))


def population_deviation(c: str) -> Column:
    n = F.col(f"_n_{c}")
    return F.when(n > 0, F.sqrt(F.col(f"_v_{c}") / n))


def with_beta(df: DataFrame, x: str, y: str, n: int, *, out: str, entity: Keys = "entity", ts: str = "d") -> DataFrame:
    """Add ``windows.beta`` of x on y over the last n rows, at a cost per row that does not grow with n."""
    parts = {"_x": F.col(x), "_y": F.col(y), "_xy": F.col(x) * F.col(y), "_yy": F.col(y) * F.col(y)}
    means = frame_moments(df.withColumns(parts), parts, n, entity=entity, ts=ts, spread=False)
    mean_x, mean_y = F.col("_m__x"), F.col("_m__y")
    slope = ratio(F.col("_m__xy") - mean_x * mean_y, F.col("_m__yy") - mean_y * mean_y)
    return means.select(*df.columns, slope.alias(out))
