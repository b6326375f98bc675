"""Cohort backtest: decide at a close, enter at the next open, leave at the close ``hold`` trading days on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidepanel.config import BookParams
from tidepanel.functions.scalar import ratio
from tidepanel.operators.windows import drop_from_high
from tidepanel.session import materialise

STRATEGY, DAY, NAME = "strategy", "d", "entity"


def trading_days(alpha: DataFrame, *, hold: int = 3) -> DataFrame:
    """(strategy, d, i, n, entry_day, exit_day, held_days): the calendar of days with scores, at most a row per day."""
    w = Window.partitionBy(STRATEGY).orderBy(DAY)
    return alpha.select(STRATEGY, DAY).distinct().select(
        STRATEGY,
        DAY,
        (F.row_number().over(w) - 1).alias("i"),
        F.count(F.lit(1)).over(Window.partitionBy(STRATEGY)).cast("int").alias("n"),
        F.lead(DAY, 1).over(w).alias("entry_day"),
        F.lead(DAY, hold).over(w).alias("exit_day"),
        F.array(*[F.lead(DAY, o).over(w) for o in range(1, hold)]).alias("held_days"),
    )


def fills(prices: DataFrame, weights: DataFrame, days: DataFrame) -> DataFrame:
    """Weighted names of the decision days that can still leave, bought at a positive entry price.

    A name without an entry price is skipped. The exit price may be missing.
    """
    opened = prices.select(F.col(DAY).alias("entry_day"), NAME, F.col("open_price").alias("entry_price"))
    closed = prices.select(F.col(DAY).alias("exit_day"), NAME, F.col("close").alias("exit_price"))
    dated = weights.join(days.where(F.col("exit_day").isNotNull()), [STRATEGY, DAY])
    return dated.join(opened.where(F.col("entry_price") > 0), ["entry_day", NAME]).join(closed, ["exit_day", NAME], "left")


def cohort_returns(filled: DataFrame, *, cost: float = 2e-4) -> DataFrame:
    """Growth of one unit of cash per (strategy, decision day), net of cost each way. No exit price: no proceeds."""
    w, gross = F.col("target_weight"), F.col("target_weight") * ratio("exit_price", "entry_price")
    return filled.groupBy(STRATEGY, DAY).agg(
        F.count(F.lit(1)).alias("names"),
        F.sum(w).alias("invested"),
        (1 - (1 + cost) * F.sum(w) + (1 - cost) * F.sum(F.coalesce(gross, F.lit(0.0)))).alias("growth"),
    )


def cohort_marks(filled: DataFrame, prices: DataFrame, *, cost: float = 2e-4) -> DataFrame:
    """Value of one unit of cash on each held day, per (strategy, decision day). A missing price counts 0."""
    held = filled.select(
        STRATEGY, DAY, NAME, "target_weight", "entry_price", F.posexplode("held_days").alias("_pos", "mark_day")
    )
    closes = prices.select(F.col(DAY).alias("mark_day"), NAME, F.col("close").alias("_mark"))
    value = F.col("target_weight") * ratio("_mark", "entry_price")
    marked = held.join(closes, ["mark_day", NAME], "left").groupBy(STRATEGY, DAY, "mark_day")
    return marked.agg(
        F.max(F.col("_pos") + 1).alias("day_offset"),
        (1 - (1 + cost) * F.sum("target_weight") + F.sum(F.coalesce(value, F.lit(0.0)))).alias("mark"),
    )


BLOCK_DAYS = 4096  # about 16 years


def _walked(start: Column, equity: Column, days: Column, hold: int, *, path: bool) -> Column:
    """Account over the days of one block, entered at day ``start``: next flat day (null: the account is closed), equity,
    and with ``path`` the flat days themselves. Days are structs (i, d, growth, n) in order."""
    visited_type = "array<struct<d:date,equity:double>>"
    begin = [start.cast("int").alias("next"), equity.cast("double").alias("equity")]
    begin += [F.from_json(F.lit("[]"), visited_type).alias("path")] if path else []

    def step(acc: Column, x: Column) -> Column:
        closes = x["i"] + hold >= x["n"]
        after = F.when(~closes, F.when(x["growth"].isNotNull(), x["i"] + hold).otherwise(x["i"] + 1)).cast("int")
        fields = [after.alias("next"), (acc["equity"] * F.coalesce(x["growth"], F.lit(1.0))).alias("equity")]
        if path:
            own = F.array(F.struct(x["d"].alias("d"), acc["equity"].alias("equity")))
            fields.append(F.concat(acc["path"], own).alias("path"))
        return F.when(acc["next"] == x["i"], F.struct(*fields)).otherwise(acc)

    return F.aggregate(days, F.struct(*begin), step)


def _entries(blocks: DataFrame, size: int, hold: int, capital: float) -> DataFrame:
    """(strategy, block, start, equity): where and with how much the account of a strategy enters each of its blocks.

    A block maps the day it is entered on, one of its first ``hold``, to the day the next block is entered on and a
    growth. Such maps compose, so prefixes of blocks are composed by pointer doubling: after k rounds a row stands for the
    2^k blocks up to its own. A round is one join of as many rows as there are blocks.
    """
    first = blocks.select(STRATEGY, F.lit(0).alias("block"), F.lit(0).alias("start"), F.lit(float(capital)).alias("equity")).distinct()
    last = blocks.agg(F.max("block")).first()[0] or 0
    if not last:
        return first
    offsets = F.explode(F.when(F.col("block") == 0, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.lit(hold - 1))))
    walked = _walked(F.col("block") * size + F.col("at"), F.lit(1.0), F.col("days"), hold, path=False)
    maps = blocks.withColumn("at", offsets).select(STRATEGY, "block", "at", walked.alias("_w")).select(
        STRATEGY, "block", "at", (F.col("_w.next") - (F.col("block") + 1) * size).alias("out"), F.col("_w.equity").alias("times")
    )
    maps = materialise(maps.where(F.col("out").isNotNull()))
    reach = 1
    while reach <= last:
        earlier = maps.select(
            STRATEGY, (F.col("block") + reach).alias("block"), F.col("at").alias("at_"), F.col("out").alias("at"), F.col("times").alias("times_")
        )
        longer = maps.where(F.col("block") >= reach).join(earlier, [STRATEGY, "block", "at"])
        maps = materialise(
            maps.where(F.col("block") < reach).unionByName(
                longer.select(STRATEGY, "block", F.col("at_").alias("at"), "out", (F.col("times_") * F.col("times")).alias("times"))
            )
        )
        reach *= 2
    later = maps.where("at = 0").select(
        STRATEGY, (F.col("block") + 1).alias("block"), ((F.col("block") + 1) * size + F.col("out")).cast("int").alias("start"),
        (F.lit(float(capital)) * F.col("times")).alias("equity"),
    )
    return first.unionByName(later)


def equity_curve(
    days: DataFrame, cohorts: DataFrame, marks: DataFrame, *, params: BookParams = BookParams(), block_days: int = BLOCK_DAYS
) -> DataFrame:
    """(strategy, d, equity): one account per strategy that holds one cohort at a time.

    A flat day is followed by the day its cohort leaves, or by the next day if nothing was bought. The curve ends on
    the first flat day too late to hold. Which days are flat depends on all days before: the calendar is cut into blocks,
    maps of whole blocks are composed (``_entries``), then the blocks of all strategies are walked in parallel.
    """
    hold = params.hold
    size = max(block_days, hold)
    day = F.struct(F.col("i"), F.col(DAY), F.col("growth"), F.col("n"))
    dated = days.join(cohorts.select(STRATEGY, DAY, "growth"), [STRATEGY, DAY], "left")
    grouped = dated.groupBy(STRATEGY, F.floor(F.col("i") / size).cast("int").alias("block"))
    blocks = materialise(grouped.agg(F.sort_array(F.collect_list(day)).alias("days")))
    walked = _walked(F.col("start"), F.col("equity"), F.col("days"), hold, path=True)
    entered = blocks.join(_entries(blocks, size, hold, params.capital), [STRATEGY, "block"])
    flat = entered.select(STRATEGY, F.explode(walked["path"]).alias("_p")).select(
        STRATEGY, F.col("_p.d").alias(DAY), F.col("_p.equity").alias("equity")
    )
    held = flat.join(marks, [STRATEGY, DAY]).select(
        STRATEGY, F.col("mark_day").alias(DAY), (F.col("equity") * F.col("mark")).alias("equity")
    )
    return flat.unionByName(held)


def with_drawdown(curve: DataFrame) -> DataFrame:
    """Add the relative distance to the highest equity so far."""
    w = Window.partitionBy(STRATEGY).orderBy(DAY)
    return curve.withColumn("drawdown", drop_from_high("equity", None, w))


def performance(curve: DataFrame, *, still: float = 1e-12) -> DataFrame:
    """(strategy, metric, value): total return, worst drawdown, annualised Sharpe ratio of the days that moved.

    A return within ``still`` of 0 is rounding noise of an unchanged account.
    """
    w = Window.partitionBy(STRATEGY).orderBy(DAY)
    moved = ratio("equity", F.lag("equity", 1).over(w)) - 1
    daily = curve.withColumn("_ret", F.when(F.abs(moved) > still, moved))
    stats = daily.groupBy(STRATEGY).agg(
        (ratio(F.max_by("equity", DAY), F.min_by("equity", DAY)) - 1).alias("Total Return"),
        F.min("drawdown").alias("Max Drawdown"),
        F.avg("_ret").alias("_mean"),
        F.stddev_samp("_ret").alias("_std"),
    )
    sharpe = F.when(F.col("_std") > 0, F.sqrt(F.lit(252.0)) * F.col("_mean") / F.col("_std")).otherwise(F.lit(0.0))
    return metric_rows(stats.withColumn("Sharpe", sharpe), [STRATEGY], ["Total Return", "Max Drawdown", "Sharpe"])


def metric_rows(df: DataFrame, ids: list[str], metrics: list[str]) -> DataFrame:
    """Metric columns to (ids, metric, value) rows."""
    return df.unpivot(ids, metrics, "metric", "value")
