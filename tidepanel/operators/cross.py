"""Cross-sectional operators: many entities at one time.

A date may hold any number of entities, so nothing here gathers a date in one task: statistics are map-side combined
and joined back, ranks come from ``order``, and top-k uses the window group limit that prunes before the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidepanel.functions.scalar import ratio
from tidepanel.operators.order import null_safe_join, positions, quantiles, value_counts
from tidepanel.operators.normalise import safe_deviation
from tidepanel.operators.windows import Keys, key_list
from tidepanel.session import materialise


def group_sizes(df: DataFrame, by: Keys = "d", *, out: str = "n") -> DataFrame:
    return df.groupBy(*key_list(by)).agg(F.count(F.lit(1)).alias(out))


def in_large_groups(df: DataFrame, min_rows: int, *, by: str = "d") -> DataFrame:
    """Keep the groups with at least ``min_rows`` rows."""
    big = materialise(group_sizes(df, by, out="_n").where(F.col("_n") >= min_rows).select(by))
    return df.join(big, by, "left_semi")


def zscore_cross(
    df: DataFrame, cols: Iterable[str], *, by: str = "d", eps: float = 1e-8, floor: float = 1e-12, ddof: int = 0
) -> DataFrame:
    """Standardise columns across the rows of each group, in place. The rows are evaluated once, into a table."""
    cols, df = list(cols), materialise(df)
    return standardised(df, cross_statistics(df, cols, by=by, ddof=ddof), cols, by=by, eps=eps, floor=floor)


def cross_statistics(df: DataFrame, cols: Iterable[str], *, by: str = "d", ddof: int = 0) -> DataFrame:
    """A table of ``_m_`` and ``_s_`` (mean, deviation) per column and group."""
    cols, std = list(cols), F.stddev_pop if ddof == 0 else F.stddev_samp
    return materialise(
        df.groupBy(by).agg(*[F.avg(c).alias(f"_m_{c}") for c in cols], *[std(c).alias(f"_s_{c}") for c in cols])
    )


def standardised(
    df: DataFrame, stats: DataFrame, cols: Iterable[str], *, by: str = "d", eps: float = 1e-8, floor: float = 1e-12, how: str = "inner"
) -> DataFrame:
    """Columns standardised in place by ``cross_statistics`` of their group."""
    cols, joined = list(cols), df.join(stats, by, how)
    return joined.select(
        *[
            ((F.col(c) - F.col(f"_m_{c}")) / safe_deviation(f"_s_{c}", eps, floor)).alias(c) if c in cols else F.col(c)
            for c in df.columns
        ]
    )


def percent_ranks(df: DataFrame, value: str, outs: Mapping[str, bool], *, by: Keys | None = None) -> DataFrame:
    """Percentile rank in (0, 1] with ties averaged; nulls get none. ``outs`` maps a name to "ascending"."""
    by = key_list(by)
    ranked = value_counts(df, value, by)
    mid = (F.col("n") + 1) / 2
    table = ranked.select(
        *by,
        F.col(value).alias("_v"),
        *[
            (((F.col("upto") - F.col("n") if up else F.col("overall") - F.col("upto")) + mid) / F.col("overall")).alias(o)
            for o, up in outs.items()
        ],
    )
    return null_safe_join(df.withColumn("_v", F.col(value)), table, by + ["_v"], "left").drop("_v")


def ntile_labels(
    df: DataFrame, n: int, order: Sequence[str], *, by: Keys = "d", out: str = "label"
) -> DataFrame:
    """Bucket 0..n-1 of each row in its group along ``order``; the first buckets take the remainder."""
    placed = positions(df, by, order, out="_p", total="_n")
    at, size, extra = F.col("_p") - 1, F.expr(f"_n div {n}"), F.col("_n") % n
    wide = extra * (size + 1)
    bucket = F.when(at < wide, F.floor(at / (size + 1))).otherwise(extra + F.floor(F.try_divide(at - wide, size)))
    return placed.withColumn(out, bucket.cast("int")).drop("_p", "_n")


def top_k(df: DataFrame, k: int, score: str, *, by: Keys | None = "d", tie: Keys = "entity", out: str = "rank") -> DataFrame:
    """The k best rows per group, best first, ties by ``tie``."""
    w = Window.partitionBy(*key_list(by)).orderBy(F.col(score).desc(), *key_list(tie))
    return df.withColumn(out, F.row_number().over(w)).where(F.col(out) <= k)


def ndcg(
    df: DataFrame, score: str, relevance: str, *, ks: Sequence[int] = (3, 5), by: str = "d", tie: Keys = "entity"
) -> DataFrame:
    """NDCG@k per group with gains 2^rel - 1; a group without any relevant row scores 1."""
    kmax = max(ks)

    def gains(frame: DataFrame, order: str, name: str) -> DataFrame:
        best = top_k(frame.select(by, order, relevance, *key_list(tie)) if order != relevance
                     else frame.select(by, relevance, *key_list(tie)), kmax, order, by=by, tie=tie, out="_r")
        gain = (F.pow(F.lit(2.0), F.col(relevance)) - 1) / F.log2(F.col("_r") + F.lit(1.0))
        return best.groupBy(by).agg(
            *[F.sum(F.when(F.col("_r") <= k, gain).otherwise(F.lit(0.0))).alias(f"{name}{k}") for k in ks]
        )

    both = gains(df, score, "_dcg").join(gains(df, relevance, "_best"), by)

    def value(k: int) -> Column:
        return F.when(F.col(f"_best{k}") == 0, F.lit(1.0)).otherwise(ratio(f"_dcg{k}", f"_best{k}"))

    return both.select(by, *[value(k).alias(f"ndcg_{k}") for k in ks])


def combined_score(
    df: DataFrame,
    *,
    ascending: Mapping[str, bool],
    entity: str = "entity",
    run: str = "run",
    target: str = "target",
    model: str = "model",
    pred: str = "pred",
) -> DataFrame:
    """Score per (entity, run) from a long frame of predictions.

    Each model's predictions become percentile ranks within (run, target, model), descending for the targets that
    ``ascending`` maps to False; models are averaged per target, then targets per run.
    """
    ranked = percent_ranks(df, pred, {"_up": True, "_down": False}, by=[run, target, model])
    ups = [t for t, up in ascending.items() if up]
    oriented = ranked.withColumn("_rank", F.when(F.col(target).isin(ups), F.col("_up")).otherwise(F.col("_down")))
    means = oriented.groupBy(entity, run).agg(
        *[F.avg(F.when(F.col(target) == t, F.col("_rank"))).alias(f"_t{i}") for i, t in enumerate(ascending)]
    )
    parts = F.array_compact(F.array(*[F.col(f"_t{i}") for i in range(len(ascending))]))
    total = F.aggregate(parts, F.lit(0.0), lambda acc, x: acc + x)
    return means.select(entity, run, F.try_divide(total, F.size(parts)).alias("result_score"))


def score_summary(
    scores: DataFrame, runs: Sequence | None = None, *, entity: str = "entity", run: str = "run", score: str = "result_score"
) -> DataFrame:
    """Mean and sample deviation over runs; with ``runs``, also one column per run."""
    wide = [F.max(F.when(F.col(run) == r, F.col(score))).alias(f"{score}{i}") for i, r in enumerate(runs or [])]
    return scores.groupBy(entity).agg(*wide, F.avg(score).alias("score"), F.stddev_samp(score).alias("score_std"))


def robust_delta(
    df: DataFrame, residual: str, *, by: Keys | None = None, scale: float = 1.345 * 1.4826, out: str = "delta"
) -> DataFrame:
    """Huber threshold per group: ``scale`` times the median absolute deviation of the residuals."""
    by = key_list(by)
    df = materialise(df.select(*by, residual))
    middle = _medians(df, residual, by)
    if by:
        centred = null_safe_join(df.select(*by, residual), middle, by)
        deviation = F.abs(F.col(residual) - F.col("_median"))
    else:
        centred, deviation = df, F.abs(F.col(residual) - middle.scalar())
    spread = _medians(centred.select(*by, deviation.alias("_dev")), "_dev", by)
    return spread.select(*by, (F.col("_median") * F.lit(scale)).alias(out))


def _medians(df: DataFrame, value: str, by: list[str]) -> DataFrame:
    return materialise(quantiles(df, value, {"_median": 0.5}, by=by))
