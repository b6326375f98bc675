"""Robust scaling by quartiles of the training rows."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, functions as F

from tidepanel.functions.scalar import ratio
from tidepanel.operators.order import quantiles
from tidepanel.operators.windows import Keys, key_list
from tidepanel.session import materialise

QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}
SKETCH_K = 1024


def unpivoted(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Long frame (feature, value)."""
    return df.unpivot([], list(cols), "feature", "value")


def lower_quantiles(df: DataFrame, cols: Iterable[str], *, by: Keys | None = None) -> DataFrame:
    """One row per feature (and group): the values at sorted positions floor(q * (n - 1)), all features in one pass."""
    by = key_list(by)
    return quantiles(df.unpivot(by, list(cols), "feature", "value"), "value", QUARTILES, by=[*by, "feature"], lower=True)


def rank_error(k: int = SKETCH_K) -> float:
    """How far the rank of a sketched quantile may be off, as a share of the rows: twice the published bound of this kind
    of sketch at 99 %, which fewer than one in a million exceed."""
    return 2 * 2.296 / k**0.9021


def sketched_quantiles(
    df: DataFrame, cols: Iterable[str], *, by: Keys | None = None, probs: Mapping[str, float] = QUARTILES, k: int = SKETCH_K
) -> DataFrame:
    """``lower_quantiles`` per group from mergeable sketches: one scan, one shuffle of sketches of bounded size, no sort.

    The rank of a value is off by at most ``rank_error(k)``; groups of fewer than about k values are exact.
    """
    by = key_list(by)
    long = df.unpivot(by, list(cols), "feature", "value").where(F.col("value").isNotNull())
    sketch = F.kll_sketch_agg_double("value", k)
    held = long.groupBy(*by, "feature").agg(sketch.alias("_sketch"), F.count(F.lit(1)).alias("n"))
    picks = [F.kll_sketch_get_quantile_double("_sketch", F.lit(float(q))).alias(name) for name, q in probs.items()]
    return held.select(*by, "feature", "n", *picks)


def fit_robust(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """One row of statistics ``{q1,median,q3}_{col}``."""
    long = lower_quantiles(df, cols)
    return materialise(
        long.agg(
            *[
                F.max(F.when(F.col("feature") == c, F.col(q))).alias(f"{q}_{c}")
                for c in cols
                for q in QUARTILES
            ]
        )
    )


def apply_robust(df: DataFrame, stats: DataFrame, cols: Iterable[str]) -> DataFrame:
    """(x - median) / (q3 - q1) in place, null where the quartiles coincide. ``stats`` runs once as a scalar."""
    cols = list(cols)
    fitted = df.withColumn("_fit", stats.select(F.struct("*")).scalar())
    return fitted.select(
        *[
            ratio(F.col(c) - F.col(f"_fit.median_{c}"), F.col(f"_fit.q3_{c}") - F.col(f"_fit.q1_{c}")).alias(c)
            if c in cols
            else F.col(c)
            for c in df.columns
        ]
    )
