"""Data-quality checks as a relation (check, violations), all of them in one aggregation pass per frame."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F

from tidepanel.session import observed


def not_null(c: str) -> Column:
    return F.col(c).isNull()


def outside(c: str, low: float, high: float, slack: float = 0.0) -> Column:
    """Violated by values outside [low, high] and by nulls."""
    return ~F.coalesce((F.col(c) >= low - slack) & (F.col(c) <= high + slack), F.lit(False))


def not_among(c: str, allowed: Iterable) -> Column:
    return ~F.coalesce(F.col(c).isin(list(allowed)), F.lit(False))


def row_checks(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """Count the rows that violate each condition; ``non_empty`` is violated once by an empty frame."""
    counted = df.agg(
        F.when(F.count(F.lit(1)) == 0, F.lit(1)).otherwise(F.lit(0)).cast("bigint").alias("non_empty"),
        *[F.count_if(condition).alias(name) for name, condition in checks.items()],
    )
    return counted.unpivot([], ["non_empty", *checks], "check", "violations")


def watched(df: DataFrame, checks: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """The relation, written once, and its ``row_checks``, counted by the pass that writes it."""
    counts = {name: F.count_if(condition) for name, condition in checks.items()}
    table, found = observed(df, {"non_empty": F.count(F.lit(1)), **counts})
    rows = [("non_empty", 0 if found["non_empty"] else 1)] + [(name, found[name]) for name in checks]
    return table, df.sparkSession.createDataFrame(rows, "check string, violations bigint")


def group_size_check(df: DataFrame, by: str, min_rows: int, *, name: str = "group_size") -> DataFrame:
    """Number of groups with fewer than ``min_rows`` rows."""
    sizes = df.groupBy(by).agg(F.count(F.lit(1)).alias("_n"))
    return sizes.agg(F.count_if(F.col("_n") < min_rows).alias("violations")).select(F.lit(name).alias("check"), "violations")


def unique_check(df: DataFrame, keys: Iterable[str], *, name: str = "unique_key") -> DataFrame:
    """Number of key values held by more than one row."""
    return group_duplicates(df, list(keys)).agg(F.count(F.lit(1)).alias("violations")).select(
        F.lit(name).alias("check"), "violations"
    )


def group_duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)


def report(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
