"""Time-aware train / validation splits. Each adds a boolean ``is_val``; two filters give the two sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tidepanel.operators.order import positions
from tidepanel.operators.windows import Keys, key_list, numbered


def split_date(df: DataFrame, ratio: float = 0.8, *, ts: str = "d") -> DataFrame:
    """One row: the distinct time at zero-based position int(n * ratio). Times are numbered by range, not in one task."""
    placed = positions(df.select(ts).where(F.col(ts).isNotNull()).distinct(), None, [ts], out="_p", total="_n")
    return placed.where(F.col("_p") - 1 == F.floor(F.col("_n") * F.lit(ratio))).select(F.col(ts).alias("split_at"))


def split_by_dates(df: DataFrame, ratio: float = 0.8, *, ts: str = "d") -> DataFrame:
    """Validation: everything after the split date. The frame is read twice and should be a table."""
    return df.withColumn("is_val", F.col(ts) > split_date(df, ratio, ts=ts).scalar())


def split_entity_tail(df: DataFrame, ratio: float = 0.2, *, entity: Keys = "entity", ts: str = "d") -> DataFrame:
    """Validation: the newest round(ratio * rows) of each entity. Adds ``step_count`` (1 = newest), ``total_step``."""
    total = F.count(F.lit(1)).over(Window.partitionBy(*key_list(entity)))
    counted = numbered(df, entity=entity, ts=ts, newest_first=True).withColumn("total_step", total)
    return counted.withColumn("is_val", F.col("step_count") <= F.round(F.col("total_step") * F.lit(ratio)))


def split_rows(df: DataFrame, ratio: float = 0.8, *, entity: Keys = "entity", ts: str = "d") -> DataFrame:
    """Validation: rows beyond ratio * (number of rows) of each series. Adds ``row_idx``."""
    total = F.count(F.lit(1)).over(Window.partitionBy(*key_list(entity)))
    counted = numbered(df, entity=entity, ts=ts, out="row_idx").withColumn("_n", total)
    return counted.withColumn("is_val", F.col("row_idx") > F.col("_n") * F.lit(ratio)).drop("_n")


def train(df: DataFrame) -> DataFrame:
    return df.where(~F.col("is_val"))


def validation(df: DataFrame) -> DataFrame:
    return df.where("is_val")


def reunited(train_df: DataFrame, val_df: DataFrame) -> DataFrame:
    """Both sets in one relation, columns matched by name."""
    return train_df.unionByName(val_df)


