"""Fixed-length sequences for sequence models. They multiply the data by the window: project features first."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F

from tidepanel.operators.windows import Keys, key_list, last_rows, timeline


def sequences(
    df: DataFrame, features: Iterable[str], target: str, *, window: int = 60, entity: Keys = "entity", ts: str = "d"
) -> DataFrame:
    """(entity, ts, sequence, target): the ``window`` rows before a row and that row's target."""
    w = timeline(entity, ts)
    step = F.array(*[F.col(f).cast("double") for f in features])
    built = df.select(
        *key_list(entity), ts, F.collect_list(step).over(w.rowsBetween(-window, -1)).alias("sequence"), target
    )
    return built.where(F.size("sequence") == window)


def latest_sequences(
    df: DataFrame, features: Iterable[str], *, window: int = 60, entity: Keys = "entity", ts: str = "d"
) -> DataFrame:
    """(entity, ts, sequence, latest): last ``window`` rows of each entity that has them, and its flat newest row.

    Entities without a row at the newest time of all are left out.
    """
    keys = key_list(entity)
    step = F.array(*[F.col(f).cast("double") for f in features])
    rows = df.select(*keys, ts, step.alias("_step"))
    recent = last_rows(rows, window, entity=keys, ts=ts)
    gathered = recent.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(ts, "_step"))).alias("_rows"))
    full = gathered.where(F.size("_rows") == window).select(
        *keys,
        F.element_at("_rows", -1)[ts].alias(ts),
        F.transform("_rows", lambda r: r["_step"]).alias("sequence"),
        F.element_at("_rows", -1)["_step"].alias("latest"),
    )
    return full.where(F.col(ts) == df.agg(F.max(ts)).scalar())


