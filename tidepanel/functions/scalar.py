"""Scalar column expressions. Every division is guarded: ANSI mode raises on a zero divisor."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F

ColumnOrName = Column | str


def as_col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(a: ColumnOrName, b: ColumnOrName) -> Column:
    """a / b, null where b is 0 or null."""
    return F.try_divide(as_col(a), as_col(b))


def ratio_or(a: ColumnOrName, b: ColumnOrName, default: float) -> Column:
    """a / b where b is a non-zero number, else ``default``."""
    b = as_col(b)
    return F.when(b != 0, F.try_divide(as_col(a), b)).otherwise(F.lit(default))


def log_ratio(a: ColumnOrName, b: ColumnOrName) -> Column:
    """Natural log of a / b; null unless the quotient is positive."""
    return F.ln(ratio(a, b))


def clip(c: ColumnOrName, low: ColumnOrName | float, high: ColumnOrName | float) -> Column:
    """Limit c to [low, high]; a null stays null."""
    bound = [x if isinstance(x, Column) else F.lit(x) for x in (low, high)]
    c = as_col(c)
    return F.when(c < bound[0], bound[0]).when(c > bound[1], bound[1]).otherwise(c)


def class_bins(c: ColumnOrName, cuts: Sequence[float]) -> Column:
    """Number of the first cut above c; the last class also takes nulls."""
    c = as_col(c)
    out = F.when(c < cuts[0], F.lit(0))
    for label, cut in enumerate(cuts[1:], start=1):
        out = out.when(c < cut, F.lit(label))
    return out.otherwise(F.lit(len(cuts)))


def regime(trend: ColumnOrName, vol: ColumnOrName, *, vol_bull: float, vol_bear: float) -> Column:
    """0 rising and calm, 1 falling and volatile, 2 anything else."""
    trend, vol = as_col(trend), as_col(vol)
    return (
        F.when((trend > 0) & (vol < vol_bull), F.lit(0)).when((trend < 0) & (vol > vol_bear), F.lit(1)).otherwise(F.lit(2))
    )


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it fails or is unknown."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def repaired_open(open_price: ColumnOrName, previous: ColumnOrName) -> Column:
    """A zero open is replaced by a non-zero previous close."""
    open_price, previous = as_col(open_price), as_col(previous)
    return F.when((open_price == 0) & (previous != 0), previous).otherwise(open_price)


def empty_to_null(c: ColumnOrName) -> Column:
    return F.nullif(as_col(c), F.lit(""))


def lookup(c: ColumnOrName, mapping: Mapping[str, float]) -> Column:
    """Value of a small fixed mapping; null for an unknown key."""
    c = as_col(c)
    out = F.lit(None).cast("double")
    for key, value in mapping.items():
        out = F.when(c == key, F.lit(float(value))).otherwise(out)
    return out


def normalised(p: ColumnOrName) -> Column:
    """Array of weights divided by its sum; null when the sum is 0."""
    p = as_col(p)
    total = F.aggregate(p, F.lit(0.0), lambda acc, x: acc + x)
    return F.transform(p, lambda x: F.try_divide(x, total))


def cycle(c: ColumnOrName, period: int) -> tuple[Column, Column]:
    """Sine and cosine of a position within a period."""
    angle = 2 * F.pi() * as_col(c) / F.lit(period)
    return F.sin(angle), F.cos(angle)


def calendar_cycles(day: ColumnOrName) -> dict[str, Column]:
    """Cyclic encodings of weekday (1 = Sunday), ISO week and month."""
    day = as_col(day)
    out = {}
    for name, part, period in (
        ("dow", F.dayofweek(day), 7),
        ("woy", F.weekofyear(day), 52),
        ("month", F.month(day), 12),
    ):
        out[f"{name}_sin"], out[f"{name}_cos"] = cycle(part, period)
    return out
