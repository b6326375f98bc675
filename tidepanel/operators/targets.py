"""Forward-looking targets and labels. They read future rows and must never be used as features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, WindowSpec, functions as F

from tidepanel.functions.scalar import ColumnOrName, as_col, flag, log_ratio, ratio
from tidepanel.operators.windows import Keys, over_rows, timeline


def forward_targets(
    df: DataFrame, price: str = "close", ret: str = "ret_1d", *, horizon: int = 3, eps: float = 1e-8,
    entity: Keys = "entity", ts: str = "d",
) -> DataFrame:
    """Log return, log volatility and log drawdown over rows 1..horizon ahead, entered at the next row's price."""
    w = timeline(entity, ts)
    entry = F.lead(price, 1).over(w)
    return df.withColumns(
        {
            "future_return": log_ratio(F.lead(price, horizon).over(w), entry),
            "future_vol": F.ln(over_rows("std_samp", ret, 1, horizon, w) + F.lit(eps)),
            "future_drawdown": log_ratio(over_rows("min", price, 1, horizon, w), entry),
        }
    )


def forward_trade_return(k: int, w: WindowSpec, *, close: str = "close", open_: str = "open_price", compat: bool = False) -> Column:
    """Return of buying at the next open and selling at the close k rows ahead.

    ``compat`` divides by (next open - 1) and does not subtract 1, the form in which published results were made.
    """
    exit_, entry = F.lead(close, k).over(w), F.lead(open_, 1).over(w)
    return ratio(exit_, entry - 1) if compat else ratio(exit_, entry) - 1


def up_label(price: str, k: int, w: WindowSpec) -> Column:
    """1 if the price k rows ahead is higher."""
    return flag(ratio(F.lead(price, k).over(w), price) - 1 > 0)


def crash_label(ret: ColumnOrName, threshold: float, w: WindowSpec) -> Column:
    """1 if the next row's return is below the threshold; 0 also at the end of the series."""
    return flag(F.lead(as_col(ret), 1).over(w) < threshold)
