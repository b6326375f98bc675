"""Order-book and flow ratios of one bar."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tidepanel.functions.scalar import ratio, ratio_or, repaired_open


def book_ratios() -> dict[str, Column]:
    """Ratios with a neutral default where the divisor is 0, by column name of the bar."""
    c = F.col
    booked = c("bid_volume") + c("offer_volume")
    return {
        "is_active": F.when(booked != 0, F.lit(1)).otherwise(F.lit(0)),
        "turnover": F.ln(1 + ratio_or("volume", "tradeble_shares", 0.0)),
        "foreign_flow": ratio_or(c("foreign_buy") - c("foreign_sell"), "volume", 0.0),
        "order_imbalance": ratio_or(c("bid_volume") - c("offer_volume"), booked, 0.0),
        "spread_proxy": ratio(c("offer") - c("bid"), "close"),
        "relative_spread": F.when(
            c("offer") + c("bid") != 0, ratio(c("offer") - c("bid"), (c("offer") + c("bid")) / 2)
        ).otherwise(F.lit(0.0)),
        "non_regular_activity": ratio_or("non_regular_volume", "volume", 0.0),
    }


def price_action() -> dict[str, Column]:
    """Gap, range and close position against the previous close stored on the bar."""
    c = F.col
    return {
        "gap": ratio(repaired_open("open_price", "previous") - c("previous"), "previous"),
        "intraday_range": ratio(c("high") - c("low"), "previous"),
        "close_position": ratio_or(c("close") - c("low"), c("high") - c("low"), 0.5),
    }


def flow_ratios() -> dict[str, Column]:
    """Ratios that are null where the divisor is 0."""
    c = F.col
    return {
        "bid_offer_imbalance": ratio(c("bid_volume") - c("offer_volume"), c("bid_volume") + c("offer_volume")),
        "foreign_flow_ratio": ratio(c("foreign_buy") - c("foreign_sell"), "volume"),
        "non_regular_vol_ratio": ratio("non_regular_volume", "volume"),
        "hl_range": ratio(c("high") - c("low"), "close"),
    }
