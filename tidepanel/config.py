"""Parameters of the pipelines, with the defaults that results depend on."""

from __future__ import annotations

from dataclasses import dataclass, field

# ---- fixed values -----------------------------------------------------------
HORIZONS = (1, 5, 20, 60)
FRAMES = (20, 60)
RECENT_RANKING_DAYS, RECENT_STORE_DAYS = 500, 270
CLASS_CUTS = (-1.5, -0.8, 0.8, 1.5)
EXPOSURE_BY_STATE = {"RISK_OFF": 0.2, "NEUTRAL": 1.0, "RISK_ON": 1.0}
RISK_FEATURES = ["ret_1d", "ret_3d", "ret_5d", "vol_5d", "vol_10d", "volume_ratio_10d"]
ALPHA_FEATURES = [
    "ret_1d", "ret_3d", "ret_5d", "volatility_5d", "volatility_10d", "volume_ratio_10d",
    "bid_offer_imbalance", "foreign_flow_ratio", "non_regular_vol_ratio", "hl_range", "gap_open",
]
STATE_FEATURES = ["ret_1d", "ret_5d", "vol_20", "vol_60", "trend", "drawdown", "volume", "volume_change"]
CYCLE_FEATURES = ["dow_sin", "dow_cos", "woy_sin", "woy_cos", "month_sin", "month_cos"]
# -----------------------------------------------------------------------------

ACTIVITY_FEATURES = ["is_active"] + [f"is_active_{n}d" for n in (5, 20, 60)]
BOOK_FEATURES = [
    "turnover", "foreign_flow", "order_imbalance", "relative_spread", "non_regular_activity", "spread_proxy",
]
PRICE_FEATURES = (
    [f"ret_{k}d" for k in HORIZONS]
    + ["gap", "intraday_range"]
    + [f"drawdown_{n}d" for n in FRAMES]
    + [f"vol_{n}d" for n in FRAMES]
)
EXCESS_FEATURES = [f"excess_ret_{k}d" for k in HORIZONS]
INDEX_FEATURES = (
    ["idx_range"]
    + [f"idx_ret_{k}d" for k in HORIZONS]
    + [f"idx_vol_{n}d" for n in FRAMES]
    + [f"idx_drawdown_{n}d" for n in FRAMES]
)
RATE = "currency_exchange_rate"
RATE_FEATURES = (
    [f"{RATE}_ret_{k}d" for k in HORIZONS]
    + [f"{RATE}_vol_{n}d" for n in FRAMES]
    + [f"{RATE}_mr_{n}d" for n in FRAMES]
)
SCALED_FEATURES = BOOK_FEATURES + PRICE_FEATURES + EXCESS_FEATURES + INDEX_FEATURES + RATE_FEATURES
PLAIN_FEATURES = ACTIVITY_FEATURES + ["close_position", "idx_close_pos"] + CYCLE_FEATURES
MODEL_FEATURES = PLAIN_FEATURES + [f"{c}_n" for c in SCALED_FEATURES]
TARGETS = ("future_return", "future_vol", "future_drawdown")


@dataclass(frozen=True)
class RankingParams:
    window: int = 60
    horizon: int = 3
    val_ratio: float = 0.2
    lookback_days: int | None = None  # RECENT_RANKING_DAYS for the recent panel alone
    eps: float = 1e-8
    std_floor: float = 1e-12


@dataclass(frozen=True)
class StoreParams:
    lookback_days: int | None = None  # RECENT_STORE_DAYS for the recent store alone
    min_names: int = 5
    buckets: int = 5
    beta_rows: int = 60
    train_ratio: float = 0.8


@dataclass(frozen=True)
class RiskParams:
    vol_bull: float = 0.02
    vol_bear: float = 0.03
    crash_threshold: float = -0.03
    crash_quantile: float = 0.95
    quantile_rows: int = 252
    quantile_min_rows: int = 60
    off_at: float = 0.4
    on_at: float = 0.6
    train_ratio: float = 0.8


@dataclass(frozen=True)
class BookParams:
    max_positions: int = 5
    cap: float = 0.30
    hold: int = 3
    cost: float = 2e-4
    capital: float = 1.0
    exposure: dict = field(default_factory=lambda: dict(EXPOSURE_BY_STATE))
