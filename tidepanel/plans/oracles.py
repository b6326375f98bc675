"""ANSI SQL for DuckDB that each query is checked against, composed from common table expressions."""

from __future__ import annotations

from collections.abc import Iterable

from tidepanel.config import (
    ALPHA_FEATURES, FRAMES, HORIZONS, RATE, RISK_FEATURES, SCALED_FEATURES, STATE_FEATURES,
)

EPS = "1e-8"


def div(a: str, b: str) -> str:
    return f"(({a}) / nullif({b}, 0))"


def ln(x: str) -> str:
    return f"(CASE WHEN ({x}) > 0 THEN ln({x}) END)"


def over(entity: str = "entity", low: int | str | None = None, high: int | str = 0, order: str = "d") -> str:
    """Window in parentheses; without ``low`` it has no frame."""

    def bound(n) -> str:
        if n == "all":
            return "UNBOUNDED PRECEDING"
        return "CURRENT ROW" if n == 0 else f"{abs(n)} {'PRECEDING' if n < 0 else 'FOLLOWING'}"

    frame = "" if low is None else f" ROWS BETWEEN {bound(low)} AND {bound(high)}"
    return f"OVER (PARTITION BY {entity} ORDER BY {order}{frame})"


def change(c: str, k: int, entity: str = "entity") -> str:
    return f"({div(c, f'lag({c}, {k}) {over(entity)}')} - 1)"


def log_change(c: str, k: int, entity: str = "entity") -> str:
    return ln(div(c, f"lag({c}, {k}) {over(entity)}"))


def trailing(agg: str, c: str, n: int, entity: str = "entity") -> str:
    return f"{agg}({c}) {over(entity, 1 - n)}"


def drop_from_high(c: str, n: int | None, entity: str = "entity") -> str:
    low = "all" if n is None else 1 - n
    return f"({div(c, f'max({c}) {over(entity, low)}')} - 1)"


PRICES = {"open_price", "close", "high", "low", "bid", "offer", "previous", "target"}


def final(ctes: Iterable[str], source: str, plain: str, doubles: Iterable[str] = (), tail: str = "") -> str:
    """SELECT of plain expressions and doubles rounded to 6 decimals without negative zero."""
    rounded = [f"round({c}, {9 if c in PRICES else 6}) + 0.0 AS \"{c}\"" for c in doubles]
    body = ", ".join(([plain] if plain else []) + rounded)
    return f"WITH {', '.join(ctes)} SELECT {body} FROM {source} {tail}"


# ---- shared relations ----------------------------------------------------------

LOTS = """lots AS (
    SELECT l_suppkey, s_nationkey, CAST(l_shipdate AS DATE) AS d, l_extendedprice / l_quantity AS p,
           (l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_quantity) AS ord, l_quantity, l_extendedprice,
           l_discount, l_tax, l_linestatus, l_returnflag
    FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey)"""


def bars(entity: str = "l_suppkey") -> list[str]:
    def quantity(c: str, v: str) -> str:
        return f"sum(CASE WHEN {c} = '{v}' THEN l_quantity ELSE 0.0 END)"

    return [
        LOTS,
        f"""days AS (
    SELECT CAST({entity} AS BIGINT) AS entity, d, arg_min(p, ord) AS open_price, arg_max(p, ord) AS close,
           max(p) AS high, min(p) AS low, sum(l_quantity) AS volume, sum(l_extendedprice) AS value,
           {quantity('l_linestatus', 'O')} AS bid_volume, {quantity('l_linestatus', 'F')} AS offer_volume,
           {quantity('l_returnflag', 'A')} AS foreign_buy, {quantity('l_returnflag', 'R')} AS foreign_sell,
           {quantity('l_returnflag', 'N')} AS non_regular_volume,
           min(p * (1 - l_discount)) AS bid, max(p * (1 + l_tax)) AS offer
    FROM lots WHERE {entity} IS NOT NULL GROUP BY 1, 2)""",
        f"""bars AS (
    SELECT *, coalesce(lag(close, 1) {over()}, 0.0) AS previous, sum(volume) OVER (PARTITION BY entity) AS tradeble_shares
    FROM days)""",
    ]


BARS = bars()
NATION_BARS = bars("s_nationkey")

INDEX = [
    LOTS,
    """series AS (
    SELECT 'COMPOSITE' AS index_profile, d, sum(l_extendedprice) / nullif(sum(l_quantity), 0) AS close, max(p) AS highest,
           min(p) AS lowest, sum(l_quantity) AS volume, sum(l_extendedprice) AS value
    FROM lots GROUP BY d
    UNION ALL
    SELECT n_name, d, sum(l_extendedprice) / nullif(sum(l_quantity), 0), max(p), min(p), sum(l_quantity), sum(l_extendedprice)
    FROM lots JOIN nation ON s_nationkey = n_nationkey GROUP BY n_name, d)""",
]

_IDX = over("index_profile")
MARKET = INDEX + [
    """rates AS (
    SELECT CAST(o_orderdate AS DATE) AS d, avg(o_totalprice) / 1.0 AS rate FROM orders GROUP BY 1)""",
    f"""market_rows AS (
    SELECT index_profile, d, CASE WHEN highest = lowest THEN 0.5 ELSE (close - lowest) / (highest - lowest) END AS idx_close_pos,
           highest - lowest AS span, value AS lvl, rate
    FROM series JOIN rates USING (d) WHERE index_profile = 'COMPOSITE')""",
    "market_1 AS (SELECT index_profile, d, idx_close_pos, "
    + f"{div('span', f'lag(lvl, 1) {_IDX}')} AS idx_range, "
    + ", ".join(f"{log_change('lvl', k, 'index_profile')} AS idx_ret_{k}d" for k in HORIZONS)
    + ", "
    + ", ".join(f"{drop_from_high('lvl', n, 'index_profile')} AS idx_drawdown_{n}d" for n in FRAMES)
    + ", "
    + ", ".join(f"{log_change('rate', k, 'index_profile')} AS {RATE}_ret_{k}d" for k in HORIZONS)
    + " FROM market_rows)",
    "market_2 AS (SELECT *, "
    + ", ".join(
        f"{ln(trailing('stddev_samp', 'idx_ret_1d', n, 'index_profile'))} AS idx_vol_{n}d, "
        f"{ln(trailing('stddev_samp', f'{RATE}_ret_1d', n, 'index_profile'))} AS {RATE}_vol_{n}d, "
        f"{RATE}_ret_1d - {trailing('avg', f'{RATE}_ret_1d', n, 'index_profile')} AS {RATE}_mr_{n}d"
        for n in FRAMES
    )
    + " FROM market_1)",
    "market AS (SELECT * EXCLUDE (index_profile) FROM market_2 WHERE idx_ret_60d IS NOT NULL)",
]
MARKET_COLUMNS = (
    ["idx_close_pos", "idx_range"]
    + [f"idx_ret_{k}d" for k in HORIZONS]
    + [f"idx_drawdown_{n}d" for n in FRAMES]
    + [f"idx_vol_{n}d" for n in FRAMES]
    + [f"{RATE}_ret_{k}d" for k in HORIZONS]
    + [f"{RATE}_vol_{n}d" for n in FRAMES]
    + [f"{RATE}_mr_{n}d" for n in FRAMES]
)

BOOK = {
    "turnover": "ln(1 + CASE WHEN tradeble_shares <> 0 THEN volume / tradeble_shares ELSE 0 END)",
    "foreign_flow": "CASE WHEN volume <> 0 THEN (foreign_buy - foreign_sell) / volume ELSE 0 END",
    "order_imbalance": "CASE WHEN bid_volume + offer_volume <> 0 THEN (bid_volume - offer_volume) / (bid_volume + offer_volume) ELSE 0 END",
    "spread_proxy": "(offer - bid) / nullif(close, 0)",
    "relative_spread": "CASE WHEN offer + bid <> 0 THEN (offer - bid) / ((offer + bid) / 2) ELSE 0 END",
    "non_regular_activity": "CASE WHEN volume <> 0 THEN non_regular_volume / volume ELSE 0 END",
}
PRICE = {
    "gap": "(CASE WHEN open_price = 0 AND previous <> 0 THEN previous ELSE open_price END - previous) / nullif(previous, 0)",
    "intraday_range": "(high - low) / nullif(previous, 0)",
    "close_position": "CASE WHEN high <> low THEN (close - low) / nullif(high - low, 0) ELSE 0.5 END",
}
FLOW = {
    "bid_offer_imbalance": "(bid_volume - offer_volume) / nullif(bid_volume + offer_volume, 0)",
    "foreign_flow_ratio": "(foreign_buy - foreign_sell) / nullif(volume, 0)",
    "non_regular_vol_ratio": "non_regular_volume / nullif(volume, 0)",
    "hl_range": "(high - low) / nullif(close, 0)",
}
CYCLES = {
    f"{name}_{fn}": f"{fn}(2 * pi() * ({part}) / {period})"
    for name, part, period in (("dow", "dayofweek(d) + 1", 7), ("woy", "weekofyear(d)", 52), ("month", "month(d)", 12))
    for fn in ("sin", "cos")
}


def aliased(exprs: dict[str, str]) -> str:
    return ", ".join(f"{e} AS {n}" for n, e in exprs.items())


_SCALED_OWN = [c for c in SCALED_FEATURES if c not in MARKET_COLUMNS and not c.startswith("excess")]
BASE = BARS + MARKET[1:] + [
    f"own_1 AS (SELECT entity, d, close, {aliased(BOOK)}, {aliased(PRICE)}, "
    + ", ".join(f"{log_change('close', k)} AS ret_{k}d" for k in HORIZONS)
    + ", "
    + ", ".join(f"{drop_from_high('close', n)} AS drawdown_{n}d" for n in FRAMES)
    + " FROM bars)",
    "own_2 AS (SELECT *, "
    + ", ".join(f"{ln(trailing('stddev_samp', 'ret_1d', n) + ' + ' + EPS)} AS vol_{n}d" for n in FRAMES)
    + " FROM own_1)",
    "base AS (SELECT own_2.*, "
    + ", ".join(f"ret_{k}d - idx_ret_{k}d AS excess_ret_{k}d" for k in HORIZONS)
    + ", market.* EXCLUDE (d) FROM own_2 JOIN market USING (d) WHERE ret_60d IS NOT NULL)",
]


def safe(s: str) -> str:
    return f"coalesce(CASE WHEN {s} < 1e-12 THEN {EPS} ELSE {s} END, {EPS})"


def past_z(c: str) -> str:
    w = over("entity", -60, -1)
    return f"({c} - avg({c}) {w}) / {safe(f'(stddev_samp({c}) {w})')}"


PANEL = BASE + [
    "panel_all AS (SELECT entity, d, "
    + ", ".join(f"{past_z(c)} AS {c}_n" for c in SCALED_FEATURES)
    + f", row_number() {over()} AS step FROM base)",
    "panel AS (SELECT * FROM panel_all WHERE step > 60)",
]
AHEAD = BASE + [
    f"""ahead AS (
    SELECT entity, d, count(*) OVER (PARTITION BY entity) AS total_step,
           {ln(div(f'lead(close, 3) {over()}', f'lead(close, 1) {over()}'))} AS future_return,
           ln(stddev_samp(ret_1d) {over('entity', 1, 3)} + {EPS}) AS future_vol,
           {ln(div(f'min(close) {over("entity", 1, 3)}', f'lead(close, 1) {over()}'))} AS future_drawdown
    FROM base)"""
]


def cross_z(c: str) -> str:
    w = "OVER (PARTITION BY d)"
    return f"({c} - avg({c}) {w}) / {safe(f'(stddev_pop({c}) {w})')} AS {c}"


TARGET_COLUMNS = ["future_return", "future_vol", "future_drawdown"]
TARGETS = AHEAD + [
    "known AS (SELECT * FROM ahead WHERE future_return IS NOT NULL AND round(total_step * 0.2) > 64)",
    f"targets AS (SELECT entity, d, total_step, {', '.join(cross_z(c) for c in TARGET_COLUMNS)} FROM known)",
]


def five_classes(c: str) -> str:
    return f"CASE WHEN {c} < -1.5 THEN 0 WHEN {c} < -0.8 THEN 1 WHEN {c} < 0.8 THEN 2 WHEN {c} < 1.5 THEN 3 ELSE 4 END"


def store(lookback: int | None) -> list[str]:
    """Feature store relation ``store``."""

    def recent(source: str) -> str:
        if lookback is None:
            return source
        return f"(SELECT * FROM {source} WHERE d >= (SELECT min(d) FROM (SELECT DISTINCT d FROM {source} ORDER BY d DESC LIMIT {lookback})))"

    beta_w = over("entity", -59)
    return BARS + INDEX[1:] + [
        f"""s1 AS (SELECT * REPLACE (CASE WHEN open_price = 0 AND previous <> 0 THEN previous ELSE open_price END AS open_price)
            FROM {recent('bars')} b)""",
        f"""s2 AS (SELECT *, {', '.join(f"{change('close', k)} AS ret_{k}d" for k in (1, 3, 5))},
            {div('open_price', f'lag(close, 1) {over()}')} - 1 AS gap_open, {aliased(FLOW)} FROM s1)""",
        f"""s3 AS (SELECT *, {', '.join(f"{trailing('stddev_pop', 'ret_1d', n)} AS volatility_{n}d" for n in (5, 10))},
            {ln(div('volume', trailing('avg', 'volume', 10)))} AS volume_ratio_10d FROM s2)""",
        f"""ix AS (SELECT d, {change('close', 1, 'index_profile')} AS index_ret_1d, {change('close', 3, 'index_profile')} AS index_ret_3d
            FROM {recent('series')} x WHERE index_profile = 'COMPOSITE')""",
        "s4 AS (SELECT s3.*, index_ret_1d, index_ret_3d, ret_3d - index_ret_3d AS rel_ret_3d FROM s3 LEFT JOIN ix USING (d))",
        f"""s5 AS (SELECT *, (avg(ret_1d * index_ret_1d) {beta_w} - avg(ret_1d) {beta_w} * avg(index_ret_1d) {beta_w})
              / nullif(avg(index_ret_1d * index_ret_1d) {beta_w} - avg(index_ret_1d) {beta_w} * avg(index_ret_1d) {beta_w}, 0) AS beta_60d,
            {', '.join(f"{div(f'lead(close, {k}) {over()}', f'lead(open_price, 1) {over()}')} - 1 AS fwd_ret_{k}d" for k in (3, 5))}
            FROM s4)""",
        """store AS (SELECT * FROM s5 WHERE ret_5d IS NOT NULL AND volatility_10d IS NOT NULL AND beta_60d IS NOT NULL
            AND fwd_ret_3d IS NOT NULL)""",
    ]


STORE = store(None)
ALPHA = STORE + [
    """alpha AS (SELECT *, ntile(5) OVER (PARTITION BY d ORDER BY fwd_ret_3d, entity) - 1 AS label FROM store
        WHERE d IN (SELECT d FROM store GROUP BY d HAVING count(*) >= 5))"""
]

SERIES = [
    f"""f1 AS (SELECT index_profile, d, close, volume, {', '.join(f"{change('close', k, 'index_profile')} AS ret_{k}d" for k in (1, 3, 5))}
        FROM series)""",
    f"""features AS (SELECT *, {', '.join(f"{trailing('stddev_pop', 'ret_1d', n, 'index_profile')} AS vol_{n}d" for n in (5, 10))},
        {ln(div('volume', trailing('avg', 'volume', 10, 'index_profile')))} AS volume_ratio_10d FROM f1)""",
]

STATE = INDEX + [
    f"""m1 AS (SELECT index_profile, d, {change('close', 1, 'index_profile')} AS ret_1d, {change('close', 5, 'index_profile')} AS ret_5d,
        {trailing('avg', 'close', 20, 'index_profile')} - {trailing('avg', 'close', 60, 'index_profile')} AS trend,
        {drop_from_high('close', None, 'index_profile')} AS drawdown, volume, {change('volume', 1, 'index_profile')} AS volume_change
        FROM series)""",
    f"""m2 AS (SELECT *, {', '.join(f"{trailing('stddev_samp', 'ret_1d', n, 'index_profile')} AS vol_{n}" for n in (20, 60))} FROM m1)""",
    f"""m3 AS (SELECT *, lead(vol_20, 5) {_IDX} AS future_vol, CASE WHEN lead(ret_1d, 1) {_IDX} < -0.03 THEN 1 ELSE 0 END AS crash,
        CASE WHEN trend > 0 AND vol_20 < 0.02 THEN 0 WHEN trend < 0 AND vol_20 > 0.03 THEN 1 ELSE 2 END AS regime,
        row_number() {_IDX} AS rn FROM m2)""",
    "state AS (SELECT * FROM m3 WHERE rn > 60 AND future_vol IS NOT NULL)",
]
SPLIT_STATE = STATE + [
    f"comp AS (SELECT *, row_number() {_IDX} AS row_idx FROM state WHERE index_profile = 'COMPOSITE')",
    "split AS (SELECT *, row_idx > (SELECT max(row_idx) * 0.8 FROM comp) AS is_val FROM comp)",
]
LOWER = SPLIT_STATE + [
    "long AS ("
    + " UNION ALL ".join(f"SELECT '{c}' AS feature, {c} AS value FROM split WHERE NOT is_val" for c in STATE_FEATURES)
    + ")",
    "ranked AS (SELECT *, percent_rank() OVER (PARTITION BY feature ORDER BY value) AS pr FROM long WHERE value IS NOT NULL)",
    """quart AS (SELECT feature, max(CASE WHEN pr <= 0.25 THEN value END) AS q1, max(CASE WHEN pr <= 0.5 THEN value END) AS median,
        max(CASE WHEN pr <= 0.75 THEN value END) AS q3 FROM ranked GROUP BY feature)""",
]

RISK = SERIES + [
    """scored AS (SELECT *, 1 / (1 + exp(-50 * ret_3d)) AS risk_prob FROM features WHERE ret_5d IS NOT NULL AND vol_10d IS NOT NULL)""",
    f"""limits AS (SELECT *, CASE WHEN count(vol_10d) {over('index_profile', -251)} >= 60
        THEN quantile_cont(vol_10d, 0.95) {over('index_profile', -251)} END AS vol_limit FROM scored)""",
    "flags AS (SELECT *, coalesce(ret_5d <= -0.03, false) OR coalesce(vol_10d >= vol_limit, false) AS crash_flag FROM limits)",
    "exposed AS (SELECT *, CASE WHEN crash_flag THEN 0.0 ELSE least(greatest(risk_prob, 0.0), 1.0) END AS risk_exposure FROM flags)",
    """risk AS (SELECT *, CASE WHEN risk_exposure >= 0.6 THEN 'RISK_ON' WHEN risk_exposure <= 0.4 THEN 'RISK_OFF'
        ELSE 'NEUTRAL' END AS risk_state FROM exposed)""",
]

# Weights by repeated capping: five rounds of "cap what is over, hand the rest to the free names by rank".
_ROUNDS = 5


def _cap_rounds() -> list[str]:
    by = "OVER (PARTITION BY strategy, d)"
    out = ["w0 AS (SELECT *, raw_weight AS w, false AS capped FROM weighted)"]
    for i in range(_ROUNDS):
        out += [
            f"c{i} AS (SELECT * REPLACE (CASE WHEN w > 0.3 THEN 0.3 ELSE w END AS w, capped OR w > 0.3 AS capped), max(w) {by} > 0.3 AS hit FROM w{i})",
            f"""l{i} AS (SELECT *, exposure - sum(w) {by} AS leftover, sum(CASE WHEN NOT capped THEN signal END) {by} AS free FROM c{i})""",
            f"""w{i + 1} AS (SELECT * EXCLUDE (hit, leftover, free) REPLACE (w + CASE WHEN hit AND leftover > 1e-8 AND NOT capped
                THEN signal / free * leftover ELSE 0 END AS w) FROM l{i})""",
        ]
    out.append(f"capped AS (SELECT *, w AS target_weight FROM w{_ROUNDS})")
    return out


SIGNALS = STORE + RISK + [
    """signals AS (SELECT 'momentum' AS strategy, entity, d, ret_5d AS alpha_score FROM store
        UNION ALL SELECT 'reversal', entity, d, -ret_1d FROM store
        UNION ALL SELECT 'flow', entity, d, foreign_flow_ratio FROM store)""",
    """allowed AS (SELECT d, greatest(least(risk_exposure, 1.0), 0.0) AS exposure FROM risk
        WHERE index_profile = 'COMPOSITE' AND risk_state <> 'RISK_OFF' AND risk_exposure > 0)""",
    """best AS (SELECT *, row_number() OVER (PARTITION BY strategy, d ORDER BY alpha_score DESC NULLS LAST, entity) AS rank
        FROM signals JOIN allowed USING (d) QUALIFY rank <= 5)""",
    "signal AS (SELECT *, count(*) OVER (PARTITION BY strategy, d) - rank + 1 AS signal FROM best)",
    "weighted AS (SELECT *, signal / sum(signal) OVER (PARTITION BY strategy, d) * exposure AS raw_weight FROM signal)",
    *_cap_rounds(),
]
COST = "0.0002"
COHORTS = SIGNALS + [
    "dd AS (SELECT DISTINCT strategy, d FROM signals)",
    """days_ AS (SELECT strategy, d, row_number() OVER w - 1 AS i, count(*) OVER (PARTITION BY strategy) AS n,
        lead(d, 1) OVER w AS d1, lead(d, 2) OVER w AS d2, lead(d, 3) OVER w AS d3 FROM dd WINDOW w AS (PARTITION BY strategy ORDER BY d))""",
    """filled AS (SELECT c.strategy, c.d, c.entity, target_weight, o.open_price AS entry_price, x.close AS exit_price, d1, d2
        FROM capped c JOIN days_ t ON c.strategy = t.strategy AND c.d = t.d AND t.d3 IS NOT NULL
        JOIN store o ON o.d = t.d1 AND o.entity = c.entity AND o.open_price > 0
        LEFT JOIN store x ON x.d = t.d3 AND x.entity = c.entity)""",
    f"""cohorts AS (SELECT strategy, d, count(*) AS names, sum(target_weight) AS invested,
        1 - (1 + {COST}) * sum(target_weight) + (1 - {COST}) * sum(coalesce(target_weight * exit_price / entry_price, 0)) AS growth
        FROM filled GROUP BY strategy, d)""",
]
MARKS = COHORTS + [
    """held AS (SELECT *, d1 AS mark_day, 1 AS day_offset FROM filled UNION ALL SELECT *, d2, 2 FROM filled)""",
    f"""marks AS (SELECT h.strategy, h.d, mark_day, max(day_offset) AS day_offset,
        1 - (1 + {COST}) * sum(target_weight) + sum(coalesce(target_weight * m.close / entry_price, 0)) AS mark
        FROM held h LEFT JOIN store m ON m.d = h.mark_day AND m.entity = h.entity GROUP BY h.strategy, h.d, mark_day)""",
]
EQUITY = MARKS + [
    "steps AS (SELECT t.*, growth FROM days_ t LEFT JOIN cohorts c ON c.strategy = t.strategy AND c.d = t.d)",
    """chain AS (SELECT strategy, i, d, CAST(1.0 AS DOUBLE) AS equity, growth, n FROM steps WHERE i = 0
        UNION ALL
        SELECT s.strategy, s.i, s.d, c.equity * coalesce(c.growth, 1.0), s.growth, s.n FROM chain c JOIN steps s
        ON s.strategy = c.strategy AND s.i = c.i + CASE WHEN c.growth IS NULL THEN 1 ELSE 3 END WHERE c.i + 3 < c.n)""",
    """curve AS (SELECT strategy, d, equity FROM chain
        UNION ALL SELECT c.strategy, mark_day, equity * mark FROM chain c JOIN marks m ON m.strategy = c.strategy AND m.d = c.d
        WHERE c.i + 3 < c.n)""",
    f"equity AS (SELECT *, {drop_from_high('equity', None, 'strategy')} AS drawdown FROM curve)",
]


def recursive(sql: str) -> str:
    return sql.replace("WITH ", "WITH RECURSIVE ", 1)


PREDS = [
    """preds AS (SELECT user_id AS entity, CAST(floor(hour(ts) / 6) AS BIGINT) AS run,
        CASE event_type WHEN 'signup' THEN 'return' WHEN 'view' THEN 'return' WHEN 'click' THEN 'vol' WHEN 'purchase' THEN 'vol'
            ELSE 'drawdown' END AS target,
        CASE event_type WHEN 'view' THEN 'tree' WHEN 'purchase' THEN 'tree' ELSE 'net' END AS model,
        round(avg(value), 6) AS pred FROM events GROUP BY user_id, 2, event_type)""",
    """pr AS (SELECT *, (rank() OVER (PARTITION BY run, target, model ORDER BY pred)
            + (count(*) OVER (PARTITION BY run, target, model, pred) - 1) / 2.0) / count(*) OVER (PARTITION BY run, target, model) AS rank_up,
        (rank() OVER (PARTITION BY run, target, model ORDER BY pred DESC)
            + (count(*) OVER (PARTITION BY run, target, model, pred) - 1) / 2.0) / count(*) OVER (PARTITION BY run, target, model) AS rank_down
        FROM preds)""",
]


def dcg(order: str, k: int) -> str:
    return f"sum(CASE WHEN {order} <= {k} THEN (pow(2, label) - 1) / log2({order} + 1) ELSE 0 END)"


RETS = [f"rets AS (SELECT *, {', '.join(f'{change('close', k)} AS ret_{k}d' for k in (1, 3, 5))} FROM bars)"]
LOG_RETS = [f"rets AS (SELECT *, {', '.join(f'{log_change('close', k)} AS ret_{k}d' for k in HORIZONS)} FROM bars)"]
INDEX_RETS = [
    f"""ix AS (SELECT d, {change('close', 1, 'index_profile')} AS index_ret_1d, {change('close', 3, 'index_profile')} AS index_ret_3d
        FROM series WHERE index_profile = 'COMPOSITE')"""
]
_BETA = over("entity", -59)


def step(name: str, exprs: dict[str, str], source: str, plain: str = "entity, d") -> str:
    return f"{name} AS (SELECT {plain}, {aliased(exprs)} FROM {source})"


def simple(ctes: list[str], source: str, exprs: dict[str, str], plain: str = "entity, d") -> str:
    return final(ctes + [step("result", exprs, source, plain)], "result", plain, exprs)


_STEPS = BARS + [
    f"steps AS (SELECT entity, d, {FLOW['hl_range']} AS hl_range, {BOOK['order_imbalance']} AS order_imbalance, close, ln(close) AS log_close FROM bars)"
]
_SEQ_SUM = "hl_range + order_imbalance + log_close"

ORACLES: dict[str, str] = {
    "bars_daily": final(
        BARS, "bars", "entity, d",
        ["open_price", "close", "high", "low", "volume", "value", "bid_volume", "offer_volume", "foreign_buy", "foreign_sell",
         "non_regular_volume", "bid", "offer", "previous", "tradeble_shares"],
    ),
    "simple_returns": final(BARS + RETS, "rets", "entity, d", ["close", "ret_1d", "ret_3d", "ret_5d"]),
    "log_returns": final(BARS + LOG_RETS, "rets", "entity, d", ["close"] + [f"ret_{k}d" for k in HORIZONS]),
    "rolling_std_pop": simple(
        BARS + RETS, "rets", {"ret_1d": "ret_1d"} | {f"volatility_{n}d": trailing("stddev_pop", "ret_1d", n) for n in (5, 10)}
    ),
    "rolling_std_samp": simple(
        BARS + LOG_RETS, "rets",
        {"ret_1d": "ret_1d"} | {f"vol_{n}d": ln(trailing("stddev_samp", "ret_1d", n) + " + " + EPS) for n in FRAMES},
    ),
    "rolling_mean_spread": simple(
        INDEX + [step("rets", {"close": "close", "ret_1d": change("close", 1, "index_profile")}, "series", "index_profile, d")],
        "rets",
        {f"ma_{n}": trailing("avg", "close", n, "index_profile") for n in FRAMES}
        | {"trend": f"{trailing('avg', 'close', 20, 'index_profile')} - {trailing('avg', 'close', 60, 'index_profile')}"}
        | {f"mr_{n}d": f"ret_1d - {trailing('avg', 'ret_1d', n, 'index_profile')}" for n in FRAMES},
        "index_profile, d",
    ),
    "rolling_drawdown": simple(BARS, "bars", {f"drawdown_{n}d": drop_from_high("close", n) for n in FRAMES}),
    "peak_drawdown": simple(INDEX, "series", {"drawdown": drop_from_high("close", None, "index_profile")}, "index_profile, d"),
    "activity_flags": final(
        BARS, "bars",
        "entity, d, CAST(bid_volume + offer_volume <> 0 AS BIGINT) AS is_active, "
        + ", ".join(
            f"CAST(sum(bid_volume + offer_volume) {over('entity', 1 - n)} <> 0 AS BIGINT) AS is_active_{n}d" for n in (5, 20, 60)
        ),
    ),
    "log_rel_volume": simple(BARS, "bars", {"volume_ratio_10d": ln(div("volume", trailing("avg", "volume", 10)))}),
    "calendar_cycles": simple(["days AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS d FROM lineitem)"], "days", CYCLES, "d"),
    "flow_ratios": final(
        NATION_BARS + [f"result AS (SELECT *, {aliased(BOOK | PRICE | FLOW)} FROM bars)"], "result",
        "entity, d, CAST(bid_volume + offer_volume <> 0 AS BIGINT) AS is_active", [*BOOK, *PRICE, *FLOW],
    ),
    "gap_repair": simple(
        NATION_BARS + ["fixed AS (SELECT * REPLACE (CASE WHEN open_price = 0 AND previous <> 0 THEN previous ELSE open_price END AS open_price) FROM bars)"],
        "fixed",
        {"open_price": "open_price", "gap": PRICE["gap"], "gap_open": f"{div('open_price', f'lag(close, 1) {over()}')} - 1"},
    ),
    "market_context": final(MARKET, "market", "d", MARKET_COLUMNS),
    "panel_with_market": final(
        BARS + MARKET[1:] + RETS, "rets JOIN market USING (d)", "entity, d",
        ["close", "ret_1d", "idx_ret_1d", "idx_close_pos", f"{RATE}_ret_1d"],
    ),
    "excess_returns": final(BASE, "base", "entity, d", [f"excess_ret_{k}d" for k in HORIZONS]),
    "left_join_index": simple(
        BARS + INDEX[1:] + RETS + INDEX_RETS, "rets LEFT JOIN ix USING (d)",
        {"ret_1d": "ret_1d", "ret_3d": "ret_3d", "index_ret_1d": "index_ret_1d", "index_ret_3d": "index_ret_3d",
         "rel_ret_3d": "ret_3d - index_ret_3d"},
    ),
    "rolling_beta": simple(
        BARS + INDEX[1:] + RETS + INDEX_RETS, "rets LEFT JOIN ix USING (d)",
        {"beta_60d": f"(avg(ret_1d * index_ret_1d) {_BETA} - avg(ret_1d) {_BETA} * avg(index_ret_1d) {_BETA}) / "
         f"nullif(avg(index_ret_1d * index_ret_1d) {_BETA} - avg(index_ret_1d) {_BETA} * avg(index_ret_1d) {_BETA}, 0)"},
    ),
    "last_n_dates": final(
        BARS, "bars", "entity, d", ["close"],
        "WHERE d >= (SELECT min(d) FROM (SELECT DISTINCT d FROM bars ORDER BY d DESC LIMIT 500))",
    ),
    "stale_prune": final(
        BARS, "bars", "entity, d", ["close"],
        "WHERE entity IN (SELECT entity FROM bars GROUP BY entity HAVING max(d) = (SELECT max(d) FROM bars))",
    ),
    "min_history": final(
        BARS + ["counted AS (SELECT entity, d, count(*) OVER (PARTITION BY entity) AS total_step FROM bars)"], "counted",
        "entity, d, total_step", tail="WHERE round(total_step * 0.2) > 64",
    ),
    "drop_warmup": final(
        BARS + LOG_RETS[:0] + [step("rets", {"ret_1d": change("close", 1), "ret_60d": change("close", 60)}, "bars"),
                               f"numbered AS (SELECT *, row_number() {over()} AS rn FROM rets WHERE ret_60d IS NOT NULL)"],
        "numbered", "entity, d", ["ret_1d", "ret_60d"], "WHERE rn > 60",
    ),
    "zscore_past": final(PANEL, "panel", "entity, d", [f"{c}_n" for c in SCALED_FEATURES]),
    "forward_targets": final(AHEAD, "ahead", "entity, d", TARGET_COLUMNS),
    "zscore_cross": final(TARGETS, "targets", "entity, d, total_step", TARGET_COLUMNS),
    "class5": final(
        TARGETS + [f"panel_all AS (SELECT entity, d, {past_z('ret_1d')} AS ret_1d_n, row_number() {over()} AS step FROM base)"],
        "panel_all p JOIN targets t USING (entity, d)",
        f"entity, d, CAST({five_classes('future_return')} AS BIGINT) AS future_return_class", ["ret_1d_n", "future_return"],
        "WHERE step > 60",
    ),
    "feature_store_daily": final(
        STORE, "store", "entity, d", [*ALPHA_FEATURES, "rel_ret_3d", "beta_60d", "fwd_ret_3d", "fwd_ret_5d"]
    ),
    "ntile_label": final(ALPHA, "alpha", "entity, d, label"),
    "regime_label": final(
        STATE, "state", "index_profile, d, CAST(regime AS BIGINT) AS regime", ["trend", "vol_20", "drawdown", "volume_change"]
    ),
    "crash_label": final(
        STATE + [f"up AS (SELECT index_profile, d, CASE WHEN lead(close, 3) {_IDX} > close THEN 1 ELSE 0 END AS risk_on_label FROM series)"],
        "state JOIN up USING (index_profile, d)",
        "index_profile, d, CAST(crash AS BIGINT) AS crash, CAST(risk_on_label AS BIGINT) AS risk_on_label", ["future_vol"],
    ),
    "risk_dataset": final(
        INDEX + SERIES
        + [f"ahead AS (SELECT *, {div(f'lead(close, 3) {_IDX}', 'close')} - 1 AS fwd_ret_3d FROM features)"],
        "ahead", "index_profile, d, CAST(CASE WHEN fwd_ret_3d > 0 THEN 1 ELSE 0 END AS BIGINT) AS risk_on_label",
        [*RISK_FEATURES, "fwd_ret_3d"],
        "WHERE index_profile = 'COMPOSITE' AND ret_5d IS NOT NULL AND vol_10d IS NOT NULL AND fwd_ret_3d IS NOT NULL",
    ),
    "fwd_ret_compat": simple(
        BARS, "bars",
        {f"compat_{k}d": div(f"lead(close, {k}) {over()}", f"lead(open_price, 1) {over()} - 1") for k in (3, 5)}
        | {f"fwd_ret_{k}d": f"{div(f'lead(close, {k}) {over()}', f'lead(open_price, 1) {over()}')} - 1" for k in (3, 5)},
    ),
    "split_dates": final(
        BARS + ["dates AS (SELECT d, row_number() OVER (ORDER BY d) - 1 AS i, count(*) OVER () AS n FROM (SELECT DISTINCT d FROM bars))"],
        "bars", "entity, d, d > (SELECT d FROM dates WHERE i = floor(n * 0.8)) AS is_val", ["close"],
    ),
    "split_entity_tail": final(
        BARS + ["counted AS (SELECT entity, d, row_number() OVER (PARTITION BY entity ORDER BY d DESC) AS step_count, count(*) OVER (PARTITION BY entity) AS total_step FROM bars)"],
        "counted", "entity, d, step_count, total_step, step_count <= round(total_step * 0.2) AS is_val",
    ),
    "split_rows": final(SPLIT_STATE, "split", "d, row_idx, is_val", ["ret_1d"]),
    "lower_quantiles": final(LOWER, "quart", "feature", ["q1", "median", "q3"]),
    "robust_scale": final(
        LOWER
        + [
            "result AS (SELECT d, is_val, crash, regime, "
            + ", ".join(
                f"({c} - (SELECT median FROM quart WHERE feature = '{c}')) / nullif((SELECT q3 - q1 FROM quart WHERE feature = '{c}'), 0) AS {c}"
                for c in STATE_FEATURES
            )
            + " FROM split)"
        ],
        "result", "d, is_val, CAST(crash AS BIGINT) AS crash, CAST(regime AS BIGINT) AS regime", STATE_FEATURES,
    ),
    "seq_windows": final(
        _STEPS
        + [
            f"""result AS (SELECT entity, d, count(*) {over('entity', -60, -1)} AS steps, lag(log_close, 60) {over()} AS oldest_log_close,
                lag(order_imbalance, 1) {over()} AS newest_imbalance, sum({_SEQ_SUM}) {over('entity', -60, -1)} AS total, close AS target
                FROM steps)"""
        ],
        "result", "entity, d, steps", ["oldest_log_close", "newest_imbalance", "total", "target"], "WHERE steps = 60",
    ),
    "seq_latest": final(
        _STEPS
        + [
            """recent AS (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY d DESC) AS rn FROM steps QUALIFY rn <= 60)""",
            f"""result AS (SELECT entity, max(d) AS d, count(*) AS steps, arg_min(log_close, d) AS oldest_log_close, sum({_SEQ_SUM}) AS total,
                arg_max(hl_range, d) AS latest_hl_range, arg_max(order_imbalance, d) AS latest_order_imbalance,
                arg_max(log_close, d) AS latest_log_close FROM recent GROUP BY entity)""",
        ],
        "result", "entity, d, steps", ["oldest_log_close", "total", "latest_hl_range", "latest_order_imbalance", "latest_log_close"],
        "WHERE steps = 60 AND d = (SELECT max(d) FROM bars)",
    ),
    "pct_rank_avg": final(
        PREDS + ["ids AS (SELECT entity, dense_rank() OVER (ORDER BY entity) - 1 AS entity_id FROM (SELECT DISTINCT entity FROM preds))"],
        "pr JOIN ids USING (entity)", "entity, run, target, model, entity_id", ["pred", "rank_up", "rank_down"],
    ),
    "combined_score": final(
        PREDS
        + [
            """per_target AS (SELECT entity, run, target, avg(CASE WHEN target = 'return' THEN rank_up ELSE rank_down END) AS s
                FROM pr GROUP BY entity, run, target)""",
            "per_run AS (SELECT entity, run, avg(s) AS s FROM per_target GROUP BY entity, run)",
            "result AS (SELECT entity, "
            + ", ".join(f"max(CASE WHEN run = {i} THEN s END) AS result_score{i}" for i in range(4))
            + ", avg(s) AS score, stddev_samp(s) AS score_std FROM per_run GROUP BY entity)",
        ],
        "result", "entity", [*[f"result_score{i}" for i in range(4)], "score", "score_std"],
    ),
    "ndcg_at_k": final(
        ALPHA
        + [
            """ordered AS (SELECT d, label, row_number() OVER (PARTITION BY d ORDER BY ret_5d DESC, entity) AS by_score,
                row_number() OVER (PARTITION BY d ORDER BY label DESC, entity) AS by_label FROM alpha)""",
            "result AS (SELECT d, "
            + ", ".join(
                f"CASE WHEN {dcg('by_label', k)} = 0 THEN 1.0 ELSE {dcg('by_score', k)} / {dcg('by_label', k)} END AS ndcg_{k}"
                for k in (3, 5)
            )
            + " FROM ordered GROUP BY d)",
        ],
        "result", "d", ["ndcg_3", "ndcg_5"],
    ),
    "rolling_quantile": final(
        INDEX + SERIES
        + [f"""result AS (SELECT *, CASE WHEN count(vol_10d) {over('index_profile', -251)} >= 60
            THEN quantile_cont(vol_10d, 0.95) {over('index_profile', -251)} END AS vol_limit FROM features)"""],
        "result", "index_profile, d", ["vol_10d", "vol_limit"],
    ),
    "risk_state": final(INDEX + RISK, "risk", "index_profile, d, crash_flag, risk_state", ["risk_prob", "risk_exposure"]),
    "exposure_rule": final(
        INDEX + SERIES
        + [
            """e1 AS (SELECT index_profile, d, 1 / (1 + exp(50 * ret_1d)) AS crash_prob, exp(-ret_5d) / (exp(ret_5d) + 1 + exp(-ret_5d)) AS bear_prob,
                least(greatest(vol_5d / nullif(vol_10d + 1e-8, 0), 0.5), 3.0) AS volatility_ratio FROM features
                WHERE ret_5d IS NOT NULL AND vol_10d IS NOT NULL)""",
            """result AS (SELECT *, least(greatest((1 - 0.7 * crash_prob) * (1 - 0.4 * bear_prob)
                * least(greatest(1 / volatility_ratio, 0.3), 1.2), 0.1), 1.0) AS recommended_exposure FROM e1)""",
        ],
        "result", "index_profile, d", ["crash_prob", "bear_prob", "volatility_ratio", "recommended_exposure"],
    ),
    "mad_delta": final(
        [
            "fit AS (SELECT user_id, avg(value) AS pred FROM events GROUP BY user_id)",
            "res AS (SELECT event_type, value - pred AS r FROM events JOIN fit USING (user_id))",
            "mid AS (SELECT event_type, median(r) AS m, avg(abs(r)) AS mae FROM res GROUP BY event_type)",
            "result AS (SELECT event_type, max(mae) AS mae, 1.345 * 1.4826 * median(abs(r - m)) AS delta FROM res JOIN mid USING (event_type) GROUP BY event_type)",
        ],
        "result", "event_type", ["mae", "delta"],
    ),
    "topk_weights": final(SIGNALS, "weighted", "strategy, entity, d, rank", ["alpha_score", "raw_weight"]),
    "capped_weights": final(SIGNALS, "capped", "strategy, entity, d, rank", ["target_weight"]),
    "cohort_returns": final(COHORTS, "cohorts", "strategy, d, names", ["invested", "growth"]),
    "cohort_marks": final(MARKS, "marks", "strategy, d, mark_day, CAST(day_offset AS BIGINT) AS day_offset", ["mark"]),
    "equity_curve": recursive(final(EQUITY, "equity", "strategy, d", ["equity"])),
    "equity_drawdown": recursive(final(EQUITY, "equity", "strategy, d", ["drawdown"])),
    "perf_summary": recursive(
        final(
            EQUITY
            + [
                "moved AS (SELECT *, equity / nullif(lag(equity, 1) OVER (PARTITION BY strategy ORDER BY d), 0) - 1 AS move FROM equity)",
                "moves AS (SELECT *, CASE WHEN abs(move) > 1e-12 THEN move END AS r FROM moved)",
                """stats AS (SELECT strategy, arg_max(equity, d) / arg_min(equity, d) - 1 AS tr, min(drawdown) AS dd, avg(r) AS m,
                    stddev_samp(r) AS s FROM moves GROUP BY strategy)""",
                """result AS (SELECT strategy, 'Total Return' AS metric, tr AS value FROM stats
                    UNION ALL SELECT strategy, 'Max Drawdown', dd FROM stats
                    UNION ALL SELECT strategy, 'Sharpe', CASE WHEN s > 0 THEN sqrt(252.0) * m / s ELSE 0.0 END FROM stats)""",
            ],
            "result", "strategy, metric", ["value"],
        )
    ),
    "missing_days": """WITH days AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)
        SELECT CAST(g AS DATE) AS d FROM (SELECT unnest(generate_series((SELECT min(d) FROM days), (SELECT max(d) FROM days), INTERVAL 1 DAY)) AS g)
        WHERE CAST(g AS DATE) NOT IN (SELECT d FROM days)""",
    "insert_ignore": """SELECT DISTINCT o_orderkey, o_custkey, o_orderstatus, round(o_totalprice, 6) + 0.0 AS o_totalprice
        FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')""",
    "upsert_first": """SELECT o_orderkey, o_custkey, o_orderstatus,
        round(CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE o_totalprice * 2 END, 6) + 0.0 AS o_totalprice FROM orders""",
    "fk_semi": """SELECT o_orderkey, o_custkey, o_orderstatus, round(o_totalprice, 6) + 0.0 AS o_totalprice FROM orders
        WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)""",
    "null_coerce": """SELECT o_orderkey, o_custkey, nullif(replace(o_orderstatus, 'P', ''), '') AS o_orderstatus,
        round(o_totalprice, 6) + 0.0 AS o_totalprice, round(coalesce(c_acctbal, 0.0), 6) + 0.0 AS c_acctbal
        FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal >= 0) ON o_custkey = c_custkey""",
    "quality_report": "WITH "
    + ", ".join(BARS + INDEX[1:] + RISK)
    + """ SELECT 'risk.non_empty' AS "check", CAST(count(*) = 0 AS BIGINT) AS violations FROM risk
        UNION ALL SELECT 'risk.exposure_bounds', count(*) FROM risk WHERE NOT coalesce(risk_exposure BETWEEN 0 AND 1, false)
        UNION ALL SELECT 'risk.known_state', count(*) FROM risk WHERE risk_state NOT IN ('RISK_ON', 'NEUTRAL', 'RISK_OFF')
        UNION ALL SELECT 'risk.quantile_present', count(*) FROM risk WHERE vol_limit IS NULL
        UNION ALL SELECT 'bars.non_empty', CAST(count(*) = 0 AS BIGINT) FROM bars
        UNION ALL SELECT 'bars.flow_within_volume', count(*) FROM bars WHERE foreign_buy >= volume
        UNION ALL SELECT 'bars.positive_close', count(*) FROM bars WHERE close <= 0
        UNION ALL SELECT 'bars.group_size', count(*) FROM (SELECT d FROM bars GROUP BY d HAVING count(*) < 20)
        UNION ALL SELECT 'bars.unique_key', count(*) FROM (SELECT entity, d FROM bars GROUP BY ALL HAVING count(*) > 1)
        UNION ALL SELECT 'lineitem.unique_key', count(*) FROM (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY ALL HAVING count(*) > 1)""",
    "json_props": """SELECT event_type, count(k) AS n, CAST(sum(k) AS BIGINT) AS sum_k, min(k) AS min_k, max(k) AS max_k
        FROM (SELECT event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events) GROUP BY event_type""",
}
