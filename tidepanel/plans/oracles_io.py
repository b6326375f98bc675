"""DuckDB SQL for the queries of ``queries_io`` and for those of fitted models that SQL can check."""

from __future__ import annotations

from tidepanel.config import SCALED_FEATURES, STATE_FEATURES
from tidepanel.plans import oracles as o

DAMAGED = "{mark} % 7 = 0 OR {mark} % 11 = 0"
_STOCK = ["lots_ AS (SELECT l_suppkey, CAST(l_shipdate AS DATE) AS d, l_extendedprice / l_quantity AS p, l_quantity FROM lineitem)",
          "days AS (SELECT l_suppkey, d, max(p) AS high, sum(l_quantity) AS volume, l_suppkey % 8 AS chunk, dayofyear(d) + l_suppkey % 8 AS mark FROM lots_ GROUP BY l_suppkey, d)"]
_RATES = ["rates AS (SELECT CAST(o_orderdate AS DATE) AS d, avg(o_totalprice) AS v FROM orders GROUP BY 1)"]


def _faults(kind: str, pages: str) -> str:
    return (
        f"SELECT '{kind}' AS kind, CASE WHEN mark % 7 = 0 THEN 'unreadable' ELSE '{'no rates' if kind == 'rate' else 'no items'}' END AS reason, count(*) AS pages "
        f"FROM {pages} WHERE {DAMAGED.format(mark='mark')} GROUP BY 2"
    )


_RECENT = "(SELECT min(d) FROM (SELECT DISTINCT d FROM live ORDER BY d DESC LIMIT 500))"


def _recent(ctes: list[str]) -> list[str]:
    """The feature chain over entities that are still there and the newest 500 days."""
    out = []
    for cte in ctes:
        name = cte.strip().split(" ", 1)[0]
        if name == "bars":
            out.append(cte.replace("bars AS", "every_bar AS", 1))
            out.append("live AS (SELECT * FROM every_bar WHERE entity IN (SELECT entity FROM every_bar GROUP BY entity HAVING max(d) = (SELECT max(d) FROM every_bar)))")
            out.append(f"bars AS (SELECT * FROM live WHERE d >= {_RECENT})")
        elif name == "series":
            out.append(cte.replace("series AS", "every_series AS", 1))
            out.append(f"series AS (SELECT * FROM every_series WHERE d >= {_RECENT})")
        else:
            out.append(cte)
    return out


_CHAIN = _recent(o.TARGETS) + [
    f"steps AS (SELECT entity, d, row_number() {o.over()} AS step FROM base)",
    "panel AS (SELECT entity, d FROM steps WHERE step > 60)",
    "labelled AS (SELECT p.entity, p.d, row_number() OVER (PARTITION BY p.entity ORDER BY p.d DESC) AS k, count(*) OVER (PARTITION BY p.entity) AS n FROM panel p JOIN targets t ON t.entity = p.entity AND t.d = p.d)",
    "inference AS (SELECT entity, d FROM panel QUALIFY row_number() OVER (PARTITION BY entity ORDER BY d DESC) <= 60)",
]
_SPAN = "count(*) AS n, count(DISTINCT entity) AS entities, min(d) AS first_day, max(d) AS last_day"
_LABELLED = " UNION ALL ".join(
    f"SELECT '{t}' AS relation, {_SPAN}, count(*) FILTER (k <= round(n * 0.2)) AS n_val FROM labelled" for t in o.TARGET_COLUMNS
)
_LONG = " UNION ALL ".join(f"SELECT '{t}' AS target, {t} AS y, is_val FROM split_rows_" for t in o.TARGET_COLUMNS)
_SHARES = "[0.1, 0.2, 0.4, 0.6, 0.8]"

ORACLES: dict[str, str] = {
    "landed_stock": o.final(_STOCK, "days", "CAST(l_suppkey AS VARCHAR) AS stock_profile, d", ["high", "volume"], f"WHERE NOT ({DAMAGED.format(mark='mark')})"),
    "landed_index": o.final(o.INDEX + ["tops AS (SELECT *, highest AS high FROM series)"], "tops", "index_profile, d", ["high", "volume"], f"WHERE NOT ({DAMAGED.format(mark='dayofyear(d)')})"),
    "landed_rates": o.final(
        _RATES, "rates", "'USD' AS primary_code, 'IDR' AS secondary_code, d, CAST(1.0 AS DOUBLE) AS primary_value, round(v, 6) + 0.0 AS secondary_value",
        tail=f"WHERE NOT ({DAMAGED.format(mark='(year(d) + month(d))')})",
    ),
    "quarantined_pages": "WITH " + ", ".join(
        _STOCK + _RATES + [
            "sp AS (SELECT DISTINCT d, chunk, mark FROM days)", "ip AS (SELECT DISTINCT d, dayofyear(d) AS mark FROM days)",
            "rp AS (SELECT DISTINCT year(d), month(d), year(d) + month(d) AS mark FROM rates)",
        ]
    ) + " " + " UNION ALL ".join([_faults("stock", "sp"), _faults("index", "ip"), _faults("rate", "rp")]),
    "both_feeds": """WITH l AS (SELECT CAST(l_shipdate AS DATE) AS d FROM lineitem), r AS (SELECT CAST(o_orderdate AS DATE) AS d FROM orders)
        SELECT 'lineitem' AS feed, d, count(*) AS n FROM l WHERE d IN (SELECT d FROM r) GROUP BY d
        UNION ALL SELECT 'orders', d, count(*) FROM r WHERE d IN (SELECT d FROM l) GROUP BY d""",
    "dimension_rows": """SELECT o_custkey, o_orderpriority, o_orderstatus FROM orders
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderpriority, o_orderstatus) = 1""",
    "unknown_state": "SELECT 'PENDING' AS risk_state, count(*) AS days FROM orders WHERE o_orderstatus = 'P'",
    "reunited_sets": o.final(o.SPLIT_STATE, "split", "d, is_val", ["ret_1d"]),
    "upsert_corrections": """WITH m AS (SELECT *, strftime(o_orderdate, '%Y-%m') AS month FROM orders),
        f AS (SELECT *, o_orderkey % 50 = 0 AND month < '1994-07' AS fixed FROM m)
        SELECT o_orderkey, round(CASE WHEN fixed THEN o_totalprice * 2 ELSE o_totalprice END, 6) + 0.0 AS o_totalprice,
               CAST(CASE WHEN fixed THEN 2 ELSE 1 END AS BIGINT) AS version, month FROM f""",
    "panel_export": o.final(o.BARS, "bars", "entity, d", ["close", "volume"]),
    "result_export": "WITH " + ", ".join(o.NATION_BARS) + """ SELECT 'sizes' AS result, count(DISTINCT entity) AS rows, count(*) AS total FROM bars
        UNION ALL SELECT 'days', count(DISTINCT d), count(*) FROM bars""",
    "panel_blocks": o.final(o.PANEL, "panel", "entity, d", [f"{c}_n" for c in SCALED_FEATURES]),
    "targets_blocks": o.final(o.TARGETS, "targets", "entity, d, total_step", o.TARGET_COLUMNS),
    "panel_chain": "WITH " + ", ".join(_CHAIN) + f""" SELECT 'base' AS relation, {_SPAN}, 0 AS n_val FROM base
        UNION ALL SELECT 'panel', {_SPAN}, 0 FROM panel UNION ALL SELECT 'targets', {_SPAN}, 0 FROM targets
        UNION ALL SELECT 'inference', {_SPAN}, 0 FROM inference UNION ALL {_LABELLED}""",
    "fast_quantiles": "WITH " + ", ".join(
        o.STATE + [
            "long AS (" + " UNION ALL ".join(f"SELECT index_profile, '{c}' AS feature, {c} AS value FROM state" for c in STATE_FEATURES) + ")",
            "known AS (SELECT *, row_number() OVER (PARTITION BY index_profile, feature ORDER BY value) - 1 AS i, count(*) OVER (PARTITION BY index_profile, feature) AS n FROM long WHERE value IS NOT NULL)",
        ]
    ) + " " + " UNION ALL ".join(
        f"SELECT index_profile, feature, '{name}' AS quantile, round(value, 6) + 0.0 AS value, true AS within FROM known WHERE i = floor({q} * (n - 1))"
        for name, q in (("q1", 0.25), ("median", 0.5), ("q3", 0.75))
    ),
    "ranking_pairs": o.final(
        o.ALPHA + [
            "placed AS (SELECT d, label, row_number() OVER (PARTITION BY d ORDER BY label DESC, entity) AS p, count(*) OVER (PARTITION BY d) AS n FROM alpha)",
            f"steps_ AS (SELECT DISTINCT d, p, n, label, CAST(ceil(n * s) AS BIGINT) AS s FROM (SELECT *, unnest({_SHARES}::DOUBLE[]) AS s FROM placed) x)",
            """pairs_ AS (SELECT a.d, a.p AS high, b.p AS low, (pow(2, a.label) - pow(2, b.label)) * (1 / log2(a.p + 1) - 1 / log2(b.p + 1)) AS w
                FROM steps_ a JOIN placed b ON b.d = a.d AND b.p = a.p + a.s WHERE a.label > b.label)""",
            "result AS (SELECT d, count(*) AS pairs, max(low) AS last, sum(w) AS weight FROM pairs_ GROUP BY d)",
        ],
        "result", "d, pairs, last", ["weight"],
    ),
    "huber_at_threshold": """WITH RECURSIVE lots_ AS (SELECT l_quantity AS x, l_extendedprice / 1e4 AS y FROM lineitem),
        fit(asked, k, a, b) AS (
            SELECT asked, 0, avg(y) - (covar_pop(x, y) / var_pop(x)) * avg(x), covar_pop(x, y) / var_pop(x)
            FROM lots_, (SELECT unnest([0.5, 2.0, 10.0]::DOUBLE[]) AS asked) t GROUP BY asked
            UNION ALL
            SELECT asked, k + 1, (sy - b1 * sx) / sw, b1 FROM (
                SELECT *, (sxy - sx * sy / sw) / (sxx - sx * sx / sw) AS b1 FROM (
                    SELECT asked, k, sum(w) AS sw, sum(w * x) AS sx, sum(w * y) AS sy, sum(w * x * x) AS sxx, sum(w * x * y) AS sxy
                    FROM (SELECT asked, k, x, y, CASE WHEN abs(y - a - b * x) > asked THEN asked / abs(y - a - b * x) ELSE 1.0 END AS w
                          FROM fit, lots_ WHERE k < 80) r GROUP BY asked, k) s) u)
        SELECT asked, asked AS in_effect, round(b, 6) + 0.0 AS slope, round(a, 6) + 0.0 AS intercept, true AS settled FROM fit WHERE k = 80""",
    "model_errors": "WITH " + ", ".join(
        o.TARGETS + [
            f"steps AS (SELECT entity, d, row_number() {o.over()} AS step FROM base)",
            """split_rows_ AS (SELECT t.*, row_number() OVER (PARTITION BY t.entity ORDER BY t.d DESC) <= round(count(*) OVER (PARTITION BY t.entity) * 0.2) AS is_val
                FROM targets t JOIN steps s ON s.entity = t.entity AND s.d = t.d WHERE step > 60)""",
            f"long AS ({_LONG})",
            "mid AS (SELECT target, avg(y) FILTER (NOT is_val) AS m FROM long GROUP BY target)",
            """err AS (SELECT target, count(*) FILTER (NOT is_val) AS n_train, count(*) FILTER (is_val) AS n_val,
                round(avg(abs(y - m)) FILTER (is_val), 6) + 0.0 AS base_mae FROM long JOIN mid USING (target) WHERE y IS NOT NULL GROUP BY target)""",
        ]
    ) + """ SELECT target, model, CAST(run AS BIGINT) AS run, n_train, n_val, base_mae, true AS no_worse, true AS has_threshold
        FROM err, (VALUES ('linear'), ('tree')) v(model), range(4) r(run)""",
    "portfolio_checks": "SELECT \"check\", CAST(0 AS BIGINT) AS violations FROM (VALUES "
    + ", ".join(f"('{c}')" for c in (
        "weight_bounds", "non_empty", "exposure_bound", "position_bound", "allowed_days", "one_weight", "one_equity", "drawdown_bounds",
        "positive_equity", "known_states",
    )) + ") v(\"check\")",
}
