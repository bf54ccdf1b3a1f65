"""The SQL each query is checked against, written for DuckDB over the given tables.

Statements are put together from shared table expressions. They follow the
definition of each operator and not the way the Spark job computes it: calendars
are joined, hourly windows are sums over the hours in range, peers are window sums.
Money stays decimal until the last step.
"""

from __future__ import annotations

import math

from kpicast.names import KPIS, METRICS, SHORT
from kpicast.operators import daily, hourly

# Same as on the Spark side: keeps values that end in a 5 behind the last shown
# digit from being rounded either way.
TIE_SHIFT = 1.3e-8

SPARSE = ["tracker_conversions", "tracker_revenue"]
LONG = daily.LONG_METRICS


def r(sql: str, name: str, digits: int = 6) -> str:
    return f"round(CAST({sql} AS DOUBLE) + {TIE_SHIFT!r}, {digits}) AS {name}"


def r4(sql: str, name: str) -> str:
    return r(sql, name, 4)


def big(sql: str, name: str) -> str:
    return f"CAST({sql} AS BIGINT) AS {name}"


def day(sql: str, name: str) -> str:
    return f"strftime({sql}, '%Y-%m-%d') AS {name}"


def ts(sql: str, name: str) -> str:
    return f"strftime({sql}, '%Y-%m-%d %H:%M:%S') AS {name}"


def with_(ctes: list[str], select: str) -> str:
    return "WITH " + ",\n".join(dict.fromkeys(ctes)) + "\n" + select


def ratio(top: str, bottom: str, scale: float = 1.0, positive: bool = False) -> str:
    test = ">" if positive else "!="
    factor = "" if scale == 1.0 else f" * {scale}"
    return (
        f"CASE WHEN CAST({bottom} AS DOUBLE) {test} 0 "
        f"THEN CAST({top} AS DOUBLE) / CAST({bottom} AS DOUBLE){factor} ELSE 0.0 END"
    )


RATIO = {
    "roas": ("revenue", "spend", 1.0),
    "ctr": ("clicks", "impressions", 100.0),
    "cvr": ("conversions", "clicks", 100.0),
    "cpc": ("spend", "clicks", 1.0),
    "cpm": ("spend", "impressions", 1000.0),
}


def kpi(name: str, values: dict[str, str], positive: bool = False) -> str:
    if name == "profit":
        return f"(CAST({values['revenue']} AS DOUBLE) - CAST({values['spend']} AS DOUBLE))"
    top, bottom, scale = RATIO[name]
    return ratio(values[top], values[bottom], scale, positive)


def kpi_of(pattern: str, name: str, positive: bool = False) -> str:
    return kpi(name, {SHORT[m]: pattern.format(m=m) for m in METRICS}, positive)


# -- facts -------------------------------------------------------------------

EV = """ev AS (SELECT event_id, ts, user_id AS u, event_type AS k,
 CAST(value AS DECIMAL(18,2)) AS v FROM events)"""
SUMS = """sum(CASE WHEN k = 'view' THEN v ELSE 0 END) AS spend,
 sum(CASE WHEN k = 'view' THEN 100 ELSE 0 END) AS impressions,
 sum(CASE WHEN k IN ('click', 'error') THEN 10 ELSE 0 END) AS clicks,
 sum(CASE WHEN k = 'click' THEN 10 ELSE 0 END) AS inline_link_clicks,
 sum(CASE WHEN k = 'signup' THEN 1 ELSE 0 END) AS tracker_conversions,
 sum(CASE WHEN k = 'purchase' THEN v ELSE 0 END) AS tracker_revenue"""
TZ = """CASE u % 5 WHEN 0 THEN 'Asia/Kolkata' WHEN 1 THEN 'America/New_York'
 WHEN 2 THEN 'UTC' WHEN 3 THEN '' ELSE 'Not/AZone' END"""
ZONE = "CASE u % 5 WHEN 0 THEN 'Asia/Kolkata' WHEN 1 THEN 'America/New_York' ELSE 'UTC' END"
ID = {"account_id": 5, "campaign_id": 15, "adset_id": 45}
IDS = ", ".join(f"CAST(u % {n} AS VARCHAR) AS {c}" for c, n in ID.items())
IDS += ", CAST(u AS VARCHAR) AS ad_id"
AD = "CAST(u AS VARCHAR) AS ad_id"
REP = f"rep AS (SELECT u, date_trunc('hour', ts) AS date, {SUMS} FROM ev GROUP BY 1, 2)"
HR = f"""hr AS (SELECT u, h, {', '.join(f'sum({m}) AS {m}' for m in ['clicks', *METRICS])} FROM (
 SELECT *, CAST(floor(epoch(timezone({ZONE}, timezone('UTC', date))) / 3600) AS BIGINT) AS h
 FROM rep) GROUP BY u, h)"""
DD = f"dd AS (SELECT u, CAST(ts AS DATE) AS d, {SUMS} FROM ev GROUP BY 1, 2)"
HOURS = [EV, REP, HR]
DAYS = [EV, DD]

_ZEROED = ", ".join(f"coalesce(dd.{m}, 0) AS {m}" for m in METRICS)


def grid(name: str, source: str, ahead: int) -> str:
    """Dense days of each ad of ``source``, ``ahead`` days past its last row."""
    return f"""{name} AS (SELECT g.u, g.d, g.last_d, {_ZEROED} FROM (
 SELECT u, last_d, CAST(unnest(generate_series(CAST(first_d AS TIMESTAMP),
 CAST(last_d + {ahead} AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS d
 FROM (SELECT u, min(d) AS first_d, max(d) AS last_d FROM {source} GROUP BY u)) g
 LEFT JOIN {source} dd ON dd.u = g.u AND dd.d = g.d)"""


DN = grid("dn", "dd", 0)
DN1 = grid("dn1", "dd", 1)

W = "(PARTITION BY u ORDER BY d ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
BY = "(PARTITION BY u ORDER BY d)"
SIGNAL = {
    "tracker_revenue_nonzero_count": "tracker_revenue > 0",
    "tracker_conversions_nonzero_count": "tracker_conversions > 0",
    "spend_positive_revenue_zero_count": "spend > 0 AND tracker_revenue = 0",
    "clicks_positive_conversions_zero_count": "inline_link_clicks > 0 AND tracker_conversions = 0",
}


def window_sum(value: str, n: int, min_rows: int = 1) -> str:
    w = W.format(n=n)
    return f"CASE WHEN count(*) OVER {w} >= {min_rows} THEN CAST(sum({value}) OVER {w} AS DOUBLE) ELSE 0.0 END"


def window_mean(value: str, n: int, min_rows: int = 1) -> str:
    w = W.format(n=n)
    return (
        f"CASE WHEN count(*) OVER {w} >= {min_rows} "
        f"THEN CAST(sum({value}) OVER {w} AS DOUBLE) / count(*) OVER {w} ELSE 0.0 END"
    )


def window_count(condition: str, n: int) -> str:
    return f"count(*) FILTER ({condition}) OVER {W.format(n=n)}"


def window_std(value: str, n: int) -> str:
    return f"coalesce(stddev_samp(CAST({value} AS DOUBLE)) OVER {W.format(n=n)}, 0.0)"


def running(inclusive: bool = False) -> dict[str, str]:
    end = "CURRENT ROW" if inclusive else "1 PRECEDING"
    w = f"(PARTITION BY u ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND {end})"
    total = {
        "cum_spend": "spend",
        "cum_clicks": "inline_link_clicks",
        "cum_conversions": "tracker_conversions",
        "cum_revenue": "tracker_revenue",
    }
    out = {"days_active": f"row_number() OVER {BY}"}
    out |= {n: f"coalesce(CAST(sum({m}) OVER {w} AS DOUBLE), 0.0)" for n, m in total.items()}
    out["zero_spend_to_date"] = f"count(*) FILTER (spend = 0) OVER {w}"
    return out


def calendar(d: str = "d") -> dict[str, str]:
    dow = f"(isodow({d}) - 1)"
    angle = f"{dow} * {2.0 * math.pi / 7.0!r}"
    return {"day_of_week": dow, "dow_sin": f"sin({angle})", "dow_cos": f"cos({angle})"}


def rolls(metric: str) -> list[int]:
    return [3, 7, 14] if metric in LONG else [3, 7]


def feature_table(name: str, source: str, inclusive: bool = False) -> str:
    """Window features of every row of a dense table, and its context columns."""
    cols = running(inclusive) | calendar()
    for m in METRICS:
        for n in (1, 2, 7, 14):
            cols[f"{m}_lag_{n}d"] = f"coalesce(CAST(lag({m}, {n}) OVER {BY} AS DOUBLE), 0.0)"
        for n in rolls(m):
            least = 2 if n == 14 else 1
            cols[f"{m}_roll_mean_{n}d"] = window_mean(m, n, least)
            cols[f"{m}_roll_sum_{n}d"] = window_sum(m, n, least)
    for n in (7, 14):
        cols |= {f"{s}_{n}d": window_count(c, n) for s, c in SIGNAL.items()}
    for m in ("spend", "tracker_revenue"):
        cols[f"{m}_zero_count_7d"] = window_count(f"{m} = 0", 7)
    cols |= {f"{m}_std_7d": window_std(m, 7) for m in SPARSE}
    select = ", ".join(f"{sql} AS {n}" for n, sql in cols.items())
    keep = ", ".join(f"CAST({m} AS DOUBLE) AS {m}" for m in METRICS)
    return f"{name} AS (SELECT u, d, last_d, {keep}, {select} FROM {source})"


def clip(sql: str, low: float, high: float) -> str:
    return f"greatest(least({sql}, {high}), {low})"


def derived() -> dict[str, str]:
    """Features made from other features."""
    out = {}
    for m in METRICS:
        out[f"{m}_same_weekday_last_week"] = f"{m}_lag_7d"
        out[f"{m}_trend_3d_vs_7d"] = ratio(f"{m}_roll_mean_3d", f"{m}_roll_mean_7d")
        out[f"{m}_lag1_vs_mean_7d"] = ratio(f"{m}_lag_1d", f"{m}_roll_mean_7d")
    for m in LONG:
        out[f"{m}_same_weekday_2w"] = f"{m}_lag_14d"
    for m in SPARSE:
        out[f"{m}_cv_7d"] = ratio(f"{m}_std_7d", f"{m}_roll_mean_7d")
    rev, conv = "tracker_revenue_roll_sum_{}d", "tracker_conversions_roll_sum_{}d"
    for n in (7, 14):
        out[f"revenue_density_{n}d"] = clip(ratio(rev.format(n), f"spend_roll_sum_{n}d"), 0, 50)
        out[f"revenue_per_conversion_{n}d"] = clip(ratio(rev.format(n), conv.format(n)), 0, 5000)
    out["revenue_7d_vs_14d"] = clip(ratio(rev.format(7), rev.format(14)), 0, 10)
    out["spend_7d_vs_14d"] = clip(ratio("spend_roll_sum_7d", "spend_roll_sum_14d"), 0, 10)
    days = "tracker_revenue_nonzero_count_{}d"
    flag = "CASE WHEN {} THEN 1.0 ELSE 0.0 END".format
    out["is_revenue_stable_7d"] = flag(f"{days.format(7)} >= 3 AND {out['revenue_density_7d']} > 0")
    out["is_revenue_stable_14d"] = flag(f"{days.format(14)} >= 5 AND {out['revenue_density_14d']} > 0")
    out["is_revenue_spiky_7d"] = flag(f"{days.format(7)} <= 2 AND {out['revenue_density_7d']} > 0")
    out["is_zero_heavy_revenue_14d"] = flag(f"{days.format(14)} <= 2 AND spend_roll_sum_14d > 0")
    return out


FE = feature_table("fe", "dn")
FE1 = feature_table("fe1", "dn1")
DENSE = [*DAYS, DN, FE]
ALLDAYS = [*DAYS, DN1, FE1]
INTEGER = {"day_of_week", "days_active"}


def features(names: list[str], source: str = "fe") -> str:
    more = derived()
    cols = [day("d", "local_date"), AD]
    for n in names:
        sql = f"({more[n]})" if n in more else n
        cols.append(big(sql, n) if n in INTEGER else r(sql, n))
    return f"SELECT {', '.join(cols)} FROM {source}"


def _daily_statements() -> dict[str, str]:
    names = daily.daily_feature_names()
    out = {
        "daily_lags": features([n for n in names if "_lag_" in n or "weekday" in n]),
        "daily_rolls": features([n for n in names if "_roll_" in n]),
        "daily_signals": features([f"{s}_{n}d" for s in SIGNAL for n in (7, 14)]),
        "daily_cum": features(daily.BASE_FEATURES[3:]),
        "daily_trends": features([f"{m}_trend_3d_vs_7d" for m in METRICS] + daily.QUALITY),
    }
    out = {name: with_(DENSE, sql) for name, sql in out.items()}
    out["daily_cum_inclusive"] = with_(
        [*DAYS, DN, feature_table("fe", "dn", True)], features(daily.BASE_FEATURES[3:])
    )
    targets = [r(m, f"target_24h_{m}") for m in METRICS]
    targets += [r(kpi_of("{m}", k), f"target_24h_{k}") for k in KPIS]
    base = features(names).removesuffix(" FROM fe")
    out["daily_features"] = with_(
        DENSE, f"{base}, {', '.join(targets)} FROM fe WHERE days_active >= 8"
    )
    # Scoring: the last 16 rows of each ad, counters from the whole history.
    last16 = """l16 AS (SELECT * EXCLUDE n FROM (SELECT *, row_number() OVER
 (PARTITION BY u ORDER BY d DESC) AS n FROM dd) WHERE n <= 16)"""
    life = """life AS (SELECT u, count(DISTINCT d) AS full_days_active,
 sum(spend) AS full_cum_spend, sum(inline_link_clicks) AS full_cum_clicks,
 sum(tracker_conversions) AS full_cum_conversions, sum(tracker_revenue) AS full_cum_revenue,
 count(*) FILTER (spend = 0) AS full_zero_spend_to_date FROM dd GROUP BY u)"""
    counters = {
        "days_active": "full_days_active",
        "cum_spend": "full_cum_spend",
        "cum_clicks": "full_cum_clicks",
        "cum_conversions": "full_cum_conversions",
        "cum_revenue": "full_cum_revenue",
        "zero_spend_to_date": "full_zero_spend_to_date",
    }
    cols = [day("d", "local_date"), day("last_d", "history_cutoff_local_date"), AD]
    more = derived()
    for n in names:
        sql = counters.get(n, f"({more[n]})" if n in more else n)
        cols.append(big(sql, n) if n == "day_of_week" else r(sql, n))
    out["next_day_features"] = with_(
        [*DAYS, last16, life, grid("dn16", "l16", 1), feature_table("fe", "dn16")],
        f"SELECT {', '.join(cols)} FROM fe JOIN life USING (u) WHERE d = last_d + 1",
    )
    out["wide_features"] = _wide()
    out["hierarchy_rolls"] = with_(
        [*DAYS, DN, *_HIER],
        "SELECT c.account_id, c.campaign_id, "
        + day("c.d", "local_date")
        + ", "
        + ", ".join(
            r(f"{t}.{m}_{x}", f"{level}_{m}_roll_{x}_7d")
            for level, t in (("account", "a"), ("campaign", "c"))
            for m in METRICS
            for x in ("mean", "sum")
        )
        + " FROM ca c JOIN ac a ON a.account_id = c.account_id AND a.d = c.d",
    )
    return out


def _level(name: str, keys: str, partition: str) -> str:
    w = f"(PARTITION BY {partition} ORDER BY d ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)"
    cols = ", ".join(
        f"coalesce(CAST(sum({m}) OVER {w} AS DOUBLE), 0.0) AS {m}_sum, "
        f"CASE WHEN count(*) OVER {w} > 0 THEN CAST(sum({m}) OVER {w} AS DOUBLE) / count(*) OVER {w}"
        f" ELSE 0.0 END AS {m}_mean"
        for m in METRICS
    )
    sums = ", ".join(f"sum({m}) AS {m}" for m in METRICS)
    return (
        f"{name} AS (SELECT {partition}, d, {cols} FROM "
        f"(SELECT {keys}, d, {sums} FROM dn GROUP BY ALL))"
    )


_ACC, _CAMP = "CAST(u % 5 AS VARCHAR) AS account_id", "CAST(u % 15 AS VARCHAR) AS campaign_id"
_HIER = [
    _level("ac", _ACC, "account_id"),
    _level("ca", f"{_ACC}, {_CAMP}", "account_id, campaign_id"),
]


def _wide() -> str:
    kpis = ["kpi_ctr", "kpi_cpc", "kpi_cpm", "kpi_cvr", "kpi_roas", "kpi_profit"]
    with_kpis = "dk AS (SELECT *, " + ", ".join(
        f"{kpi_of('{m}', k.removeprefix('kpi_'))} AS {k}" for k in kpis
    ) + " FROM dn)"
    cols = running() | calendar()
    for c in [*METRICS, *kpis]:
        for n in (1, 2, 3, 7, 14):
            cols[f"{c}_lag_{n}d"] = f"coalesce(CAST(lag({c}, {n}) OVER {BY} AS DOUBLE), 0.0)"
        for n in (3, 7, 14):
            cols[f"{c}_roll_mean_{n}d"] = window_mean(c, n)
            cols[f"{c}_roll_std_{n}d"] = window_std(c, n)
            if c in METRICS:
                cols[f"{c}_roll_sum_{n}d"] = window_sum(c, n)
                cols[f"{c}_zero_count_{n}d"] = window_count(f"{c} = 0", n)
    fe = f"fw AS (SELECT u, d, {', '.join(f'{sql} AS {n}' for n, sql in cols.items())} FROM dk)"
    more = {}
    for m in METRICS:
        more[f"{m}_trend_3d_vs_7d"] = ratio(f"{m}_roll_mean_3d", f"{m}_roll_mean_7d")
        more[f"{m}_cv_7d"] = ratio(f"{m}_roll_std_7d", f"{m}_roll_mean_7d")
        more[f"{m}_lag1_vs_mean_7d"] = ratio(f"{m}_lag_1d", f"{m}_roll_mean_7d")
        for level, t in (("account", "ac"), ("campaign", "ca")):
            for x in ("mean", "sum"):
                more[f"{level}_{m}_roll_{x}_7d"] = f"{t}.{m}_{x}"
    out = [day("fw.d", "local_date"), AD]
    for n in daily.wide_feature_names():
        sql = f"({more[n]})" if n in more else f"fw.{n}"
        out.append(big(sql, n) if n in INTEGER else r(sql, n))
    return with_(
        [*DAYS, DN, *_HIER, with_kpis, fe],
        f"SELECT {', '.join(out)} FROM fw "
        "JOIN ac ON ac.account_id = CAST(fw.u % 5 AS VARCHAR) AND ac.d = fw.d "
        "JOIN ca ON ca.account_id = CAST(fw.u % 5 AS VARCHAR) "
        "AND ca.campaign_id = CAST(fw.u % 15 AS VARCHAR) AND ca.d = fw.d",
    )


# -- cleaning, rollups, extracts ---------------------------------------------

_DAILY_OUT = ", ".join(r(m, m) for m in METRICS)
_STATUS = (
    "CASE WHEN {k} % {p} IN ({paused}) THEN 'Paused' WHEN {k} % {p} IN ({missing}) THEN NULL "
    "WHEN ({k} % {p}) % 2 = 0 THEN 'ACTIVE' ELSE 'active' END"
)
_STATUSES = {
    "account": _STATUS.format(k="(u % 5)", p=3, paused="2", missing="-1"),
    "campaign": _STATUS.format(k="(u % 15)", p=7, paused="6", missing="5"),
    "adset": _STATUS.format(k="(u % 45)", p=11, paused="10", missing="-1"),
    "ad": _STATUS.format(k="u", p=13, paused="11, 12", missing="10"),
}
_ON = {level: f"upper(coalesce({sql}, '')) = 'ACTIVE'" for level, sql in _STATUSES.items()}
_ALL_ON = " AND ".join(f"({sql})" for sql in _ON.values())
_SCHEDULED = """sch AS (SELECT DISTINCT u, TIMESTAMP '2024-01-30 00:00:00' + to_hours(u % 96) AS f,
 CASE WHEN u % 2 = 0 THEN TIMESTAMP '2024-01-30 00:00:00' + to_hours(u % 96 + 12) END AS t
 FROM ev)"""


def _top(rows: str, limit: int) -> str:
    return (
        f"top AS (SELECT u FROM {rows} GROUP BY u ORDER BY sum(spend) DESC, max(date) DESC, "
        f"CAST(u AS VARCHAR) LIMIT {limit})"
    )


def _extract_statements() -> dict[str, str]:
    out = {}
    dirty = """CASE o_orderkey % 7 WHEN 0 THEN '  ' || CAST(o_custkey AS VARCHAR) || ' '
 WHEN 1 THEN CAST(o_custkey AS VARCHAR) || '.0' WHEN 2 THEN 'nan' WHEN 3 THEN 'None'
 WHEN 4 THEN '<NA>' WHEN 5 THEN NULL ELSE CAST(o_custkey AS VARCHAR) END"""
    out["clean_ids"] = f"""SELECT o_orderkey, CASE WHEN c IN ('nan', 'None', '<NA>') THEN ''
 ELSE c END AS clean_id FROM (SELECT o_orderkey,
 regexp_replace(trim(coalesce({dirty}, '')), '\\.0$', '') AS c FROM orders)"""
    dirty = """CASE event_id % 6 WHEN 0 THEN 'x' WHEN 1 THEN NULL WHEN 2 THEN 'NaN'
 WHEN 3 THEN 'Infinity' ELSE CAST(value AS VARCHAR) END"""
    out["clean_numbers"] = f"""SELECT event_id,
 {r("CASE WHEN n IS NULL OR isnan(n) THEN 0.0 WHEN isinf(n) THEN -1.0 ELSE n END", "number")},
 {r("CASE WHEN n IS NULL OR isnan(n) OR isinf(n) THEN 0.0 ELSE n END", "model_value")}
 FROM (SELECT event_id, TRY_CAST({dirty} AS DOUBLE) AS n FROM events)"""
    dirty = """CASE o_orderkey % 4 WHEN 0 THEN 'not a date'
 WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d')
 ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END"""
    out["lenient_dates"] = f"""SELECT o_orderkey, {ts('t', 'ts')}, {day('t', 'day')}
 FROM (SELECT o_orderkey, TRY_CAST({dirty} AS TIMESTAMP) AS t FROM orders) WHERE t IS NOT NULL"""
    out["resolved_columns"] = with_(
        DAYS,
        f"SELECT {day('d', 'local_date')}, {r('sum(tracker_conversions)', 'tracker_conversions')}, "
        f"{r('sum(tracker_revenue)', 'tracker_revenue')} FROM dd GROUP BY d",
    )
    hourly_out = ", ".join(r(m, m) for m in [*METRICS, "clicks"])
    out["local_hour_rollup"] = with_(
        HOURS,
        f"SELECT {big('h', 'hour_idx')}, {ts('make_timestamp(h * 3600000000)', 'local_ts')}, "
        f"{TZ} AS timezone, {IDS}, {hourly_out} FROM hr",
    )
    out["attach_timezone"] = with_(
        [EV, REP],
        f"SELECT {ts('date', 'date')}, {IDS}, {TZ} AS timezone, "
        f"{_STATUSES['account']} AS account_status FROM rep",
    )
    out["tz_match_rate"] = with_(
        [EV, REP],
        f"""SELECT count(*) AS rows, count(*) FILTER (z != '') AS matched_rows,
 count(*) FILTER (z = '') AS missing_rows, count(*) FILTER (z = 'Not/AZone') AS unknown_zone_rows,
 {r("count(*) FILTER (z != '') / count(*)", "match_rate")}
 FROM (SELECT {TZ} AS z FROM rep)""",
    )
    out["daily_rollup"] = with_(
        DAYS, f"SELECT {day('d', 'local_date')}, {TZ} AS timezone, {IDS}, {_DAILY_OUT} FROM dd"
    )
    out["lifetime_summary"] = with_(
        DAYS,
        f"""SELECT {AD}, count(DISTINCT d) AS full_days_active,
 {r('sum(spend)', 'full_cum_spend')}, {r('sum(inline_link_clicks)', 'full_cum_clicks')},
 {r('sum(tracker_conversions)', 'full_cum_conversions')},
 {r('sum(tracker_revenue)', 'full_cum_revenue')},
 count(*) FILTER (spend = 0) AS full_zero_spend_to_date FROM dd GROUP BY u""",
    )
    ads = f"SELECT {AD}, count(DISTINCT d) AS days FROM dd GROUP BY u HAVING count(DISTINCT d) >= 8"
    out["eligible_ads"] = with_(DAYS, ads)
    out["top_eligible_ads"] = with_(DAYS, ads + " ORDER BY days DESC, ad_id LIMIT 20")
    out["eligible_history"] = with_(
        DAYS,
        f"SELECT {day('d', 'local_date')}, {AD}, {r('spend', 'spend')} FROM dd WHERE u IN "
        "(SELECT u FROM dd GROUP BY u HAVING count(DISTINCT d) >= 20)",
    )
    fields = ", ".join([r("spend", "spend"), big("impressions", "impressions"), r("tracker_revenue", "tracker_revenue")])
    anchor = "TIMESTAMP '2024-01-28 00:00:00'"
    rows = f"""act AS (SELECT * FROM rep WHERE date BETWEEN {anchor} - INTERVAL 8 DAY AND {anchor}
 AND {_ALL_ON})"""
    out["extract_hourly"] = with_(
        [EV, REP, rows, _top("act", 50)],
        f"SELECT {ts('date', 'date')}, {TZ} AS timezone, {IDS}, {fields} FROM act "
        "WHERE u IN (SELECT u FROM top)",
    )
    hours = rows
    rows = f"""act AS (SELECT *, d AS date FROM dd WHERE
 CAST(d AS TIMESTAMP) BETWEEN {anchor} - INTERVAL 21 DAY AND {anchor}
 AND u % 5 IN (0, 1, 3, 4) AND {_ALL_ON})"""
    out["extract_hourly_all"] = with_(
        [EV, REP, hours],
        f"SELECT {ts('date', 'date')}, {TZ} AS timezone, {IDS}, {fields} FROM act",
    )
    out["extract_daily"] = with_(
        [*DAYS, rows, _top("act", 50)],
        f"SELECT {day('date', 'date')}, {TZ} AS timezone, {IDS}, {fields} FROM act "
        "WHERE u IN (SELECT u FROM top)",
    )
    everyone = rows.replace("AND u % 5 IN (0, 1, 3, 4) ", "")
    out["extract_daily_all"] = with_(
        [*DAYS, everyone],
        f"SELECT {day('date', 'date')}, {TZ} AS timezone, {IDS}, {fields} FROM act",
    )
    out["extract_daily_per_account"] = with_(
        [*DAYS, everyone],
        f"""SELECT {day('date', 'date')}, {TZ} AS timezone, {IDS}, {fields} FROM act
 WHERE u IN (SELECT u FROM act GROUP BY u QUALIFY row_number() OVER (PARTITION BY u % 5
 ORDER BY sum(spend) DESC, max(date) DESC, CAST(u AS VARCHAR)) <= 3)""",
    )
    out["top_ads_per_account"] = with_(
        [EV, REP],
        f"""SELECT CAST(u % 5 AS VARCHAR) AS account_id, {AD}, {r('sum(spend)', 'total_spend')},
 {ts('max(date)', 'last_seen')} FROM rep GROUP BY u QUALIFY row_number() OVER (PARTITION BY u % 5
 ORDER BY sum(spend) DESC, max(date) DESC, CAST(u AS VARCHAR)) <= 4""",
    )
    out["csv_by_name"] = (
        "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, "
        "CASE WHEN o_orderkey % 2 = 1 THEN o_orderstatus END AS o_orderstatus FROM orders"
    )
    out["log_transform"] = (
        f"SELECT o_orderkey, {r('ln(1 + o_totalprice)', 'logged')}, {r('o_totalprice', 'back')} FROM orders"
    )
    out["active_rows"] = with_(
        [EV, REP], f"SELECT {ts('date', 'date')}, {AD}, {r('spend', 'spend')} FROM rep WHERE {_ALL_ON}"
    )
    recent = HR.replace("FROM rep)", "FROM rep WHERE date >= (SELECT max(date) FROM rep) - INTERVAL 10 DAY)")
    out["recent_hours"] = with_(
        [EV, REP, recent], f"SELECT {big('h', 'hour_idx')}, {AD}, {r('spend', 'spend')} FROM hr"
    )
    out["account_scope"] = with_(
        DAYS,
        f"SELECT {day('d', 'local_date')}, {AD}, CAST(u % 5 AS VARCHAR) AS account_id, "
        f"{r('spend', 'spend')} FROM dd WHERE u % 5 IN (1, 4)",
    )
    out["top_ads"] = with_(
        [EV, REP],
        f"SELECT {AD}, {r('sum(spend)', 'total_spend')}, {ts('max(date)', 'last_seen')} FROM rep "
        "GROUP BY u ORDER BY sum(spend) DESC, max(date) DESC, ad_id LIMIT 20",
    )
    out["active_accounts"] = with_(
        [EV],
        f"SELECT DISTINCT CAST(u % 5 AS VARCHAR) AS account_id FROM ev WHERE {_ON['account']} ORDER BY 1",
    )
    hierarchy = f"""SELECT {IDS}, CAST(({_ALL_ON}) AS VARCHAR) AS is_currently_active,
 {ts('f', 'scheduled_active_from')}, {ts('t', 'scheduled_active_until')},
 CASE WHEN {_ALL_ON} THEN 'currently_active' ELSE 'not_currently_active' END AS eligibility_status
 FROM sch"""
    out["eligible_hierarchy"] = with_([EV, _SCHEDULED], hierarchy)
    out["eligible_in_window"] = with_(
        [EV, _SCHEDULED],
        f"""{hierarchy} WHERE ({_ALL_ON}) OR (f >= TIMESTAMP '2024-02-01' AND
 f < TIMESTAMP '2024-02-02' AND (t IS NULL OR t > TIMESTAMP '2024-02-01'))""",
    )
    two = f"""two AS (SELECT u, CAST(ts AS DATE) AS d, 0 AS src, {SUMS} FROM ev
 WHERE ts < TIMESTAMP '2024-01-20' AND k != 'purchase' GROUP BY 1, 2 UNION ALL
 SELECT u, CAST(ts AS DATE) AS d, 1 AS src, {SUMS} FROM ev
 WHERE ts >= TIMESTAMP '2024-01-10' GROUP BY 1, 2)"""
    out["dedupe_sources"] = with_(
        [EV, two],
        f"SELECT {day('d', 'local_date')}, {TZ} AS timezone, {IDS}, {_DAILY_OUT} FROM two "
        "QUALIFY row_number() OVER (PARTITION BY u, d ORDER BY src DESC) = 1",
    )
    zones = """tz2 AS (SELECT u, CAST(ts AS DATE) AS d,
 CASE WHEN k IN ('purchase', 'signup') THEN 'UTC' ELSE 'Asia/Kolkata' END AS timezone,
 sum(v) AS spend FROM ev GROUP BY ALL)"""
    last = """kl AS (SELECT * FROM tz2 QUALIFY row_number() OVER
 (PARTITION BY u, d ORDER BY timezone DESC) = 1)"""
    out["keep_last"] = with_(
        [EV, zones, last],
        f"SELECT {day('d', 'local_date')}, timezone, {IDS}, {r('spend', 'spend')} FROM kl",
    )
    out["dense_fill"] = with_(
        [EV, zones, last],
        f"""SELECT {day('d', 'local_date')}, timezone, {IDS}, {r('spend', 'spend')} FROM (
 SELECT g.u, g.d, coalesce(kl.spend, 0) AS spend,
 last_value(kl.timezone IGNORE NULLS) OVER (PARTITION BY g.u ORDER BY g.d) AS timezone FROM (
 SELECT u, CAST(unnest(generate_series(CAST(a AS TIMESTAMP), CAST(z AS TIMESTAMP), INTERVAL 1 DAY))
 AS DATE) AS d FROM (SELECT u, min(d) AS a, max(d) AS z FROM kl GROUP BY u)) g
 LEFT JOIN kl ON kl.u = g.u AND kl.d = g.d)""",
    )
    out["last_rows"] = with_(
        DAYS,
        f"SELECT {AD}, {day('d', 'local_date')}, {r('spend', 'spend')} FROM dd "
        "QUALIFY row_number() OVER (PARTITION BY u ORDER BY d DESC) <= 16",
    )
    out["daily_dense"] = with_(
        [*DAYS, DN], f"SELECT {day('d', 'local_date')}, {TZ} AS timezone, {IDS}, {_DAILY_OUT} FROM dn"
    )
    last16 = """l16 AS (SELECT * FROM dd
 QUALIFY row_number() OVER (PARTITION BY u ORDER BY d DESC) <= 16)"""
    out["scoring_frame"] = with_(
        [*DAYS, last16, grid("dn16", "l16", 1)],
        f"SELECT {day('d', 'local_date')}, {TZ} AS timezone, {IDS}, "
        "CASE WHEN d > last_d THEN strftime(last_d, '%Y-%m-%d') END AS history_cutoff_local_date, "
        f"{_DAILY_OUT} FROM dn16",
    )
    out["kpis"] = with_(
        DAYS,
        f"SELECT {day('d', 'local_date')}, {AD}, "
        + ", ".join(r(kpi_of("{m}", k), f"kpi_{k}") for k in KPIS)
        + " FROM dd",
    )
    out["kpis_fill"] = with_(
        DAYS,
        f"""SELECT {day('d', 'local_date')}, {AD},
 {r("CASE WHEN inline_link_clicks = 0 THEN 1.5 WHEN spend > 0 THEN CAST(tracker_revenue AS DOUBLE) / CAST(spend AS DOUBLE) END", "roas")},
 {r("CAST(tracker_revenue AS DOUBLE) - CAST(spend AS DOUBLE)", "profit")},
 {r("CASE WHEN impressions > 0 THEN inline_link_clicks / impressions * 100.0 END", "ctr")},
 {r("CASE WHEN inline_link_clicks > 0 THEN tracker_conversions / inline_link_clicks * 100.0 END", "cvr")},
 {r("CASE WHEN inline_link_clicks > 0 THEN CAST(spend AS DOUBLE) / inline_link_clicks END", "cpc")},
 {r("CASE WHEN impressions > 0 THEN CAST(spend AS DOUBLE) / impressions * 1000.0 END", "cpm")}
 FROM dd""",
    )
    out["payload_json"] = with_(
        DAYS, f"SELECT {day('d', 'local_date')}, {AD}, {r('impressions', 'impressions')} FROM dd"
    )
    out["range_scan"] = """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts,
 CAST(user_id AS VARCHAR) AS ad_id FROM events WHERE event_type = 'purchase'
 AND ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-15' AND user_id % 5 = 2"""
    out["list_measurements"] = (
        "SELECT DISTINCT event_type AS measurement FROM events WHERE coalesce(event_type, '') != ''"
    )
    out["find_page"] = f"""SELECT o_orderkey, o_custkey, {r('o_totalprice', 'o_totalprice')} FROM orders
 WHERE o_orderstatus = 'F' ORDER BY orders.o_totalprice DESC, o_orderkey LIMIT 50 OFFSET 20"""
    out["find_after"] = f"""SELECT o_orderkey, {r('o_totalprice', 'o_totalprice')} FROM orders
 WHERE o_orderstatus = 'F' ORDER BY orders.o_totalprice DESC, o_orderkey OFFSET 500"""
    rejected = "u % 11 IN (0, 1) OR u % 13 IN (0, 1)"
    out["rejected_rows"] = with_(
        [EV, REP],
        f"SELECT count(*) AS rows, {big('count(*) FILTER (u % 13 = 0)', 'unreadable_dates')}, "
        f"{big('count(*) FILTER (u % 13 = 1)', 'impossible_dates')}, "
        f"{big('count(*) FILTER (u % 11 IN (0, 1))', 'blank_ads')}, "
        f"{big('count(*) FILTER (u % 5 = 3)', 'unmatched_zones')}, "
        f"{big('count(*) FILTER (u % 7 = 0)', 'rejected_numbers')}, "
        f"{big(f'count(*) FILTER (NOT ({rejected}))', 'kept_rows')} FROM rep",
    )
    out["clustered_hours"] = with_(
        HOURS,
        f"SELECT {big('h', 'hour_idx')}, {AD}, {r('spend', 'spend')}, "
        f"{r('lag(spend) OVER (PARTITION BY u ORDER BY h)', 'previous_spend')} FROM hr",
    )
    late = everyone.replace("2024-01-28", "2024-03-10").replace("INTERVAL 21 DAY", "INTERVAL 90 DAY")
    out["extract_attempts"] = with_(
        [*DAYS, late],
        f"""SELECT {day('date', 'date')}, {AD}, {r('spend', 'spend')}, CAST(90 AS BIGINT) AS lookback_days,
 CAST(2 AS BIGINT) AS ads_per_account FROM act WHERE u IN (SELECT u FROM act GROUP BY u
 QUALIFY row_number() OVER (PARTITION BY u % 5 ORDER BY sum(spend) DESC, max(date) DESC,
 CAST(u AS VARCHAR)) <= 2)""",
    )
    tenants = (("a", "tracker_conversions", "tracker_revenue"), ("b", "inline_link_clicks", "spend"))
    out["tenant_columns"] = with_(
        DAYS,
        " UNION ALL ".join(
            f"SELECT {AD}, '{t}' AS tenant, {big(f'sum({c})', 'conversions')}, {r(f'sum({v})', 'revenue')} "
            "FROM dd GROUP BY u"
            for t, c, v in tenants
        ),
    )
    out["report_round_trip"] = with_(
        DAYS,
        " UNION ALL ".join(
            f"SELECT '{f}' AS format, {AD}, {r('sum(spend)', 'full_cum_spend')} FROM dd GROUP BY u"
            for f in ("parquet", "csv")
        ),
    )
    spend = f"{day('d', 'local_date')}, {AD}, {r('spend', 'spend')}"
    out["feature_cache"] = with_(
        DAYS,
        f"SELECT {spend}, scope FROM dd, (VALUES ('even'), ('rebuilt')) AS t(scope) WHERE u % 2 = 0",
    )
    out["scoring_cap"] = with_(
        [*DAYS, _top("(SELECT *, d AS date FROM dd)", 10)],
        f"SELECT {spend} FROM dd WHERE u IN (SELECT u FROM top)",
    )
    out["count_matching"] = (
        "SELECT count(*) AS count FROM orders WHERE o_orderstatus = 'F'"
    )
    return out


# -- hourly anchors ----------------------------------------------------------


def anchor_table(which: str) -> str:
    """Anchors: every one inside the series, or the latest per ad."""
    spans = "(SELECT u, min(h) AS h0, max(h) AS h1 FROM hr GROUP BY u)"
    if which == "latest":
        return f"an AS (SELECT u, h0, h1, h1 - h1 % 6 AS a FROM {spans} WHERE h0 <= h1 - h1 % 6)"
    first = "CAST(ceil((h0 + 167) / 6.0) * 6 AS BIGINT)"
    return (
        f"an AS (SELECT * FROM (SELECT u, h0, h1, unnest(generate_series({first}, h1 - 6, 6)) AS a "
        f"FROM {spans}))"
    )


def _in(low: str, high: str) -> str:
    return f"hr.h BETWEEN {low} AND {high}"


def _hours_sum(m: str, condition: str) -> str:
    return f"coalesce(sum(hr.{m}) FILTER ({condition}), 0)"


def anchor_sums() -> str:
    """All window sums at the anchors, summed from the hours in range."""
    cols = [
        f"count(*) FILTER ({_in('a - 167', 'a')}) AS observed_history_hours",
        f"count(*) FILTER ({_in('a - 23', 'a')}) AS observed_recent_24h",
        f"min(hr.h) FILTER ({_in('a - 167', 'a')}) AS w0",
    ]
    for m in METRICS:
        for w in hourly.WINDOWS:
            cols.append(f"CAST({_hours_sum(m, _in(f'a - {w - 1}', 'a'))} AS DOUBLE) AS {m}_sum_{w}h")
        for n in hourly.SAME_WINDOW_DAYS:
            span = _in(f"a + 1 - {24 * n}", f"a + 6 - {24 * n}")
            cols.append(f"CAST({_hours_sum(m, span)} AS DOUBLE) AS {m}_same_target_6h_d{n}")
        cols.append(f"CAST({_hours_sum(m, _in('a - 167', 'a'))} AS DOUBLE) AS {m}_cum")
        cols.append(f"CAST({_hours_sum(m, _in('a + 1', 'a + 6'))} AS DOUBLE) AS target_{m}")
        cols.append(f"CAST(sum(hr.{m}) AS DOUBLE) AS total_{m}")
    return (
        f"sm AS (SELECT an.u, a, h0, h1, {', '.join(cols)} FROM an JOIN hr ON hr.u = an.u "
        "GROUP BY an.u, a, h0, h1)"
    )


def stats() -> dict[str, str]:
    out = {}
    for m in METRICS:
        days = [f"{m}_same_target_6h_d{n}" for n in hourly.SAME_WINDOW_DAYS]
        up = f"list_sort([{', '.join(days)}])"
        mean = f"(({' + '.join(days)}) / 7)"
        name = f"{m}_same_6h_7d"
        out[f"{name}_mean"] = mean
        out[f"{name}_median"] = f"{up}[4]"
        out[f"{name}_std"] = f"sqrt(({' + '.join(f'({x} - {mean}) * ({x} - {mean})' for x in days)}) / 7)"
        out[f"{name}_min"] = f"{up}[1]"
        out[f"{name}_max"] = f"{up}[7]"
        out[f"{name}_p75"] = f"({up}[5] + {up}[6]) / 2"
        out[f"{name}_p90"] = f"{up}[6] + ({up}[7] - {up}[6]) * 0.4"
        out[f"{name}_last_over_mean"] = ratio(days[0], mean)
    return out


ST = "st AS (SELECT *, " + ", ".join(f"{sql} AS {n}" for n, sql in stats().items()) + " FROM sm)"
EVERY = [*HOURS, anchor_table("every"), anchor_sums(), ST]
LATEST = [*HOURS, anchor_table("latest"), anchor_sums(), ST]
_AK = f"{big('a', 'anchor_idx')}, {IDS}"
_TRAIN = """observed_history_hours >= 12 AND spend_sum_24h >= 1 AND impressions_sum_24h >= 50
 AND inline_link_clicks_sum_24h >= 1 AND total_spend >= 1 AND total_impressions >= 50
 AND total_inline_link_clicks >= 1 AND target_spend + target_impressions
 + target_inline_link_clicks + target_tracker_conversions + target_tracker_revenue > 0"""
_KPI6 = ["ctr", "cpc", "cpm", "cvr", "roas", "profit"]


def anchor_calendar() -> dict[str, str]:
    hour, dow = "(a % 24)", "((a // 24 + 3) % 7)"
    by_hour, by_day = 2.0 * math.pi / 24.0, 2.0 * math.pi / 7.0
    return {
        "anchor_hour": hour,
        **{f"anchor_hour_{h}": f"CAST({hour} = {h} AS INT)" for h in (0, 6, 12, 18)},
        "dow": dow,
        "is_weekend": f"CAST({dow} >= 5 AS INT)",
        "hour_sin": f"sin({hour} * {by_hour!r})",
        "hour_cos": f"cos({hour} * {by_hour!r})",
        "dow_sin": f"sin({dow} * {by_day!r})",
        "dow_cos": f"cos({dow} * {by_day!r})",
        "observed_history_hours": "observed_history_hours",
        "observed_history_ratio": "observed_history_hours / 168.0",
        "observed_recent_24h": "observed_recent_24h",
        "hours_active": "coalesce(a - w0 + 1, 0)",
    }


_INT6 = {
    "anchor_hour", "anchor_hour_0", "anchor_hour_6", "anchor_hour_12", "anchor_hour_18",
    "dow", "is_weekend", "observed_history_hours", "observed_recent_24h",
}


def _hourly_statements() -> dict[str, str]:
    def typed(name: str, sql: str) -> str:
        return big(sql, name) if name in _INT6 else r(sql, name)

    cal = anchor_calendar()
    out = {
        "anchors_latest": with_(
            LATEST,
            f"SELECT {_AK}, {TZ} AS timezone, {ts('make_timestamp(a * 3600000000)', 'anchor_ts')}, "
            + ", ".join(typed(n, sql) for n, sql in cal.items())
            + " FROM st",
        ),
        "trailing_sums": with_(
            EVERY,
            f"SELECT {_AK}, observed_history_hours, observed_recent_24h, "
            + ", ".join(r(f"{m}_sum_{w}h", f"{m}_sum_{w}h") for m in METRICS for w in hourly.WINDOWS)
            + " FROM st",
        ),
        "same_window_history": with_(
            EVERY,
            f"SELECT {_AK}, "
            + ", ".join(
                r(f"{m}_same_target_6h_d{n}", f"{m}_same_target_6h_d{n}")
                for m in METRICS
                for n in hourly.SAME_WINDOW_DAYS
            )
            + " FROM st",
        ),
        "same_window_stats": with_(
            EVERY, f"SELECT {_AK}, " + ", ".join(r(n, n) for n in stats()) + " FROM st"
        ),
        "future_target": with_(
            EVERY,
            f"SELECT {_AK}, "
            + ", ".join(r(n, n) for n in [f"{m}_cum" for m in METRICS] + [f"target_{m}" for m in METRICS])
            + " FROM st",
        ),
        "train_anchors": with_(
            EVERY,
            f"SELECT {_AK}, observed_history_hours, "
            + ", ".join(r(f"target_{m}", f"target_{m}") for m in METRICS)
            + f" FROM st WHERE {_TRAIN}",
        ),
    }
    split = """ts AS (SELECT list_sort(list(DISTINCT a)) AS t FROM st WHERE {w}),
 n AS (SELECT t, CAST(floor(len(t) * 0.7) AS INT) AS i, CAST(floor(len(t) * 0.85) AS INT) AS j FROM ts),
 cut AS (SELECT t[greatest(i, 1)] AS lo, t[least(greatest(j, i + 1), len(t))] AS hi FROM n),
 part AS (SELECT st.*, CASE WHEN a <= lo THEN 'train' WHEN a <= hi THEN 'valid' ELSE 'test' END AS split
 FROM st, cut WHERE {w})""".replace("{w}", _TRAIN)
    parts = [*EVERY, split]
    out["training_rows"] = with_(
        parts,
        f"""SELECT split, count(*) AS rows, {ts('make_timestamp(min(a) * 3600000000)', 'first_anchor')},
 {ts('make_timestamp(max(a) * 3600000000)', 'last_anchor')}, {r('sum(target_tracker_revenue)', 'revenue')}
 FROM part GROUP BY split""",
    )
    out["search_choice"] = with_(
        parts,
        """SELECT target, CAST(6 AS BIGINT) AS candidates, count(*) FILTER (split = 'valid') AS valid_rows,
 count(*) FILTER (split = 'test') AS test_rows, 'true' AS same_settings, 'true' AS chosen_is_best
 FROM part, (VALUES ('target_tracker_conversions'), ('target_tracker_revenue')) AS t(target) GROUP BY target""",
    )
    out["routing_checks"] = with_(
        parts,
        """SELECT split, count(*) AS rows, count(*) AS good, count(*) AS from_main, count(*) AS from_search
 FROM part GROUP BY split""",
    )
    made = dict(cal)
    for w in hourly.WINDOWS:
        made |= {f"{m}_avg_{w}h": f"{m}_sum_{w}h / {w}" for m in METRICS}
        made |= {f"kpi_{w}h_{k}": kpi_of("{m}_sum_" + f"{w}h", k) for k in _KPI6}
    for n in hourly.SAME_WINDOW_DAYS:
        made |= {
            f"kpi_same_target_6h_d{n}_{k}": kpi_of("{m}_same_target_6h_" + f"d{n}", k) for k in _KPI6
        }
    for s in ("mean", "median", "p90"):
        made |= {f"kpi_same_6h_7d_{s}_{k}": kpi_of("{m}_same_6h_7d_" + s, k) for k in _KPI6}
    made |= {f"kpi_cum_{k}": kpi_of("{m}_cum", k) for k in _KPI6}
    cols = [typed(n, made.get(n, n)) for n in hourly.hourly_feature_names()]
    out["hourly_features"] = with_(
        EVERY, f"SELECT {big('a', 'anchor_idx')}, {AD}, {', '.join(cols)} FROM st WHERE {_TRAIN}"
    )
    return out


# -- peers, labels and serving -----------------------------------------------

LEVELS = ["adset", "campaign", "account"]
_PARTS = {"account": "u % 5", "campaign": "u % 5, u % 15", "adset": "u % 5, u % 15, u % 45"}


def peer_table(name: str, source: str, values: dict[str, str], within: str) -> str:
    cols = []
    for m, v in values.items():
        own = f"CASE WHEN {v} > 0 THEN {v} ELSE 0 END"
        for level in LEVELS:
            w = f"(PARTITION BY {within}{_PARTS[level]})"
            others = f"(count(*) FILTER ({v} > 0) OVER {w} - CASE WHEN {v} > 0 THEN 1 ELSE 0 END)"
            cols.append(
                f"CASE WHEN {others} >= 2 THEN greatest(sum({own}) OVER {w} - {own}, 0.0) / {others} END "
                f"AS {m}_{level}_peer"
            )
    return f"{name} AS (SELECT *, {', '.join(cols)} FROM {source})"


def peer_value(m: str) -> str:
    return f"coalesce({', '.join(f'{m}_{level}_peer' for level in LEVELS)}, 0.0)"


def peer_source(m: str) -> str:
    arms = " ".join(
        f"WHEN {m}_{level}_peer IS NOT NULL THEN '{level}_same_window_benchmark'" for level in LEVELS
    )
    return f"CASE {arms} ELSE 'insufficient_history' END"


MEAN7 = {m: f"{m}_roll_mean_7d" for m in METRICS}
PD = peer_table("pd", "fe1", MEAN7, "d, ")


def label_table(name: str, source: str) -> str:
    """History columns and labels, then confidence, of a feature table."""
    s = {m: f"{m}_roll_sum_7d" for m in METRICS}
    rev, conv = s["tracker_revenue"], s["tracker_conversions"]
    spike = clip(ratio("tracker_revenue_lag_1d", "tracker_revenue_roll_mean_7d", 1.0, True), 0, 100)
    rd, cd = "tracker_revenue_nonzero_count_7d", "tracker_conversions_nonzero_count_7d"
    zs, zr = "spend_zero_count_7d", "tracker_revenue_zero_count_7d"
    return f"""{name}_c AS (SELECT *, {spike} AS spike,
 ({s['spend']} <= 0 AND {s['impressions']} <= 0 AND {s['inline_link_clicks']} <= 0 AND {rev} <= 0) AS c_in,
 (days_active < 7) AS c_new,
 ({s['spend']} < 7 OR {s['impressions']} < 300 OR {s['inline_link_clicks']} < 5) AS c_low,
 ({zs} >= 5 OR ({zr} >= 5 AND {rev} > 0)) AS c_zero,
 ({spike} >= 3 OR ({rd} <= 2 AND {rev} > 0) OR ({cd} <= 2 AND {conv} > 0)) AS c_spiky,
 (days_active >= 14 AND {s['spend']} > 0 AND {rd} >= 3 AND {cd} >= 3 AND {zs} <= 2) AS c_stable
 FROM {source}),
{name}_s AS (SELECT *,
 CASE WHEN c_in THEN 'inactive' WHEN c_new THEN 'new_ad' WHEN c_low THEN 'low_volume'
 WHEN c_zero THEN 'mostly_zero_history' WHEN c_spiky THEN 'spiky_history'
 WHEN c_stable THEN 'stable_history' ELSE 'mixed_history' END AS history_segment,
 CASE WHEN c_in OR c_new OR c_low THEN 'LOW_DATA' WHEN c_zero OR c_spiky THEN 'HIGH'
 WHEN c_stable THEN 'LOW' ELSE 'MEDIUM' END AS spike_risk,
 CASE WHEN c_in THEN 'INACTIVE' WHEN c_new OR c_low THEN 'LOW' WHEN c_zero OR c_spiky THEN 'RISKY'
 WHEN c_stable THEN 'HIGH' ELSE 'MEDIUM' END AS forecast_data_quality FROM {name}_c),
{name}_f AS (SELECT *,
 CASE WHEN history_segment IN ('inactive', 'new_ad', 'low_volume', 'mostly_zero_history')
 OR days_active < 14 OR spend_roll_mean_7d < 1 OR impressions_roll_mean_7d < 100
 OR inline_link_clicks_roll_mean_7d < 1 THEN 'LOW'
 WHEN history_segment IN ('spiky_history', 'mixed_history') OR impressions_roll_mean_7d < 100
 OR inline_link_clicks_roll_mean_7d < 5 THEN 'MEDIUM' ELSE 'HIGH' END AS forecast_confidence,
 CASE WHEN history_segment = 'inactive' THEN 'INACTIVE_HISTORY'
 WHEN history_segment = 'mostly_zero_history' THEN 'MOSTLY_ZERO_HISTORY'
 WHEN history_segment = 'spiky_history' THEN 'SPIKY_HISTORY'
 WHEN days_active < 14 THEN 'LOW_RECENT_HISTORY' WHEN spend_roll_mean_7d < 1 THEN 'LOW_RECENT_SPEND'
 WHEN impressions_roll_mean_7d < 100 THEN 'LOW_IMPRESSIONS'
 WHEN inline_link_clicks_roll_mean_7d < 5 THEN 'LOW_CLICKS' ELSE 'OK' END AS kpi_reliability_flag
 FROM {name}_s),
{name} AS (SELECT *, (days_active >= 7 AND history_segment NOT IN ('inactive', 'new_ad', 'low_volume')) AS ok,
 CASE forecast_confidence WHEN 'LOW' THEN 'benchmark_range' WHEN 'MEDIUM' THEN 'point_with_caution'
 ELSE 'point_forecast' END AS forecast_use_case,
 CASE WHEN history_segment = 'inactive' THEN 0.0
 WHEN history_segment IN ('new_ad', 'low_volume', 'mostly_zero_history') THEN 0.9
 WHEN history_segment = 'spiky_history' THEN 1.25 WHEN forecast_confidence = 'MEDIUM' THEN 0.55
 ELSE 0.3 END AS width,
 CASE WHEN history_segment = 'inactive' THEN 'No recent activity; forecast forced to zero.'
 WHEN history_segment IN ('mostly_zero_history', 'spiky_history')
 THEN 'History is zero-heavy or spiky; use p10-p90 range, not point forecast only.'
 WHEN kpi_reliability_flag != 'OK' THEN 'KPI ratios are low-confidence; use raw metric range.'
 WHEN forecast_confidence = 'MEDIUM' THEN 'Use point forecast with caution.'
 ELSE 'Forecast is stable enough for point use.' END AS forecast_note FROM {name}_f)"""


def recommend_table(name: str, source: str) -> str:
    value = {
        m: f"CASE WHEN history_segment = 'inactive' THEN 0.0 WHEN ok THEN {m}_roll_mean_7d "
        f"ELSE {peer_value(m)} END"
        for m in METRICS
    }
    named = " ".join(
        f"WHEN {peer_source(m)} != 'insufficient_history' THEN {peer_source(m)}"
        for m in reversed(METRICS)
    )
    cols = ", ".join(f"{sql} AS rec_{m}" for m, sql in value.items())
    return (
        f"{name} AS (SELECT *, {cols}, CASE WHEN ok THEN 'model_point' {named} "
        f"ELSE 'insufficient_history' END AS benchmark_source FROM {source})"
    )


def _range(m: str, end: str) -> str:
    if end == "p10":
        return f"greatest(rec_{m} * (1.0 - width), 0.0)"
    return f"rec_{m}" if end == "p50" else f"rec_{m} * (1.0 + width)"


def _serving_statements() -> dict[str, str]:
    key = f"{day('d', 'local_date')}, {AD}"
    peers_all = ", ".join(r(f"{m}_{v}_peer", f"{m}_{v}_peer") for m in METRICS for v in LEVELS)
    out = {
        "peer_benchmark": with_(
            [*ALLDAYS, PD], f"SELECT {day('d', 'local_date')}, {IDS}, {peers_all} FROM pd"
        ),
        "hierarchical_choice": with_(
            [*ALLDAYS, PD],
            f"SELECT {key}, "
            + r(
                f"CASE WHEN days_active < 8 THEN {peer_value('tracker_revenue')} "
                "ELSE tracker_revenue_roll_mean_7d END",
                "forecast",
            )
            + f", {peer_source('tracker_revenue')} AS forecast_source FROM pd",
        ),
    }
    labels = " UNION ALL ".join(f"SELECT u, d, {peer_source(m)} AS s FROM pd" for m in METRICS)
    out["source_mode"] = with_(
        [*ALLDAYS, PD],
        f"""SELECT {key}, s AS source FROM (SELECT u, d, s, count(*) AS n FROM ({labels})
 GROUP BY u, d, s) QUALIFY row_number() OVER (PARTITION BY u, d ORDER BY n DESC, s) = 1""",
    )
    lb = label_table("lb", "pd")
    history = {
        "history_spend_sum_7d": "spend_roll_sum_7d",
        "history_impressions_sum_7d": "impressions_roll_sum_7d",
        "history_clicks_sum_7d": "inline_link_clicks_roll_sum_7d",
        "history_conversions_sum_7d": "tracker_conversions_roll_sum_7d",
        "history_revenue_sum_7d": "tracker_revenue_roll_sum_7d",
        "history_revenue_nonzero_days_7d": "tracker_revenue_nonzero_count_7d",
        "history_conversion_nonzero_days_7d": "tracker_conversions_nonzero_count_7d",
        "history_zero_spend_days_7d": "spend_zero_count_7d",
        "history_zero_revenue_days_7d": "tracker_revenue_zero_count_7d",
        "history_revenue_spike_ratio_7d": "spike",
    }
    out["history_segments"] = with_(
        [*ALLDAYS, PD, lb],
        f"SELECT {key}, {big('days_active', 'days_active')}, "
        + ", ".join(r(sql, n) for n, sql in history.items())
        + ", history_segment, spike_risk, forecast_data_quality FROM lb",
    )
    out["confidence_24h"] = with_(
        [*ALLDAYS, PD, lb],
        f"""SELECT {key}, history_segment, forecast_confidence, kpi_reliability_flag,
 forecast_use_case, forecast_note FROM lb""",
    )
    rec = recommend_table("rc", "lb")
    out["ranges_24h"] = with_(
        [*ALLDAYS, PD, lb, rec],
        f"SELECT {key}, benchmark_source, "
        + ", ".join(r(f"rec_{m}", f"recommended_24h_{m}") for m in METRICS)
        + ", "
        + ", ".join(r(kpi_of("rec_{m}", k, True), f"recommended_24h_{k}") for k in KPIS)
        + ", "
        + ", ".join(r(_range(m, e), f"pred_24h_{m}_{e}") for m in METRICS for e in ("p10", "p90"))
        + ", "
        + ", ".join(
            r(ratio(_range("tracker_revenue", e), "rec_spend", 1.0, True), f"recommended_24h_roas_{e}")
            for e in ("p10", "p50", "p90")
        )
        + " FROM rc",
    )
    # Sink rows of the next-day forecast.
    latest = "nx AS (SELECT * FROM fe1 WHERE d = last_d + 1)"
    pn = peer_table("pd", "nx", MEAN7, "")
    utc = f"timezone('UTC', timezone({ZONE}, {{}}))"
    d0, d1 = "CAST(d AS TIMESTAMP)", "CAST(d + 1 AS TIMESTAMP)"
    served = {SHORT[m]: f"rec_{m}" for m in METRICS}
    raw = {SHORT[m]: f"{m}_roll_mean_7d" for m in METRICS}
    cols = [
        "'24h' AS forecast_horizon",
        IDS,
        ts(utc.format(d0), "forecast_anchor"),
        ts(utc.format(d0), "forecast_window_start"),
        ts(utc.format(d1), "forecast_window_end"),
        f"{TZ} AS timezone",
        ts(d0, "forecast_anchor_local"),
        ts(d0, "forecast_window_start_local"),
        ts(d1, "forecast_window_end_local"),
        day("d", "forecast_local_date"),
        "forecast_confidence",
        r(
            "CASE forecast_confidence WHEN 'HIGH' THEN 0.9 WHEN 'MEDIUM' THEN 0.6 ELSE 0.3 END",
            "forecast_confidence_score",
        ),
        "CASE WHEN benchmark_source = 'insufficient_history' THEN 'insufficient_history_monitoring' "
        "WHEN benchmark_source != 'model_point' THEN 'hierarchical_benchmark_forecast' "
        "WHEN forecast_confidence = 'LOW' THEN 'low_confidence_forecast' ELSE 'model_forecast' END "
        "AS forecast_status",
        "benchmark_source",
        "'recent_mean' AS model_source",
        *[r(sql, f"result_{n}") for n, sql in served.items()],
        *[r(kpi(k, served, True), f"result_{k}") for k in KPIS],
        *[r(sql, f"raw_pred_{n}") for n, sql in raw.items()],
        *[r(kpi(k, raw), f"raw_pred_{k}") for k in KPIS],
        "CAST(NULL AS VARCHAR) AS recently_active",
        "'2024-02-01 00:00:00' AS created_at",
        *[
            r(_range(m, e), f"result_{SHORT[m]}_{e}")
            for m in METRICS
            for e in ("p10", "p90")
        ],
        *[
            r(ratio(_range("tracker_revenue", e), "rec_spend", 1.0, True), f"result_roas_{e}")
            for e in ("p10", "p90")
        ],
    ]
    out["forecast_rows"] = with_(
        [*ALLDAYS, latest, pn, label_table("lb", "pd"), rec], f"SELECT {', '.join(cols)} FROM rc"
    )
    # Read back from the stored table; the second rerun has even ads only.
    spend, roas = served["spend"], kpi("roas", served, True)
    kept = [AD, day("d", "forecast_local_date")]
    whole = ", ".join(["'24h' AS forecast_horizon", *kept])
    stored = [*ALLDAYS, latest, pn, label_table("lb", "pd"), rec]
    out["forecast_append"] = with_(
        stored,
        f"SELECT {whole}, {r(f'({spend}) + 1', 'result_spend')}, {r(roas, 'result_roas')} FROM rc WHERE u % 2 = 0 "
        f"UNION ALL SELECT {whole}, {r(spend, 'result_spend')}, {r(roas, 'result_roas')} FROM rc WHERE u % 3 = 0",
    )
    ends = ", ".join(
        r(f"CASE WHEN u % 2 = 1 THEN {_range('spend', e)} END", f"result_spend_{e}") for e in ("p10", "p90")
    )
    out["schema_evolution"] = with_(stored, f"SELECT {', '.join(kept)}, {r(spend, 'result_spend')}, {ends} FROM rc")
    out["forecast_schema"] = _forecast_schema()
    out["empty_forecast"] = f"SELECT *, CAST(0 AS BIGINT) AS rows FROM ({_forecast_schema()})"
    # The whole job: features from the last 18 days, counters from all of them.
    recent = """rd AS (SELECT * FROM dd WHERE d >= (SELECT max(d) FROM dd) - 18),
l16 AS (SELECT * FROM rd QUALIFY row_number() OVER (PARTITION BY u ORDER BY d DESC) <= 16)"""
    life = "life AS (SELECT u, count(DISTINCT d) AS days FROM dd GROUP BY u)"
    nx = """nx AS (SELECT fe.* EXCLUDE days_active, CAST(days AS DOUBLE) AS days_active
 FROM fe JOIN life USING (u) WHERE d = last_d + 1)"""
    out["forecast_24h"] = with_(
        [*DAYS, recent, life, grid("dn16", "l16", 1), feature_table("fe", "dn16"), nx, pn,
         label_table("lb", "pd"), rec],
        f"SELECT {day('d', 'forecast_anchor_local_date')}, "
        f"{day('last_d', 'history_cutoff_local_date')}, {IDS}, {r('days_active', 'days_active')}, "
        "history_segment, benchmark_source, "
        + ", ".join(r(f"rec_{m}", f"recommended_24h_{m}") for m in METRICS)
        + " FROM rc",
    )
    return out | _serving_6h()


def _forecast_schema() -> str:
    """The forecast table's columns, written out: fixed values."""
    columns = """
forecast_horizon string|account_id string|campaign_id string|adset_id string|ad_id string
forecast_anchor timestamp|forecast_window_start timestamp|forecast_window_end timestamp|timezone string
forecast_anchor_local timestamp_ntz|forecast_window_start_local timestamp_ntz|forecast_window_end_local timestamp_ntz
forecast_local_date date|forecast_confidence string|forecast_confidence_score double
forecast_status string|benchmark_source string|model_source string
result_spend double|result_impressions double|result_clicks double|result_conversions double|result_revenue double
result_roas double|result_profit double|result_ctr double|result_cvr double|result_cpc double
result_cpm double
raw_pred_spend double|raw_pred_impressions double|raw_pred_clicks double|raw_pred_conversions double
raw_pred_revenue double|raw_pred_roas double|raw_pred_profit double|raw_pred_ctr double|raw_pred_cvr double
raw_pred_cpc double|raw_pred_cpm double|recently_active boolean|created_at timestamp
result_spend_p10 double|result_spend_p90 double|result_impressions_p10 double|result_impressions_p90 double
result_clicks_p10 double|result_clicks_p90 double|result_conversions_p10 double|result_conversions_p90 double
result_revenue_p10 double|result_revenue_p90 double|result_roas_p10 double|result_roas_p90 double
"""
    pairs = [c.split(" ") for c in columns.strip().replace("\n", "|").split("|")]
    rows = ", ".join(f"({k}, '{name}', '{kind}')" for k, (name, kind) in enumerate(pairs))
    return f"SELECT CAST(place AS BIGINT) AS place, name, type FROM (VALUES {rows}) AS t(place, name, type)"


def _guard(m: str, prediction: str, multiplier: float, cap: float) -> tuple[str, str]:
    peer = peer_value(m)
    ok = f"({peer_source(m)} != 'insufficient_history' AND {peer} > 0)"
    limit = (
        f"greatest(greatest({m}_same_6h_7d_mean, CASE WHEN {ok} THEN {peer} ELSE 0.0 END) "
        f"* {multiplier}, {cap})"
    )
    over = f"(enough AND {prediction} > {limit})"
    return (
        f"CASE WHEN {over} AND {ok} THEN {peer} WHEN {over} THEN {limit} ELSE {prediction} END",
        f"CASE WHEN {over} AND {ok} THEN 'guarded_peer_benchmark' "
        f"WHEN {over} THEN 'guarded_history_cap' ELSE 'model_point' END",
    )


def serve_6h(source: str, factor: str, multiplier: float, caps: dict, roas: float) -> list[str]:
    """Guarded values, ROAS limit, overall source and status."""
    vals, srcs = {}, {}
    for m in METRICS:
        pred = f"({m}_same_6h_7d_mean{factor})"
        value, label = pred, "'model_point'"
        if m in SPARSE:
            value, label = _guard(m, pred, multiplier, caps[m])
        vals[m] = f"CASE WHEN enough THEN {value} ELSE {peer_value(m)} END"
        srcs[m] = f"CASE WHEN enough THEN {label} ELSE {peer_source(m)} END"
    s1 = (
        f"s1 AS (SELECT *, {', '.join(f'{v} AS val_{m}' for m, v in vals.items())}, "
        f"{', '.join(f'{v} AS src_{m}' for m, v in srcs.items())} FROM "
        f"(SELECT *, observed_history_hours >= 16 AS enough FROM {source}))"
    )
    high = f"(val_spend > 0 AND val_tracker_revenue > val_spend * {roas})"
    s2 = (
        "s2 AS (SELECT * EXCLUDE (val_tracker_revenue, src_tracker_revenue), "
        f"CASE WHEN {high} THEN val_spend * {roas} ELSE val_tracker_revenue END AS val_tracker_revenue, "
        f"CASE WHEN {high} THEN 'guarded_roas_cap' ELSE src_tracker_revenue END AS src_tracker_revenue "
        "FROM s1)"
    )
    long = " UNION ALL ".join(f"SELECT u, a, src_{m} AS s FROM s2" for m in METRICS)
    s3 = (
        f"s3 AS (SELECT u, a, s AS common FROM (SELECT u, a, s, count(*) AS n FROM ({long}) "
        "GROUP BY u, a, s) QUALIFY row_number() OVER (PARTITION BY u, a ORDER BY n DESC, s) = 1)"
    )
    guards = ", ".join(f"CASE WHEN src_{m} LIKE 'guarded%' THEN src_{m} END" for m in METRICS)
    s4 = f"s4 AS (SELECT s2.*, coalesce({guards}, common) AS benchmark_source FROM s2 JOIN s3 USING (u, a))"
    s5 = (
        "s5 AS (SELECT *, CASE WHEN benchmark_source = 'insufficient_history' "
        "THEN 'insufficient_history_monitoring' WHEN benchmark_source LIKE 'guarded%' "
        "THEN 'guarded_model_forecast' WHEN enough THEN 'model_forecast' "
        "ELSE 'hierarchical_benchmark_forecast' END AS forecast_status FROM s4)"
    )
    return [s1, s2, s3, s4, s5]


HIST6 = {m: f"{m}_same_6h_7d_mean" for m in METRICS}
_K6 = ["roas", "profit", "ctr", "cvr", "cpm"]
_DEFAULT_CAPS = {"tracker_revenue": 5000.0, "tracker_conversions": 100.0}


def _serving_6h() -> dict[str, str]:
    out = {}
    served = [
        *[r(f"val_{m}", f"recommended_6h_{m}") for m in METRICS],
        *[f"src_{m} AS recommended_6h_{m}_source" for m in METRICS],
        "benchmark_source",
        "forecast_status",
        *[r(kpi_of("val_{m}", k, True), f"recommended_6h_{k}") for k in _K6],
    ]
    small = {"tracker_revenue": 60.0, "tracker_conversions": 0.2}
    out["guards_6h"] = with_(
        [*EVERY, peer_table("pa", "st", HIST6, "a, "), *serve_6h("pa", " * 1.5", 1.1, small, 20.0)],
        f"SELECT {big('a', 'anchor_idx')}, {AD}, {', '.join(served)}, "
        "CASE WHEN enough THEN 'HIGH' ELSE 'LOW' END AS forecast_confidence, "
        "CASE WHEN enough THEN 'model_point' ELSE 'same_window_benchmark' END AS forecast_use_case, "
        "CAST(spend_sum_24h > 0 AS VARCHAR) AS recently_active FROM s5",
    )
    latest = [
        *LATEST,
        peer_table("pa", "st", HIST6, ""),
        *serve_6h("pa", "", 5.0, _DEFAULT_CAPS, 100.0),
    ]
    at = "make_timestamp((a + {}) * 3600000000)"
    out["forecast_6h"] = with_(
        latest,
        f"SELECT {ts(at.format(0), 'anchor_ts')}, {ts(at.format(1), 'forecast_window_start')}, "
        f"{ts(at.format(6), 'forecast_window_end')}, {TZ} AS timezone, {IDS}, "
        f"observed_history_hours, observed_recent_24h, {', '.join(served)} FROM s5",
    )
    utc = f"timezone('UTC', timezone({ZONE}, {{}}))"
    a0, a1, a7 = at.format(0), at.format(1), at.format(7)
    values = {SHORT[m]: f"val_{m}" for m in METRICS}
    raw = {SHORT[m]: f"{m}_same_6h_7d_mean" for m in METRICS}

    def filled(k: str, v: dict[str, str]) -> str:
        if k == "profit":
            return kpi(k, v)
        _, bottom, _ = RATIO[k]
        return f"CASE WHEN {v[bottom]} > 0 THEN {kpi(k, v)} END"

    results = [r(sql, f"result_{n}") for n, sql in values.items()]
    results += [r(kpi(k, values, True), f"result_{k}") for k in _K6]
    results += [r(filled("cpc", values), "result_cpc")]
    results += [r(sql, f"raw_pred_{n}") for n, sql in raw.items()]
    results += [r(filled(k, raw), f"raw_pred_{k}") for k in KPIS]
    out["forecast_rows_6h"] = with_(
        latest,
        f"""SELECT '6h' AS forecast_horizon, {IDS}, {ts(utc.format(a0), 'forecast_anchor')},
 {ts(utc.format(a1), 'forecast_window_start')}, {ts(utc.format(a7), 'forecast_window_end')},
 {TZ} AS timezone, {ts(a0, 'forecast_anchor_local')}, {ts(a1, 'forecast_window_start_local')},
 {ts(a7, 'forecast_window_end_local')}, {day(a1, 'forecast_local_date')},
 CASE WHEN enough THEN 'HIGH' ELSE 'LOW' END AS forecast_confidence,
 CASE WHEN enough THEN 0.9::DOUBLE ELSE 0.3::DOUBLE END AS forecast_confidence_score, forecast_status,
 benchmark_source, 'same_window_mean' AS model_source, {', '.join(results)},
 CAST(spend_sum_24h > 0 AS VARCHAR) AS recently_active, '2024-02-01 00:00:00' AS created_at FROM s5""",
    )
    out["run_counts"] = with_(
        latest,
        f"SELECT forecast_status, count(*) AS rows, {ts(at.format(0).replace('(a + 0)', 'min(a)'), 'first_anchor')}, "
        f"{ts(at.format(0).replace('(a + 0)', 'max(a)'), 'last_anchor')} FROM s5 GROUP BY forecast_status",
    )
    return out


# -- calibration and quality -------------------------------------------------

_ELIGIBLE = "(SELECT u FROM dd GROUP BY u HAVING count(DISTINCT d) >= 8)"


def _sc() -> str:
    more = derived()
    extra = [f"{more[f'{m}_cv_7d']} AS {m}_cv_7d" for m in SPARSE]
    extra += [f"{more[f'{m}_lag1_vs_mean_7d']} AS {m}_lag1_vs_mean_7d" for m in METRICS]
    s = "spend_roll_sum_7d"
    return f"""sc0 AS (SELECT *, {', '.join(extra)},
 CASE WHEN d <= DATE '2024-01-20' THEN 'train' WHEN d <= DATE '2024-01-25' THEN 'valid'
 ELSE 'test' END AS split FROM fe WHERE days_active >= 8 AND u IN {_ELIGIBLE}),
sc AS (SELECT *, CASE WHEN days_active < 14 THEN 'new'
 WHEN {s} < 5 OR impressions_roll_sum_7d < 100 OR inline_link_clicks_roll_sum_7d < 3 THEN 'low_volume'
 WHEN tracker_revenue_cv_7d > 1.75 OR tracker_conversions_cv_7d > 1.75
 OR (tracker_revenue_lag1_vs_mean_7d > 3 AND {s} >= 10)
 OR (tracker_conversions_lag1_vs_mean_7d > 3 AND inline_link_clicks_roll_sum_7d >= 5) THEN 'spiky'
 ELSE 'stable' END AS seg FROM sc0)"""


SC = _sc()


def _bucket(v: str) -> str:
    return (
        f"CASE WHEN {v} <= 0 THEN 'zero' WHEN {v} <= 1 THEN 'tiny' WHEN {v} <= 10 THEN 'small' "
        f"WHEN {v} <= 50 THEN 'medium' ELSE 'large' END"
    )


def _lg(split: str | None) -> str:
    where = f"WHERE split = '{split}'" if split else "WHERE split != 'train'"
    parts = " UNION ALL ".join(
        f"SELECT u, d, split, seg, '{m}' AS target, {m} AS actual, {m}_roll_mean_7d AS pred, "
        f"{m}_roll_mean_7d AS mean7, {m}_roll_sum_7d AS sum7, {m}_lag_1d AS lag1, "
        f"{_bucket(f'{m}_roll_sum_7d')} AS bucket FROM sc {where}"
        for m in METRICS
    )
    return f"({parts})"


LV = f"lv AS (SELECT * FROM {_lg('valid')})"
LA = f"la AS (SELECT * FROM {_lg(None)})"


def _factor(keys: str, least: int, low: float, high: float) -> str:
    return f"""SELECT target, {keys} count(*) AS rows,
 greatest(least(sum(actual) / sum(pred), {high}), {low}) AS factor FROM lv
 GROUP BY ALL HAVING count(*) >= {least} AND sum(pred) > 0"""


FACTORS = [
    f"""fg AS (SELECT target, count(*) AS rows, CASE WHEN sum(pred) > 0
 THEN greatest(least(sum(actual) / sum(pred), 5.0), 0.2) ELSE 1.0 END AS factor FROM lv GROUP BY target)""",
    f"fb AS ({_factor('bucket,', 25, 0.2, 5.0)})",
    f"fs AS ({_factor('seg,', 25, 0.15, 6.0)})",
    f"fa AS ({_factor('u % 5 AS k,', 10, 0.35, 3.0)})",
    f"fc AS ({_factor('u % 15 AS k,', 8, 0.3, 3.5)})",
    f"fd AS ({_factor('u AS k,', 4, 0.25, 4.0)})",
]
RANGES = """rg AS (SELECT target, segment, greatest(least(quantile_cont(x, 0.1), 5.0), 0.05) AS p10,
 greatest(least(quantile_cont(x, 0.9), 8.0), 0.2) AS p90 FROM (
 SELECT target, seg AS segment, actual / pred AS x FROM lv WHERE pred > 0 UNION ALL
 SELECT target, 'all' AS segment, actual / pred AS x FROM lv WHERE pred > 0)
 GROUP BY target, segment HAVING segment = 'all' OR count(*) >= 25)"""
CAPS = """cp AS (SELECT target, k AS max_multiplier,
 greatest(coalesce(q * k, a95), a90, 1.0) AS fallback_cap FROM (SELECT target,
 CASE WHEN target IN ('tracker_revenue', 'tracker_conversions') THEN 3.0 ELSE 4.0 END AS k,
 quantile_cont(mean7, 0.95) FILTER (mean7 > 0) AS q, quantile_cont(actual, 0.95) AS a95,
 quantile_cont(actual, 0.9) AS a90 FROM lv GROUP BY target))"""
# Calibrated long table, one row per (ad, day, target).
CALIBRATED = """cl0 AS (SELECT la.*, fallback_cap AS cap, max_multiplier AS k,
 greatest(pred, 0) * greatest(least(
 sqrt(coalesce(fb.factor, fg.factor, 1.0) * coalesce(fs.factor, fg.factor, 1.0))
 * sqrt(coalesce(fd.factor, fc.factor, fa.factor, 1.0)), 8.0), 0.1) AS c0,
 coalesce(r1.p10, r0.p10, 0.5) AS q10, coalesce(r1.p90, r0.p90, 2.0) AS q90
 FROM la LEFT JOIN fg USING (target) LEFT JOIN fb ON fb.target = la.target AND fb.bucket = la.bucket
 LEFT JOIN fs ON fs.target = la.target AND fs.seg = la.seg
 LEFT JOIN fa ON fa.target = la.target AND fa.k = la.u % 5
 LEFT JOIN fc ON fc.target = la.target AND fc.k = la.u % 15
 LEFT JOIN fd ON fd.target = la.target AND fd.k = la.u
 LEFT JOIN rg r1 ON r1.target = la.target AND r1.segment = la.seg
 LEFT JOIN rg r0 ON r0.target = la.target AND r0.segment = 'all'
 LEFT JOIN cp ON cp.target = la.target),
cl1 AS (SELECT *, target IN ('tracker_revenue', 'tracker_conversions') AS sparse FROM cl0),
cl2 AS (SELECT *, CASE WHEN sparse AND sum7 <= 0 THEN least(c0, cap * 0.15) ELSE c0 END AS c1 FROM cl1),
cl3 AS (SELECT *, CASE WHEN sparse AND seg = 'spiky'
 THEN least(c1, greatest(mean7 * 4.0, lag1 * 2.5)) ELSE c1 END AS c2 FROM cl2),
cl4 AS (SELECT *, CASE WHEN sparse AND seg IN ('new', 'low_volume')
 THEN least(c2, greatest(mean7 * 2.0, cap * 0.25)) ELSE c2 END AS c3 FROM cl3),
cl AS (SELECT *, greatest(least(c3, greatest(mean7 * k, lag1 * k, cap)), 0.0) AS cal FROM cl4)"""
CALS = [*DENSE, SC, LV, LA, *FACTORS, RANGES, CAPS, CALIBRATED]


def _pivot(value: str, m: str) -> str:
    return f"max(CASE WHEN target = '{m}' THEN {value} END)"


BT = (
    "bt AS (SELECT u, d, split, seg, "
    + ", ".join(
        f"{_pivot(v, m)} AS {n}_{m}"
        for m in METRICS
        for n, v in (("act", "actual"), ("prd", "pred"), ("cal", "cal"))
    )
    + " FROM cl GROUP BY u, d, split, seg)"
)
FLAG = """CASE WHEN act_impressions < 100 THEN 'LOW_IMPRESSIONS'
 WHEN act_inline_link_clicks < 5 THEN 'LOW_CLICKS' WHEN act_spend < 1 THEN 'LOW_SPEND' ELSE 'OK' END"""


def _scores(bias: str, under: bool = True) -> str:
    cols = [
        "count(*) AS rows",
        r4("avg(abs(p - y))", "mae"),
        r4("sqrt(avg((p - y) * (p - y)))", "rmse"),
        r4(
            "CASE WHEN count(*) <= 1 THEN 0.0 WHEN var_pop(y) > 0 "
            "THEN 1 - sum((p - y) * (p - y)) / (var_pop(y) * count(*)) "
            "WHEN sum((p - y) * (p - y)) = 0 THEN 1.0 ELSE 0.0 END",
            "r2",
        ),
        r4("CASE WHEN sum(abs(y)) != 0 THEN sum(abs(p - y)) / sum(abs(y)) ELSE 0.0 END", "wmape"),
        r4(f"CASE WHEN {bias} != 0 THEN sum(p - y) / {bias} ELSE 0.0 END", "bias"),
    ]
    if under:
        cols.append(r4("avg(CASE WHEN p < y THEN 1.0 ELSE 0.0 END)", "underprediction_rate"))
    return ", ".join(cols)


def _quality_statements() -> dict[str, str]:
    key = f"{day('d', 'local_date')}, {AD}"
    base = [*DENSE, SC]
    out = {
        "prediction_segment": with_(base, f"SELECT {key}, split, seg AS prediction_segment FROM sc"),
        "calibration_factors": with_(
            [*base, LV, *FACTORS],
            f"""SELECT target, level, label, rows, {r('factor', 'factor')} FROM (
 SELECT target, 'global' AS level, 'all' AS label, rows, factor FROM fg UNION ALL
 SELECT target, 'bucket', bucket, rows, factor FROM fb UNION ALL
 SELECT target, 'segment', seg, rows, factor FROM fs)""",
        ),
        "entity_factors": with_(
            [*base, LV, *FACTORS],
            f"""SELECT target, level, account_id, campaign_id, ad_id, rows, {r('factor', 'factor')} FROM (
 SELECT target, 'account' AS level, CAST(k AS VARCHAR) AS account_id, '' AS campaign_id, '' AS ad_id,
 rows, factor FROM fa UNION ALL
 SELECT target, 'campaign', CAST(k % 5 AS VARCHAR), CAST(k AS VARCHAR), '', rows, factor FROM fc UNION ALL
 SELECT target, 'ad', '', '', CAST(k AS VARCHAR), rows, factor FROM fd)""",
        ),
        "range_ratios": with_(
            [*base, LV, RANGES], f"SELECT target, segment, {r('p10', 'p10')}, {r('p90', 'p90')} FROM rg"
        ),
        "fallback_caps": with_(
            [*base, LV, CAPS],
            f"SELECT target, {r('max_multiplier', 'max_multiplier')}, {r('fallback_cap', 'fallback_cap')} FROM cp",
        ),
        "calibrated": with_(
            CALS,
            f"SELECT {key}, "
            + ", ".join(r(_pivot("cal", m), f"pred_calibrated_24h_{m}") for m in METRICS)
            + ", "
            + ", ".join(
                r(_pivot(v, m), f"pred_{e}_24h_{m}")
                for m in METRICS
                for e, v in (
                    ("p10", "greatest(least(cal, cal * q10), 0.0)"),
                    ("p90", "greatest(cal, cal * q90)"),
                )
            )
            + " FROM cl GROUP BY u, d",
        ),
        "backtest_flags": with_(
            [*CALS, BT],
            f"SELECT {key}, split, seg AS prediction_segment, {FLAG} AS kpi_reliability_flag, "
            + ", ".join(r(f"prd_{m} - act_{m}", f"gap_24h_{m}") for m in METRICS)
            + " FROM bt",
        ),
        "headline_counts": with_(
            [*CALS, BT],
            "SELECT count(*) AS rows, count(DISTINCT u % 5) AS accounts, count(DISTINCT u) AS ads FROM bt",
        ),
    }
    longs = []
    for family, suffix in (("prd", ""), ("cal", "_calibrated")):
        for m in METRICS:
            longs.append(f"SELECT 'target_24h_{m}{suffix}' AS target, split, act_{m} AS y, {family}_{m} AS p FROM bt")
        for k in KPIS:
            longs.append(
                f"SELECT 'target_24h_{k}{suffix}' AS target, split, {kpi_of('act_{m}', k)} AS y, "
                f"{kpi_of(family + '_{m}', k)} AS p FROM bt"
            )
    out["regression_metrics"] = with_(
        [*CALS, BT],
        f"SELECT target, split, {_scores('sum(y)')} FROM ({' UNION ALL '.join(longs)}) GROUP BY target, split",
    )
    longs = " UNION ALL ".join(
        f"SELECT 'target_{m}' AS target, a % 24 AS anchor_hour, target_{m} AS y, "
        f"{m}_same_6h_7d_mean AS p FROM st"
        for m in METRICS
    )
    out["metrics_by_anchor"] = with_(
        EVERY,
        f"SELECT target, CAST(anchor_hour AS BIGINT) AS anchor_hour, {_scores('sum(abs(y))', False)} "
        f"FROM ({longs}) GROUP BY target, anchor_hour HAVING count(*) >= 2",
    )
    out["quality_monitor"] = _monitor()
    out["quality_monitor_calibrated"] = _monitor()
    out["quality_monitor_base"] = _monitor("prd", "pred")
    out["account_summary"] = _accounts()
    out["best_model"] = _best()
    return out


def _monitor(values: str = "cal", family: str = "pred_calibrated") -> str:
    pairs = {
        "spend": "spend",
        "impressions": "impressions",
        "clicks": "inline_link_clicks",
        "conversions": "tracker_conversions",
        "revenue": "tracker_revenue",
    }
    parts = []
    for name, m in pairs.items():
        parts.append((name, f"act_{m}", f"{values}_{m}", f"{family}_24h_{m}"))
    for k in ("roas", "ctr", "cvr", "cpm"):
        parts.append((k, kpi_of("act_{m}", k), kpi_of(values + "_{m}", k), f"{family}_24h_{k}"))
    groups = {
        "all": "'all'",
        "split": "split",
        "prediction_segment": "seg",
        "kpi_reliability_flag": FLAG,
    }
    long = " UNION ALL ".join(
        f"SELECT '{g}' AS group_name, {value} AS group_value, '{metric}' AS metric, {y} AS y, {p} AS p, "
        f"'{column}' AS prediction_column FROM bt"
        for g, value in groups.items()
        for metric, y, p, column in parts
    )
    ape = "abs(p - y) / greatest(abs(y), 1.0)"
    return with_(
        [*CALS, BT],
        f"""SELECT group_name, group_value, metric, count(*) AS rows, {r4('sum(y)', 'actual_sum')},
 {r4('sum(p)', 'predicted_sum')}, {r4('sum(abs(p - y)) / greatest(sum(abs(y)), 1.0)', 'wmape')},
 {r4('sum(p - y) / greatest(sum(abs(y)), 1.0)', 'bias')},
 {r4(f'quantile_cont({ape} * 100.0, 0.5)', 'median_abs_pct_error')},
 {r4(f'quantile_cont({ape} * 100.0, 0.75)', 'p75_abs_pct_error')},
 {r4('CASE WHEN var_pop(y) > 0 THEN 1 - sum((p - y) * (p - y)) / (var_pop(y) * count(*)) ELSE 0.0 END', 'r2')},
 prediction_column FROM ({long}) GROUP BY group_name, group_value, metric, prediction_column""",
    )


def _accounts() -> str:
    sums = {
        "actual_revenue": "act_tracker_revenue",
        "pred_revenue": "prd_tracker_revenue",
        "pred_calibrated_revenue": "cal_tracker_revenue",
        "actual_spend": "act_spend",
        "pred_spend": "prd_spend",
        "pred_calibrated_spend": "cal_spend",
    }
    inner = ", ".join(f"sum({v}) AS {n}" for n, v in sums.items())
    gaps = []
    for family, p in (("base", "pred"), ("calibrated", "pred_calibrated")):
        for m in ("revenue", "spend"):
            gaps.append(r4(ratio(f"abs({p}_{m} - actual_{m})", f"actual_{m}"), f"{family}_{m}_gap_pct"))
    return with_(
        [*CALS, BT],
        f"""SELECT account_id, rows, ads, {', '.join(r4(n, n) for n in sums)},
 {r4('bad', 'kpi_unstable_rate')}, {', '.join(gaps)} FROM (
 SELECT CAST(u % 5 AS VARCHAR) AS account_id, count(*) AS rows, count(DISTINCT u) AS ads, {inner},
 avg(CASE WHEN {FLAG} != 'OK' THEN 1.0 ELSE 0.0 END) AS bad FROM bt WHERE split = 'test' GROUP BY u % 5)
 ORDER BY calibrated_revenue_gap_pct DESC, account_id LIMIT 30""",
    )


def _best() -> str:
    long = " UNION ALL ".join(
        f"SELECT '{SHORT[m]}' AS metric, 'target_24h_{m}' AS target, '{model}' AS model, {m} AS y, "
        f"{m}_{column} AS p FROM sc WHERE split = 'test'"
        for m in METRICS
        for model, column in (("mean_7d", "roll_mean_7d"), ("last_day", "lag_1d"))
    )
    return with_(
        [*DENSE, SC],
        f"""SELECT * EXCLUDE rows FROM (SELECT metric, target, model, {_scores('sum(abs(y))', False)}
 FROM ({long}) GROUP BY metric, target, model)
 QUALIFY row_number() OVER (PARTITION BY target ORDER BY r2 DESC, model) = 1""",
    )


def _sample_statements() -> dict[str, str]:
    base = [*DENSE, SC]
    key = f"{day('d', 'local_date')}, {AD}"
    out = {}
    out["time_split"] = with_(
        [*base, "ds AS (SELECT list_sort(list(DISTINCT d)) AS t FROM sc)",
         "cut AS (SELECT t[greatest(CAST(floor(len(t) * 0.7) AS INT), 1)] AS a, "
         "t[greatest(CAST(floor(len(t) * 0.85) AS INT), 1)] AS b FROM ds)"],
        f"""SELECT part AS split, count(*) AS rows, {day('min(d)', 'first_day')},
 {day('max(d)', 'last_day')} FROM (SELECT d, CASE WHEN d <= a THEN 'train' WHEN d <= b THEN 'valid'
 ELSE 'test' END AS part FROM sc, cut) GROUP BY part""",
    )
    parts = "CASE WHEN d <= DATE '2024-01-20' THEN 'train' WHEN d <= DATE '2024-01-25' THEN 'valid' ELSE 'test' END"
    out["prediction_checks"] = with_(
        base,
        f"""SELECT {parts} AS split, count(*) AS rows, count(*) AS good, count(*) AS good_again
 FROM sc GROUP BY 1""",
    )
    out["model_metadata"] = with_(
        base,
        f"""SELECT CAST(84 AS BIGINT) AS features, CAST(5 AS BIGINT) AS targets, '2024-01-20' AS train_end,
 strftime(max(d) FILTER ({parts} = 'train'), '%Y-%m-%d') AS train_last,
 strftime(max(d) FILTER ({parts} = 'valid'), '%Y-%m-%d') AS valid_last,
 strftime(max(d) FILTER ({parts} = 'test'), '%Y-%m-%d') AS test_last, 'true' AS ready FROM sc""",
    )
    r7, r14 = "tracker_revenue_nonzero_count_7d", "tracker_revenue_nonzero_count_14d"
    c7, c14 = "tracker_conversions_nonzero_count_7d", "tracker_conversions_nonzero_count_14d"
    s7, s14 = "spend_positive_revenue_zero_count_7d", "spend_positive_revenue_zero_count_14d"
    k7, k14 = "clicks_positive_conversions_zero_count_7d", "clicks_positive_conversions_zero_count_14d"

    def f(condition: str, factor: float) -> str:
        return f"(CASE WHEN {condition} THEN {factor} ELSE 1.0 END)"

    consistent, strong = f"({r7} >= 2 OR {c7} >= 2)", f"({r7} >= 4 OR {c7} >= 4)"
    strong14 = f"({r14} >= 6 OR {c14} >= 6)"
    bad = (
        f"(({s7} >= 5 AND {r7} = 0) OR ({k7} >= 5 AND {c7} = 0) OR ({s14} >= 10 AND {r14} <= 1) "
        f"OR ({k14} >= 10 AND {c14} <= 1))"
    )
    recent = f("d >= DATE '2024-01-20'", 2.5)
    more = derived()
    weights = {}
    for m in METRICS:
        parts = [recent]
        if m in SPARSE:
            parts += [f(consistent, 1.6), f(strong, 1.3), f(strong14, 1.2), f(bad, 0.3), f(f"{m} > 0", 1.35)]
            cut = f"(SELECT quantile_cont({m}, 0.75) FROM sc WHERE {m} > 0)"
            if m == "tracker_revenue":
                parts += [
                    f(f"{more['is_revenue_stable_7d']} >= 1", 1.6),
                    f(f"{more['is_revenue_spiky_7d']} >= 1", 0.75),
                ]
            parts.append(f(f"{m} >= {cut}", 1.15))
        elif m == "inline_link_clicks":
            parts += [f(f"{c7} >= 1", 1.15), f(strong, 1.05)]
        else:
            parts += [f(consistent, 1.1), f(strong, 1.05)]
        product = " * ".join(f"CAST({p} AS DOUBLE)" for p in parts)
        weights[f"weight_{m}"] = clip(product, 0.2, 6.0)
    out["sample_weights"] = with_(
        base, f"SELECT {key}, {', '.join(r(sql, n) for n, sql in weights.items())} FROM sc"
    )
    out["revenue_clip"] = with_(
        base,
        f"SELECT {key}, "
        + r(
            "greatest(least(tracker_revenue, (SELECT quantile_cont(tracker_revenue, 0.995) FROM sc "
            "WHERE tracker_revenue > 0)), 0.0)",
            "training_revenue",
        )
        + " FROM sc",
    )
    return out


def statements() -> dict[str, str]:
    return (
        _extract_statements()
        | _daily_statements()
        | _hourly_statements()
        | _serving_statements()
        | _quality_statements()
        | _sample_statements()
    )

