"""Daily features on the dense calendar of :mod:`grid`.

All window expressions of one call share the partitioning and order
(ad, day), so they run in a single Window operator: one shuffle, one sort.
On a dense calendar the row before is the day before, hence ROWS frames.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame

from ..functions.ratios import clipped, kpi, ratio
from ..functions.text import add, pick
from ..names import ENTITY, KPIS, METRICS, SHORT, SPARSE
from .joins import spread_lookup

BASE_FEATURES = [
    "day_of_week",
    "dow_sin",
    "dow_cos",
    "days_active",
    "cum_spend",
    "cum_clicks",
    "cum_conversions",
    "cum_revenue",
    "zero_spend_to_date",
]
LONG_METRICS = ["spend", "tracker_conversions", "tracker_revenue"]
# Signal -> the days it counts.
SIGNALS = {
    "tracker_revenue_nonzero_count": "tracker_revenue > 0",
    "tracker_conversions_nonzero_count": "tracker_conversions > 0",
    "spend_positive_revenue_zero_count": "spend > 0 AND tracker_revenue = 0",
    "clicks_positive_conversions_zero_count": "inline_link_clicks > 0 AND tracker_conversions = 0",
}
QUALITY = [
    "revenue_density_7d",
    "revenue_density_14d",
    "revenue_per_conversion_7d",
    "revenue_per_conversion_14d",
    "revenue_7d_vs_14d",
    "spend_7d_vs_14d",
    "is_revenue_stable_7d",
    "is_revenue_stable_14d",
    "is_revenue_spiky_7d",
    "is_zero_heavy_revenue_14d",
]
# Columns the serving and calibration rules need beside the model features.
CONTEXT = [
    "spend_zero_count_7d",
    "tracker_revenue_zero_count_7d",
    *[f"{m}_cv_7d" for m in SPARSE],
    *[f"{m}_lag1_vs_mean_7d" for m in METRICS],
]
KPI_COLUMNS = [f"kpi_{name}" for name in KPIS]
# KPI order in the wide feature set.
_WIDE_KPIS = ["kpi_ctr", "kpi_cpc", "kpi_cpm", "kpi_cvr", "kpi_roas", "kpi_profit"]
_WIDE_LAGS = [1, 2, 3, 7, 14]
_WIDE_ROLLS = [3, 7, 14]
_KEYS = ["local_date", "timezone", *ENTITY]
_BY_DAY = "PARTITION BY ad_id ORDER BY local_date"


def _before(days: int) -> str:
    return f"({_BY_DAY} ROWS BETWEEN {days} PRECEDING AND 1 PRECEDING)"


def _sum(value: str, frame: str) -> str:
    return f"coalesce(sum({value}) OVER {frame}, 0D)"


def _count(condition: str, frame: str) -> str:
    return f"CAST(coalesce(sum(CAST({condition} AS int)) OVER {frame}, 0) AS double)"


def _lag(value: str, days: int) -> str:
    return f"lag({value}, {days}, 0D) OVER ({_BY_DAY})"


def _std(value: str, days: int) -> str:
    return f"coalesce(stddev_samp({value}) OVER {_before(days)}, 0D)"


def _mean(total: str, days: int, min_rows: int = 1) -> str:
    """Mean of the rows a frame of ``days`` had: all there are before this row."""
    seen = f"least(days_active - 1, {days})"
    return f"CASE WHEN {seen} >= {min_rows} THEN {total} / {seen} ELSE 0D END"


def kpi_columns(df: DataFrame) -> DataFrame:
    values = {SHORT[name]: name for name in METRICS}
    return add(df, {f"kpi_{name}": kpi(name, values) for name in KPIS})


def _calendar() -> dict[str, str]:
    angle = f"weekday(local_date) * {2.0 * math.pi / 7.0!r}D"
    return {
        "day_of_week": "weekday(local_date)",
        "dow_sin": f"sin({angle})",
        "dow_cos": f"cos({angle})",
    }


def _running(inclusive: bool) -> dict[str, str]:
    last = "CURRENT ROW" if inclusive else "1 PRECEDING"
    frame = f"({_BY_DAY} ROWS BETWEEN UNBOUNDED PRECEDING AND {last})"
    return {
        "days_active": f"row_number() OVER ({_BY_DAY})",
        "cum_spend": _sum("spend", frame),
        "cum_clicks": _sum("inline_link_clicks", frame),
        "cum_conversions": _sum("tracker_conversions", frame),
        "cum_revenue": _sum("tracker_revenue", frame),
        "zero_spend_to_date": _count("spend = 0", frame),
    }


def _lags(metric: str) -> list[int]:
    return [1, 2, 7, 14] if metric in LONG_METRICS else [1, 2, 7]


def _rolls(metric: str) -> list[int]:
    return [3, 7, 14] if metric in LONG_METRICS else [3, 7]


def daily_feature_names() -> list[str]:
    """The 84 model features of the production set."""
    names = list(BASE_FEATURES)
    for metric in METRICS:
        names += [f"{metric}_lag_{n}d" for n in (1, 2, 7)]
        for n in _rolls(metric):
            names += [f"{metric}_roll_mean_{n}d", f"{metric}_roll_sum_{n}d"]
        names.append(f"{metric}_same_weekday_last_week")
        if metric in LONG_METRICS:
            names += [f"{metric}_lag_14d", f"{metric}_same_weekday_2w"]
    names += [f"{signal}_{n}d" for n in (7, 14) for signal in SIGNALS]
    names += [f"{metric}_trend_3d_vs_7d" for metric in METRICS]
    return names + QUALITY


def daily_features(
    dense: DataFrame, inclusive_totals: bool = False, carry: tuple = ()
) -> DataFrame:
    """Production feature set, one row per ad and day of ``dense``.

    Totals exclude the day being predicted unless ``inclusive_totals``."""
    by_day = _running(inclusive_totals)
    for m in METRICS:
        by_day |= {f"{m}_lag_{n}d": _lag(m, n) for n in _lags(m)}
        by_day |= {f"{m}_before_{n}d": _sum(m, _before(n)) for n in _rolls(m)}
    for n in (7, 14):
        by_day |= {f"{name}_{n}d": _count(days, _before(n)) for name, days in SIGNALS.items()}
    for m in ("spend", "tracker_revenue"):
        by_day[f"{m}_zero_count_7d"] = _count(f"{m} = 0", _before(7))
    by_day |= {f"{m}_std_7d": _std(m, 7) for m in SPARSE}
    windowed = pick(dense, [*_KEYS, *carry, *METRICS], by_day)

    rolled = _calendar()
    for m in METRICS:
        for n in _rolls(m):
            min_rows = 2 if n == 14 else 1
            total = f"{m}_before_{n}d"
            rolled[f"{m}_roll_mean_{n}d"] = _mean(total, n, min_rows)
            rolled[f"{m}_roll_sum_{n}d"] = (
                f"CASE WHEN days_active > {min_rows} THEN {total} ELSE 0D END"
            )
        rolled[f"{m}_same_weekday_last_week"] = f"{m}_lag_7d"
        if m in LONG_METRICS:
            rolled[f"{m}_same_weekday_2w"] = f"{m}_lag_14d"
    out = add(windowed, rolled)
    shape = _quality_ratios()
    for m in METRICS:
        shape[f"{m}_trend_3d_vs_7d"] = ratio(f"{m}_roll_mean_3d", f"{m}_roll_mean_7d")
        shape[f"{m}_lag1_vs_mean_7d"] = ratio(f"{m}_lag_1d", f"{m}_roll_mean_7d")
    for m in SPARSE:
        shape[f"{m}_cv_7d"] = ratio(f"{m}_std_7d", f"{m}_roll_mean_7d")
    out = kpi_columns(add(add(out, shape), _quality_flags()))
    return out.select(*_KEYS, *carry, *METRICS, *KPI_COLUMNS, *daily_feature_names(), *CONTEXT)


def _quality_ratios() -> dict[str, str]:
    def total(metric, n):
        return f"{metric}_roll_sum_{n}d"

    revenue, conversions = "tracker_revenue", "tracker_conversions"
    out = {}
    for n in (7, 14):
        density = ratio(total(revenue, n), total("spend", n))
        value = ratio(total(revenue, n), total(conversions, n))
        out[f"revenue_density_{n}d"] = clipped(density, 0, 50)
        out[f"revenue_per_conversion_{n}d"] = clipped(value, 0, 5000)
    out["revenue_7d_vs_14d"] = clipped(ratio(total(revenue, 7), total(revenue, 14)), 0, 10)
    out["spend_7d_vs_14d"] = clipped(ratio(total("spend", 7), total("spend", 14)), 0, 10)
    return out


def _quality_flags() -> dict[str, str]:
    days = "tracker_revenue_nonzero_count"
    flags = {
        "is_revenue_stable_7d": f"{days}_7d >= 3 AND revenue_density_7d > 0",
        "is_revenue_stable_14d": f"{days}_14d >= 5 AND revenue_density_14d > 0",
        "is_revenue_spiky_7d": f"{days}_7d <= 2 AND revenue_density_7d > 0",
        "is_zero_heavy_revenue_14d": f"{days}_14d <= 2 AND spend_roll_sum_14d > 0",
    }
    return {name: f"CAST({flag} AS double)" for name, flag in flags.items()}


def with_targets(features: DataFrame) -> DataFrame:
    """The day's own values under their target names."""
    raw = {f"target_24h_{m}": m for m in METRICS}
    return add(features, raw | {f"target_24h_{k}": f"kpi_{k}" for k in KPIS})


def recent_scale(features: DataFrame) -> DataFrame:
    """Names under which calibration reads the recent level of each metric."""
    out, present = {}, set(features.columns)
    for m in METRICS:
        out[f"{m}_recent_mean_7d"] = f"coalesce({m}_roll_mean_7d, 0D)"
        out[f"{m}_recent_sum_7d"] = f"coalesce({m}_roll_sum_7d, 0D)"
        out[f"{m}_recent_lag_1d"] = f"coalesce({m}_lag_1d, 0D)"
        if f"{m}_cv_7d" not in present:
            out[f"{m}_cv_7d"] = "0D"
        if f"{m}_lag1_vs_mean_7d" not in present:
            out[f"{m}_lag1_vs_mean_7d"] = ratio(f"{m}_lag_1d", f"{m}_roll_mean_7d")
    return add(features, out)


def wide_feature_names() -> list[str]:
    """The 195 features of the wide set."""
    names = list(BASE_FEATURES)
    for column in [*METRICS, *_WIDE_KPIS]:
        names += [f"{column}_lag_{n}d" for n in _WIDE_LAGS]
        for n in _WIDE_ROLLS:
            names += [f"{column}_roll_mean_{n}d", f"{column}_roll_std_{n}d"]
            if column in METRICS:
                names += [f"{column}_roll_sum_{n}d", f"{column}_zero_count_{n}d"]
    for m in METRICS:
        names += [f"{m}_trend_3d_vs_7d", f"{m}_cv_7d", f"{m}_lag1_vs_mean_7d"]
    for level in ("account", "campaign"):
        for m in METRICS:
            names += [f"{level}_{m}_roll_mean_7d", f"{level}_{m}_roll_sum_7d"]
    return names


def wide_daily_features(dense: DataFrame, inclusive_totals: bool = False) -> DataFrame:
    """Wide feature set: KPI lags, deviations, zero counts and hierarchy means."""
    by_day = _running(inclusive_totals)
    for column in [*METRICS, *_WIDE_KPIS]:
        by_day |= {f"{column}_lag_{n}d": _lag(column, n) for n in _WIDE_LAGS}
        for n in _WIDE_ROLLS:
            by_day[f"{column}_roll_sum_{n}d"] = _sum(column, _before(n))
            by_day[f"{column}_roll_std_{n}d"] = _std(column, n)
            if column in METRICS:
                by_day[f"{column}_zero_count_{n}d"] = _count(f"{column} = 0", _before(n))
    base = [*_KEYS, *METRICS, *KPI_COLUMNS]
    out = pick(kpi_columns(dense), base, by_day)
    means = {
        f"{column}_roll_mean_{n}d": _mean(f"{column}_roll_sum_{n}d", n)
        for column in [*METRICS, *_WIDE_KPIS]
        for n in _WIDE_ROLLS
    }
    out = add(out, _calendar() | means)
    tops = {"trend_3d_vs_7d": "roll_mean_3d", "cv_7d": "roll_std_7d", "lag1_vs_mean_7d": "lag_1d"}
    out = add(
        out,
        {
            f"{m}_{name}": ratio(f"{m}_{top}", f"{m}_roll_mean_7d")
            for m in METRICS
            for name, top in tops.items()
        },
    )
    campaign = ["account_id", "campaign_id", "local_date"]
    out = spread_lookup(out, hierarchy_rolls(dense), campaign, ["ad_id"])
    return out.select(*base, *wide_feature_names())


def hierarchy_rolls(dense: DataFrame) -> DataFrame:
    """Mean and sum of the seven previous rows of each account and campaign, one
    row per (account, campaign, day).

    Ads are summed to campaign days first and accounts are summed from those, so
    only day totals reach the windows: a window holds one row per day, however
    many ads the account has."""
    sums = {m: "sum" for m in METRICS}
    back = {f"sum({m})": m for m in METRICS}
    campaigns = dense.groupBy("account_id", "campaign_id", "local_date").agg(sums)
    campaigns = campaigns.withColumnsRenamed(back)
    accounts = campaigns.groupBy("account_id", "local_date").agg(sums).withColumnsRenamed(back)
    campaigns = _level_rolls(campaigns, ["account_id", "campaign_id"], "campaign")
    accounts = _level_rolls(accounts, ["account_id"], "account")
    return spread_lookup(campaigns, accounts, ["account_id", "local_date"], ["campaign_id"])


def _level_rolls(days: DataFrame, keys: list[str], level: str) -> DataFrame:
    by_day = f"PARTITION BY {', '.join(keys)} ORDER BY local_date"
    frame = f"({by_day} ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)"
    sums = {f"{level}_{m}_roll_sum_7d": _sum(m, frame) for m in METRICS}
    sums["_seen"] = f"count(*) OVER {frame}"
    means = {
        f"{level}_{m}_roll_mean_7d": ratio(f"{level}_{m}_roll_sum_7d", "_seen") for m in METRICS
    }
    return add(pick(days, [*keys, "local_date"], sums), means).drop("_seen")
