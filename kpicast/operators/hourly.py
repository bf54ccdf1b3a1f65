"""Hourly features at 6-hour anchors.

Anchors fall on the local hours 0, 6, 12 and 18, and every window the features
use either ends at an anchor and is a multiple of six hours long, or is the last
one or three hours before it. So the hours are first summed into blocks of the
six hours that end at an anchor, with the last one and three hours kept apart.
A 168-hour sum is then 28 blocks, the same hours of an earlier day are one block,
and the next-6-hour target is the following block: all exact, and the windows run
over a sixth of the rows with frames a sixth as long.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F

from ..config import AnchorRules
from ..functions import localtime
from ..functions.ratios import kpi, ratio
from ..functions.text import add, all_of, num, pick
from ..names import ENTITY, METRICS, SHORT
from .rollup import keep_last

# Totals at an anchor and the hours since the first row cover this many hours, however
# long a history is passed in: training and scoring see the same.
HISTORY_HOURS = 168
WINDOWS = [1, 3, 6, 12, 24, 48, 72, 168]
SAME_WINDOW_DAYS = [1, 2, 3, 4, 5, 6, 7]
STATS = ["mean", "median", "std", "min", "max", "p75", "p90", "last_over_mean"]
CALENDAR_FEATURES = [
    "anchor_hour",
    "anchor_hour_0",
    "anchor_hour_6",
    "anchor_hour_12",
    "anchor_hour_18",
    "dow",
    "is_weekend",
    "hour_sin",
    "hour_cos",
    "dow_sin",
    "dow_cos",
    "observed_history_hours",
    "observed_history_ratio",
    "observed_recent_24h",
    "hours_active",
]
# KPI order in the hourly feature set.
_KPIS = ["ctr", "cpc", "cpm", "cvr", "roas", "profit"]
_STEP = 6
_BY_BLOCK = "PARTITION BY ad_id ORDER BY block"
# Facts about the whole series of an ad, repeated on each of its blocks.
_AD_COLUMNS = ["first_hour", "last_hour", *[f"ad_total_{m}" for m in METRICS[:3]]]


def hourly_feature_names() -> list[str]:
    """The 289 model features."""
    names = list(CALENDAR_FEATURES)
    for w in WINDOWS:
        for m in METRICS:
            names += [f"{m}_sum_{w}h", f"{m}_avg_{w}h"]
        names += [f"kpi_{w}h_{k}" for k in _KPIS]
    for d in SAME_WINDOW_DAYS:
        names += [f"{m}_same_target_6h_d{d}" for m in METRICS]
        names += [f"kpi_same_target_6h_d{d}_{k}" for k in _KPIS]
    names += [f"{m}_same_6h_7d_{s}" for m in METRICS for s in STATS]
    names += [f"kpi_same_6h_7d_{s}_{k}" for s in ("mean", "median", "p90") for k in _KPIS]
    names += [f"{m}_cum" for m in METRICS] + [f"kpi_cum_{k}" for k in _KPIS]
    return names


def hour_blocks(hourly: DataFrame, stored_by_ad: bool = False) -> DataFrame:
    """Dense 6-hour blocks per ad. Takes the hourly rollup, which may be a table stored by
    ad (:mod:`kpicast.sources.clustered`): it is then not shuffled at all.

    Block ``b`` covers the hours after 6(b-1) up to and including 6b, so 6b is its
    anchor. Blocks without a row are filled with 0 by opening each gap from the
    block before it; ids and timezone carry forward."""
    # Hashed by ad once, for the blocks and all windows after them.
    hours = keep_last(hourly, "hour_idx")
    if not stored_by_ad:
        hours = hours.repartition("ad_id")
    hours = add(hours, {"_ahead": f"pmod(-hour_idx, {_STEP})"})
    hours = add(hours, {"block": f"(hour_idx + _ahead) div {_STEP}"})
    sums = {f"{m}_6": f"sum({m})" for m in METRICS}
    for n in (3, 1):
        sums |= {f"{m}_{n}": f"sum(CASE WHEN _ahead < {n} THEN {m} ELSE 0D END)" for m in METRICS}
    latest = ", ".join(["hour_idx", "timezone", *ENTITY[:3]])
    blocks = hours.groupBy("ad_id", "block").agg(
        F.expr(f"max(struct({latest}))").alias("_latest"),
        F.expr("min(hour_idx)").alias("_first"),
        F.expr("count(*)").alias("hours_6"),
        *[F.expr(sql).alias(name) for name, sql in sums.items()],
    )
    series = {
        "_until": f"coalesce(lead(block) OVER ({_BY_BLOCK}) - 1, block)",
        "first_hour": "min(_first) OVER (PARTITION BY ad_id)",
        "last_hour": "max(_latest.hour_idx) OVER (PARTITION BY ad_id)",
    }
    series |= {f"ad_total_{m}": f"sum({m}_6) OVER (PARTITION BY ad_id)" for m in METRICS[:3]}
    opened = add(blocks, series)
    filled = opened.select("*", F.explode(F.sequence("block", "_until")).alias("_block"))
    return pick(
        filled,
        ["ad_id", *_AD_COLUMNS],
        {"block": "_block"}
        | {name: f"_latest.{name}" for name in ["timezone", *ENTITY[:3]]}
        | {"hours_6": "CASE WHEN _block = block THEN hours_6 ELSE 0 END"}
        | {"first_6": "CASE WHEN _block = block THEN _first END"}
        | {name: f"CASE WHEN _block = block THEN {name} ELSE 0D END" for name in sums},
    )


def _trailing(hours: int) -> str:
    return f"({_BY_BLOCK} ROWS BETWEEN {hours // _STEP - 1} PRECEDING AND CURRENT ROW)"


def block_windows(blocks: DataFrame) -> DataFrame:
    """Trailing sums, observed hours, same-window history, totals and the next
    six hours for every block, in one Window operator."""
    out = {
        "observed_history_hours": f"sum(hours_6) OVER {_trailing(168)}",
        "observed_recent_24h": f"sum(hours_6) OVER {_trailing(24)}",
        "recent_first": f"min(first_6) OVER {_trailing(HISTORY_HOURS)}",
    }
    for m in METRICS:
        for w in WINDOWS:
            short = f"{m}_{w}"
            out[f"{m}_sum_{w}h"] = short if w <= _STEP else f"sum({m}_6) OVER {_trailing(w)}"
        for d in SAME_WINDOW_DAYS:
            back = 24 * d // _STEP - 1
            out[f"{m}_same_target_6h_d{d}"] = f"lag({m}_6, {back}, 0D) OVER ({_BY_BLOCK})"
        out[f"target_{m}"] = f"lead({m}_6, 1, 0D) OVER ({_BY_BLOCK})"
    anchor = {"anchor_idx": f"block * {_STEP}"}
    windows = pick(blocks, ["timezone", *ENTITY, *_AD_COLUMNS], anchor | out)
    # The totals are the sums of the longest window, which is not run a second time.
    return add(windows, {f"{m}_cum": f"{m}_sum_{HISTORY_HOURS}h" for m in METRICS})


def latest_windows(hourly: DataFrame) -> DataFrame:
    """The windows of each ad's latest anchor alone, straight from the hours.

    Scoring needs one anchor per ad, so its windows are conditional sums of one
    aggregation: no calendar and no sliding frame. Equal to :func:`latest_anchors`
    of :func:`block_windows`, without the target."""
    hours = add(
        keep_last(hourly, "hour_idx"),
        {
            "first_hour": "min(hour_idx) OVER (PARTITION BY ad_id)",
            "last_hour": "max(hour_idx) OVER (PARTITION BY ad_id)",
        },
    )
    # Hours back from the anchor: 0 is the anchor itself.
    back = f"last_hour - pmod(last_hour, {_STEP}) - hour_idx"
    hours = add(hours, {"_back": back}).filter("_back >= 0")
    out = {
        "observed_history_hours": "count_if(_back < 168)",
        "observed_recent_24h": "count_if(_back < 24)",
        "recent_first": f"min(CASE WHEN _back < {HISTORY_HOURS} THEN hour_idx END)",
    }
    for m in METRICS:
        for w in WINDOWS:
            out[f"{m}_sum_{w}h"] = f"sum(CASE WHEN _back < {w} THEN {m} ELSE 0D END)"
        for d in SAME_WINDOW_DAYS:
            ahead = f"_back BETWEEN {24 * d - _STEP} AND {24 * d - 1}"
            out[f"{m}_same_target_6h_d{d}"] = f"sum(CASE WHEN {ahead} THEN {m} ELSE 0D END)"
        out[f"{m}_cum"] = f"sum(CASE WHEN _back < {HISTORY_HOURS} THEN {m} ELSE 0D END)"
        out[f"target_{m}"] = "CAST(NULL AS double)"
    latest = ", ".join(["hour_idx", "timezone", *ENTITY[:3]])
    grouped = hours.groupBy("ad_id", "first_hour", "last_hour").agg(
        F.expr(f"max(struct({latest}))").alias("_latest"),
        *[F.expr(sql).alias(name) for name, sql in out.items()],
    )
    return pick(
        grouped,
        ["ad_id", "first_hour", "last_hour", *out],
        {"anchor_idx": f"last_hour - pmod(last_hour, {_STEP})"}
        | {name: f"_latest.{name}" for name in ["timezone", *ENTITY[:3]]},
    )


def latest_anchors(windows: DataFrame) -> DataFrame:
    """One row per ad: the last anchor at or before its last hour. An ad seen
    only after that anchor has no history yet and yields no row."""
    return windows.filter(f"anchor_idx = last_hour - pmod(last_hour, {_STEP})")


def training_anchors(windows: DataFrame, rules: AnchorRules = AnchorRules()) -> DataFrame:
    """Anchors fit for training: a full week behind, six hours ahead, enough
    observed hours, recent and total volume, and something to predict. (An ad's
    own hour count and span pass whenever one of its anchors does.)"""
    volume = dict(zip(METRICS, [rules.min_spend, rules.min_impressions, rules.min_clicks]))
    gates = [
        f"anchor_idx - first_hour >= {rules.history_hours - 1}",
        f"anchor_idx + {rules.ahead_hours} <= last_hour",
        f"observed_history_hours >= {rules.min_observed_hours}",
        " + ".join(f"target_{m}" for m in METRICS) + " > 0",
    ]
    for m, least in volume.items():
        gates += [f"{m}_sum_24h >= {num(least)}", f"ad_total_{m} >= {num(least)}"]
    return windows.filter(all_of(gates))


def same_window_stats(anchors: DataFrame) -> DataFrame:
    """Statistics over the same six hours of the seven days before."""
    days = {m: [f"{m}_same_target_6h_d{d}" for d in SAME_WINDOW_DAYS] for m in METRICS}
    lists, stats = {}, {}
    for m in METRICS:
        lists[f"_{m}_up"] = f"sort_array(array({', '.join(days[m])}))"
        lists[f"{m}_same_6h_7d_mean"] = f"({' + '.join(days[m])}) / {len(days[m])}"
        up, mean, name = f"_{m}_up", f"{m}_same_6h_7d_mean", f"{m}_same_6h_7d"
        squares = " + ".join(f"pow({day} - {mean}, 2)" for day in days[m])
        stats[f"{name}_median"] = f"{up}[3]"
        stats[f"{name}_std"] = f"sqrt(({squares}) / {len(days[m])})"
        stats[f"{name}_min"] = f"{up}[0]"
        stats[f"{name}_max"] = f"{up}[6]"
        stats[f"{name}_p75"] = f"({up}[4] + {up}[5]) / 2"
        stats[f"{name}_p90"] = f"{up}[5] + ({up}[6] - {up}[5]) * 0.4D"
        stats[f"{name}_last_over_mean"] = ratio(days[m][0], mean)
    return add(add(anchors, lists), stats).drop(*[f"_{m}_up" for m in METRICS])


def calendar_features(anchors: DataFrame) -> DataFrame:
    hour, dow = "anchor_hour", "dow"
    first = add(
        anchors.withColumn("anchor_ts", localtime.wall_clock(F.col("anchor_idx"))),
        {
            hour: "pmod(anchor_idx, 24)",
            # Day 0 of the count was a Thursday; Monday is 0.
            dow: "pmod((anchor_idx - pmod(anchor_idx, 24)) div 24 + 3, 7)",
        },
    )
    by_hour, by_day = (f"{2.0 * math.pi / n!r}D" for n in (24.0, 7.0))
    return add(
        first,
        {
            **{f"anchor_hour_{h}": f"CAST({hour} = {h} AS int)" for h in (0, 6, 12, 18)},
            "is_weekend": f"CAST({dow} >= 5 AS int)",
            "hour_sin": f"sin({hour} * {by_hour})",
            "hour_cos": f"cos({hour} * {by_hour})",
            "dow_sin": f"sin({dow} * {by_day})",
            "dow_cos": f"cos({dow} * {by_day})",
            "observed_history_ratio": "observed_history_hours / 168D",
            "hours_active": "CAST(coalesce(anchor_idx - recent_first + 1, 0) AS double)",
        },
    )


def hourly_features(anchors: DataFrame) -> DataFrame:
    """All 289 features, with keys, calendar and targets. Takes
    :func:`block_windows` rows, filtered to the anchors wanted."""
    out = same_window_stats(calendar_features(anchors))
    groups = {f"kpi_{w}h": "{m}_sum_" + f"{w}h" for w in WINDOWS}
    groups |= {
        f"kpi_same_target_6h_d{d}": "{m}_same_target_6h_" + f"d{d}" for d in SAME_WINDOW_DAYS
    }
    groups |= {f"kpi_same_6h_7d_{s}": "{m}_same_6h_7d_" + s for s in ("mean", "median", "p90")}
    groups["kpi_cum"] = "{m}_cum"
    derived = {}
    for prefix, pattern in groups.items():
        values = {SHORT[m]: pattern.format(m=m) for m in METRICS}
        derived |= {f"{prefix}_{k}": kpi(k, values) for k in _KPIS}
    for w in WINDOWS:
        derived |= {f"{m}_avg_{w}h": f"{m}_sum_{w}h / {num(w)}" for m in METRICS}
    keys = ["anchor_idx", "anchor_ts", "timezone", *ENTITY]
    targets = [f"target_{m}" for m in METRICS]
    return add(out, derived).select(*keys, *hourly_feature_names(), *targets)
