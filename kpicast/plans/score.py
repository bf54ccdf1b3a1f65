"""Scoring jobs. One run covers all accounts: the account is a key, not a run."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, functions as F

from ..config import AnchorRules, ExtractRules, GuardRules, HistoryRules
from ..functions.text import add
from ..names import ENTITY, METRICS
from ..operators import daily, grid, hourly, models, recommend, rollup, topk
from ..sources import extract

Predictor = Callable[[DataFrame], DataFrame]
HISTORY_DAYS = 7


def same_window_mean(features: DataFrame) -> DataFrame:
    """Stand-in predictor: the mean of the same hours of the last seven days."""
    return add(features, {f"pred_6h_{m}": f"{m}_same_6h_7d_mean" for m in METRICS})


def recent_mean(features: DataFrame) -> DataFrame:
    """Stand-in predictor: the mean of the last seven days."""
    return add(features, {f"pred_24h_{m}": f"{m}_roll_mean_7d" for m in METRICS})


def model_6h(routing: models.Routing) -> Predictor:
    """Predictor from stored models; a folder that is not ready is refused."""
    return _served(routing, "target_", "pred_6h_", 20.0)


def model_24h(routing: models.Routing) -> Predictor:
    """Predictor from stored models; a folder that is not ready is refused."""
    return _served(routing, "target_24h_", "pred_24h_", None)


def _served(routing: models.Routing, target: str, output: str, bound: float | None) -> Predictor:
    targets, outputs = ({m: f"{prefix}{m}" for m in METRICS} for prefix in (target, output))

    def predict(frame: DataFrame) -> DataFrame:
        routing.require_ready(frame.sparkSession)
        return models.predict_targets(frame, routing, targets, outputs, bound)

    return predict


def latest_features_6h(hourly_rows: DataFrame) -> DataFrame:
    """Features of every ad at its latest anchor. Takes the hourly rollup."""
    return hourly.hourly_features(hourly.latest_windows(hourly_rows))


def score_6h(
    features: DataFrame,
    predict: Predictor = same_window_mean,
    guards: GuardRules = GuardRules(),
    anchors: AnchorRules = AnchorRules(),
    model_source: str = "hourly_target_routed",
    hourly_source: str = "",
) -> DataFrame:
    """Forecast of the next six hours for rows of :func:`latest_features_6h`."""
    out = recommend.recommend_6h(predict(features), guards, anchors)
    out = out.withColumns(
        {
            "forecast_window_start": F.timestamp_add("HOUR", F.lit(1), F.col("anchor_ts")),
            "forecast_window_end": F.timestamp_add("HOUR", F.lit(6), F.col("anchor_ts")),
            "model_source": F.lit(model_source),
            "hourly_source": F.lit(hourly_source),
        }
    )
    served = [
        c
        for m in METRICS
        for c in (f"pred_6h_{m}", f"recommended_6h_{m}", f"recommended_6h_{m}_source")
    ]
    return out.select(
        "anchor_ts",
        "forecast_window_start",
        "forecast_window_end",
        "timezone",
        *ENTITY,
        "observed_history_hours",
        "observed_history_ratio",
        "observed_recent_24h",
        "recently_active",
        "forecast_confidence",
        "forecast_use_case",
        *served,
        "benchmark_source",
        "forecast_status",
        *[f"recommended_6h_{k}" for k in ("roas", "profit", "ctr", "cvr", "cpm")],
        "model_source",
        "hourly_source",
    )


def next_day_features(
    daily_rows: DataFrame, history_rows: int | None = 16, summary: DataFrame | None = None
) -> DataFrame:
    """Features of the day after each ad's last one. Takes the daily rollup.

    ``summary`` (see :func:`rollup.lifetime_summary`) replaces the counters that
    a short history would cut off."""
    dense = grid.scoring_days(daily_rows, history_rows)
    features = daily.daily_features(dense, carry=("history_cutoff_local_date",))
    latest = features.filter(F.col("history_cutoff_local_date").isNotNull())
    if summary is None:
        return latest
    counters = {
        "days_active": "full_days_active",
        "cum_spend": "full_cum_spend",
        "cum_clicks": "full_cum_clicks",
        "cum_conversions": "full_cum_conversions",
        "cum_revenue": "full_cum_revenue",
        "zero_spend_to_date": "full_zero_spend_to_date",
    }
    joined = latest.join(summary, "ad_id", "left")
    return joined.withColumns(
        {
            name: F.coalesce(F.col(full).cast("double"), F.col(name).cast("double"))
            for name, full in counters.items()
        }
    ).drop(*counters.values())


def score_24h(
    features: DataFrame,
    predict: Predictor = recent_mean,
    rules: HistoryRules = HistoryRules(),
    model_source: str = "daily_24h_trees",
    daily_source: str = "",
) -> DataFrame:
    """Forecast of the next day for rows of :func:`next_day_features`."""
    out = recommend.recommend_24h(recommend.prediction_kpis(predict(features)), rules)
    out = out.withColumns(
        {
            "forecast_anchor_local_date": F.col("local_date"),
            "model_source": F.lit(model_source),
            "daily_source": F.lit(daily_source),
        }
    )
    kpis = ["roas", "profit", "ctr", "cvr", "cpc", "cpm"]
    history = [c for c in out.columns if c.startswith("history_") and c != "history_cutoff_local_date"]
    return out.select(
        "forecast_anchor_local_date",
        "history_cutoff_local_date",
        "timezone",
        *ENTITY,
        "days_active",
        *[f"{m}_roll_mean_7d" for m in METRICS],
        *[f"pred_24h_{m}" for m in METRICS],
        *[f"pred_24h_{k}" for k in kpis],
        *history,
        "spike_risk",
        "forecast_data_quality",
        "forecast_confidence",
        "kpi_reliability_flag",
        "forecast_use_case",
        "benchmark_source",
        *[f"recommended_24h_{m}" for m in METRICS],
        *[f"pred_24h_{m}_{end}" for m in METRICS for end in ("p10", "p50", "p90")],
        *[f"recommended_24h_{k}" for k in kpis],
        *[f"recommended_24h_roas_{end}" for end in ("p10", "p50", "p90")],
        "forecast_note",
        "model_source",
        "daily_source",
    )


def features_6h(
    reports: DataFrame,
    account_ids: list[str] | None = None,
    max_ads: int = 0,
    recent_days: int | None = ExtractRules.hourly_recent_days,
    active_hours: int | None = None,
    newest=None,
) -> DataFrame:
    """Features at the latest anchors from raw hourly reports with timezone: rows
    of the last days, of the accounts in scope, of the largest ads (0 = all), and
    only of ads seen in the last ``active_hours``, if given. ``newest`` is the time of the
    newest report, if known (see :func:`kpicast.sources.extract.recent_rows`)."""
    rows = rollup.clean_hourly(reports)
    if recent_days is not None:
        rows = extract.recent_rows(rows, "date", recent_days, newest)
    rows = rollup.hourly_rollup(extract.filter_ids(rows, "account_id", account_ids))
    rows = topk.keep_top_ads(rows, max_ads, "hour_idx")
    if active_hours is not None:
        seen = rows.groupBy("ad_id").agg(F.max("hour_idx").alias("_last"))
        newest = seen.agg(F.max("_last"))
        active = seen.filter(F.col("_last") > newest.scalar() - active_hours).select("ad_id")
        rows = rows.join(active, "ad_id", "left_semi")
    return latest_features_6h(rows)


def forecast_6h(
    reports: DataFrame,
    predict: Predictor = same_window_mean,
    account_ids: list[str] | None = None,
    max_ads: int = 0,
    recent_days: int | None = ExtractRules.hourly_recent_days,
    **options,
) -> DataFrame:
    """Raw hourly reports with timezone to the 6h forecast of the ads seen in the last
    ``recent_days`` (None: of all). The history read reaches a week further back, so that
    the windows of the oldest anchor are whole."""
    if recent_days is None:
        features = features_6h(reports, account_ids, max_ads, None)
    else:
        newest = extract.newest_time(rollup.clean_hourly(reports), "date")
        features = features_6h(
            reports, account_ids, max_ads, recent_days + HISTORY_DAYS, 24 * recent_days, newest
        )
    return score_6h(features, predict, **options)


def forecast_24h(
    facts: DataFrame,
    predict: Predictor = recent_mean,
    account_ids: list[str] | None = None,
    max_ads: int = 0,
    recent_days: int = ExtractRules.daily_recent_days,
    history: DataFrame | None = None,
    **options,
) -> DataFrame:
    """Raw daily facts to the 24h forecast. Counters come from ``history`` (daily
    rollup; else from all of ``facts``), features from the last days of the facts."""
    rows = rollup.daily_rollup(rollup.clean_daily(facts))
    rows = extract.filter_ids(rows, "account_id", account_ids)
    rows = topk.keep_top_ads(rows, max_ads, "local_date")
    recent = extract.recent_rows(rows, "local_date", recent_days)
    features = next_day_features(recent, summary=rollup.lifetime_summary(rows if history is None else history))
    return score_24h(features, predict, **options)
