"""Runnable jobs: read a tenant's tables, compute, write.

``read`` is any function from a table name to a DataFrame, so the same job runs on
parquet, JDBC or catalog tables. One run covers all accounts of a tenant.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from .. import session
from ..config import AnchorRules, ExtractRules, Tenant
from ..names import HOURLY_METRICS, METRICS
from ..operators import metrics, models, rollup
from ..sources import extract, readers, sinks
from . import score, train

Reader = Callable[[str], DataFrame]
_EXTRACTS = "run string, tenant string, lookback_days long, ads_per_account long"


def hierarchy(read: Reader, tenant: Tenant) -> extract.Hierarchy:
    return extract.Hierarchy(
        *[
            readers.tenant_table(read, tenant, f"traffic_source_{level}")
            for level in ("accounts", "campaigns", "adsets", "ads")
        ]
    )


def run_label(spark: SparkSession, anchor: Column, *scope) -> str:
    """Name of a run: equal for a rerun with the same anchor, tenant and scope."""
    moment = spark.range(1).select(F.date_format(anchor, "yyyyMMddHHmm")).first()[0]
    return sinks.run_name(moment, *scope)


def run_6h(
    read: Reader,
    tenant: Tenant,
    anchor: Column,
    forecast_path: str,
    predict: score.Predictor = score.same_window_mean,
    rules: ExtractRules = ExtractRules(),
    anchors: AnchorRules = AnchorRules(),
    account_ids: list[str] | None = None,
    cache_root: str | None = None,
    reuse_features: bool = False,
) -> DataFrame:
    """Next-6-hour forecast of a tenant, written to the forecast table. A rerun with the
    same anchor and scope replaces its rows. What was wrong with the extracted rows is
    counted as they are written and reported beside the table (``runs``)."""
    counts = Observation("extract")
    counted = []

    def features() -> DataFrame:
        # A week before the oldest anchor that is scored, so that its windows are whole.
        reports = readers.tenant_metrics(
            readers.tenant_table(read, tenant, "traffic_source_reports"), tenant, "6h"
        )
        rows = extract.extract_hourly(
            reports,
            hierarchy(read, tenant),
            anchor,
            rules.hourly_lookback_days + score.HISTORY_DAYS,
            ads_per_account=rules.ads_per_account,
            account_ids=account_ids,
        )
        rows = rollup.watched(rows, counts, HOURLY_METRICS)
        rows = readers.require_non_empty(rows, "hourly", tenant=tenant.name)
        counted.append(counts.get)
        return score.features_6h(
            rows, recent_days=None, active_hours=24 * rules.hourly_lookback_days
        )

    if cache_root is None:
        frame = features()
    else:
        # The anchor names the cache entry, so it has to be a value.
        spark = SparkSession.active()
        label = spark.range(1).select(F.date_format(anchor, "yyyyMMddHH")).first()[0]
        # Everything that changes the rows is part of the name.
        scope = (tenant.name, tenant.table_prefix, rules, sorted(account_ids or []))
        root = f"{cache_root}/{tenant.feature_table}"
        path = sinks.feature_cache_path(root, "6h", label, sinks.run_name(*scope))
        frame = sinks.cached_features(spark, features, path, reuse_features)
    scored = score.score_6h(frame, predict, anchors=anchors, hourly_source=tenant.name)
    rows = session.written(sinks.forecast_rows(scored, "6h", ranges=False), "forecast-6h")
    run = run_label(rows.sparkSession, anchor, tenant, "6h", rules, account_ids)
    sinks.write_forecasts(rows, f"{forecast_path}/{tenant.forecast_table}", run)
    for found in counted:
        report = rows.sparkSession.createDataFrame([(run, tenant.name, *found.values())], run_schema(found))
        sinks.write_report(report, f"{forecast_path}/runs", mode="append")
    return rows


def run_schema(counts: dict) -> str:
    return ", ".join(["run string", "tenant string", *(f"{name} long" for name in counts)])


def run_24h(
    read: Reader,
    tenant: Tenant,
    anchor: Column,
    forecast_path: str,
    predict: score.Predictor = score.recent_mean,
    rules: ExtractRules = ExtractRules(),
    account_ids: list[str] | None = None,
) -> DataFrame:
    """Next-day forecast of a tenant, written to the forecast table; counters come from
    all facts of the tenant, other features from the extract. What the extract was made
    with is reported beside the table."""
    facts = readers.tenant_metrics(
        readers.tenant_table(read, tenant, "daily_breakdown_kpis"), tenant, "24h"
    )
    dims = hierarchy(read, tenant)

    def one(days: int, limit: int) -> DataFrame:
        return extract.extract_daily(
            facts, dims, anchor, days, ads_per_account=limit, account_ids=account_ids
        )

    rows, used = readers.extract_with_fallback(
        one, rules.daily_lookback_days, rules.ads_per_account, rules.daily_attempts
    )
    past = facts.filter(F.col("date").cast("timestamp") <= anchor.cast("timestamp"))
    past = extract.filter_ids(past.filter(F.lower("entity_type") == "ad"), "account_id", account_ids)
    history = rollup.daily_rollup(rollup.clean_daily(past))
    scored = score.forecast_24h(rows, predict, history=history, daily_source=tenant.name)
    out = session.written(sinks.forecast_rows(scored, "24h"), "forecast-24h")
    run = run_label(out.sparkSession, anchor, tenant, "24h", rules, account_ids)
    sinks.write_forecasts(out, f"{forecast_path}/{tenant.forecast_table}", run)
    made = out.sparkSession.createDataFrame([(run, tenant.name, *used.values())], _EXTRACTS)
    sinks.write_report(made, f"{forecast_path}/extracts", mode="append")
    return out


def run_training_24h(
    sources: list[DataFrame],
    model_path: str,
    report_path: str,
    top_ads: int | None = None,
    **options,
) -> DataFrame:
    """Trains the daily models; writes the backtest table, its calibration and
    its metrics. Returns the backtest table."""
    spark = sources[0].sparkSession
    features = session.written(train.daily_samples(sources, top_ads), "samples")
    scored = train.train_24h(features, model_path, sampled=top_ads is not None, **options)
    scored = session.written(train.scored_columns(scored), "scored")
    table, spec = train.backtest(scored)
    sinks.write_report(table, f"{report_path}/backtest")
    for name in ("factors", "ranges", "caps"):
        sinks.write_report(getattr(spec, name), f"{report_path}/calibration/{name}")
    backtest = spark.read.parquet(f"{report_path}/backtest")
    sinks.write_report(metrics.backtest_metrics(backtest), f"{report_path}/metrics")
    return backtest


def run_training_6h(
    reports: DataFrame,
    model_path: str,
    sparse_model_path: str,
    report_path: str,
    rules: AnchorRules = AnchorRules(),
    search_iterations: int | None = None,
    train_end=None,
    valid_end=None,
    sampled: bool = False,
    **options,
) -> DataFrame:
    """Trains the hourly models and searches the objective of the sparse targets.
    Writes the metrics of both, also by anchor hour, and the best model per
    target, which is returned."""
    features = session.written(train.hourly_samples(reports, rules), "samples")
    scored = train.train_6h(features, model_path, train_end, valid_end, sampled=sampled, **options)
    pairs = {f"target_{m}": (f"target_{m}", f"pred_6h_{m}") for m in METRICS}
    held_out = scored.filter(F.col("split") != "train")
    long = session.written(
        metrics.target_rows(held_out, ["split", "anchor_hour"], pairs), "predictions"
    )
    by_split = metrics.regression_metrics(long, ["target", "split"], "actual", "predicted")
    sinks.write_report(by_split, f"{report_path}/metrics")
    by_anchor = metrics.metrics_by_anchor(
        long.filter(F.col("split") == "test"), ["target", "split"], "actual", "predicted"
    )
    sinks.write_report(by_anchor, f"{report_path}/anchor_metrics")
    table, selected = train.search_6h(
        features, sparse_model_path, search_iterations, train_end, valid_end, sampled=sampled
    )
    sinks.write_report(table, f"{report_path}/search_metrics")
    labels = {f"target_{m}": m for m in METRICS}
    best = metrics.selection_report({"anchor": by_split, "search": selected}, labels)
    sinks.write_report(best, f"{report_path}/selection")
    return best


def routing_6h(model_path: str, sparse_model_path: str) -> models.Routing:
    """Sparse targets from the objective search, the others from the main models."""
    sparse = {"tracker_conversions", "tracker_revenue"}
    return models.Routing({m: sparse_model_path if m in sparse else model_path for m in METRICS})


def run_monitor(
    spark: SparkSession, backtest_path: str, report_path: str, mode: str = "serving"
) -> DataFrame:
    """Quality of a stored backtest table per metric and segment."""
    table = spark.read.parquet(backtest_path)
    report = metrics.quality_monitor(table, mode)
    sinks.write_report(report, report_path)
    return spark.read.parquet(report_path)
