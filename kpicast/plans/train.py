"""Training jobs and the backtest table."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, functions as F

from ..config import MIN_AD_DAYS, AnchorRules, CalibrationRules, SegmentRules
from ..functions import labels
from ..functions.ratios import kpi
from ..functions.text import add
from ..names import ENTITY, KPIS, METRICS, SHORT, SPARSE
from ..operators import calibration, daily, grid, hourly, models, rollup, samples

TARGETS_24H = {m: f"target_24h_{m}" for m in METRICS}
TARGETS_6H = {m: f"target_{m}" for m in METRICS}


def daily_samples(sources: list[DataFrame], top: int | None = None) -> DataFrame:
    """Feature rows with targets from one or more daily sources, later ones first
    in rank: eligible ads only, from their eighth dense day on."""
    rows = [rollup.daily_rollup(rollup.clean_daily(source)) for source in sources]
    merged = rollup.merge_sources(rows) if len(rows) > 1 else rows[0]
    kept = rollup.restrict_to_ads(merged, rollup.eligible_ads(merged, top=top))
    features = daily.daily_features(grid.dense_days(kept))
    return daily.recent_scale(
        daily.with_targets(features.filter(F.col("days_active") >= MIN_AD_DAYS))
    )


def hourly_samples(reports: DataFrame, rules: AnchorRules = AnchorRules()) -> DataFrame:
    """Feature rows with targets at every anchor that passes the gates."""
    rows = rollup.hourly_rollup(rollup.clean_hourly(reports))
    windows = hourly.block_windows(hourly.hour_blocks(rows))
    return hourly.hourly_features(hourly.training_anchors(windows, rules))


def scored_columns(rows: DataFrame) -> DataFrame:
    """What calibration and the backtest read of predicted rows."""
    recent = ("recent_mean_7d", "recent_sum_7d", "recent_lag_1d", "cv_7d", "lag1_vs_mean_7d")
    present = set(rows.columns)
    return rows.select(
        "local_date",
        "timezone",
        *ENTITY,
        "days_active",
        *[f"kpi_{k}" for k in KPIS],
        *[f"target_24h_{m}" for m in METRICS],
        *[f"pred_24h_{m}" for m in METRICS],
        *[f"{m}_{name}" for m in METRICS for name in recent if f"{m}_{name}" in present],
        "split",
    )


def backtest(
    scored: DataFrame,
    rules: CalibrationRules = CalibrationRules(),
    segments: SegmentRules = SegmentRules(),
) -> tuple[DataFrame, calibration.Calibration]:
    """Backtest table of the validation and test rows.

    ``scored`` has the columns of :func:`scored_columns` and should be a written
    table: fitting and applying read it several times. Calibration is fitted on
    the validation part alone."""
    rows = scored.filter(F.col("split") != "train")
    rows = add(rows, {"prediction_segment": labels.prediction_segment(segments)})
    spec = calibration.fit_calibration(rows.filter(F.col("split") == "valid"), rules=rules)
    out = calibration.apply_calibration(rows, spec, rules=rules)
    return backtest_columns(out), spec


def backtest_columns(rows: DataFrame) -> DataFrame:
    actual = {f"actual_24h_{m}": f"target_24h_{m}" for m in METRICS}
    derived = {}
    for family in ("pred_24h", "pred_calibrated_24h"):
        values = {SHORT[m]: f"{family}_{m}" for m in METRICS}
        derived |= {f"{family}_{k}": kpi(k, values) for k in KPIS}
    for m in METRICS:
        derived[f"gap_24h_{m}"] = f"pred_24h_{m} - actual_24h_{m}"
        derived[f"gap_calibrated_24h_{m}"] = f"pred_calibrated_24h_{m} - actual_24h_{m}"
    derived["kpi_reliability_flag"] = labels.backtest_flag()
    out = add(add(rows, actual), derived)
    return out.select(
        "local_date",
        "timezone",
        *ENTITY,
        "days_active",
        *actual,
        *[f"kpi_{k}" for k in KPIS],
        "prediction_segment",
        *[f"pred_24h_{name}" for name in [*METRICS, *KPIS]],
        *[f"pred_calibrated_24h_{name}" for name in [*METRICS, *KPIS]],
        *[f"pred_{end}_24h_{m}" for m in METRICS for end in ("p10", "p50", "p90")],
        "split",
        *[f"gap_24h_{m}" for m in METRICS],
        *[f"gap_calibrated_24h_{m}" for m in METRICS],
        "kpi_reliability_flag",
    )


def _limited(trees: dict, iterations: int | None) -> dict:
    if iterations is None:
        return trees
    return {m: replace(params, iterations=iterations) for m, params in trees.items()}


def used_cutoffs(rows: DataFrame, time: str, train_end, valid_end) -> dict:
    """The end times asked for, and the last time of each part as split."""
    last = dict(rows.groupBy("split").agg(F.max(F.col(time).cast("string"))).collect())
    return {"train_end": train_end, "valid_end": valid_end} | {
        f"{part}_last": last.get(part) for part in ("train", "valid", "test")
    }


def train_24h(
    feature_rows: DataFrame,
    path: str,
    train_end=None,
    valid_end=None,
    recency_start=None,
    revenue_focus: bool = False,
    iterations: int | None = None,
    sampled: bool = False,
    trees: dict = models.DAILY_TREES,
) -> DataFrame:
    """Fits the five daily models and returns all rows with split and predictions.

    ``feature_rows`` (see :func:`daily_samples`) should be a written table: every
    fit reads it again."""
    # Not served while its models are of two fits.
    models.mark_ready(feature_rows.sparkSession, path, sampled=True)
    rows = samples.time_split(feature_rows, "local_date", train_end, valid_end, on_empty="error")
    train = rows.filter(F.col("split") == "train")
    models.fit_targets(
        rows,
        daily.daily_feature_names(),
        TARGETS_24H,
        _limited(trees, iterations),
        path,
        weights={
            m: samples.sample_weight(train, m, recency_start, revenue_focus) for m in METRICS
        },
        labels={m: samples.clipped_target(train, m, revenue_focus) for m in SPARSE},
        metadata={"basis": "daily_24h", **used_cutoffs(rows, "local_date", train_end, valid_end)},
    )
    models.mark_ready(feature_rows.sparkSession, path, sampled)
    return models.predict_targets(
        rows, models.Routing.single(path), TARGETS_24H, {m: f"pred_24h_{m}" for m in METRICS}
    )


def train_6h(
    feature_rows: DataFrame,
    path: str,
    train_end=None,
    valid_end=None,
    iterations: int | None = None,
    trees: dict = models.HOURLY_TREES,
    on_empty: str = "error",
    sampled: bool = False,
) -> DataFrame:
    """Fits the five hourly models on the absolute log error with early stopping
    and returns all rows with split and predictions. Given end times that leave a part
    without rows stop the job, unless ``on_empty="fallback"`` asks for the usual ones."""
    models.mark_ready(feature_rows.sparkSession, path, sampled=True)
    rows = samples.time_split(feature_rows, "anchor_ts", train_end, valid_end, True, on_empty)
    models.fit_targets(
        rows,
        hourly.hourly_feature_names(),
        TARGETS_6H,
        _limited(trees, iterations),
        path,
        loss="absolute",
        early_stop=True,
        metadata={"basis": "hourly_6h", **used_cutoffs(rows, "anchor_ts", train_end, valid_end)},
    )
    models.mark_ready(feature_rows.sparkSession, path, sampled)
    return models.predict_targets(
        rows, models.Routing.single(path), TARGETS_6H, {m: f"pred_6h_{m}" for m in METRICS}
    )


def search_6h(
    feature_rows: DataFrame,
    path: str,
    iterations: int | None = None,
    train_end=None,
    valid_end=None,
    on_empty: str = "error",
    sampled: bool = False,
    grid: dict = models.SEARCH,
) -> tuple[DataFrame, DataFrame]:
    """Objective search for conversions and revenue; ``iterations`` shortens the trees'
    fit, for tests. ``on_empty`` is that of :func:`train_6h`."""
    models.mark_ready(feature_rows.sparkSession, path, sampled=True)
    rows = samples.time_split(feature_rows, "anchor_ts", train_end, valid_end, True, on_empty)
    found = models.objective_search(
        rows,
        hourly.hourly_feature_names(),
        {m: TARGETS_6H[m] for m in SPARSE},
        path,
        {m: tuple(c.limited(iterations) for c in grid[m]) for m in SPARSE},
        metadata={"basis": "search_6h", **used_cutoffs(rows, "anchor_ts", train_end, valid_end)},
    )
    models.mark_ready(feature_rows.sparkSession, path, sampled)
    return found
