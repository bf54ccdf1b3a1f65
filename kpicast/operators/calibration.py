"""Calibration of daily predictions from a validation table.

A specification is three tidy tables: ``factors`` (target, level, keys, factor),
``ranges`` (target, segment, p10, p90) and ``caps`` (target, multiplier, cap).
Global, bucket and segment factors, ranges and caps have a fixed number of rows
(targets x labels) and travel as one row; entity factors grow with the data and
are joined.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..config import CalibrationRules
from ..functions.labels import scale_bucket
from ..functions.ratios import clip
from ..functions.text import add, num, pick
from ..names import METRICS, SPARSE
from .joins import spread_lookup
from .quantiles import exact_quantiles

BUCKETS = ["zero", "tiny", "small", "medium", "large"]
SEGMENTS = ["stable", "spiky", "new", "low_volume"]
_ALL = "all"


@dataclass(frozen=True)
class Calibration:
    factors: DataFrame
    ranges: DataFrame
    caps: DataFrame


def calibration_rows(valid: DataFrame, targets: list[str] = METRICS) -> DataFrame:
    """One row per validation row and target. Needs ``prediction_segment``, the
    recent-scale columns, ``target_24h_*`` and ``pred_24h_*``."""
    entries = [
        f"struct('{t}' AS target, coalesce(target_24h_{t}, 0D) AS actual, "
        f"greatest(pred_24h_{t}, 0D) AS pred, {scale_bucket(f'{t}_recent_sum_7d')} AS bucket, "
        f"{t}_recent_mean_7d AS recent_mean)"
        for t in targets
    ]
    ids = ["account_id", "campaign_id", "ad_id"]
    return valid.selectExpr(
        *ids, "prediction_segment AS segment", f"inline(array({', '.join(entries)}))"
    )


def factor_table(rows: DataFrame, rules: CalibrationRules = CalibrationRules()) -> DataFrame:
    """Actual over predicted per target at every level that has enough rows. A
    level that is absent falls back when the factors are applied.

    Rows are summed per ad, bucket and segment first, so the six groupings expand
    those totals and not the rows."""
    ids = ["account_id", "campaign_id", "ad_id"]
    totals = rows.groupBy("target", *ids, "bucket", "segment").agg(
        F.count(F.lit(1)).alias("n"), F.sum("actual").alias("actual"), F.sum("pred").alias("pred")
    )
    levels = {
        "global": ((), 0, rules.global_clip),
        "bucket": (("bucket",), rules.min_rows, rules.bucket_clip),
        "segment": (("segment",), rules.min_rows, rules.segment_clip),
    }
    for level, (keys, least, low, high) in rules.entity_levels.items():
        levels[level] = (keys, least, (low, high))
    columns = ["bucket", "segment", *ids]
    entries = [
        F.struct(
            F.lit(level).alias("level"),
            *[(F.col(c) if c in keys else F.lit(None).cast("string")).alias(c) for c in columns],
            F.lit(float(least)).alias("least"),
            F.lit(bounds[0]).alias("low"),
            F.lit(bounds[1]).alias("high"),
        )
        for level, (keys, least, bounds) in levels.items()
    ]
    spread = totals.select(
        "target", "n", "actual", "pred", F.explode(F.array(*entries)).alias("_l")
    ).select("target", "n", "actual", "pred", "_l.*")
    grouped = spread.groupBy("target", "level", *columns, "least", "low", "high").agg(
        F.sum("n").alias("rows"), F.sum("actual").alias("actual"), F.sum("pred").alias("pred")
    )
    factor = F.when(
        F.col("pred") > 0,
        F.greatest(F.least(F.col("actual") / F.col("pred"), F.col("high")), F.col("low")),
    ).otherwise(1.0)
    enough = (F.col("rows") >= F.col("least")) & (F.col("pred") > 0)
    return grouped.filter(enough | (F.col("level") == "global")).select(
        "target", "level", *columns, "rows", factor.alias("factor")
    )


def range_table(rows: DataFrame, rules: CalibrationRules = CalibrationRules()) -> DataFrame:
    """Clipped 10 % and 90 % quantiles of actual over predicted, per target for
    all rows and for each segment with enough of them."""
    ratios = rows.filter(F.col("pred") > 0).select(
        "target",
        "ad_id",
        F.explode(F.array(F.lit(_ALL), F.col("segment"))).alias("segment"),
        (F.col("actual") / F.col("pred")).alias("ratio"),
    )
    # The keys are the targets times the segment labels: a fixed list.
    quantiles = exact_quantiles(
        ratios,
        ["target", "segment"],
        "ratio",
        {"p10": 0.10, "p90": 0.90},
        spread_by=["ad_id"],
        few_keys=True,
    )
    return quantiles.filter((F.col("segment") == _ALL) | (F.col("n") >= rules.min_rows)).select(
        "target",
        "segment",
        clip(F.col("p10"), *rules.p10_clip).alias("p10"),
        clip(F.col("p90"), *rules.p90_clip).alias("p90"),
    )


def _multiplier(target: Column, rules: CalibrationRules) -> Column:
    return F.when(target.isin(*SPARSE), rules.sparse_multiplier).otherwise(rules.multiplier)


def cap_table(rows: DataFrame, rules: CalibrationRules = CalibrationRules()) -> DataFrame:
    """Fallback cap per target: the largest of the 95 % quantile of recent
    non-zero means times the multiplier, the 90 % quantile of actuals, and 1."""
    values = rows.select(
        "target",
        "ad_id",
        F.explode(
            F.array(
                F.struct(F.lit("actual").alias("which"), F.col("actual").alias("value")),
                F.struct(
                    F.lit("recent").alias("which"),
                    F.when(F.col("recent_mean") > 0, F.col("recent_mean")).alias("value"),
                ),
            )
        ).alias("_v"),
    ).select("target", "ad_id", "_v.*")
    quantiles = exact_quantiles(
        values,
        ["target", "which"],
        "value",
        {"q90": 0.90, "q95": 0.95},
        spread_by=["ad_id"],
        few_keys=True,
    )
    c = F.col
    wide = quantiles.groupBy("target").agg(
        F.max(F.when(c("which") == "actual", c("q90"))).alias("actual_q90"),
        F.max(F.when(c("which") == "actual", c("q95"))).alias("actual_q95"),
        F.max(F.when(c("which") == "recent", c("q95"))).alias("recent_q95"),
    )
    multiplier = _multiplier(c("target"), rules)
    cap = F.greatest(
        F.coalesce(c("recent_q95") * multiplier, c("actual_q95")), c("actual_q90"), F.lit(1.0)
    )
    return wide.select("target", multiplier.alias("max_multiplier"), cap.alias("fallback_cap"))


def fit_calibration(
    valid: DataFrame, targets: list[str] = METRICS, rules: CalibrationRules = CalibrationRules()
) -> Calibration:
    rows = calibration_rows(valid, targets)
    return Calibration(factor_table(rows, rules), range_table(rows, rules), cap_table(rows, rules))


def _pick(condition: str, value: str) -> str:
    return f"max(CASE WHEN {condition} THEN {value} END)"


def _one_row(table: DataFrame, values: dict[str, str]) -> Column:
    """One struct of aggregated values, as a scalar."""
    struct = ", ".join(f"{sql} AS {name}" for name, sql in values.items())
    return table.agg(F.expr(f"struct({struct})").alias("s")).scalar()


def _one_rows(spec: Calibration, targets: list[str]) -> dict[str, Column]:
    """The tables of fixed size as one-row structs."""
    factors, ranges, caps = {}, {}, {}
    for t in targets:
        mine = f"target = '{t}'"
        factors[f"{t}_global"] = _pick(f"{mine} AND level = 'global'", "factor")
        for level, labels in (("bucket", BUCKETS), ("segment", SEGMENTS)):
            for label in labels:
                row = f"{mine} AND level = '{level}' AND {level} = '{label}'"
                factors[f"{t}_{level}_{label}"] = _pick(row, "factor")
        for segment in [_ALL, *SEGMENTS]:
            for end in ("p10", "p90"):
                ranges[f"{t}_{end}_{segment}"] = _pick(f"{mine} AND segment = '{segment}'", end)
        caps[f"{t}_cap"] = _pick(mine, "fallback_cap")
        caps[f"{t}_multiplier"] = _pick(mine, "max_multiplier")
    fixed = spec.factors.filter("level IN ('global', 'bucket', 'segment')")
    return {
        "_factors": _one_row(fixed, factors),
        "_ranges": _one_row(spec.ranges, ranges),
        "_caps": _one_row(spec.caps, caps),
    }


def entity_factors(rows: DataFrame, spec: Calibration, targets: list[str]) -> DataFrame:
    """One factor column per target for every ad of ``rows``: that of the ad, else
    of its campaign, else of its account, else 1.

    The levels are looked up once per ad and not once per row, which leaves a
    single join with the rows, on keys as fine as the ad."""
    ads = rows.select("account_id", "campaign_id", "ad_id").distinct()
    for level, keys in (
        ("account", ["account_id"]),
        ("campaign", ["account_id", "campaign_id"]),
        ("ad", ["ad_id"]),
    ):
        table = (
            spec.factors.filter(F.col("level") == level)
            .groupBy(*keys)
            .agg(*[F.expr(_pick(f"target = '{t}'", "factor")).alias(f"{t}_{level}") for t in targets])
        )
        ads = spread_lookup(ads, table, keys, ["ad_id"]) if level != "ad" else ads.join(table, keys, "left")
    best = {
        f"{t}_entity_factor": f"coalesce({t}_ad, {t}_campaign, {t}_account, 1D)" for t in targets
    }
    return pick(ads, ["account_id", "campaign_id", "ad_id"], best)


def _by_label(struct: str, prefix: str, label: str, labels: list[str]) -> str:
    arms = " ".join(f"WHEN '{name}' THEN {struct}.{prefix}_{name}" for name in labels)
    return f"CASE {label} {arms} END"


def apply_calibration(
    frame: DataFrame,
    spec: Calibration,
    targets: list[str] = METRICS,
    rules: CalibrationRules = CalibrationRules(),
) -> DataFrame:
    """Adds ``pred_calibrated_24h_*`` and the p10, p50 and p90 of each target."""
    entities = entity_factors(frame, spec, targets)
    joined = frame.join(entities, ["account_id", "campaign_id", "ad_id"], "left")
    joined = joined.withColumns(_one_rows(spec, targets))
    segment = "prediction_segment"
    buckets = {f"_{t}_bucket": scale_bucket(f"{t}_recent_sum_7d") for t in targets}
    joined = add(joined, buckets)
    low, high = (num(bound) for bound in rules.factor_clip)
    scaled, capped = {}, {}
    for t in targets:
        whole = f"coalesce(_factors.{t}_global, 1D)"
        bucket = _by_label("_factors", f"{t}_bucket", f"_{t}_bucket", BUCKETS)
        by_segment = _by_label("_factors", f"{t}_segment", segment, SEGMENTS)
        blend = f"sqrt(coalesce({bucket}, {whole}) * coalesce({by_segment}, {whole}))"
        factor = f"greatest(least({blend} * sqrt({t}_entity_factor), {high}), {low})"
        scaled[f"_{t}_scaled"] = f"greatest(pred_24h_{t}, 0D) * {factor}"
        capped[f"pred_calibrated_24h_{t}"] = _capped(t, f"_{t}_scaled", segment)
    out = add(add(joined, scaled), capped)
    ranges = {}
    for t in targets:
        p50 = f"pred_calibrated_24h_{t}"
        p10 = _range_ratio(t, "p10", segment, rules.p10_default)
        p90 = _range_ratio(t, "p90", segment, rules.p90_default)
        ranges[f"pred_p10_24h_{t}"] = f"greatest(least({p50}, {p50} * {p10}), 0D)"
        ranges[f"pred_p50_24h_{t}"] = p50
        ranges[f"pred_p90_24h_{t}"] = f"greatest({p50}, {p50} * {p90})"
    working = [name for t in targets for name in (f"{t}_entity_factor", f"_{t}_bucket", f"_{t}_scaled")]
    return add(out, ranges).drop("_factors", "_ranges", "_caps", *working)


def _capped(target: str, value: str, segment: str) -> str:
    """Upper limits in their order: silent, spiky and thin ads of sparse targets,
    then the recent level of every target."""
    cap, times = f"_caps.{target}_cap", f"_caps.{target}_multiplier"
    mean, lag = f"{target}_recent_mean_7d", f"{target}_recent_lag_1d"
    limits = [f"greatest({mean} * {times}, {lag} * {times}, {cap})"]
    if target in SPARSE:
        open_end = "double('Infinity')"
        limits += [
            f"CASE WHEN {target}_recent_sum_7d <= 0 THEN {cap} * 0.15D ELSE {open_end} END",
            f"CASE WHEN {segment} = 'spiky' THEN greatest({mean} * 4D, {lag} * 2.5D) "
            f"ELSE {open_end} END",
            f"CASE WHEN {segment} IN ('new', 'low_volume') "
            f"THEN greatest({mean} * 2D, {cap} * 0.25D) ELSE {open_end} END",
        ]
    return f"greatest(least({value}, {', '.join(limits)}), 0D)"


def _range_ratio(target: str, end: str, segment: str, default: float) -> str:
    own = _by_label("_ranges", f"{target}_{end}", segment, SEGMENTS)
    return f"coalesce({own}, _ranges.{target}_{end}_{_ALL}, {num(default)})"
