"""Forecast quality: regression metrics, the segment monitor and summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.clean import first_column
from ..functions.ratios import ratio
from ..functions.text import add, pick
from ..names import KPIS, METRICS
from .quantiles import merged, select_quantiles, sketch_of, thresholds

MONITOR_GROUPS = [
    "split",
    "prediction_segment",
    "history_segment",
    "forecast_confidence",
    "spike_risk",
    "forecast_data_quality",
    "kpi_reliability_flag",
]
# Monitored metric -> (actual column, suffix of the prediction columns).
MONITOR_METRICS = {
    "spend": ("actual_24h_spend", "spend"),
    "impressions": ("actual_24h_impressions", "impressions"),
    "clicks": ("actual_24h_inline_link_clicks", "inline_link_clicks"),
    "conversions": ("actual_24h_tracker_conversions", "tracker_conversions"),
    "revenue": ("actual_24h_tracker_revenue", "tracker_revenue"),
    "roas": ("kpi_roas", "roas"),
    "ctr": ("kpi_ctr", "ctr"),
    "cvr": ("kpi_cvr", "cvr"),
    "cpm": ("kpi_cpm", "cpm"),
}
# Which prediction family is taken first.
_FAMILIES = {
    "serving": ["recommended", "pred_calibrated", "pred"],
    "calibrated": ["pred_calibrated", "recommended", "pred"],
    "base": ["pred", "pred_calibrated", "recommended"],
}


def prediction_column(columns: list[str], suffix: str, mode: str = "serving") -> str | None:
    return first_column(columns, [f"{family}_24h_{suffix}" for family in _FAMILIES[mode]])


def r2(n: Column, squared_error: Column, variance: Column, constant: Column | float) -> Column:
    """1 - SSE / SST; ``constant`` where the actuals do not vary."""
    total = variance * n
    constant = F.lit(constant) if isinstance(constant, float) else constant
    return F.when(total > 0, 1.0 - squared_error / total).otherwise(constant)


def regression_metrics(
    rows: DataFrame, keys: list[str], actual: str, predicted: str, bias_by: str = "absolute"
) -> DataFrame:
    """One aggregation per key. ``bias_by`` picks the bias denominator: the
    absolute actuals, or their plain ``sum``. R2 of a single row is 0."""
    y, p = F.col(actual), F.col(predicted)
    error = p - y
    sums = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(y).alias("_y"),
        F.sum(F.abs(y)).alias("_abs_y"),
        F.var_pop(y).alias("_var"),
        F.sum(error).alias("_e"),
        F.sum(F.abs(error)).alias("_abs_e"),
        F.sum(error * error).alias("_sse"),
        F.avg((p < y).cast("double")).alias("underprediction_rate"),
    )
    c = F.col
    perfect = F.when(c("_sse") == 0, 1.0).otherwise(0.0)
    score = r2(c("rows"), c("_sse"), c("_var"), perfect)
    return sums.select(
        *keys,
        "rows",
        (c("_abs_e") / c("rows")).alias("mae"),
        F.sqrt(c("_sse") / c("rows")).alias("rmse"),
        F.when(c("rows") > 1, score).otherwise(0.0).alias("r2"),
        F.expr(ratio("_abs_e", "_abs_y")).alias("wmape"),
        F.expr(ratio("_e", "_y" if bias_by == "sum" else "_abs_y")).alias("bias"),
        "underprediction_rate",
    )


def target_rows(backtest: DataFrame, keys: list[str], pairs: dict[str, tuple]) -> DataFrame:
    """Long form: one row per target of ``pairs`` (target -> actual, predicted)."""
    entries = [
        f"struct('{target}' AS target, CAST({actual} AS double) AS actual, "
        f"CAST({predicted} AS double) AS predicted)"
        for target, (actual, predicted) in pairs.items()
    ]
    return backtest.selectExpr(*keys, f"inline(array({', '.join(entries)}))")


def backtest_metrics(backtest: DataFrame) -> DataFrame:
    """Metrics per target and split, for the raw and the calibrated predictions."""
    pairs = {f"target_24h_{m}": (f"actual_24h_{m}", f"pred_24h_{m}") for m in METRICS}
    pairs |= {f"target_24h_{k}": (f"kpi_{k}", f"pred_24h_{k}") for k in KPIS}
    pairs |= {
        f"{target}_calibrated": (actual, predicted.replace("pred_24h_", "pred_calibrated_24h_"))
        for target, (actual, predicted) in list(pairs.items())
    }
    long = target_rows(backtest, ["split"], pairs)
    return regression_metrics(long, ["target", "split"], "actual", "predicted", bias_by="sum")


def metrics_by_anchor(rows: DataFrame, keys: list[str], actual: str, predicted: str) -> DataFrame:
    """Metrics per anchor hour; groups of a single row are left out."""
    return regression_metrics(rows, [*keys, "anchor_hour"], actual, predicted).filter(
        F.col("rows") >= 2
    )


def quality_monitor(backtest: DataFrame, mode: str = "serving") -> DataFrame:
    """Quality per metric over all rows and over each value of every segment
    column the table has.

    All sums and error sketches are first taken per combination of the segment labels,
    which are few, so only those totals are expanded into the segment groups. The error
    quantiles are exact: the thresholds that the merged sketches give, a table as long
    as the report, reach the rows as one value, and every row is compared with those of
    its groups without being shuffled or repeated."""
    groups = [name for name in MONITOR_GROUPS if name in backtest.columns]
    pairs = {}
    for metric, (actual, suffix) in MONITOR_METRICS.items():
        predicted = prediction_column(backtest.columns, suffix, mode)
        if actual in backtest.columns and predicted is not None:
            pairs[metric] = (actual, predicted)
    labels = {name: f"coalesce(CAST({name} AS string), 'UNKNOWN')" for name in groups}
    values = [
        f"struct('{metric}' AS metric, coalesce(CAST({actual} AS double), 0D) AS y, "
        f"coalesce(CAST({predicted} AS double), 0D) AS p)"
        for metric, (actual, predicted) in pairs.items()
    ]
    labelled = pick(backtest, [], labels | {"_m": f"array({', '.join(values)})"})
    long = labelled.selectExpr(*groups, "inline(_m)")
    y, error = F.col("y"), F.col("p") - F.col("y")
    combined = long.groupBy("metric", *groups).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("y").alias("y"),
        F.sum("p").alias("p"),
        F.sum(F.abs(y)).alias("abs_y"),
        F.sum(F.abs(error)).alias("abs_e"),
        F.sum(error).alias("e"),
        F.sum(error * error).alias("sse"),
        F.var_pop(y).alias("var"),
    )
    by_group = _per_group(combined, groups)
    keys = ["group_name", "group_value", "metric"]
    c = F.col
    weighted = by_group.groupBy(*keys).agg(
        F.sum("n").alias("rows"),
        F.sum("y").alias("actual_sum"),
        F.sum("p").alias("predicted_sum"),
        F.sum("abs_y").alias("_abs_y"),
        F.sum("abs_e").alias("_abs_e"),
        F.sum("e").alias("_e"),
        F.sum("sse").alias("_sse"),
        # Spread inside the combinations plus spread of their means.
        F.sum(c("var") * c("n")).alias("_inside"),
        F.sum(c("y") * c("y") / c("n")).alias("_squares"),
    )
    denominator = F.greatest(c("_abs_y"), F.lit(1.0))
    mean_part = c("_squares") - c("actual_sum") * c("actual_sum") / c("rows")
    spread = c("_inside") + F.greatest(mean_part, F.lit(0.0))
    # Rounding must not turn constant actuals into varying ones.
    spread = F.when(spread > c("_squares") * 1e-13, spread).otherwise(0.0)
    summary = weighted.select(
        *keys,
        "rows",
        "actual_sum",
        "predicted_sum",
        (c("_abs_e") / denominator).alias("wmape"),
        (c("_e") / denominator).alias("bias"),
        F.when(spread > 0, 1.0 - c("_sse") / spread).otherwise(0.0).alias("r2"),
    )
    percent = F.abs(error) / F.greatest(F.abs(y), F.lit(1.0)) * 100.0
    quantiles = _error_quantiles(long.select("metric", *groups, percent.alias("_v")), groups, list(pairs))
    source = F.create_map(
        *[F.lit(x) for metric, (_, predicted) in pairs.items() for x in (metric, predicted)]
    )
    return summary.join(quantiles, keys).select(
        *keys,
        "rows",
        "actual_sum",
        "predicted_sum",
        "wmape",
        "bias",
        "median_abs_pct_error",
        "p75_abs_pct_error",
        "r2",
        source[c("metric")].alias("prediction_column"),
    )


_ERROR_PROBS = {"median_abs_pct_error": 0.5, "p75_abs_pct_error": 0.75}


def _error_quantiles(errors: DataFrame, groups: list[str], names: list[str]) -> DataFrame:
    """Quantiles of ``_v`` per group_name, group_value and metric."""
    # One sketch per label combination and metric, side by side, then one per group.
    wide = errors.groupBy(*groups).agg(
        *(sketch_of(F.when(F.col("metric") == m, F.col("_v"))).alias(f"_{m}") for m in names)
    )
    each = wide.selectExpr(
        *groups, f"inline(array({', '.join(f'struct({chr(39)}{m}{chr(39)} AS metric, _{m} AS _s)' for m in names)}))"
    )
    by_group = _per_group(each, groups).groupBy("group_name", "group_value", "metric")
    limits = by_group.agg(thresholds(merged(F.col("_s")), _ERROR_PROBS).alias("_limits"))
    place = F.concat_ws("/", "metric", "group_name")
    of_place = limits.groupBy(place.alias("_place")).agg(
        F.map_from_entries(F.collect_list(F.struct("group_value", "_limits"))).alias("_values")
    )
    known = of_place.agg(F.map_from_entries(F.collect_list(F.struct("_place", "_values"))).alias("_known"))
    marked, sides = errors.withColumn("_known", known.scalar()), []
    for k, name in enumerate(["all", *groups]):
        value = F.lit("all") if name == "all" else F.col(name)
        key = F.struct(
            F.lit(name).alias("group_name"), value.alias("group_value"), F.col("metric").alias("metric")
        )
        values = F.element_at("_known", F.concat(F.col("metric"), F.lit(f"/{name}")))
        marked = marked.withColumn(f"_limits{k}", F.element_at(values, value))
        sides.append((key, F.col(f"_limits{k}")))
    found = select_quantiles(marked, ["metric", *groups], sides, _ERROR_PROBS, few_keys=True)
    return found.select("_key.*", *_ERROR_PROBS)


def _per_group(rows: DataFrame, groups: list[str]) -> DataFrame:
    pairs = ["struct('all' AS group_name, 'all' AS group_value)"]
    pairs += [f"struct('{g}' AS group_name, {g} AS group_value)" for g in groups]
    return rows.selectExpr("*", f"inline(array({', '.join(pairs)}))").drop(*groups)


def account_summary(backtest: DataFrame, worst: int = 30) -> DataFrame:
    """Accounts with the largest calibrated revenue gap on the test split."""
    sums = {
        "actual_revenue": "actual_24h_tracker_revenue",
        "pred_revenue": "pred_24h_tracker_revenue",
        "pred_calibrated_revenue": "pred_calibrated_24h_tracker_revenue",
        "actual_spend": "actual_24h_spend",
        "pred_spend": "pred_24h_spend",
        "pred_calibrated_spend": "pred_calibrated_24h_spend",
    }
    totals = (
        backtest.filter(F.col("split") == "test")
        .groupBy("account_id")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.countDistinct("ad_id").alias("ads"),
            *[F.sum(column).alias(name) for name, column in sums.items()],
            F.avg((F.col("kpi_reliability_flag") != "OK").cast("double")).alias(
                "kpi_unstable_rate"
            ),
        )
    )
    gaps = {}
    for family, prefix in (("base", "pred"), ("calibrated", "pred_calibrated")):
        for metric in ("revenue", "spend"):
            gap = f"abs({prefix}_{metric} - actual_{metric})"
            gaps[f"{family}_{metric}_gap_pct"] = ratio(gap, f"actual_{metric}")
    return (
        add(totals, gaps)
        .orderBy(F.col("calibrated_revenue_gap_pct").desc(), "account_id")
        .limit(worst)
    )


def headline_counts(backtest: DataFrame) -> DataFrame:
    return backtest.agg(
        F.count(F.lit(1)).alias("rows"),
        F.countDistinct("account_id").alias("accounts"),
        F.countDistinct("ad_id").alias("ads"),
    )


def run_counts(forecasts: DataFrame, label: str, anchor: str) -> DataFrame:
    """Rows and anchor span of a scoring run per value of a label column."""
    return forecasts.groupBy(label).agg(
        F.count(F.lit(1)).alias("rows"),
        F.min(anchor).alias("first_anchor"),
        F.max(anchor).alias("last_anchor"),
    )


def best_models(metrics: DataFrame, keys: list[str], score: str = "r2", label: str = "model") -> DataFrame:
    """The row with the highest score per key; the label's name breaks ties.
    A metric table has a few rows per model, so its groups are small."""
    order = Window.partitionBy(*keys).orderBy(F.col(score).desc(), F.col(label))
    return metrics.withColumn("_n", F.row_number().over(order)).filter("_n = 1").drop("_n")


def selection_report(
    test_metrics: dict[str, DataFrame], labels: dict[str, str]
) -> DataFrame:
    """Best model per target over the test metrics of several models."""
    columns = ["target", "model", "mae", "rmse", "r2", "wmape", "bias"]
    tables = []
    for model, table in test_metrics.items():
        if "split" in table.columns:
            table = table.filter(F.col("split").isin("test", "selected_test"))
        table = table.withColumn("model", F.lit(model))
        for name in columns:
            if name not in table.columns:
                table = table.withColumn(name, F.lit(None).cast("double"))
        tables.append(table.select(*columns))
    every = tables[0]
    for table in tables[1:]:
        every = every.unionByName(table)
    names = F.create_map(*[F.lit(x) for pair in labels.items() for x in pair])
    best = best_models(every.filter(F.col("target").isin(*labels)), ["target"])
    return best.select(names[F.col("target")].alias("metric"), *columns)
