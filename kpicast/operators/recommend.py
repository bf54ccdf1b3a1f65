"""What is served: the model's value, a peer benchmark or a guarded value."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..config import AnchorRules, GuardRules, HistoryRules
from ..functions import labels
from ..functions.ratios import clipped, kpi, ratio
from ..functions.text import add, case, label_case, num, quoted
from ..names import KPIS, METRICS, SHORT, SPARSE
from .peers import INSUFFICIENT, LEVELS, fallback_source, fallback_value, peer_means

KPIS_6H = ["roas", "profit", "ctr", "cvr", "cpm"]
_PEERS = [f"{m}_{level}_peer" for m in METRICS for level in LEVELS]


def history_columns(frame: DataFrame, rules: HistoryRules = HistoryRules()) -> DataFrame:
    """Recent totals and day counts, then the history labels."""
    spike = ratio("tracker_revenue_lag_1d", "tracker_revenue_roll_mean_7d", positive=True)
    out = add(
        frame,
        {
            "history_spend_sum_7d": "spend_roll_sum_7d",
            "history_impressions_sum_7d": "impressions_roll_sum_7d",
            "history_clicks_sum_7d": "inline_link_clicks_roll_sum_7d",
            "history_conversions_sum_7d": "tracker_conversions_roll_sum_7d",
            "history_revenue_sum_7d": "tracker_revenue_roll_sum_7d",
            "history_revenue_nonzero_days_7d": "tracker_revenue_nonzero_count_7d",
            "history_conversion_nonzero_days_7d": "tracker_conversions_nonzero_count_7d",
            "history_zero_spend_days_7d": "spend_zero_count_7d",
            "history_zero_revenue_days_7d": "tracker_revenue_zero_count_7d",
            "history_revenue_spike_ratio_7d": clipped(spike, 0, rules.spike_ratio_cap),
        },
    )
    return add(out, labels.history_labels(rules))


def confidence_columns(frame: DataFrame, rules: HistoryRules = HistoryRules()) -> DataFrame:
    out = add(
        frame,
        {
            "forecast_confidence": labels.confidence_24h(rules),
            "kpi_reliability_flag": labels.reliability_24h(rules),
        },
    )
    return add(out, {"forecast_use_case": labels.use_case_24h()})


def recommend_24h(
    frame: DataFrame, rules: HistoryRules = HistoryRules(), within: list[str] | None = None
) -> DataFrame:
    """Labels, recommendation, ranges, KPIs and note for predicted rows."""
    out = confidence_columns(history_columns(frame, rules), rules)
    out = peer_means(out, {m: f"{m}_roll_mean_7d" for m in METRICS}, rules.min_peers, within)
    enough = (
        f"days_active >= {rules.point_days}"
        " AND history_segment NOT IN ('inactive', 'new_ad', 'low_volume')"
    )
    out = add(out, {"_enough": enough, "_width": labels.range_width(rules)})
    served = {
        f"recommended_24h_{m}": case(
            [
                ("history_segment = 'inactive'", "0D"),
                ("_enough", f"coalesce(pred_24h_{m}, 0D)"),
            ],
            fallback_value(m),
        )
        for m in METRICS
    }
    # The last metric with enough peers names the source.
    named = [
        (f"{fallback_source(m)} != {quoted(INSUFFICIENT)}", fallback_source(m))
        for m in reversed(METRICS)
    ]
    served["benchmark_source"] = case(
        [("_enough", quoted("model_point")), *named], quoted(INSUFFICIENT)
    )
    out = add(out, served)
    ranges = {}
    for m in METRICS:
        value = f"recommended_24h_{m}"
        ranges[f"pred_24h_{m}_p10"] = f"greatest({value} * (1D - _width), 0D)"
        ranges[f"pred_24h_{m}_p50"] = value
        ranges[f"pred_24h_{m}_p90"] = f"{value} * (1D + _width)"
    out = add(out, ranges | served_kpis("recommended_24h", KPIS))
    roas = {
        f"recommended_24h_roas_{end}": ratio(
            f"pred_24h_tracker_revenue_{end}", "recommended_24h_spend", positive=True
        )
        for end in ("p10", "p50", "p90")
    }
    return add(out, roas | {"forecast_note": labels.note_24h()}).drop("_enough", "_width", *_PEERS)


def served_kpis(prefix: str, names: list[str]) -> dict[str, str]:
    values = {SHORT[m]: f"coalesce({prefix}_{m}, 0D)" for m in METRICS}
    return {f"{prefix}_{k}": kpi(k, values, positive=True) for k in names}


def prediction_kpis(frame: DataFrame, prefix: str = "pred_24h") -> DataFrame:
    """KPIs of the raw predictions."""
    values = {SHORT[m]: f"{prefix}_{m}" for m in METRICS}
    return add(frame, {f"{prefix}_{k}": kpi(k, values) for k in KPIS})


def guarded(metric: str, prediction: str, history: str, rules: GuardRules) -> tuple[str, str]:
    """Value and source label of a sparse metric after its upper limit: five times
    the larger of the ad's own and its peers' level, but at least a fixed cap.
    ``_enough`` marks the rows the limit applies to."""
    peer = fallback_value(metric)
    peer_ok = f"({fallback_source(metric)} != {quoted(INSUFFICIENT)} AND {peer} > 0)"
    level = f"greatest({history}, CASE WHEN {peer_ok} THEN {peer} ELSE 0D END)"
    cap = f"greatest({level} * {num(rules.multiplier)}, 0D, {num(rules.caps[metric])})"
    over = f"(_enough AND {prediction} > {cap})"
    value = case([(f"{over} AND {peer_ok}", peer), (over, cap)], prediction)
    label = label_case(
        [
            (f"{over} AND {peer_ok}", "guarded_peer_benchmark"),
            (over, "guarded_history_cap"),
        ],
        "model_point",
    )
    return value, label


def most_common(labels_: list[str]) -> str:
    """Most frequent of a row's labels; the smallest one among ties. Plain
    comparisons keep it inside generated code, which lambdas would leave."""
    counted = []
    for label in labels_:
        same = " + ".join(f"CAST({label} = {other} AS int)" for other in labels_)
        counted.append(f"struct(-({same}) AS n, {label} AS label)")
    return f"array_min(array({', '.join(counted)})).label"


def recommend_6h(
    frame: DataFrame,
    rules: GuardRules = GuardRules(),
    anchors: AnchorRules = AnchorRules(),
    within: list[str] | None = None,
) -> DataFrame:
    """Guards, peer fallback, source labels, status and KPIs for rows that carry
    ``pred_6h_*`` and the same-window history means."""
    history = {m: f"{m}_same_6h_7d_mean" for m in METRICS}
    out = peer_means(frame, history, rules.min_peers, within)
    out = add(out, {"_enough": f"observed_history_hours >= {anchors.enough_hours}"})
    served = {}
    for m in METRICS:
        value, label = f"coalesce(pred_6h_{m}, 0D)", quoted("model_point")
        if m in SPARSE:
            value, label = guarded(m, value, history[m], rules)
        # Revenue waits for the ROAS limit under working names.
        name = f"_{m}" if m == "tracker_revenue" else f"recommended_6h_{m}"
        served[name] = case([("_enough", value)], fallback_value(m))
        served[f"{name}_source"] = case([("_enough", label)], fallback_source(m))
    out = add(out, served)
    limit = f"recommended_6h_spend * {num(rules.max_roas)}"
    too_high = f"recommended_6h_spend > 0 AND _tracker_revenue > {limit}"
    revenue = "recommended_6h_tracker_revenue"
    out = add(
        out,
        {
            revenue: case([(too_high, limit)], "_tracker_revenue"),
            f"{revenue}_source": case(
                [(too_high, quoted("guarded_roas_cap"))], "_tracker_revenue_source"
            ),
        },
    )
    sources = [f"recommended_6h_{m}_source" for m in METRICS]
    guards = ", ".join(f"CASE WHEN startswith({s}, 'guarded_') THEN {s} END" for s in sources)
    out = add(out, {"benchmark_source": f"coalesce({guards}, {most_common(sources)})"})
    status = label_case(
        [
            (f"benchmark_source = {quoted(INSUFFICIENT)}", "insufficient_history_monitoring"),
            ("startswith(benchmark_source, 'guarded_')", "guarded_model_forecast"),
            ("_enough", "model_forecast"),
        ],
        "hierarchical_benchmark_forecast",
    )
    out = add(
        out,
        {
            "forecast_status": status,
            "recently_active": "coalesce(spend_sum_24h, 0D) > 0",
            "forecast_confidence": "CASE WHEN _enough THEN 'HIGH' ELSE 'LOW' END",
            "forecast_use_case": label_case(
                [("_enough", "model_point")], "same_window_benchmark"
            ),
        }
        | served_kpis("recommended_6h", KPIS_6H),
    )
    return out.drop("_enough", "_tracker_revenue", "_tracker_revenue_source", *_PEERS)
