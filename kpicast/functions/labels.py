"""Label rules as SQL text. Each is an ordered list of conditions: the first match
wins."""

from __future__ import annotations

from ..config import HistoryRules, SegmentRules
from .text import any_of, case, label_case, num, one_of, quoted


def scale_bucket(scale: str) -> str:
    return label_case(
        [
            (f"{scale} <= 0", "zero"),
            (f"{scale} <= 1", "tiny"),
            (f"{scale} <= 10", "small"),
            (f"{scale} <= 50", "medium"),
        ],
        "large",
    )


def prediction_segment(rules: SegmentRules = SegmentRules()) -> str:
    """Segment used by calibration, from the recent-scale columns."""
    spend, clicks = "spend_recent_sum_7d", "inline_link_clicks_recent_sum_7d"
    low = any_of(
        [
            f"{spend} < {num(rules.low_spend_7d)}",
            f"impressions_recent_sum_7d < {num(rules.low_impressions_7d)}",
            f"{clicks} < {num(rules.low_clicks_7d)}",
        ]
    )
    jump = f"> {num(rules.spike_ratio)}"
    spiky = any_of(
        [
            f"tracker_revenue_cv_7d > {num(rules.max_cv)}",
            f"tracker_conversions_cv_7d > {num(rules.max_cv)}",
            f"tracker_revenue_lag1_vs_mean_7d {jump} AND {spend} >= {num(rules.spike_spend_7d)}",
            f"tracker_conversions_lag1_vs_mean_7d {jump}"
            f" AND {clicks} >= {num(rules.spike_clicks_7d)}",
        ]
    )
    return label_case(
        [(f"days_active < {rules.new_days}", "new"), (low, "low_volume"), (spiky, "spiky")],
        "stable",
    )


def history_conditions(rules: HistoryRules = HistoryRules()) -> dict[str, str]:
    """The six conditions behind the history labels, from the history columns."""
    spend, revenue = "history_spend_sum_7d", "history_revenue_sum_7d"
    impressions, clicks = "history_impressions_sum_7d", "history_clicks_sum_7d"
    revenue_days = "history_revenue_nonzero_days_7d"
    conversion_days = "history_conversion_nonzero_days_7d"
    zero_spend = "history_zero_spend_days_7d"
    return {
        "inactive": f"{spend} <= 0 AND {impressions} <= 0 AND {clicks} <= 0 AND {revenue} <= 0",
        "new": f"days_active < {rules.new_ad_days}",
        "low": any_of(
            [
                f"{spend} < {num(rules.low_spend_7d)}",
                f"{impressions} < {num(rules.low_impressions_7d)}",
                f"{clicks} < {num(rules.low_clicks_7d)}",
            ]
        ),
        "zero": any_of(
            [
                f"{zero_spend} >= {rules.mostly_zero_days}",
                f"history_zero_revenue_days_7d >= {rules.mostly_zero_days} AND {revenue} > 0",
            ]
        ),
        "spiky": any_of(
            [
                f"history_revenue_spike_ratio_7d >= {num(rules.spike_ratio)}",
                f"{revenue_days} <= {rules.spiky_signal_days} AND {revenue} > 0",
                f"{conversion_days} <= {rules.spiky_signal_days}"
                " AND history_conversions_sum_7d > 0",
            ]
        ),
        "stable": f"days_active >= {rules.stable_days} AND {spend} > 0"
        f" AND {revenue_days} >= {rules.stable_revenue_days}"
        f" AND {conversion_days} >= {rules.stable_conversion_days}"
        f" AND {zero_spend} <= {rules.stable_zero_spend_days}",
    }


def history_labels(rules: HistoryRules = HistoryRules()) -> dict[str, str]:
    on = history_conditions(rules)
    thin = any_of([on["new"], on["low"]])
    uneven = any_of([on["zero"], on["spiky"]])
    return {
        "history_segment": label_case(
            [
                (on["inactive"], "inactive"),
                (on["new"], "new_ad"),
                (on["low"], "low_volume"),
                (on["zero"], "mostly_zero_history"),
                (on["spiky"], "spiky_history"),
                (on["stable"], "stable_history"),
            ],
            "mixed_history",
        ),
        "spike_risk": label_case(
            [
                (any_of([on["inactive"], thin]), "LOW_DATA"),
                (uneven, "HIGH"),
                (on["stable"], "LOW"),
            ],
            "MEDIUM",
        ),
        "forecast_data_quality": label_case(
            [
                (on["inactive"], "INACTIVE"),
                (thin, "LOW"),
                (uneven, "RISKY"),
                (on["stable"], "HIGH"),
            ],
            "MEDIUM",
        ),
    }


def confidence_24h(rules: HistoryRules = HistoryRules()) -> str:
    thin = ["inactive", "new_ad", "low_volume", "mostly_zero_history"]
    low = any_of(
        [
            one_of("history_segment", thin),
            f"days_active < {rules.confident_days}",
            f"spend_roll_mean_7d < {num(rules.min_spend_mean)}",
            f"impressions_roll_mean_7d < {num(rules.min_impressions)}",
            f"inline_link_clicks_roll_mean_7d < {num(rules.min_clicks_mean)}",
        ]
    )
    medium = any_of(
        [
            one_of("history_segment", ["spiky_history", "mixed_history"]),
            f"pred_24h_impressions < {num(rules.min_impressions)}",
            f"pred_24h_inline_link_clicks < {num(rules.min_pred_clicks)}",
        ]
    )
    return label_case([(low, "LOW"), (medium, "MEDIUM")], "HIGH")


def reliability_24h(rules: HistoryRules = HistoryRules()) -> str:
    return label_case(
        [
            ("history_segment = 'inactive'", "INACTIVE_HISTORY"),
            ("history_segment = 'mostly_zero_history'", "MOSTLY_ZERO_HISTORY"),
            ("history_segment = 'spiky_history'", "SPIKY_HISTORY"),
            (f"days_active < {rules.confident_days}", "LOW_RECENT_HISTORY"),
            (f"spend_roll_mean_7d < {num(rules.min_spend_mean)}", "LOW_RECENT_SPEND"),
            (f"pred_24h_impressions < {num(rules.min_impressions)}", "LOW_IMPRESSIONS"),
            (f"pred_24h_inline_link_clicks < {num(rules.min_pred_clicks)}", "LOW_CLICKS"),
        ],
        "OK",
    )


def use_case_24h() -> str:
    return label_case(
        [
            ("forecast_confidence = 'LOW'", "benchmark_range"),
            ("forecast_confidence = 'MEDIUM'", "point_with_caution"),
        ],
        "point_forecast",
    )


def range_width(rules: HistoryRules = HistoryRules()) -> str:
    thin = one_of("history_segment", ["new_ad", "low_volume", "mostly_zero_history"])
    return case(
        [
            ("history_segment = 'inactive'", num(rules.width_inactive)),
            (thin, num(rules.width_thin)),
            ("history_segment = 'spiky_history'", num(rules.width_spiky)),
            ("forecast_confidence = 'MEDIUM'", num(rules.width_medium)),
        ],
        num(rules.width_default),
    )


def note_24h() -> str:
    """Fixed texts shown beside a forecast."""
    return label_case(
        [
            ("history_segment = 'inactive'", "No recent activity; forecast forced to zero."),
            (
                one_of("history_segment", ["mostly_zero_history", "spiky_history"]),
                "History is zero-heavy or spiky; use p10-p90 range, not point forecast only.",
            ),
            (
                "kpi_reliability_flag != 'OK'",
                "KPI ratios are low-confidence; use raw metric range.",
            ),
            ("forecast_confidence = 'MEDIUM'", "Use point forecast with caution."),
        ],
        "Forecast is stable enough for point use.",
    )


def backtest_flag() -> str:
    return label_case(
        [
            ("actual_24h_impressions < 100", "LOW_IMPRESSIONS"),
            ("actual_24h_inline_link_clicks < 5", "LOW_CLICKS"),
            ("actual_24h_spend < 1", "LOW_SPEND"),
        ],
        "OK",
    )


def sink_status(given: str, source: str, confidence: str) -> str:
    """Status of a forecast row: what the scorer gave, else from its source."""
    source = f"trim(coalesce({source}, ''))"
    return case(
        [
            (f"coalesce({given}, '') != ''", given),
            (f"{source} = 'insufficient_history'", quoted("insufficient_history_monitoring")),
            (
                f"{source} NOT IN ('', 'model_point')",
                quoted("hierarchical_benchmark_forecast"),
            ),
            (
                f"upper(trim(coalesce({confidence}, ''))) = 'LOW'",
                quoted("low_confidence_forecast"),
            ),
        ],
        quoted("model_forecast"),
    )


def confidence_score(given: str, confidence: str) -> str:
    level = f"upper(trim(coalesce({confidence}, '')))"
    table = f"CASE {level} WHEN 'HIGH' THEN 0.9D WHEN 'MEDIUM' THEN 0.6D WHEN 'LOW' THEN 0.3D END"
    return f"coalesce(try_cast({given} AS double), {table})"
