"""Tenant settings and thresholds. Every constant of the rules is a field here,
so a job can change it without touching code. The defaults are fixed values."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Tenant:
    """Where one tenant's tables live and what its metric columns are called."""

    name: str
    table_prefix: str = ""
    hourly_revenue: str = "tracker_revenue"
    hourly_conversions: str = "tracker_conversions"
    daily_revenue: str = "tracker_revenue"
    daily_conversions: str = "tracker_conversions"
    forecast_table: str = "model_forecasts"
    feature_table: str = "model_feature_cache"

    def table(self, suffix: str) -> str:
        return f"{self.table_prefix}{suffix}"


def tracker_tenant(name: str, table_prefix: str, **overrides) -> Tenant:
    """Tenant whose conversions and revenue come from the tracker columns."""
    return Tenant(name=name, table_prefix=table_prefix, **overrides)


def platform_tenant(name: str, table_prefix: str = "", **overrides) -> Tenant:
    """Tenant whose conversions and revenue come from the ad platform itself."""
    columns = dict(
        hourly_revenue="conversions_value",
        hourly_conversions="conversions",
        daily_revenue="conversions_value",
        daily_conversions="conversions",
    )
    return Tenant(name=name, table_prefix=table_prefix, **{**columns, **overrides})


@dataclass(frozen=True)
class ExtractRules:
    hourly_lookback_days: int = 8
    daily_lookback_days: int = 21
    # Largest ads of every account; 0 takes all.
    ads_per_account: int = 0
    # (lookback days, ads per account) tried in order while an extract is empty.
    # None: the one extract above and no other.
    daily_attempts: tuple | None = None
    hourly_recent_days: int = 10
    daily_recent_days: int = 18


@dataclass(frozen=True)
class AnchorRules:
    """Gates for hourly training anchors and the enough-history cut."""

    anchor_step_hours: int = 6
    min_observed_hours: int = 24
    history_hours: int = 168
    ahead_hours: int = 6
    min_spend: float = 1.0
    min_impressions: float = 50.0
    min_clicks: float = 1.0
    enough_hours: int = 24


@dataclass(frozen=True)
class HistoryRules:
    """History segments, confidence and ranges of the daily forecast."""

    new_ad_days: int = 7
    low_spend_7d: float = 7.0
    low_impressions_7d: float = 300.0
    low_clicks_7d: float = 5.0
    mostly_zero_days: int = 5
    spike_ratio: float = 3.0
    spike_ratio_cap: float = 100.0
    spiky_signal_days: int = 2
    stable_days: int = 14
    stable_revenue_days: int = 3
    stable_conversion_days: int = 3
    stable_zero_spend_days: int = 2
    confident_days: int = 14
    min_spend_mean: float = 1.0
    min_impressions: float = 100.0
    min_clicks_mean: float = 1.0
    min_pred_clicks: float = 5.0
    point_days: int = 7
    min_peers: int = 2
    width_inactive: float = 0.0
    width_thin: float = 0.9
    width_spiky: float = 1.25
    width_medium: float = 0.55
    width_default: float = 0.3


@dataclass(frozen=True)
class GuardRules:
    """Upper limits for hourly conversions and revenue."""

    multiplier: float = 5.0
    caps: dict = field(
        default_factory=lambda: {"tracker_revenue": 5000.0, "tracker_conversions": 100.0}
    )
    max_roas: float = 100.0
    min_peers: int = 2


@dataclass(frozen=True)
class CalibrationRules:
    global_clip: tuple = (0.20, 5.00)
    bucket_clip: tuple = (0.20, 5.00)
    segment_clip: tuple = (0.15, 6.00)
    min_rows: int = 25
    # level -> (keys, least rows, low clip, high clip)
    entity_levels: dict = field(
        default_factory=lambda: {
            "account": (("account_id",), 10, 0.35, 3.00),
            "campaign": (("account_id", "campaign_id"), 8, 0.30, 3.50),
            "ad": (("ad_id",), 4, 0.25, 4.00),
        }
    )
    p10_clip: tuple = (0.05, 5.00)
    p90_clip: tuple = (0.20, 8.00)
    p10_default: float = 0.50
    p90_default: float = 2.00
    sparse_multiplier: float = 3.0
    multiplier: float = 4.0
    factor_clip: tuple = (0.10, 8.00)


@dataclass(frozen=True)
class SegmentRules:
    """Prediction segments used by calibration."""

    new_days: int = 14
    low_spend_7d: float = 5.0
    low_impressions_7d: float = 100.0
    low_clicks_7d: float = 3.0
    max_cv: float = 1.75
    spike_ratio: float = 3.0
    spike_spend_7d: float = 10.0
    spike_clicks_7d: float = 5.0


@dataclass(frozen=True)
class WeightRules:
    recency: float = 2.5
    low: float = 0.20
    high: float = 6.0
    high_target_quantile: float = 0.75
    revenue_clip_quantile: float = 0.995


FIRST_DAY = "2000-01-01"
MIN_AD_DAYS = 8
