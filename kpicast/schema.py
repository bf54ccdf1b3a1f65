"""Explicit schemas of every table read or written."""

from __future__ import annotations

from pyspark.sql import types as T

from .names import ENTITY, HOURLY_METRICS, KPIS, METRICS, SHORT


def _struct(*fields) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


def _all(names, kind):
    return [(name, kind) for name in names]


_S, _D, _TS, _NTZ = T.StringType(), T.DoubleType(), T.TimestampType(), T.TimestampNTZType()

HOURLY_REPORTS = _struct(
    ("id", _S),
    ("report_id", _S),
    ("date", _TS),
    *_all(["company_id", "traffic_source_id", "traffic_source_config_id"], _S),
    *_all(ENTITY, _S),
    *_all(["impressions", "inline_link_clicks", "clicks", "spend", "inline_link_click_ctr"], _D),
    ("created_at", _TS),
    ("updated_at", _TS),
    ("site_id", _S),
    ("results", _S),
    ("tracker_revenue", _D),
    ("tracker_conversions", _D),
    ("synced_at", _TS),
)

ACCOUNTS = _struct(
    *_all(
        ["id", "company_id", "traffic_source_id", "traffic_source_config_id", "status", "timezone"],
        _S,
    )
)
CAMPAIGNS = _struct(("id", _S), ("status", _S))
ADSETS = _struct(("id", _S), ("status", _S))
ADS = _struct(*_all(["id", "adset_id", "campaign_id", "account_id", "status"], _S))
SCHEDULE = _struct(
    ("ad_id", _S), ("scheduled_active_from", _TS), ("scheduled_active_until", _TS)
)

DAILY_KPIS = _struct(
    ("entity_type", _S),
    ("date", T.DateType()),
    ("timezone", _S),
    *_all(ENTITY, _S),
    *_all(METRICS, _D),
    ("conversions", _D),
    ("conversions_value", _D),
)

POINTS = _struct(
    ("measurement", _S),
    ("tags", T.MapType(_S, _S)),
    ("fields", T.MapType(_S, _D)),
    ("ts", _TS),
)

HOURLY_ROLLED = _struct(
    ("hour_idx", T.LongType()),
    ("local_ts", _NTZ),
    ("timezone", _S),
    *_all(ENTITY, _S),
    *_all(HOURLY_METRICS, _D),
)

DAILY_ROLLED = _struct(
    ("local_date", T.DateType()), ("timezone", _S), *_all(ENTITY, _S), *_all(METRICS, _D)
)

_RESULTS = [*SHORT.values(), *KPIS]

# The forecast table: 41 written columns and the write time.
FORECAST = _struct(
    ("forecast_horizon", _S),
    *_all(ENTITY, _S),
    *_all(["forecast_anchor", "forecast_window_start", "forecast_window_end"], _TS),
    ("timezone", _S),
    *_all(
        [
            "forecast_anchor_local",
            "forecast_window_start_local",
            "forecast_window_end_local",
        ],
        _NTZ,
    ),
    ("forecast_local_date", T.DateType()),
    ("forecast_confidence", _S),
    ("forecast_confidence_score", _D),
    *_all(["forecast_status", "benchmark_source", "model_source"], _S),
    *_all([f"result_{name}" for name in _RESULTS], _D),
    *_all([f"raw_pred_{name}" for name in _RESULTS], _D),
    ("recently_active", T.BooleanType()),
    ("created_at", _TS),
)

# Range ends kept beside the served value.
RANGE_NAMES = [*SHORT.values(), "roas"]
FORECAST_RANGES = _struct(
    *[(f"result_{name}_{end}", _D) for name in RANGE_NAMES for end in ("p10", "p90")]
)

FORECAST_24H_KEYS = [
    "forecast_anchor_local_date",
    "history_cutoff_local_date",
    "timezone",
    *ENTITY,
    "days_active",
]
