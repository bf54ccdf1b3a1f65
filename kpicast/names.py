"""Column names shared by every job. These are fixed values: they are the
interface to the input and output tables."""

ENTITY = ["account_id", "campaign_id", "adset_id", "ad_id"]

# The five metrics that are forecast, in the order in which they are served.
METRICS = [
    "spend",
    "impressions",
    "inline_link_clicks",
    "tracker_conversions",
    "tracker_revenue",
]

# Metrics summed by the hourly rollup (clicks is carried, never forecast).
HOURLY_METRICS = [
    "spend",
    "impressions",
    "clicks",
    "inline_link_clicks",
    "tracker_conversions",
    "tracker_revenue",
]

KPIS = ["roas", "profit", "ctr", "cvr", "cpc", "cpm"]

# Metric name in the forecast table.
SHORT = {
    "spend": "spend",
    "impressions": "impressions",
    "inline_link_clicks": "clicks",
    "tracker_conversions": "conversions",
    "tracker_revenue": "revenue",
}

# Metrics that are sparse and get extra guards.
SPARSE = ["tracker_conversions", "tracker_revenue"]
