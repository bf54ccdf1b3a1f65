"""Small fact tables for tests."""

from __future__ import annotations

import datetime as dt

from kpicast.names import ENTITY, HOURLY_METRICS, METRICS

DAILY = "local_date date, timezone string, " + ", ".join(
    [f"{c} string" for c in ENTITY] + [f"{m} double" for m in METRICS]
)
HOURLY = "hour_idx bigint, timezone string, " + ", ".join(
    [f"{c} string" for c in ENTITY] + [f"{m} double" for m in HOURLY_METRICS]
)
START = dt.date(2024, 1, 1)


def day_row(day, ad="1", values=(1.0, 100.0, 10.0, 1.0, 2.0), ids=("1", "1", "1"), tz="UTC"):
    return (START + dt.timedelta(days=day), tz, *ids, ad, *map(float, values))


def hour_row(hour, ad="1", values=(1.0, 100.0, 10.0, 10.0, 1.0, 2.0), ids=("1", "1", "1"), tz="UTC"):
    return (hour, tz, *ids, ad, *map(float, values))
