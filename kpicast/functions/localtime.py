"""Account-local time.

Local hours are whole numbers counted from 1970-01-01 00:00 on the wall clock, so
all window arithmetic is integer arithmetic; timestamps are made for output only.
"""

from __future__ import annotations

from zoneinfo import available_timezones

from pyspark.sql import Column, functions as F

HOUR_MICROS = 3_600_000_000
# Names the operating system lists but that are no zones.
_NOT_ZONES = {"Factory", "localtime", "posixrules"}
# Zones the JVM knows by another name only.
_RENAMED = {"ROC": "Asia/Taipei"}


def known_zones() -> list[str]:
    return sorted(available_timezones() - _NOT_ZONES)


def _zone_list() -> str:
    return ", ".join(f"'{name}'" for name in known_zones())


def is_known_zone(timezone: str) -> Column:
    """Whether the named column holds a known zone."""
    return F.expr(f"trim(coalesce({timezone}, '')) IN ({_zone_list()})")


def zone_or_utc(timezone: str) -> Column:
    """Zone in the named column when it is known, UTC otherwise (empty, null,
    invalid). The list of zones is a constant set: no join."""
    name = f"trim(coalesce({timezone}, ''))"
    renamed = " ".join(f"WHEN {name} = '{old}' THEN '{new}'" for old, new in _RENAMED.items())
    return F.expr(f"CASE {renamed} WHEN {name} IN ({_zone_list()}) THEN {name} ELSE 'UTC' END")


def _floor_hours(micros: Column) -> Column:
    return ((micros - F.pmod(micros, F.lit(HOUR_MICROS))) / F.lit(HOUR_MICROS)).cast("long")


def local_hour(utc: Column, timezone: str) -> Column:
    """Wall-clock hour number of a UTC instant."""
    return _floor_hours(F.unix_micros(F.from_utc_timestamp(utc, zone_or_utc(timezone))))


def hour_number(wall: Column) -> Column:
    """Hour number of a wall-clock timestamp."""
    return _floor_hours(F.unix_micros(wall.cast("timestamp")))


def wall_clock(hour: Column) -> Column:
    """Wall-clock timestamp of an hour number."""
    return F.timestamp_add("HOUR", hour, F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"))


def anchor_hour(hour: Column, step: int = 6) -> Column:
    """Latest anchor at or before ``hour``: anchors are at 0, 6, 12 and 18."""
    return hour - F.pmod(hour, F.lit(step))


def weekday_of_hour(hour: Column) -> Column:
    """Monday is 0. Day 0 of the count was a Thursday."""
    days = ((hour - F.pmod(hour, F.lit(24))) / F.lit(24)).cast("long")
    return F.pmod(days + 3, F.lit(7))


def to_local(instant: Column, timezone: str) -> Column:
    """Wall clock of an instant; an unknown zone keeps the UTC clock."""
    return F.from_utc_timestamp(instant, zone_or_utc(timezone)).cast("timestamp_ntz")


def to_instant(wall: Column, zone: Column) -> Column:
    """UTC instant of a wall clock in a zone made by :func:`zone_or_utc`."""
    return F.to_utc_timestamp(wall.cast("timestamp"), zone)


def plus_hours(ts: Column, hours) -> Column:
    hours = F.lit(hours) if isinstance(hours, int) else hours
    return F.timestamp_add("HOUR", hours, ts)


def window_end(start: Column, horizon: str) -> Column:
    """End of the forecast window; null for a horizon that is neither."""
    length = {"24h": 24, "6h": 6}.get(horizon)
    return plus_hours(start, length) if length else F.lit(None).cast("timestamp")
