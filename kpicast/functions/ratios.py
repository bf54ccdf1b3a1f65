"""KPI ratios as SQL text, and the log transform of targets."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import num

# KPI -> (numerator, denominator, scale), with the forecast table's metric names.
RATIOS = {
    "roas": ("revenue", "spend", 1.0),
    "ctr": ("clicks", "impressions", 100.0),
    "cvr": ("conversions", "clicks", 100.0),
    "cpc": ("spend", "clicks", 1.0),
    "cpm": ("spend", "impressions", 1000.0),
}


def _scaled(top: str, bottom: str, scale: float) -> str:
    return f"{top} / {bottom}" + ("" if scale == 1.0 else f" * {num(scale)}")


def ratio(top: str, bottom: str, scale: float = 1.0, positive: bool = False) -> str:
    """``top / bottom * scale``, 0 when the bottom is 0 (or, with ``positive``,
    not above 0)."""
    usable = f"{bottom} > 0" if positive else f"{bottom} != 0"
    return f"CASE WHEN {usable} THEN {_scaled(top, bottom, scale)} ELSE 0D END"


def kpi(name: str, values: dict[str, str], positive: bool = False) -> str:
    """One KPI of ``values``, keyed by the forecast table's metric names."""
    if name == "profit":
        return f"{values['revenue']} - {values['spend']}"
    top, bottom, scale = RATIOS[name]
    return ratio(values[top], values[bottom], scale, positive)


def fill_kpis(values: dict[str, str]) -> dict[str, str]:
    """KPIs for the sink: what is given stays, a gap is computed. A ratio whose
    denominator is not positive stays null and a missing numerator counts as 0."""
    out = {}
    for name, (top, bottom, scale) in RATIOS.items():
        value = _scaled(f"coalesce({values[top]}, 0D)", values[bottom], scale)
        computed = f"CASE WHEN {values[bottom]} > 0 THEN {value} END"
        out[name] = f"coalesce({values[name]}, {computed})"
    profit = f"{values['revenue']} - {values['spend']}"
    out["profit"] = f"coalesce({values['profit']}, {profit})"
    return out


def clipped(value: str, low: float, high: float) -> str:
    return f"greatest(least({value}, {num(high)}), {num(low)})"


def clip(value: Column, low: float, high: float) -> Column:
    return F.greatest(F.least(value, F.lit(high)), F.lit(low))


def to_log(value: Column) -> Column:
    return F.log1p(F.greatest(value, F.lit(0.0)))


def from_log(value: Column, bound: float | None = None) -> Column:
    """Back from the log scale, floored at 0; ``bound`` clips the exponent."""
    if bound is not None:
        value = clip(value, -bound, bound)
    return F.greatest(F.expm1(value), F.lit(0.0))
