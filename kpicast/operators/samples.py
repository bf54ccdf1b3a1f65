"""Time split, sample weights and target clipping."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from ..config import WeightRules
from ..functions.ratios import clip
from ..functions.text import any_of, num
from ..names import SPARSE
from .quantiles import exact_quantiles


def _cutoffs(rows: DataFrame, time: str, at_least_first: bool) -> DataFrame:
    """One row with the times at 70 % and 85 % of the distinct times. There are
    as many distinct times as calendar slots, not as many as rows."""
    times = rows.select(time).distinct().agg(F.sort_array(F.collect_set(time)).alias("t"))
    n = F.size("t")
    train, valid = F.floor(n * 0.70).cast("int"), F.floor(n * 0.85).cast("int")
    first = F.greatest(train, F.lit(1))
    second = F.greatest(valid, train + 1 if at_least_first else F.lit(1))
    return times.agg(
        F.first(F.try_element_at("t", first)).alias("train_end"),
        F.first(F.try_element_at("t", F.least(second, n))).alias("valid_end"),
    )


def time_split(
    rows: DataFrame,
    time: str,
    train_end=None,
    valid_end=None,
    at_least_first: bool = False,
    on_empty: str = "fallback",
) -> DataFrame:
    """Adds ``split``: train, valid or test. The given end times are used when all
    three parts have rows, else the 70 % and 85 % points of the distinct times, or,
    with ``on_empty="error"``, the job stops.
    ``at_least_first`` keeps the validation part from being empty by position."""
    fallback = _cutoffs(rows, time, at_least_first)
    if train_end is None or valid_end is None:
        ends = fallback.select(F.struct("train_end", "valid_end").alias("e"))
    else:
        kind = dict(rows.dtypes)[time]
        low, high = F.lit(train_end).cast(kind), F.lit(valid_end).cast(kind)
        t = F.col(time)
        parts = rows.agg(
            F.bool_or(t <= low).alias("a"),
            F.bool_or((t > low) & (t <= high)).alias("b"),
            F.bool_or(t > high).alias("c"),
        ).select((F.col("a") & F.col("b") & F.col("c")).alias("usable"))
        if on_empty == "error":
            message = f"a part is empty for train_end={train_end}, valid_end={valid_end}"
            parts = parts.select(F.when(F.col("usable"), True).otherwise(F.raise_error(F.lit(message)).cast("boolean")))
        ends = fallback.select(
            F.when(parts.scalar(), F.struct(low.alias("train_end"), high.alias("valid_end")))
            .otherwise(F.struct("train_end", "valid_end"))
            .alias("e")
        )
    cut = rows.withColumn("_ends", ends.scalar())
    split = (
        F.when(F.col(time) <= F.col("_ends.train_end"), "train")
        .when(F.col(time) <= F.col("_ends.valid_end"), "valid")
        .otherwise("test")
    )
    return cut.withColumn("split", split).drop("_ends")


def positive_quantile(rows: DataFrame, value: str, p: float) -> DataFrame:
    """One row with the quantile of the positive values."""
    positive = rows.filter(F.col(value) > 0)
    return exact_quantiles(positive, [], value, {"q": p}, spread_by=[]).select("q")


def sample_weight(
    train: DataFrame,
    target: str,
    recency_start: dt.date | str | None = None,
    revenue_focus: bool = False,
    rules: WeightRules = WeightRules(),
) -> Column:
    """Weight of each training row for one target. ``train`` is read for the
    upper-quartile cut of the sparse targets."""
    revenue, sales = "tracker_revenue_nonzero_count", "tracker_conversions_nonzero_count"
    unpaid = "spend_positive_revenue_zero_count"
    unsold = "clicks_positive_conversions_zero_count"
    consistent = f"{revenue}_7d >= 2 OR {sales}_7d >= 2"
    strong = f"{revenue}_7d >= 4 OR {sales}_7d >= 4"
    strong_14 = f"{revenue}_14d >= 6 OR {sales}_14d >= 6"
    suspicious = any_of(
        [
            f"{unpaid}_7d >= 5 AND {revenue}_7d = 0",
            f"{unsold}_7d >= 5 AND {sales}_7d = 0",
            f"{unpaid}_14d >= 10 AND {revenue}_14d <= 1",
            f"{unsold}_14d >= 10 AND {sales}_14d <= 1",
        ]
    )
    factors: list[tuple[str, float]] = []
    if recency_start is not None:
        factors.append((f"local_date >= DATE'{recency_start}'", rules.recency))
    value = f"coalesce(target_24h_{target}, 0D)"
    if target in SPARSE:
        factors += [
            (consistent, 1.60),
            (strong, 1.30),
            (strong_14, 1.20),
            (suspicious, 0.30),
            (f"{value} > 0", 1.35),
        ]
        if revenue_focus and target == "tracker_revenue":
            factors += _focus_factors(set(train.columns))
    elif target == "inline_link_clicks":
        factors += [(f"{sales}_7d >= 1", 1.15), (strong, 1.05)]
    else:
        factors += [(consistent, 1.10), (strong, 1.05)]
    arms = [f"CASE WHEN {condition} THEN {num(f)} ELSE 1D END" for condition, f in factors]
    weight = F.expr(" * ".join(arms))
    if target in SPARSE:
        cut = positive_quantile(train, f"target_24h_{target}", rules.high_target_quantile)
        weight = weight * F.when(F.expr(value) >= cut.scalar(), 1.15).otherwise(1.0)
    return clip(weight, rules.low, rules.high)


def _focus_factors(present: set[str]) -> list[tuple[str, float]]:
    def signal(name: str, least: int) -> str:
        return f"{name} >= {least}" if name in present else "false"

    def group_signal(days: int, least: int) -> str:
        name = f"tracker_revenue_nonzero_count_{days}d"
        return any_of([signal(f"{g}_{name}", least) for g in ("campaign", "account")])

    return [
        (signal("is_revenue_stable_7d", 1), 1.60),
        (group_signal(7, 2), 1.20),
        (group_signal(14, 5), 1.15),
        (signal("is_revenue_spiky_7d", 1), 0.75),
    ]


def clipped_target(
    train: DataFrame, target: str, revenue_focus: bool = False, rules: WeightRules = WeightRules()
) -> Column:
    """Training value of a target; revenue is clipped at a high quantile of its
    positive values when the focus flag is set."""
    name = f"target_24h_{target}"
    if not (revenue_focus and target == "tracker_revenue"):
        return F.col(name)
    cap = positive_quantile(train, name, rules.revenue_clip_quantile)
    return F.greatest(F.least(F.col(name), cap.scalar()), F.lit(0.0))
