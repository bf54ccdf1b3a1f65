"""Rollups to hours and days, and the per-ad summaries made from them.

Sums combine on the map side, so an ad that owns a third of all source rows
arrives at the shuffle as one row per hour or day and task. After a rollup an
ad has at most one row per hour (or day) and hierarchy, which bounds every
window partitioned by ad by the calendar span.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F

from ..config import FIRST_DAY, MIN_AD_DAYS
from ..functions import clean, localtime
from ..names import ENTITY, HOURLY_METRICS, METRICS

_HIERARCHY = ["account_id", "campaign_id", "adset_id"]


_DATES = ("timestamp", "timestamp_ntz", "date")


def _instant(kinds: dict[str, str]) -> Column:
    return F.col("date").cast("timestamp") if kinds["date"] in _DATES else clean.instant(F.col("date"))


def _possible(day: Column) -> Column:
    """Whether a day can be one of a report: a single wrong date would open a calendar
    of centuries. Two days ahead leave room for every zone."""
    return day.between(F.lit(FIRST_DAY).cast("date"), F.date_add(F.current_date(), 2))


def watched(reports: DataFrame, counts: Observation, metrics: list[str]) -> DataFrame:
    """``reports``, counted while they pass: ``rows``, and how many have an unreadable or
    impossible date, no ad, no timezone, or (per value) text in place of a number. The
    counts are there once the rows have been computed; no second scan is made. Nulls are
    no rejected numbers."""
    kinds = dict(reports.dtypes)
    instant = _instant(kinds)
    texts = [F.col(m) for m in metrics if kinds.get(m) == "string"]
    wrong = [F.when(c.isNotNull() & c.try_cast("double").isNull(), 1).otherwise(0) for c in texts]
    count = lambda condition: F.count_if(condition)
    return reports.observe(
        counts,
        F.count(F.lit(1)).alias("rows"),
        count(instant.isNull()).alias("unreadable_dates"),
        count(instant.isNotNull() & ~_possible(F.to_date(instant))).alias("impossible_dates"),
        count(clean.text_id(F.col("ad_id")) == "").alias("blank_ads"),
        count(F.trim(clean.text(F.col("timezone"))) == "").alias("unmatched_zones"),
        F.sum(reduce(lambda a, b: a + b, wrong, F.lit(0))).cast("long").alias("rejected_numbers"),
    )


def clean_hourly(
    reports: DataFrame, metrics: list[str] = HOURLY_METRICS, counts: Observation | None = None
) -> DataFrame:
    """Typed hourly facts: ids as text, metrics as numbers; rows without a readable and
    possible instant or without an ad are dropped, and counted on the way if ``counts`` is
    given (:func:`watched`). Numeric columns keep their type."""
    kinds = dict(reports.dtypes)
    instant = _instant(kinds)
    if counts is not None:
        reports = watched(reports, counts, metrics)
    return (
        reports.select(
            instant.alias("date"),
            clean.text(F.col("timezone")).alias("timezone"),
            *[clean.text_id(F.col(name)).alias(name) for name in ENTITY],
            *[_metric(reports, kinds, name) for name in metrics],
        )
        .filter(_possible(F.to_date("date")) & (F.col("ad_id") != ""))
    )


def clean_daily(facts: DataFrame, metrics: list[str] = METRICS) -> DataFrame:
    """Typed daily facts at ad grain, of rows with an ad and a possible day; the day is
    already account-local."""
    kinds = dict(facts.dtypes)
    if "entity_type" in facts.columns:
        facts = facts.filter(F.lower(F.col("entity_type").cast("string")) == "ad")
    day = (
        F.to_date(F.col("date"))
        if kinds["date"] in ("timestamp", "timestamp_ntz", "date")
        else clean.day(F.col("date"))
    )
    timezone = F.col("timezone") if "timezone" in facts.columns else F.lit("")
    return facts.select(
        day.alias("local_date"),
        clean.text(timezone).alias("timezone"),
        *[clean.text_id(F.col(name)).alias(name) for name in ENTITY],
        *[_metric(facts, kinds, name) for name in metrics],
    ).filter(_possible(F.col("local_date")) & (F.col("ad_id") != ""))


def _metric(df: DataFrame, kinds: dict, name: str):
    if name not in df.columns:
        return F.lit(0.0).alias(name)
    if kinds[name].startswith("decimal") or kinds[name] in ("int", "bigint"):
        return F.coalesce(F.col(name), F.lit(0)).alias(name)
    return clean.number(F.col(name)).alias(name)


def hourly_rollup(reports: DataFrame, metrics: list[str] = HOURLY_METRICS) -> DataFrame:
    """Sum of the metrics per local hour, timezone and hierarchy. Takes the
    output of :func:`clean_hourly`."""
    hour = localtime.local_hour(F.col("date"), "timezone")
    return (
        reports.groupBy(hour.alias("hour_idx"), "timezone", *ENTITY)
        .agg(*[F.sum(name).cast("double").alias(name) for name in metrics])
        .withColumn("local_ts", localtime.wall_clock(F.col("hour_idx")))
    )


def daily_rollup(facts: DataFrame, metrics: list[str] = METRICS) -> DataFrame:
    """Sum of the metrics per local day, timezone and hierarchy. Takes the output
    of :func:`clean_daily`."""
    return facts.groupBy("local_date", "timezone", *ENTITY).agg(
        *[F.sum(name).cast("double").alias(name) for name in metrics]
    )


def keep_last(rows: DataFrame, time: str) -> DataFrame:
    """One row per ad and ``time``: the last by timezone and hierarchy. Grouped by
    ad and time, so an id shared by very many hierarchies (a blank one, say) is
    spread over its hours before anything is gathered per ad."""
    order = [F.col(name).desc() for name in ["timezone", *_HIERARCHY]]
    same_slot = Window.partitionBy("ad_id", time).orderBy(*order)
    return rows.withColumn("_n", F.row_number().over(same_slot)).filter("_n = 1").drop("_n")


def merge_sources(sources: list[DataFrame]) -> DataFrame:
    """Union of daily rollups in which a later source replaces an earlier one for
    the same day, timezone and hierarchy; values are never added up. A key has at
    most one row per source, so no group grows with the data."""
    keys = ["local_date", "timezone", *ENTITY]
    tagged = [df.withColumn("_source", F.lit(place)) for place, df in enumerate(sources)]
    newest = Window.partitionBy(*keys).orderBy(F.col("_source").desc())
    return (
        reduce(lambda a, b: a.unionByName(b), tagged)
        .withColumn("_n", F.row_number().over(newest))
        .filter("_n = 1")
        .drop("_n", "_source")
    )


def last_rows(daily: DataFrame, count: int = 1) -> DataFrame:
    """The last ``count`` days of every ad. Takes one row per ad and day."""
    newest = Window.partitionBy("ad_id").orderBy(F.col("local_date").desc())
    return (
        daily.withColumn("_n", F.row_number().over(newest)).filter(F.col("_n") <= count).drop("_n")
    )


def lifetime_summary(daily: DataFrame) -> DataFrame:
    """Whole-history totals per ad, with exact distinct days."""
    return daily.groupBy("ad_id").agg(
        F.countDistinct("local_date").alias("full_days_active"),
        F.sum("spend").alias("full_cum_spend"),
        F.sum("inline_link_clicks").alias("full_cum_clicks"),
        F.sum("tracker_conversions").alias("full_cum_conversions"),
        F.sum("tracker_revenue").alias("full_cum_revenue"),
        F.count_if(F.col("spend") == 0).alias("full_zero_spend_to_date"),
    )


def eligible_ads(daily: DataFrame, min_days: int = MIN_AD_DAYS, top: int | None = None) -> DataFrame:
    """Ads with enough distinct days, or the ``top`` of them by days."""
    ads = (
        daily.groupBy("ad_id")
        .agg(F.countDistinct("local_date").alias("days"))
        .filter(F.col("days") >= min_days)
    )
    return ads.orderBy(F.col("days").desc(), "ad_id").limit(top) if top else ads


def restrict_to_ads(rows: DataFrame, ads: DataFrame) -> DataFrame:
    return rows.join(ads.select("ad_id"), "ad_id", "left_semi")


def timezone_match_rate(reports: DataFrame) -> DataFrame:
    """Share of rows with a timezone, and with one that is a known zone."""
    timezone = F.trim(F.coalesce(F.col("timezone"), F.lit("")))
    return reports.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(timezone != "").alias("matched_rows"),
        F.count_if(timezone == "").alias("missing_rows"),
        F.count_if((timezone != "") & ~localtime.is_known_zone("timezone")).alias("unknown_zone_rows"),
    ).withColumn(
        "match_rate",
        F.when(F.col("rows") > 0, F.col("matched_rows") / F.col("rows")).otherwise(0.0),
    )
