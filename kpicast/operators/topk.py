"""Largest ads by spend and the other limited reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


# A top-k of at most this many ads is broadcast.
MAX_BROADCAST_ADS = 10_000


def top_ads(rows: DataFrame, limit: int, time: str = "date") -> DataFrame:
    """Ads by total spend, then by their latest row; the ad id breaks ties."""
    ranked = rows.groupBy("ad_id").agg(
        F.sum(F.coalesce(F.col("spend"), F.lit(0))).alias("total_spend"),
        F.max(time).alias("last_seen"),
    )
    return ranked.orderBy(
        F.col("total_spend").desc(), F.col("last_seen").desc(), F.col("ad_id")
    ).limit(limit)


def top_ads_per_account(
    rows: DataFrame, limit: int, time: str = "date", account: str = "account_id"
) -> DataFrame:
    """The ``limit`` largest ads of every account. Rows are summed per ad first, and
    Spark keeps no more than ``limit`` ads an account in each task before the ads of
    an account meet, so a very large account moves few rows."""
    totals = rows.groupBy(account, "ad_id").agg(
        F.sum(F.coalesce(F.col("spend"), F.lit(0))).alias("total_spend"),
        F.max(time).alias("last_seen"),
    )
    order = Window.partitionBy(account).orderBy(
        F.col("total_spend").desc(), F.col("last_seen").desc(), F.col("ad_id")
    )
    ranked = totals.withColumn("_rank", F.row_number().over(order))
    return ranked.filter(F.col("_rank") <= limit).drop("_rank")


def limited(ads: DataFrame, limit: int) -> DataFrame:
    """The ids of a top-k, broadcast while the limit itself bounds them."""
    ids = ads.select("ad_id")
    return F.broadcast(ids) if limit <= MAX_BROADCAST_ADS else ids


def keep_top_ads(rows: DataFrame, limit: int, time: str = "date") -> DataFrame:
    """All rows of the largest ads; limit 0 keeps every ad."""
    if limit <= 0:
        return rows
    return rows.join(limited(top_ads(rows, limit, time), limit), "ad_id", "left_semi")
