"""The given test tables read as advertising facts.

``events`` becomes hourly and daily facts: a user is an ad, ads roll up to adsets,
campaigns and accounts by the user id, and each event type feeds one metric. Money
is summed as decimals, so sums do not depend on the order of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..names import ENTITY
from .extract import Hierarchy
from .readers import read_parquet

ZONES = {
    "0": "Asia/Kolkata",
    "1": "America/New_York",
    "2": "UTC",
    "3": "",
    "4": "Not/AZone",
}


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_parquet(
        spark,
        f"{sf_dir}/events.parquet",
        ["event_id", "ts", "user_id", "event_type", "value"],
    )


def _ids(user: Column) -> dict[str, Column]:
    return {
        "account_id": (user % 5).cast("string"),
        "campaign_id": (user % 15).cast("string"),
        "adset_id": (user % 45).cast("string"),
        "ad_id": user.cast("string"),
    }


def timezone_of(account: Column) -> Column:
    zones = F.create_map(*[F.lit(x) for pair in ZONES.items() for x in pair])
    return zones[account]


def _metrics() -> list[Column]:
    kind, money = F.col("event_type"), F.col("value").cast("decimal(18,2)")

    def total(condition: Column, value: Column) -> Column:
        return F.sum(F.when(condition, value).otherwise(F.lit(0)))

    zero = F.lit(0).cast("decimal(18,2)")
    return [
        F.sum(F.when(kind == "view", money).otherwise(zero)).alias("spend"),
        total(kind == "view", F.lit(100)).alias("impressions"),
        total(kind.isin("click", "error"), F.lit(10)).alias("clicks"),
        total(kind == "click", F.lit(10)).alias("inline_link_clicks"),
        total(kind == "signup", F.lit(1)).alias("tracker_conversions"),
        F.sum(F.when(kind == "purchase", money).otherwise(zero)).alias("tracker_revenue"),
    ]


def hourly_reports(spark: SparkSession, sf_dir: str, rows: DataFrame | None = None) -> DataFrame:
    """One row per ad and UTC hour, with the four account keys but no timezone."""
    rows = events(spark, sf_dir) if rows is None else rows
    hour = F.date_trunc("hour", F.col("ts").cast("timestamp"))
    facts = rows.groupBy("user_id", hour.alias("date")).agg(*_metrics())
    ids = _ids(F.col("user_id"))
    return facts.withColumns(ids).withColumns(account_keys()).drop("user_id")


def account_keys() -> dict[str, Column]:
    account = F.col("account_id").cast("int")
    return {
        "company_id": (account % 2).cast("string"),
        "traffic_source_id": F.lit("1"),
        "traffic_source_config_id": F.concat(F.lit("cfg-"), F.col("account_id")),
    }


def hourly_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly reports with the timezone of their account."""
    return hourly_reports(spark, sf_dir).withColumn("timezone", timezone_of(F.col("account_id")))


def daily_facts(spark: SparkSession, sf_dir: str, rows: DataFrame | None = None) -> DataFrame:
    """Facts per ad and UTC day (taken as the account's day) next to campaign-grain
    rows of the same days, as in a table of mixed grain."""
    rows = events(spark, sf_dir) if rows is None else rows
    day = F.to_date("ts")
    ads = rows.groupBy("user_id", day.alias("date")).agg(*_metrics()).withColumns(
        _ids(F.col("user_id"))
    )
    grain = F.when(F.col("account_id") == "4", "Ad").otherwise("ad")
    columns = ["entity_type", "date", "timezone", *ENTITY, "spend", "impressions", "clicks",
               "inline_link_clicks", "tracker_conversions", "tracker_revenue"]
    ads = ads.withColumns({"entity_type": grain, "timezone": timezone_of(F.col("account_id"))})
    campaigns = (
        rows.groupBy((F.col("user_id") % 15).alias("campaign"), day.alias("date"))
        .agg(*_metrics())
        .withColumns(
            {
                "entity_type": F.lit("campaign"),
                "account_id": (F.col("campaign") % 5).cast("string"),
                "campaign_id": F.col("campaign").cast("string"),
                "adset_id": F.lit(None).cast("string"),
                "ad_id": F.lit(None).cast("string"),
            }
        )
        .withColumn("timezone", timezone_of(F.col("account_id")))
    )
    return ads.select(*columns).unionByName(campaigns.select(*columns))


def _status(key: Column, prime: int, paused: list[int], missing: list[int]) -> Column:
    rest = key % prime
    return (
        F.when(rest.isin(paused), "Paused")
        .when(rest.isin(missing), F.lit(None).cast("string"))
        .when(rest % 2 == 0, "ACTIVE")
        .otherwise("active")
    )


def hierarchy(spark: SparkSession, sf_dir: str) -> Hierarchy:
    """Dimension tables from the distinct users."""
    users = events(spark, sf_dir).select("user_id").distinct()

    def level(name: str, modulo: int) -> DataFrame:
        return users.select((F.col("user_id") % modulo).alias("k")).distinct().withColumn(
            "id", F.col("k").cast("string")
        )

    accounts = level("account", 5).withColumn("account_id", F.col("id"))
    accounts = accounts.withColumns(account_keys()).select(
        "id",
        "company_id",
        "traffic_source_id",
        "traffic_source_config_id",
        _status(F.col("k"), 3, [2], []).alias("status"),
        timezone_of(F.col("id")).alias("timezone"),
    )
    campaigns = level("campaign", 15).select("id", _status(F.col("k"), 7, [6], [5]).alias("status"))
    adsets = level("adset", 45).select("id", _status(F.col("k"), 11, [10], []).alias("status"))
    user = F.col("user_id")
    ids = _ids(user)
    ads = users.select(
        ids["ad_id"].alias("id"),
        *[ids[name].alias(name) for name in ("adset_id", "campaign_id", "account_id")],
        _status(user, 13, [11, 12], [10]).alias("status"),
    )
    return Hierarchy(accounts, campaigns, adsets, ads)


def schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A scheduled period for every ad; some are open-ended."""
    user = F.col("user_id")
    users = events(spark, sf_dir).select("user_id").distinct()
    begins = F.timestamp_add(
        "HOUR", F.pmod(user, F.lit(96)), F.lit("2024-01-30 00:00:00").cast("timestamp")
    )
    return users.select(
        user.cast("string").alias("ad_id"),
        begins.alias("scheduled_active_from"),
        F.when(F.pmod(user, F.lit(2)) == 0, F.timestamp_add("HOUR", F.lit(12), begins)).alias(
            "scheduled_active_until"
        ),
    )


def sources(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Two overlapping daily sources: an early export up to 20 January that lacks
    purchases, and a later one from 10 January on."""
    rows = events(spark, sf_dir)
    early = (F.col("ts") < "2024-01-20") & (F.col("event_type") != "purchase")
    late = F.col("ts") >= "2024-01-10"
    return [daily_facts(spark, sf_dir, rows.filter(part)) for part in (early, late)]


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as measurement points."""
    return events(spark, sf_dir).select(
        F.col("event_type").alias("measurement"),
        F.create_map(F.lit("ad_id"), F.col("user_id").cast("string"),
                     F.lit("account_id"), (F.col("user_id") % 5).cast("string")).alias("tags"),
        F.create_map(F.lit("value"), F.col("value")).alias("fields"),
        F.col("ts").cast("timestamp").alias("ts"),
        "event_id",
    )
