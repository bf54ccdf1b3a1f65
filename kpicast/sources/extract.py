"""Extracts: which rows and ads a forecast run works on.

All predicates are plain DataFrame filters, so those on the time, the ids and the
grain reach the scan.
"""

from __future__ import annotations

import datetime as dt
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .. import session
from ..functions.clean import is_active, text_id
from ..names import ENTITY
from ..operators.joins import dimension_lookup, spread_lookup
from ..operators.membership import may_be_in
from ..operators.topk import limited, top_ads, top_ads_per_account

ACCOUNT_KEYS = ["account_id", "company_id", "traffic_source_id", "traffic_source_config_id"]
# An id list longer than this is joined instead of inlined.
_INLINE_IDS = 1000
# A dimension of at most this many rows (of a few short columns) is broadcast.
BROADCAST_ROWS = 100_000


@dataclass(frozen=True)
class Hierarchy:
    """The four dimension tables."""

    accounts: DataFrame
    campaigns: DataFrame
    adsets: DataFrame
    ads: DataFrame


def lookback(time: Column, anchor: Column, days: int) -> Column:
    """The ``days`` before ``anchor``, both ends included."""
    return time.between(anchor - F.make_interval(days=F.lit(days)), anchor)


def filter_ids(rows: DataFrame, column: str, ids: list[str] | None) -> DataFrame:
    """Rows of the listed ids; an empty list keeps every row."""
    ids = [i.strip() for i in ids or [] if i.strip()]
    if not ids:
        return rows
    if len(ids) <= _INLINE_IDS:
        return rows.filter(F.col(column).isin(ids))
    wanted = rows.sparkSession.createDataFrame([(i,) for i in set(ids)], f"{column} string")
    return rows.join(wanted, column, "left_semi")


def split_ids(text: str | None) -> list[str]:
    """Ids of a comma-separated setting."""
    return [part.strip() for part in (text or "").split(",") if part.strip()]


def recent_rows(rows: DataFrame, time: str, days: int, newest=None) -> DataFrame:
    """Rows at most ``days`` older than the newest one. With ``newest`` given as a value
    (see :func:`newest_time` and :func:`newest_folder`) the filter is a constant that
    reaches the scan: partitions and row groups of older rows are not read."""
    if newest is not None:
        return rows.filter(F.col(time) >= F.lit(newest - dt.timedelta(days=days)))
    found = rows.agg(F.max(time).alias("newest"))
    return rows.filter(F.col(time) >= found.scalar() - F.make_interval(days=F.lit(days)))


def newest_time(rows: DataFrame, time: str):
    """The newest time as a value; reads one column. None if there are no rows."""
    return rows.agg(F.max(time)).first()[0]


def newest_folder(spark: SparkSession, path: str, column: str) -> dt.date | None:
    """The newest day of a table in folders ``column=yyyy-MM-dd``, from the names of the
    folders alone. Folders are taken as not empty."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{column}=*")
    system = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName().split("=", 1)[1] for s in system.globStatus(hadoop) or []]
    days = [n for n in names if re.fullmatch(r"\d{4}-\d\d-\d\d", n)]
    return dt.date.fromisoformat(max(days)) if days else None


def _active_ids(dimension: DataFrame, column: str) -> DataFrame:
    return dimension.filter(is_active(F.col("status"))).select(F.col("id").alias(column))


def keep_active(
    rows: DataFrame, dims: Hierarchy, levels: list[str], broadcast_rows: int = 0
) -> DataFrame:
    """Rows whose hierarchy is active at every named level: one semi-join each.
    The coarse levels spread the rows of a large account over tasks."""
    tables = {
        "account": dims.accounts,
        "campaign": dims.campaigns,
        "adset": dims.adsets,
        "ad": dims.ads,
    }
    for level in levels:
        column = f"{level}_id"
        active = _active_ids(tables[level], column)
        if level == "ad":
            rows = rows.join(active, column, "left_semi")
        else:
            rows = dimension_lookup(
                rows, active, [column], ["ad_id"], "left_semi", broadcast_rows
            )
    return rows


def active_rows(rows: DataFrame, dims: Hierarchy, levels: list[str]) -> DataFrame:
    """Facts whose hierarchy is active at every named level. The levels are checked on
    the distinct combinations of ids, so the facts themselves are shuffled once."""
    ids = [f"{level}_id" for level in levels]
    active = keep_active(rows.select(*ids).distinct(), dims, levels)
    return rows.join(active, ids, "left_semi")


def unique_accounts(accounts: DataFrame) -> DataFrame:
    """Timezone and status per account key. Of repeated keys one row is kept: the
    last by timezone and status."""
    keyed = accounts.select(
        text_id(F.col("id")).alias("account_id"),
        *[text_id(F.col(name)).alias(name) for name in ACCOUNT_KEYS[1:]],
        F.trim(F.coalesce(F.col("timezone"), F.lit(""))).alias("timezone"),
        F.col("status").alias("account_status"),
    )
    order = [F.col("timezone").desc(), F.col("account_status").desc_nulls_last()]
    last = Window.partitionBy(*ACCOUNT_KEYS).orderBy(*order)
    return keyed.withColumn("_n", F.row_number().over(last)).filter("_n = 1").drop("_n")


def attach_timezone(
    reports: DataFrame, accounts: DataFrame, broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Timezone of each report's account by the four normalised keys; '' where no
    account matches. The accounts are broadcast if a count shows that they are few,
    so the reports stay where they are; else both are shuffled."""
    keyed = reports.withColumns({name: text_id(F.col(name)) for name in ACCOUNT_KEYS})
    joined = dimension_lookup(
        keyed, unique_accounts(accounts), ACCOUNT_KEYS, ["ad_id", "date"], "left", broadcast_rows
    )
    return joined.withColumn("timezone", F.coalesce(F.col("timezone"), F.lit("")))


def _totals(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Spend and latest row per combination of ids: one row per ad and hierarchy,
    however many rows the ads have."""
    return rows.groupBy(*keys).agg(
        F.sum(F.coalesce(F.col("spend"), F.lit(0))).alias("spend"), F.max("date").alias("date")
    )


def _restrict(
    rows: DataFrame,
    entities: DataFrame,
    keys: list[str],
    carry: list[str],
    ad_limit: int,
    ads_per_account: int,
) -> DataFrame:
    """Rows of the kept combinations of ids, with the ``carry`` columns of each.
    With a limit the few ads kept are broadcast first, which leaves little to
    join. Without one the combinations are written, and a filter of fixed size made from
    them drops nearly all other rows in the scan, so that only what is kept is shuffled
    for the exact join."""
    if ad_limit > 0:
        small = limited(top_ads(entities, ad_limit), ad_limit)
        rows = rows.join(small, "ad_id", "left_semi")
        entities = entities.join(small, "ad_id", "left_semi")
    if ads_per_account > 0:
        largest = top_ads_per_account(entities, ads_per_account).select("account_id", "ad_id")
        entities = entities.join(largest, ["account_id", "ad_id"], "left_semi")
    kept = entities.select(*keys, *carry)
    if ad_limit <= 0:
        kept = session.written(kept, "kept")
        rows = may_be_in(rows, kept, keys)
    # The keys hold the ad, so no key is hot beyond one ad's rows, which adaptive
    # execution splits if need be.
    return rows.join(kept, keys, "inner" if carry else "left_semi")


def extract_hourly(
    reports: DataFrame,
    dims: Hierarchy,
    anchor: Column,
    lookback_days: int = 8,
    ad_limit: int = 0,
    ads_per_account: int = 0,
    ad_ids: list[str] | None = None,
    account_ids: list[str] | None = None,
) -> DataFrame:
    """Reports of the active hierarchy inside the lookback with their timezone,
    for the largest ads of all accounts or of each (0 = all).

    The dimensions are joined with the distinct ids of the reports and not with
    the reports, so these are never shuffled once per level."""
    rows = reports.filter(
        lookback(F.col("date"), anchor, lookback_days) & F.col("ad_id").isNotNull()
    )
    rows = filter_ids(filter_ids(rows, "ad_id", ad_ids), "account_id", account_ids)
    rows = rows.withColumns({name: text_id(F.col(name)) for name in ACCOUNT_KEYS})
    keys = [*ACCOUNT_KEYS, "campaign_id", "adset_id", "ad_id"]
    entities = spread_lookup(
        _totals(rows, keys), unique_accounts(dims.accounts), ACCOUNT_KEYS, ["ad_id"], "inner"
    ).filter(is_active(F.col("account_status")))
    entities = keep_active(entities, dims, ["campaign", "adset", "ad"])
    return _restrict(rows, entities, keys, ["timezone"], ad_limit, ads_per_account)


def extract_daily(
    facts: DataFrame,
    dims: Hierarchy,
    anchor: Column,
    lookback_days: int = 21,
    ad_limit: int = 0,
    ads_per_account: int = 0,
    ad_ids: list[str] | None = None,
    account_ids: list[str] | None = None,
) -> DataFrame:
    """Daily facts at ad grain of the active hierarchy inside the lookback, for
    the largest ads of all accounts or of each (0 = all)."""
    rows = facts.filter(
        (F.lower("entity_type") == "ad")
        & F.col("ad_id").isNotNull()
        & lookback(F.col("date").cast("timestamp"), anchor.cast("timestamp"), lookback_days)
    )
    rows = filter_ids(filter_ids(rows, "ad_id", ad_ids), "account_id", account_ids)
    entities = keep_active(_totals(rows, ENTITY), dims, ["account", "campaign", "adset", "ad"])
    return _restrict(rows, entities, ENTITY, [], ad_limit, ads_per_account)


def active_accounts(accounts: DataFrame) -> DataFrame:
    """Distinct ids of active accounts in order."""
    return (
        accounts.filter(is_active(F.col("status")))
        .select(F.col("id").cast("string").alias("account_id"))
        .distinct()
        .orderBy("account_id")
    )


def eligible_hierarchy(dims: Hierarchy, schedule: DataFrame | None = None) -> DataFrame:
    """Every ad with its hierarchy, whether all four levels are active, and its
    scheduled period."""

    def status(table: DataFrame, level: str) -> DataFrame:
        return table.select(
            F.col("id").alias(f"{level}_id"), is_active(F.col("status")).alias(f"_{level}")
        )

    ads = dims.ads.select(
        "account_id",
        "campaign_id",
        "adset_id",
        F.col("id").alias("ad_id"),
        is_active(F.col("status")).alias("_ad"),
    )
    for level, table in (
        ("adset", dims.adsets),
        ("campaign", dims.campaigns),
        ("account", dims.accounts),
    ):
        ads = dimension_lookup(ads, status(table, level), [f"{level}_id"], ["ad_id"], "inner")
    active = F.col("_account") & F.col("_campaign") & F.col("_adset") & F.col("_ad")
    out = ads.withColumn("is_currently_active", active)
    if schedule is None:
        none = F.lit(None).cast("timestamp")
        out = out.withColumns({"scheduled_active_from": none, "scheduled_active_until": none})
    else:
        out = out.join(schedule, "ad_id", "left")
    label = F.when(active, "currently_active").otherwise("not_currently_active")
    return out.select(
        "account_id",
        "campaign_id",
        "adset_id",
        "ad_id",
        "is_currently_active",
        "scheduled_active_from",
        "scheduled_active_until",
        label.alias("eligibility_status"),
    )


def eligible_in_window(hierarchy: DataFrame, start: Column, end: Column) -> DataFrame:
    """Ads active now, or scheduled to start inside ``[start, end)`` and not
    already over by its start."""
    begins = F.col("scheduled_active_from")
    until = F.col("scheduled_active_until")
    scheduled = (begins >= start) & (begins < end) & (until.isNull() | (until > start))
    return hierarchy.filter(F.col("is_currently_active") | F.coalesce(scheduled, F.lit(False)))
