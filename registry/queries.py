"""One query per operator of the inventory, over the whole given tables.

Each takes (spark, folder of tables). Predictions are stand-ins where a query is
about the rules that follow a prediction: the mean of the last seven days (24h) or
of the same hours of the last seven days (6h). Label rules run on every ad and day.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession, Window, functions as F, types as T

from kpicast import config, session
from kpicast.config import AnchorRules, GuardRules
from kpicast.functions import clean, labels, ratios
from kpicast.functions.text import add, case, pick
from kpicast.names import ENTITY, KPIS, METRICS, SHORT, SPARSE
from kpicast.operators import (
    calibration,
    daily,
    grid,
    hourly,
    metrics,
    models,
    peers,
    recommend,
    rollup,
    samples,
    topk,
)
from kpicast.plans import jobs, score, train
from kpicast.sources import clustered, extract, lens, points, readers, sinks

KEYS = ["local_date", "timezone", *ENTITY]
ANCHOR_KEYS = ["anchor_idx", *ENTITY]
# Thresholds under which the test tables reach every branch.
TRAIN_ANCHORS = AnchorRules(min_observed_hours=12)
ENOUGH_ANCHORS = AnchorRules(enough_hours=16)
SMALL_GUARDS = GuardRules(
    multiplier=1.1, caps={"tracker_revenue": 60.0, "tracker_conversions": 0.2}, max_roas=20.0
)
RECENCY_START = "2024-01-20"
TRAIN_END, VALID_END = "2024-01-20", "2024-01-25"


# Also used by the SQL side.
TIE_SHIFT = 1.3e-8


def portable(df: DataFrame, digits: int = 6) -> DataFrame:
    """Plain output types: times as text, whole numbers as bigint, doubles rounded
    so that the order of a sum does not show. Means of cents often end in a 5 right
    behind the last digit, so a shift far below it comes before the rounding."""
    out = []
    for name, kind in df.dtypes:
        sql = f"`{name}`"
        if kind == "date":
            sql = f"date_format({sql}, 'yyyy-MM-dd')"
        elif kind.startswith("timestamp"):
            sql = f"date_format({sql}, 'yyyy-MM-dd HH:mm:ss')"
        elif kind in ("double", "float") or kind.startswith("decimal"):
            sql = f"round(CAST({sql} AS double) + {TIE_SHIFT!r}D, {digits})"
        elif kind == "boolean":
            sql = f"CAST({sql} AS string)"
        elif kind in ("tinyint", "smallint", "int", "bigint"):
            sql = f"CAST({sql} AS bigint)"
        out.append(f"{sql} AS `{name}`")
    return df.selectExpr(*out)


# -- building blocks ---------------------------------------------------------


def _hourly(spark: SparkSession, d: str) -> DataFrame:
    return rollup.hourly_rollup(rollup.clean_hourly(lens.hourly_facts(spark, d)))


def _daily(spark: SparkSession, d: str) -> DataFrame:
    return rollup.daily_rollup(rollup.clean_daily(lens.daily_facts(spark, d)))


def _windows(spark: SparkSession, d: str) -> DataFrame:
    return hourly.block_windows(hourly.hour_blocks(_hourly(spark, d)))


def _every_anchor(spark: SparkSession, d: str) -> DataFrame:
    """Anchors with a full week behind and six hours ahead."""
    c = F.col
    return _windows(spark, d).filter(
        (c("anchor_idx") - c("first_hour") >= 167) & (c("anchor_idx") + 6 <= c("last_hour"))
    )


def _dense_features(spark: SparkSession, d: str) -> DataFrame:
    return daily.daily_features(grid.dense_days(_daily(spark, d)))


def _all_day_features(spark: SparkSession, d: str) -> DataFrame:
    """Features of every dense day and of the day after the last one."""
    return daily.daily_features(
        grid.scoring_days(_daily(spark, d), None), carry=("history_cutoff_local_date",)
    )


def _recommended(spark: SparkSession, d: str) -> DataFrame:
    frame = recommend.prediction_kpis(score.recent_mean(_all_day_features(spark, d)))
    return recommend.recommend_24h(frame, within=["local_date"])


def _scored_days(spark: SparkSession, d: str) -> DataFrame:
    """Training rows with split and stand-in prediction."""
    rows = train.daily_samples([lens.daily_facts(spark, d)])
    rows = samples.time_split(rows, "local_date", TRAIN_END, VALID_END)
    # Read several times by calibration and its metrics, so written once.
    return session.written(train.scored_columns(score.recent_mean(rows)), "scored")


def _segmented(spark: SparkSession, d: str) -> DataFrame:
    return add(_scored_days(spark, d), {"prediction_segment": labels.prediction_segment()})


def _valid_rows(spark: SparkSession, d: str) -> DataFrame:
    return calibration.calibration_rows(_segmented(spark, d).filter("split = 'valid'"))


def _backtest(spark: SparkSession, d: str) -> DataFrame:
    return train.backtest(_scored_days(spark, d))[0]


# -- cleaning ----------------------------------------------------------------


def clean_ids(spark, d):
    customer = "CAST(o_custkey AS string)"
    dirty = case(
        [
            ("o_orderkey % 7 = 0", f"concat('  ', {customer}, ' ')"),
            ("o_orderkey % 7 = 1", f"concat({customer}, '.0')"),
            ("o_orderkey % 7 = 2", "'nan'"),
            ("o_orderkey % 7 = 3", "'None'"),
            ("o_orderkey % 7 = 4", "'<NA>'"),
            ("o_orderkey % 7 = 5", "CAST(NULL AS string)"),
        ],
        customer,
    )
    orders = readers.read_parquet(spark, f"{d}/orders.parquet", ["o_orderkey", "o_custkey"])
    return orders.select("o_orderkey", clean.text_id(F.expr(dirty)).alias("clean_id"))


def clean_numbers(spark, d):
    dirty = case(
        [
            ("event_id % 6 = 0", "'x'"),
            ("event_id % 6 = 1", "CAST(NULL AS string)"),
            ("event_id % 6 = 2", "'NaN'"),
            ("event_id % 6 = 3", "'Infinity'"),
        ],
        "CAST(value AS string)",
    )
    number = clean.number(F.expr(dirty))
    return lens.events(spark, d).select(
        "event_id",
        F.when(number == float("inf"), -1.0).otherwise(number).alias("number"),
        clean.finite(number).alias("model_value"),
    )


def lenient_dates(spark, d):
    dirty = case(
        [
            ("o_orderkey % 4 = 0", "'not a date'"),
            ("o_orderkey % 4 = 1", "date_format(o_orderdate, 'yyyy-MM-dd')"),
        ],
        "date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss')",
    )
    orders = readers.read_parquet(spark, f"{d}/orders.parquet", ["o_orderkey", "o_orderdate"])
    read = orders.select("o_orderkey", clean.instant(F.expr(dirty)).alias("ts"))
    return read.filter(F.col("ts").isNotNull()).withColumn("day", F.to_date("ts"))


def resolved_columns(spark, d):
    """A header that names conversions and revenue the platform's way."""
    facts = lens.daily_facts(spark, d).withColumnsRenamed(
        {"tracker_conversions": "conversions", "tracker_revenue": "conversions_value"}
    )
    named = readers.resolve_columns(facts)
    return rollup.daily_rollup(rollup.clean_daily(named)).groupBy("local_date").agg(
        F.sum("tracker_conversions").alias("tracker_conversions"),
        F.sum("tracker_revenue").alias("tracker_revenue"),
    )


# -- rollups and extracts ----------------------------------------------------


def local_hour_rollup(spark, d):
    return _hourly(spark, d)


def attach_timezone(spark, d):
    dims = lens.hierarchy(spark, d)
    rows = extract.attach_timezone(lens.hourly_reports(spark, d), dims.accounts)
    return rows.select("date", *ENTITY, "timezone", "account_status")


def tz_match_rate(spark, d):
    dims = lens.hierarchy(spark, d)
    rows = extract.attach_timezone(lens.hourly_reports(spark, d), dims.accounts)
    return rollup.timezone_match_rate(rows)


def daily_rollup(spark, d):
    return _daily(spark, d)


def lifetime_summary(spark, d):
    return rollup.lifetime_summary(_daily(spark, d))


def eligible_ads(spark, d):
    return rollup.eligible_ads(_daily(spark, d))


def eligible_history(spark, d):
    rows = _daily(spark, d)
    return rollup.restrict_to_ads(rows, rollup.eligible_ads(rows, min_days=20)).select(
        "local_date", "ad_id", "spend"
    )


def top_eligible_ads(spark, d):
    return rollup.eligible_ads(_daily(spark, d), top=20)


def extract_hourly(spark, d):
    dims = lens.hierarchy(spark, d)
    anchor = F.lit("2024-01-28 00:00:00").cast("timestamp")
    rows = extract.extract_hourly(
        lens.hourly_reports(spark, d), dims, anchor, lookback_days=8, ad_limit=50
    )
    return rows.select("date", "timezone", *ENTITY, "spend", "impressions", "tracker_revenue")


def extract_daily(spark, d):
    dims = lens.hierarchy(spark, d)
    anchor = F.lit("2024-01-28 00:00:00").cast("timestamp")
    rows = extract.extract_daily(
        lens.daily_facts(spark, d), dims, anchor, lookback_days=21, ad_limit=50,
        account_ids=["0", "1", "3", "4"],
    )
    return rows.select("date", "timezone", *ENTITY, "spend", "impressions", "tracker_revenue")


def _anchor_day():
    return F.lit("2024-01-28 00:00:00").cast("timestamp")


_EXTRACTED = ["date", "timezone", *ENTITY, "spend", "impressions", "tracker_revenue"]


def extract_hourly_all(spark, d):
    rows = extract.extract_hourly(lens.hourly_reports(spark, d), lens.hierarchy(spark, d), _anchor_day())
    return rows.select(*_EXTRACTED)


def extract_daily_all(spark, d):
    rows = extract.extract_daily(lens.daily_facts(spark, d), lens.hierarchy(spark, d), _anchor_day())
    return rows.select(*_EXTRACTED)


def extract_daily_per_account(spark, d):
    rows = extract.extract_daily(
        lens.daily_facts(spark, d), lens.hierarchy(spark, d), _anchor_day(), ads_per_account=3
    )
    return rows.select(*_EXTRACTED)


def top_ads_per_account(spark, d):
    ads = topk.top_ads_per_account(lens.hourly_reports(spark, d), 4)
    return ads.select("account_id", "ad_id", "total_spend", "last_seen")


def csv_by_name(spark, d):
    """Orders written as CSV with two orders and sets of columns, read back by name."""
    orders = spark.read.parquet(f"{d}/orders.parquet")
    path = f"{session.shared_dir(spark)}/csv-{uuid.uuid4().hex}"
    for part, names in enumerate((["o_orderkey", "o_custkey"], ["o_orderstatus", "o_custkey", "o_orderkey"])):
        rows = orders.filter(F.col("o_orderkey") % 2 == part).select(*names)
        rows.write.mode("append").option("header", True).csv(path)
    wanted = T.StructType().add("o_orderkey", "string").add("o_custkey", "string").add("o_orderstatus", "string")
    return readers.read_csv(spark, path, wanted)


def extract_attempts(spark, d):
    """Daily extract whose first attempt, a week before an anchor long after the facts,
    finds nothing; what the second one was made with stands beside its rows."""
    anchor = F.lit("2024-03-10 00:00:00").cast("timestamp")
    facts, dims = lens.daily_facts(spark, d), lens.hierarchy(spark, d)

    def one(days: int, limit: int) -> DataFrame:
        return extract.extract_daily(facts, dims, anchor, days, ads_per_account=limit)

    rows, used = readers.extract_with_fallback(one, attempts=((7, 5), (90, 2)))
    made = {name: F.lit(value) for name, value in used.items()}
    return rows.select("date", "ad_id", "spend").withColumns(made)


def tenant_columns(spark, d):
    """One table of facts read by two tenants that name their metrics differently."""
    facts = lens.daily_facts(spark, d).filter(F.lower("entity_type") == "ad").withColumns(
        {"conversions": F.col("inline_link_clicks"), "conversions_value": F.col("spend")}
    )
    out = []
    for tenant in (config.tracker_tenant("a", "a_"), config.platform_tenant("b", "b_")):
        tables = {tenant.table("daily_breakdown_kpis"): facts}
        rows = readers.tenant_table(tables.__getitem__, tenant, "daily_breakdown_kpis")
        out.append(
            readers.tenant_metrics(rows, tenant, "24h").groupBy("ad_id").agg(
                F.lit(tenant.name).alias("tenant"),
                F.sum("tracker_conversions").alias("conversions"),
                F.sum("tracker_revenue").alias("revenue"),
            )
        )
    return out[0].unionByName(out[1])


def report_round_trip(spark, d):
    """A report written as parquet and CSV, replaced whole and then added to, read back."""
    rows = session.written(rollup.lifetime_summary(_daily(spark, d)).select("ad_id", "full_cum_spend"), "report")
    out, odd = [], F.col("ad_id").cast("int") % 2 == 1
    for fmt in ("parquet", "csv"):
        path = f"{session.shared_dir(spark)}/report-{uuid.uuid4().hex}"
        sinks.write_report(rows, path, fmt)
        sinks.write_report(rows.filter(odd), path, fmt)
        sinks.write_report(rows.filter(~odd), path, fmt, mode="append")
        read = spark.read.parquet(path) if fmt == "parquet" else spark.read.option("header", True).csv(path)
        out.append(read.select(F.lit(fmt).alias("format"), "ad_id", F.col("full_cum_spend").cast("double")))
    return out[0].unionByName(out[1])


def feature_cache(spark, d):
    """Two scopes cached under names of their own; a second job of a scope takes what is
    stored, unless it is told to build anew."""
    rows, out = _daily(spark, d).select("local_date", "ad_id", "spend"), []
    root = f"{session.shared_dir(spark)}/cache-{uuid.uuid4().hex}"
    for scope, part in {"all": rows, "even": rows.filter(F.col("ad_id").try_cast("int") % 2 == 0)}.items():
        path = sinks.feature_cache_path(root, "24h", "2024012800", sinks.run_name(scope))
        sinks.cached_features(spark, lambda part=part: part, path)
        again = sinks.cached_features(spark, lambda: rows.filter("false"), path)
        out.append(again.withColumn("scope", F.lit(scope)))
    path = sinks.feature_cache_path(root, "24h", "2024012800", sinks.run_name("all"))
    sinks.cached_features(spark, lambda: session.written(out[1].drop("scope"), "rebuilt"), path, reuse=False)
    fresh = spark.read.parquet(path).withColumn("scope", F.lit("rebuilt"))
    return out[1].unionByName(fresh)


def scoring_cap(spark, d):
    """All days of the ten largest ads by spend."""
    return topk.keep_top_ads(_daily(spark, d), 10, "local_date").select("local_date", "ad_id", "spend")


def empty_forecast(spark, d):
    """A forecast of no ads, stored: all columns of a full one in order, and no row."""
    none = score.score_24h(score.next_day_features(_daily(spark, d).filter("false"), None))
    path = _forecast_table(spark)
    sinks.write_report(sinks.forecast_rows(none, "24h"), path)
    stored = spark.read.parquet(path)
    fields = [(k, f.name, f.dataType.simpleString()) for k, f in enumerate(stored.schema)]
    return spark.createDataFrame(fields, "place long, name string, type string").withColumn(
        "rows", stored.agg(F.count(F.lit(1)).alias("n")).scalar()
    )


def log_transform(spark, d):
    orders = spark.read.parquet(f"{d}/orders.parquet").withColumn("logged", ratios.to_log(F.col("o_totalprice").cast("double")))
    return orders.select("o_orderkey", "logged", ratios.from_log(F.col("logged")).alias("back"))


def active_rows(spark, d):
    dims = lens.hierarchy(spark, d)
    rows = extract.active_rows(
        lens.hourly_reports(spark, d), dims, ["account", "campaign", "adset", "ad"]
    )
    return rows.select("date", "ad_id", "spend")


def recent_hours(spark, d):
    """Hours since ten days before the newest one; older events are not read."""
    rows = lens.events(spark, d)
    newest = extract.newest_time(rows, "ts").replace(minute=0, second=0, microsecond=0)
    recent = extract.recent_rows(rows, "ts", 10, newest)
    facts = lens.hourly_reports(spark, d, recent).withColumn("timezone", lens.timezone_of(F.col("account_id")))
    return rollup.hourly_rollup(rollup.clean_hourly(facts)).select("hour_idx", "ad_id", "spend")


def rejected_rows(spark, d):
    """Rows and values that cleaning rejects, counted in the pass that writes the rest."""
    user = F.col("ad_id").cast("int")
    stamp = F.date_format("date", "yyyy-MM-dd HH:mm:ss")
    dirty = lens.hourly_facts(spark, d).withColumns(
        {
            "ad_id": F.when(user % 11 == 0, "  ").when(user % 11 != 1, F.col("ad_id")),
            "spend": F.when(user % 7 == 0, "n/a").when(user % 7 != 1, F.col("spend").cast("string")),
            "date": F.when(user % 13 == 0, "soon").when(user % 13 == 1, "1890-01-01 00:00:00").otherwise(stamp),
        }
    )
    counts = Observation("rejected")
    kept = session.written(rollup.clean_hourly(dirty, counts=counts), "kept")
    found = counts.get
    row = spark.createDataFrame([tuple(found.values())], ", ".join(f"{name} long" for name in found))
    return row.withColumn("kept_rows", kept.agg(F.count(F.lit(1)).alias("n")).scalar())


def account_scope(spark, d):
    rows = extract.filter_ids(_daily(spark, d), "account_id", extract.split_ids("1, 4,"))
    return rows.select("local_date", "ad_id", "account_id", "spend")


def top_ads(spark, d):
    ads = topk.top_ads(lens.hourly_reports(spark, d), 20)
    return ads.select("ad_id", "total_spend", "last_seen")


def active_accounts(spark, d):
    return extract.active_accounts(lens.hierarchy(spark, d).accounts)


def eligible_hierarchy(spark, d):
    return extract.eligible_hierarchy(lens.hierarchy(spark, d), lens.schedule(spark, d))


def eligible_in_window(spark, d):
    rows = extract.eligible_hierarchy(lens.hierarchy(spark, d), lens.schedule(spark, d))
    start = F.lit("2024-02-01 00:00:00").cast("timestamp")
    return extract.eligible_in_window(rows, start, start + F.make_interval(hours=F.lit(24)))


def dedupe_sources(spark, d):
    rows = [rollup.daily_rollup(rollup.clean_daily(s)) for s in lens.sources(spark, d)]
    return rollup.merge_sources(rows)


def _two_zone_days(spark, d):
    """Daily rows in which an ad can have two timezones on one day."""
    late = F.col("event_type").isin("purchase", "signup")
    ids = {
        "account_id": F.col("user_id") % 5,
        "campaign_id": F.col("user_id") % 15,
        "adset_id": F.col("user_id") % 45,
        "ad_id": F.col("user_id"),
    }
    rows = lens.events(spark, d).select(
        F.to_date("ts").alias("local_date"),
        F.when(late, "UTC").otherwise("Asia/Kolkata").alias("timezone"),
        *[c.cast("string").alias(n) for n, c in ids.items()],
        F.col("value").cast("decimal(18,2)").alias("spend"),
    )
    return rollup.daily_rollup(rows, ["spend"])


def keep_last(spark, d):
    return rollup.keep_last(_two_zone_days(spark, d), "local_date")


def last_rows(spark, d):
    rows = rollup.last_rows(rollup.keep_last(_daily(spark, d), "local_date"), 16)
    return rows.select("ad_id", "local_date", "spend")


# -- calendars and daily features --------------------------------------------


def daily_dense(spark, d):
    return grid.dense_days(_daily(spark, d))


def dense_fill(spark, d):
    """Ids and timezone carried forward over gaps, from rows whose timezone varies."""
    return grid.dense_days(_two_zone_days(spark, d), ["spend"])


def scoring_frame(spark, d):
    return grid.scoring_days(_daily(spark, d), 16)


def _daily_part(spark, d, names):
    return _dense_features(spark, d).select("local_date", "ad_id", *names)


def daily_lags(spark, d):
    return _daily_part(spark, d, [n for n in daily.daily_feature_names() if "_lag_" in n or "weekday" in n])


def daily_rolls(spark, d):
    return _daily_part(spark, d, [n for n in daily.daily_feature_names() if "_roll_" in n])


def daily_signals(spark, d):
    return _daily_part(spark, d, [f"{s}_{n}d" for s in daily.SIGNALS for n in (7, 14)])


def daily_cum(spark, d):
    return _daily_part(spark, d, daily.BASE_FEATURES[3:])


def daily_cum_inclusive(spark, d):
    rows = daily.daily_features(grid.dense_days(_daily(spark, d)), inclusive_totals=True)
    return rows.select("local_date", "ad_id", *daily.BASE_FEATURES[3:])


def daily_trends(spark, d):
    names = [f"{m}_trend_3d_vs_7d" for m in METRICS] + daily.QUALITY
    return _daily_part(spark, d, names)


def daily_features(spark, d):
    """The training rows: all 84 features and the targets."""
    rows = daily.with_targets(_dense_features(spark, d).filter("days_active >= 8"))
    targets = [f"target_24h_{x}" for x in [*METRICS, *KPIS]]
    return rows.select("local_date", "ad_id", *daily.daily_feature_names(), *targets)


def wide_features(spark, d):
    rows = daily.wide_daily_features(grid.dense_days(_daily(spark, d)))
    return rows.select("local_date", "ad_id", *daily.wide_feature_names())


def hierarchy_rolls(spark, d):
    return daily.hierarchy_rolls(grid.dense_days(_daily(spark, d)))


def next_day_features(spark, d):
    rows = _daily(spark, d)
    out = score.next_day_features(rows, 16, rollup.lifetime_summary(rows))
    return out.select(
        "local_date", "history_cutoff_local_date", "ad_id", *daily.daily_feature_names()
    )


# -- hourly anchors ----------------------------------------------------------


def anchors_latest(spark, d):
    rows = hourly.calendar_features(hourly.latest_anchors(_windows(spark, d)))
    return rows.select(*ANCHOR_KEYS, "timezone", "anchor_ts", *hourly.CALENDAR_FEATURES)


def trailing_sums(spark, d):
    names = [f"{m}_sum_{w}h" for m in METRICS for w in hourly.WINDOWS]
    return _every_anchor(spark, d).select(
        *ANCHOR_KEYS, "observed_history_hours", "observed_recent_24h", *names
    )


def same_window_history(spark, d):
    names = [f"{m}_same_target_6h_d{n}" for m in METRICS for n in hourly.SAME_WINDOW_DAYS]
    return _every_anchor(spark, d).select(*ANCHOR_KEYS, *names)


def same_window_stats(spark, d):
    names = [f"{m}_same_6h_7d_{s}" for m in METRICS for s in hourly.STATS]
    return hourly.same_window_stats(_every_anchor(spark, d)).select(*ANCHOR_KEYS, *names)


def future_target(spark, d):
    return _every_anchor(spark, d).select(
        *ANCHOR_KEYS, *[f"{m}_cum" for m in METRICS], *[f"target_{m}" for m in METRICS]
    )


def train_anchors(spark, d):
    rows = hourly.training_anchors(_windows(spark, d), TRAIN_ANCHORS)
    return rows.select(*ANCHOR_KEYS, "observed_history_hours", *[f"target_{m}" for m in METRICS])


def hourly_features(spark, d):
    """All 289 features at the training anchors."""
    rows = hourly.hourly_features(hourly.training_anchors(_windows(spark, d), TRAIN_ANCHORS))
    return rows.select("anchor_idx", "ad_id", *hourly.hourly_feature_names())


# -- ratios, peers, labels, serving ------------------------------------------


def kpis(spark, d):
    return daily.kpi_columns(_daily(spark, d)).select("local_date", "ad_id", *daily.KPI_COLUMNS)


def kpis_fill(spark, d):
    """Gaps of partly given KPIs: no impressions is a gap, ROAS is given when even."""
    values = {SHORT[m]: m for m in METRICS} | {k: "CAST(NULL AS double)" for k in KPIS}
    values["impressions"] = "CASE WHEN impressions > 0 THEN impressions END"
    values["conversions"] = "CASE WHEN tracker_conversions > 0 THEN tracker_conversions END"
    values["roas"] = "CASE WHEN inline_link_clicks = 0 THEN 1.5D END"
    given = pick(_daily(spark, d), ["local_date", "ad_id"], values)
    filled = ratios.fill_kpis({name: f"{name}" for name in values})
    return pick(given, ["local_date", "ad_id"], {k: filled[k] for k in KPIS})


def _day_peers(spark, d):
    frame = score.recent_mean(_all_day_features(spark, d))
    values = {m: f"{m}_roll_mean_7d" for m in METRICS}
    return peers.peer_means(frame, values, 2, ["local_date"])


def peer_benchmark(spark, d):
    names = [f"{m}_{level}_peer" for m in METRICS for level in peers.LEVELS]
    return _day_peers(spark, d).select("local_date", *ENTITY, *names)


def hierarchical_choice(spark, d):
    frame = score.recent_mean(_all_day_features(spark, d))
    out = peers.choose_hierarchical(
        frame,
        "pred_24h_tracker_revenue",
        "tracker_revenue_roll_mean_7d",
        "days_active < 8",
        "forecast",
        within=["local_date"],
    )
    return out.select("local_date", "ad_id", "forecast", "forecast_source")


def source_mode(spark, d):
    sources = {f"source_{m}": peers.fallback_source(m) for m in METRICS}
    rows = pick(_day_peers(spark, d), ["local_date", "ad_id"], sources)
    return pick(rows, ["local_date", "ad_id"], {"source": recommend.most_common(list(sources))})


def history_segments(spark, d):
    rows = recommend.history_columns(_all_day_features(spark, d))
    names = [n for n in rows.columns if n.startswith("history_") and not n.endswith("date")]
    return rows.select("local_date", "ad_id", "days_active", *names, "spike_risk", "forecast_data_quality")


def confidence_24h(spark, d):
    return _recommended(spark, d).select(
        "local_date",
        "ad_id",
        "history_segment",
        "forecast_confidence",
        "kpi_reliability_flag",
        "forecast_use_case",
        "forecast_note",
    )


def ranges_24h(spark, d):
    return _recommended(spark, d).select(
        "local_date",
        "ad_id",
        "benchmark_source",
        *[f"recommended_24h_{x}" for x in [*METRICS, *KPIS]],
        *[f"pred_24h_{m}_{e}" for m in METRICS for e in ("p10", "p90")],
        *[f"recommended_24h_roas_{e}" for e in ("p10", "p50", "p90")],
    )


def _recommended_6h(spark, d):
    features = hourly.hourly_features(_every_anchor(spark, d))
    # Half as much again as the same hours held, so that guards have work.
    frame = add(features, {f"pred_6h_{m}": f"{m}_same_6h_7d_mean * 1.5D" for m in METRICS})
    return recommend.recommend_6h(
        frame, SMALL_GUARDS, ENOUGH_ANCHORS, within=["anchor_idx"]
    )


def guards_6h(spark, d):
    return _recommended_6h(spark, d).select(
        "anchor_idx",
        "ad_id",
        *[f"recommended_6h_{m}" for m in METRICS],
        *[f"recommended_6h_{m}_source" for m in METRICS],
        "benchmark_source",
        "forecast_status",
        "forecast_confidence",
        "forecast_use_case",
        "recently_active",
        *[f"recommended_6h_{k}" for k in ("roas", "profit", "ctr", "cvr", "cpm")],
    )


def forecast_rows(spark, d):
    scored = score.score_24h(
        score.next_day_features(_daily(spark, d), None), model_source="recent_mean"
    )
    rows = sinks.forecast_rows(scored, "24h", F.lit("2024-02-01 00:00:00").cast("timestamp"))
    return rows


def forecast_schema(spark, d):
    """Name, type and place of the columns of the forecast table."""
    schema = forecast_rows(spark, d).schema
    rows = [(k, f.name, f.dataType.simpleString()) for k, f in enumerate(schema)]
    return spark.createDataFrame(rows, "place long, name string, type string")


def _forecast_table(spark) -> str:
    return f"{session.shared_dir(spark)}/forecasts-{uuid.uuid4().hex}"


def forecast_append(spark, d):
    """Two runs share a day; one of them is run again for fewer ads."""
    path, ad = _forecast_table(spark), F.col("ad_id").cast("int")
    rows = session.written(forecast_rows(spark, d), "forecasts")
    sinks.write_forecasts(rows, path, "first")
    sinks.write_forecasts(rows.filter(ad % 3 == 0), path, "second")
    again = rows.filter(ad % 2 == 0).withColumn("result_spend", F.col("result_spend") + 1)
    sinks.write_forecasts(session.written(again, "forecasts"), path, "first")
    stored = sinks.read_forecasts(spark, path, horizon="24h")
    return stored.select("forecast_horizon", "forecast_local_date", "ad_id", "result_spend", "result_roas")


def schema_evolution(spark, d):
    """Rows written before there were ranges, and with a column that has gone since."""
    path, ad = _forecast_table(spark), F.col("ad_id").cast("int")
    rows = session.written(forecast_rows(spark, d), "forecasts")
    ranges = [c for c in rows.columns if c.endswith(("_p10", "_p90"))]
    old = rows.filter(ad % 2 == 0).drop(*ranges).withColumn("payload", F.lit("{}"))
    sinks.write_forecasts(old, path, "old")
    sinks.write_forecasts(rows.filter(ad % 2 == 1), path, "new")
    return sinks.read_forecasts(spark, path).select(
        "forecast_local_date", "ad_id", "result_spend", "result_spend_p10", "result_spend_p90"
    )


def clustered_hours(spark, d):
    """The hourly rollup stored by ad, and each ad's hour before, read without a shuffle."""
    name = f"hours_{uuid.uuid4().hex}"
    stored = clustered.write_clustered(
        _hourly(spark, d), name, f"{session.shared_dir(spark)}/{name}", ["ad_id"], ["hour_idx"], 8
    )
    before = F.lag("spend").over(Window.partitionBy("ad_id").orderBy("hour_idx"))
    return stored.select("hour_idx", "ad_id", "spend", before.alias("previous_spend"))


def forecast_rows_6h(spark, d):
    scored = score.score_6h(
        score.latest_features_6h(_hourly(spark, d)), anchors=ENOUGH_ANCHORS,
        model_source="same_window_mean",
    )
    return sinks.forecast_rows(
        scored, "6h", F.lit("2024-02-01 00:00:00").cast("timestamp"), ranges=False
    )


def forecast_6h(spark, d):
    """Next-6-hour forecast with hierarchical fallback, from raw reports."""
    out = score.forecast_6h(
        lens.hourly_facts(spark, d), recent_days=None, anchors=ENOUGH_ANCHORS
    )
    return out.select(
        "anchor_ts",
        "forecast_window_start",
        "forecast_window_end",
        "timezone",
        *ENTITY,
        "observed_history_hours",
        "observed_recent_24h",
        *[f"recommended_6h_{m}" for m in METRICS],
        *[f"recommended_6h_{m}_source" for m in METRICS],
        "benchmark_source",
        "forecast_status",
        *[f"recommended_6h_{k}" for k in ("roas", "profit", "ctr", "cvr", "cpm")],
    )


def forecast_24h(spark, d):
    """Next-day forecast from raw daily facts."""
    return score.forecast_24h(lens.daily_facts(spark, d)).select(
        "forecast_anchor_local_date",
        "history_cutoff_local_date",
        *ENTITY,
        "days_active",
        "history_segment",
        "benchmark_source",
        *[f"recommended_24h_{m}" for m in METRICS],
    )


def payload_json(spark, d):
    """Feature payload written as JSON and read back."""
    rows = _daily(spark, d).withColumn(
        "payload", sinks.payload_json(_daily(spark, d), ["ad_id", "impressions"])
    )
    kind = T.StructType(
        [T.StructField("ad_id", T.StringType()), T.StructField("impressions", T.DoubleType())]
    )
    parsed = sinks.read_payload(F.col("payload"), kind)
    return rows.select(
        "local_date", parsed["ad_id"].alias("ad_id"), parsed["impressions"].alias("impressions")
    )


# -- calibration and quality -------------------------------------------------


def prediction_segment(spark, d):
    return _segmented(spark, d).select("local_date", "ad_id", "split", "prediction_segment")


def calibration_factors(spark, d):
    table = calibration.factor_table(_valid_rows(spark, d))
    label = F.coalesce("bucket", "segment", F.lit("all"))
    return table.filter(F.col("level").isin("global", "bucket", "segment")).select(
        "target", "level", label.alias("label"), "rows", "factor"
    )


def entity_factors(spark, d):
    table = calibration.factor_table(_valid_rows(spark, d))
    return table.filter(F.col("level").isin("account", "campaign", "ad")).select(
        "target",
        "level",
        *[F.coalesce(c, F.lit("")).alias(c) for c in ("account_id", "campaign_id", "ad_id")],
        "rows",
        "factor",
    )


def range_ratios(spark, d):
    return calibration.range_table(_valid_rows(spark, d))


def fallback_caps(spark, d):
    return calibration.cap_table(_valid_rows(spark, d))


def calibrated(spark, d):
    return _backtest(spark, d).select(
        "local_date",
        "ad_id",
        *[f"pred_calibrated_24h_{m}" for m in METRICS],
        *[f"pred_{e}_24h_{m}" for m in METRICS for e in ("p10", "p90")],
    )


def backtest_flags(spark, d):
    return _backtest(spark, d).select(
        "local_date",
        "ad_id",
        "split",
        "prediction_segment",
        "kpi_reliability_flag",
        *[f"gap_24h_{m}" for m in METRICS],
    )


def regression_metrics(spark, d):
    return metrics.backtest_metrics(_backtest(spark, d))


def metrics_by_anchor(spark, d):
    rows = hourly.hourly_features(_every_anchor(spark, d))
    rows = score.same_window_mean(rows)
    pairs = {f"target_{m}": (f"target_{m}", f"pred_6h_{m}") for m in METRICS}
    long = metrics.target_rows(rows, ["anchor_hour"], pairs)
    return metrics.metrics_by_anchor(long, ["target"], "actual", "predicted").drop(
        "underprediction_rate"
    )


def quality_monitor(spark, d):
    table = session.written(_backtest(spark, d), "backtest")
    return metrics.quality_monitor(table)


def quality_monitor_calibrated(spark, d):
    return _monitored(spark, d, "calibrated")


def quality_monitor_base(spark, d):
    return _monitored(spark, d, "base")


def _monitored(spark, d, mode):
    """Quality by one prediction family; the table has what was served as well."""
    table = session.written(_backtest(spark, d), "backtest")
    served = {f"recommended_24h_{m}": f"2D * pred_24h_{m}" for m in [*METRICS, *KPIS]}
    return metrics.quality_monitor(add(table, served), mode)


def account_summary(spark, d):
    return metrics.account_summary(_backtest(spark, d))


def headline_counts(spark, d):
    return metrics.headline_counts(_backtest(spark, d))


def run_counts(spark, d):
    scored = score.score_6h(
        score.latest_features_6h(_hourly(spark, d)), anchors=ENOUGH_ANCHORS
    )
    return metrics.run_counts(scored, "forecast_status", "anchor_ts")


# -- samples and models ------------------------------------------------------


def time_split(spark, d):
    rows = train.daily_samples([lens.daily_facts(spark, d)])
    return samples.time_split(rows, "local_date").groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("local_date").alias("first_day"),
        F.max("local_date").alias("last_day"),
    )


def sample_weights(spark, d):
    rows = session.written(train.daily_samples([lens.daily_facts(spark, d)]), "samples")
    weights = [
        samples.sample_weight(rows, m, RECENCY_START, revenue_focus=True).alias(f"weight_{m}")
        for m in METRICS
    ]
    return rows.select("local_date", "ad_id", *weights)


def revenue_clip(spark, d):
    rows = train.daily_samples([lens.daily_facts(spark, d)])
    clipped = samples.clipped_target(rows, "tracker_revenue", revenue_focus=True)
    return rows.select("local_date", "ad_id", clipped.alias("training_revenue"))


def best_model(spark, d):
    """The better of two stand-ins per target by R2 on the test days."""
    rows = _scored_days(spark, d).filter("split = 'test'")
    tables = {}
    for name, suffix in (("mean_7d", "recent_mean_7d"), ("last_day", "recent_lag_1d")):
        pairs = {f"target_24h_{m}": (f"target_24h_{m}", f"{m}_{suffix}") for m in METRICS}
        long = metrics.target_rows(rows, ["split"], pairs)
        tables[name] = metrics.regression_metrics(long, ["target", "split"], "actual", "predicted")
    names = {f"target_24h_{m}": SHORT[m] for m in METRICS}
    return metrics.selection_report(tables, names)


# Test settings: boosting rounds of the fits below. The jobs use the full numbers.
TEST_ROUNDS_24H, TEST_ROUNDS_6H = 5, 3


def _models(spark):
    """A folder of its own for every run."""
    return f"{session.shared_dir(spark)}/models-{uuid.uuid4().hex}"


def _fitted_24h(spark, d, path):
    rows = session.written(train.daily_samples([lens.daily_facts(spark, d)]), "samples")
    return train.train_24h(
        rows, path, TRAIN_END, VALID_END, RECENCY_START, iterations=TEST_ROUNDS_24H
    )


def fit_predict_24h(spark, d):
    out = _fitted_24h(spark, d, _models(spark))
    return out.select("local_date", "ad_id", "split", *[f"pred_24h_{m}" for m in METRICS])


def prediction_checks(spark, d):
    """Per split the rows and how many have five finite predictions that are not
    negative, also after the models were read again."""
    path = _models(spark)
    out = _fitted_24h(spark, d, path)
    names = [f"pred_24h_{m}" for m in METRICS]
    good = " AND ".join(f"{n} >= 0 AND {n} < double('infinity')" for n in names)
    again = score.model_24h(models.Routing.single(path))(out.drop(*names))
    kept = [F.count(F.lit(1)).alias("rows"), F.count_if(F.expr(good)).alias("good")]
    first = out.groupBy("split").agg(*kept)
    second = again.groupBy("split").agg(F.count_if(F.expr(good)).alias("good_again"))
    return first.join(second, "split").select("split", "rows", "good", "good_again")


def model_metadata(spark, d):
    """What the daily model folder says about itself."""
    path = _models(spark)
    _fitted_24h(spark, d, path)
    rows = spark.read.schema(
        "feature_cols array<string>, target_cols array<string>, settings map<string,string>"
    ).json(f"{path}/metadata")
    settings = [F.col("settings")[n].alias(n) for n in ("train_end", "train_last", "valid_last", "test_last")]
    return rows.select(
        F.size("feature_cols").alias("features"), F.size("target_cols").alias("targets"), *settings,
        F.lit(models.is_ready(spark, path)).alias("ready"),
    )


def fit_predict_6h(spark, d):
    path = _models(spark)
    out = train.train_6h(_hourly_samples(spark, d), path, iterations=TEST_ROUNDS_6H)
    return out.select("anchor_ts", "ad_id", "split", *[f"pred_6h_{m}" for m in METRICS])


def _hourly_samples(spark, d):
    return session.written(train.hourly_samples(lens.hourly_facts(spark, d), TRAIN_ANCHORS), "samples")


def objective_search(spark, d):
    table, _ = train.search_6h(_hourly_samples(spark, d), _models(spark), iterations=TEST_ROUNDS_6H)
    return table


def training_rows(spark, d):
    """The hourly training rows per part of the split."""
    rows = samples.time_split(_hourly_samples(spark, d), "anchor_ts", at_least_first=True)
    return rows.groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("anchor_ts").alias("first_anchor"),
        F.max("anchor_ts").alias("last_anchor"),
        F.sum("target_tracker_revenue").alias("revenue"),
    )


def search_choice(spark, d):
    """Per target the candidates tried, the rows they were judged by, and whether the one
    its folder names is that with the best validation R2, with the settings it was tried with."""
    path = _models(spark)
    table, _ = train.search_6h(_hourly_samples(spark, d), path, iterations=TEST_ROUNDS_6H)
    kept, tried = models.chosen_candidates(spark, path), {
        (f"target_{m}", c.name): c.limited(TEST_ROUNDS_6H) for m, grid in models.SEARCH.items() for c in grid
    }
    rows = [(t, c.name, c == tried[t, c.name]) for t, c in kept.items()]
    chosen = spark.createDataFrame(rows, "target string, chosen string, same_settings boolean")
    valid = F.col("split") == "valid"
    judged = table.groupBy("target").agg(
        F.countDistinct("candidate").alias("candidates"),
        F.max(F.when(valid, F.col("rows"))).cast("long").alias("valid_rows"),
        F.max(F.when(~valid, F.col("rows"))).cast("long").alias("test_rows"),
        F.max(F.when(valid, F.col("r2"))).alias("best_r2"),
    )
    own = table.filter(valid).select("target", F.col("candidate").alias("chosen"), "r2")
    return judged.join(chosen, "target").join(own, ["target", "chosen"]).select(
        "target", "candidates", "valid_rows", "test_rows", "same_settings",
        (F.col("r2") == F.col("best_r2")).alias("chosen_is_best"),
    )


def routing_checks(spark, d):
    """Sparse targets from the search's folder and the others from the main one, both read
    again: rows with finite predictions, and rows that each folder alone predicts alike."""
    rows, main, sparse = _hourly_samples(spark, d), _models(spark), _models(spark)
    fitted = session.written(train.train_6h(rows, main, iterations=TEST_ROUNDS_6H), "fitted")
    train.search_6h(rows, sparse, iterations=TEST_ROUNDS_6H)
    routing = jobs.routing_6h(main, sparse)
    names = {m: f"pred_6h_{m}" for m in METRICS}
    targets = {m: f"target_{m}" for m in METRICS}
    routed = score.model_6h(routing)(fitted.withColumnsRenamed({n: f"main_{n}" for n in names.values()}))
    only = models.Routing({m: sparse for m in SPARSE})
    alone = {m: f"alone_{m}" for m in SPARSE}
    routed = models.predict_targets(routed, only, targets, alone, exponent_bound=20.0)
    good = " AND ".join(f"{n} >= 0 AND {n} < double('infinity')" for n in names.values())
    dense = " AND ".join(f"abs({names[m]} - main_{names[m]}) <= 1e-9 * (1 + {names[m]})" for m in METRICS if m not in SPARSE)
    thin = " AND ".join(f"{names[m]} = {alone[m]}" for m in SPARSE)
    return routed.groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.expr(good)).alias("good"),
        F.count_if(F.expr(dense)).alias("from_main"),
        F.count_if(F.expr(thin)).alias("from_search"),
    )


# -- points and documents ----------------------------------------------------


def range_scan(spark, d):
    rows = points.range_scan(
        lens.points(spark, d),
        "purchase",
        F.lit("2024-01-05 00:00:00").cast("timestamp"),
        F.lit("2024-01-15 00:00:00").cast("timestamp"),
        tags={"account_id": "2"},
    )
    return rows.select("event_id", "ts", F.col("tags")["ad_id"].alias("ad_id"))


def list_measurements(spark, d):
    return points.list_measurements(lens.points(spark, d))


def find_page(spark, d):
    orders = spark.read.parquet(f"{d}/orders.parquet")
    return points.find_all(
        orders,
        {"o_orderstatus": "F"},
        sort=[("o_totalprice", -1), ("o_orderkey", 1)],
        skip=20,
        limit=50,
        projection={"o_orderkey": 1, "o_custkey": 1, "o_totalprice": 1},
    )


def find_after(spark, d):
    """All that comes after the first rows: no page, so no top-k."""
    orders = spark.read.parquet(f"{d}/orders.parquet")
    return points.find_all(
        orders,
        {"o_orderstatus": "F"},
        sort=[("o_totalprice", -1), ("o_orderkey", 1)],
        skip=500,
        projection={"o_orderkey": 1, "o_totalprice": 1},
    )


def count_matching(spark, d):
    orders = spark.read.parquet(f"{d}/orders.parquet")
    return points.count_matching(orders, {"o_orderstatus": "F"})


_NAMES = [
    "clean_ids",
    "clean_numbers",
    "lenient_dates",
    "resolved_columns",
    "local_hour_rollup",
    "attach_timezone",
    "tz_match_rate",
    "daily_rollup",
    "lifetime_summary",
    "eligible_ads",
    "eligible_history",
    "top_eligible_ads",
    "extract_hourly",
    "extract_daily",
    "active_rows",
    "extract_hourly_all",
    "extract_daily_all",
    "extract_daily_per_account",
    "top_ads_per_account",
    "csv_by_name",
    "log_transform",
    "recent_hours",
    "account_scope",
    "top_ads",
    "active_accounts",
    "eligible_hierarchy",
    "eligible_in_window",
    "dedupe_sources",
    "keep_last",
    "last_rows",
    "daily_dense",
    "dense_fill",
    "scoring_frame",
    "daily_lags",
    "daily_rolls",
    "daily_signals",
    "daily_cum",
    "daily_cum_inclusive",
    "daily_trends",
    "daily_features",
    "wide_features",
    "hierarchy_rolls",
    "next_day_features",
    "anchors_latest",
    "trailing_sums",
    "same_window_history",
    "same_window_stats",
    "future_target",
    "train_anchors",
    "hourly_features",
    "kpis",
    "kpis_fill",
    "peer_benchmark",
    "hierarchical_choice",
    "source_mode",
    "history_segments",
    "confidence_24h",
    "ranges_24h",
    "guards_6h",
    "forecast_rows",
    "forecast_rows_6h",
    "forecast_6h",
    "forecast_24h",
    "payload_json",
    "prediction_segment",
    "calibration_factors",
    "entity_factors",
    "range_ratios",
    "fallback_caps",
    "calibrated",
    "backtest_flags",
    "regression_metrics",
    "metrics_by_anchor",
    "quality_monitor",
    "quality_monitor_calibrated",
    "quality_monitor_base",
    "account_summary",
    "headline_counts",
    "run_counts",
    "time_split",
    "sample_weights",
    "revenue_clip",
    "best_model",
    "fit_predict_24h",
    "prediction_checks",
    "model_metadata",
    "fit_predict_6h",
    "objective_search",
    "range_scan",
    "list_measurements",
    "find_page",
    "count_matching",
    "find_after",
    "rejected_rows",
    "forecast_schema",
    "forecast_append",
    "schema_evolution",
    "clustered_hours",
    "extract_attempts",
    "tenant_columns",
    "report_round_trip",
    "feature_cache",
    "scoring_cap",
    "empty_forecast",
    "training_rows",
    "search_choice",
    "routing_checks",
]


# Sums of long columns of doubles: shown with fewer digits.
_SUMMED = {
    name: 4
    for name in (
        "quality_monitor",
        "quality_monitor_calibrated",
        "quality_monitor_base",
        "regression_metrics",
        "metrics_by_anchor",
        "account_summary",
        "best_model",
    )
}


def registered() -> dict:
    def runner(name):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            session.prepare(spark)
            return portable(globals()[name](spark, sf_dir), _SUMMED.get(name, 6))

        return run

    return {name: runner(name) for name in _NAMES}
