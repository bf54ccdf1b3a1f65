"""Sinks, extracts, models, the stream and the shape of plans."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F, types as T

from kpicast import session
from kpicast.config import AnchorRules, platform_tenant, tracker_tenant
from kpicast.names import METRICS
from kpicast.operators import hourly, models, rollup
from kpicast.plans import score, train
from kpicast.schema import FORECAST, FORECAST_RANGES, SCHEDULE
from kpicast.sources import extract, lens, points, readers, sinks
from kpicast.streaming.rollup import read_hourly_rollup, start_hourly_rollup
from registry.queries import registered

SF = "/root/testdata/sf0.001"


def scored_24h(spark):
    rows = rollup.daily_rollup(rollup.clean_daily(lens.daily_facts(spark, SF)))
    return score.score_24h(score.next_day_features(rows, summary=rollup.lifetime_summary(rows)))


def test_forecast_table_grows_and_keeps_old_rows(spark, tmp_path):
    path = str(tmp_path / "forecasts")
    old = spark.createDataFrame(
        [("24h", "old", dt.date(2023, 1, 1), '{"a": 1}', 5.0)],
        "forecast_horizon string, ad_id string, forecast_local_date date, payload string, result_spend double",
    )
    old.write.partitionBy("forecast_horizon", "forecast_local_date").parquet(path)
    rows = sinks.forecast_rows(scored_24h(spark), "24h")
    sinks.write_forecasts(rows, path)
    stored = sinks.read_forecasts(spark, path)
    assert stored.columns == [f.name for f in [*FORECAST, *FORECAST_RANGES]]
    assert stored.count() == 1 + rows.count()
    assert stored.filter("ad_id = 'old'").first()["result_spend"] == 5.0
    assert sinks.screening(stored, 3).count() == 3
    assert len(FORECAST) == 42


def test_ranges_hold_the_served_value(spark):
    rows = sinks.forecast_rows(scored_24h(spark), "24h")
    for m in ("spend", "impressions", "clicks", "conversions", "revenue", "roas"):
        assert rows.filter(f"NOT (result_{m}_p10 <= result_{m} AND result_{m} <= result_{m}_p90)").count() == 0


def test_windows_are_true_instants(spark):
    scored = spark.createDataFrame(
        [("1", "Asia/Kolkata", dt.datetime(2024, 1, 5, 6)), ("2", "Not/AZone", dt.datetime(2024, 1, 5, 6))],
        "ad_id string, timezone string, anchor_ts timestamp_ntz",
    ).withColumn("forecast_window_start", F.timestamp_add("HOUR", F.lit(1), "anchor_ts"))
    got = {r["ad_id"]: r for r in sinks.forecast_rows(scored, "6h").withColumns(
        {c: F.date_format(c, "dd HH:mm") for c in ("forecast_anchor", "forecast_window_start", "forecast_window_end")}
    ).collect()}
    assert [got["1"][c] for c in ("forecast_anchor", "forecast_window_start", "forecast_window_end")] == ["05 00:30", "05 01:30", "05 07:30"]
    assert got["2"]["forecast_anchor"] == "05 06:00"
    assert got["1"]["forecast_window_end_local"] == dt.datetime(2024, 1, 5, 13)
    assert got["1"]["result_spend"] is None and got["1"]["recently_active"] is None


def test_report_formats(spark, tmp_path):
    df = spark.range(3)
    for fmt in ("parquet", "csv"):
        path = str(tmp_path / fmt)
        sinks.write_report(df, path, fmt)
        sinks.write_report(df, path, fmt)
        sinks.write_report(df, path, fmt, "append")
        assert spark.read.option("header", True).format(fmt).load(path).count() == 6


def test_tenants(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0, 4.0)], ["conversions", "conversions_value", "tracker_conversions", "tracker_revenue"])
    own = readers.tenant_metrics(df, platform_tenant("b"), "24h").first()
    assert (own["tracker_conversions"], own["tracker_revenue"]) == (1.0, 2.0)
    tenant = tracker_tenant("a", "a_")
    kept = readers.tenant_metrics(df, tenant, "6h").first()
    assert (kept["tracker_conversions"], kept["tracker_revenue"]) == (3.0, 4.0)
    assert readers.tenant_table(lambda name: name, tenant, "traffic_source_ads") == "a_traffic_source_ads"


def small_hierarchy(spark):
    status = "id string, status string"
    return extract.Hierarchy(
        spark.createDataFrame(
            [("1", "c", "s", "f", "Active", "UTC"), ("1", "c", "s", "f", "active", "Asia/Kolkata"), ("2", "c", "s", "f", None, "UTC")],
            "id string, company_id string, traffic_source_id string, traffic_source_config_id string, status string, timezone string",
        ),
        spark.createDataFrame([("1", "ACTIVE"), ("2", "paused")], status),
        spark.createDataFrame([("1", "ACTIVE")], status),
        spark.createDataFrame([(str(i), "1", "1", "1", "ACTIVE") for i in range(4)], "id string, adset_id string, campaign_id string, account_id string, status string"),
    )


def small_reports(spark):
    t = dt.datetime(2024, 1, 10)
    rows = [(t - dt.timedelta(days=d), "1.0", "c", "s", "f", camp, "1", ad, spend)
            for d, camp, ad, spend in [(0, "1", "0", 5.0), (8, "1", "0", 1.0), (9, "1", "0", 99.0), (1, "2", "0", 50.0), (1, "1", "1", 6.0), (1, "1", "2", 3.0), (1, "1", None, 9.0)]]
    return spark.createDataFrame(
        rows, "date timestamp, account_id string, company_id string, traffic_source_id string, traffic_source_config_id string, "
        "campaign_id string, adset_id string, ad_id string, spend double",
    )


@pytest.mark.parametrize("limit, want", [(0, {"0": 2, "1": 1, "2": 1}), (2, {"0": 2, "1": 1}), (1, {"0": 2})])
def test_hourly_extract(spark, limit, want):
    got = extract.extract_hourly(
        small_reports(spark), small_hierarchy(spark), F.lit("2024-01-10").cast("timestamp"), 8, limit
    )
    # Both spend 6 in the period; the later row wins the tie.
    assert {r["ad_id"]: r["count"] for r in got.groupBy("ad_id").count().collect()} == want
    assert {r["timezone"] for r in got.collect()} == {"UTC"}


def test_eligibility_by_schedule(spark):
    day = lambda d: dt.datetime(2024, 2, d)
    dims = small_hierarchy(spark)
    ads = dims.ads.withColumn("status", F.when(F.col("id") == "0", "ACTIVE"))
    dims = extract.Hierarchy(dims.accounts.limit(1), dims.campaigns, dims.adsets, ads)
    schedule = spark.createDataFrame([("1", day(2), None), ("2", day(3), None), ("3", day(2), day(1))], SCHEDULE)
    rows = extract.eligible_hierarchy(dims, schedule)
    got = extract.eligible_in_window(rows, F.lit(day(2)), F.lit(day(3)))
    assert sorted(r["ad_id"] for r in got.collect()) == ["0", "1"]
    assert extract.eligible_hierarchy(dims).schema == rows.schema


def test_points_and_pages(spark):
    rows = spark.range(10).select("id", (F.col("id") % 3).alias("g"))
    page = points.find_all(rows, {"g": 0}, [("id", -1)], limit=2, skip=1, projection={"g": 0})
    assert [r["id"] for r in page.collect()] == [6, 3] and page.columns == ["id"]
    assert points.find_one(rows, {"id": 4}).first()["g"] == 1
    assert points.count_matching(rows, {"g": None}).first()["count"] == 0
    with pytest.raises(ValueError):
        points.find_all(rows, sort=[("id", 2)])
    data = lens.points(spark, SF)
    full = points.range_scan(data, "view", F.lit("2024-01-01").cast("timestamp"), fields={"value": 1.63})
    assert all(r["fields"]["value"] == 1.63 and r["measurement"] == "view" for r in full.collect())


def test_written_tables_need_a_shared_folder(spark):
    got = session.written(spark.range(5), "numbers")
    assert got.count() == 5 and session.shared_dir(spark) in got.inputFiles()[0]


def test_models_reload_and_route(spark, tmp_path):
    rows = session.written(train.hourly_samples(lens.hourly_facts(spark, SF), AnchorRules(min_observed_hours=8)), "s")
    path = str(tmp_path / "m")
    small = {m: models.TreeParams(iterations=2, depth=2, min_rows=1) for m in METRICS}
    first = train.train_6h(rows, path, trees=small)
    routing = models.Routing({**{m: path for m in METRICS}})
    again = score.model_6h(routing)(rows)
    keys = ["anchor_idx", "ad_id", *[f"pred_6h_{m}" for m in METRICS]]
    assert sorted(first.select(*keys).collect()) == sorted(again.select(*keys).collect())
    assert models.read_metadata(spark, path)["feature_cols"] == hourly.hourly_feature_names()
    assert models.is_ready(spark, path)
    models.mark_ready(spark, path, sampled=True)
    assert not models.is_ready(spark, path)
    with pytest.raises(models.NotReady):
        score.model_6h(routing)(rows)
    models.mark_ready(spark, path, sampled=False)
    assert models.is_ready(spark, path)
    served = score.score_6h(score.latest_features_6h(rollup.hourly_rollup(rollup.clean_hourly(lens.hourly_facts(spark, SF)))), score.model_6h(routing))
    assert served.count() == 15 and served.filter("pred_6h_spend < 0").count() == 0


def test_stream_equals_batch(spark, tmp_path):
    facts = lens.hourly_facts(spark, SF).withColumn("timezone", F.coalesce("timezone", F.lit("")))
    source = str(tmp_path / "in")
    money = {c: F.col(c).cast("double") for c in ("spend", "tracker_revenue")}
    late = F.col("date") > "2024-01-12"
    for number, part in enumerate((~late, late)):
        facts.withColumns(money).filter(part).write.mode("append").parquet(source)
        stream = spark.readStream.schema(spark.read.parquet(source).schema).parquet(source)
        query = start_hourly_rollup(stream, str(tmp_path / "out"), str(tmp_path / "cp"))
        assert query.awaitTermination(120)
    got = read_hourly_rollup(spark, str(tmp_path / "out"))
    want = rollup.hourly_rollup(rollup.clean_hourly(facts))
    columns = sorted(want.columns)
    assert sorted(map(str, got.select(columns).collect())) == sorted(map(str, want.select(columns).collect()))


def plan(spark, name):
    return registered()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["forecast_6h", "ranges_24h", "hourly_features", "wide_features", "extract_hourly", "calibrated"])
def test_no_python_and_no_cross_join(spark, name):
    text = plan(spark, name)
    for word in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in text


@pytest.mark.parametrize("name", ["daily_features", "trailing_sums", "scoring_frame"])
def test_windows_per_ad_share_one_shuffle(spark, name):
    text = plan(spark, name)
    assert len(re.findall(r"Exchange hashpartitioning\(ad_id#\d+, \d+\)", text)) == 1


def test_scans_read_only_what_is_used(spark):
    text = plan(spark, "top_ads")
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert "props" not in schema and "event_id" not in schema


def test_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "reports")
    small_reports(spark).write.parquet(path)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    rows = extract.extract_hourly(
        spark.read.parquet(path), small_hierarchy(spark), F.lit("2024-01-10").cast("timestamp"), account_ids=["1.0"]
    )
    text = rows._jdf.queryExecution().executedPlan().toString()
    # The other scan is that of the kept combinations.
    scans = [line for line in text.split("\n") if "PushedFilters" in line and "reports" in line]
    assert scans
    for pushed in (re.search(r"PushedFilters: \[([^\]]*)\]", line).group(1) for line in scans):
        assert "GreaterThanOrEqual(date" in pushed and "IsNotNull(ad_id)" in pushed and "account_id" in pushed


def test_payload_round_trip(spark):
    df = spark.createDataFrame([("a", 1.5)], "ad_id string, spend double")
    kind = T.StructType([T.StructField("spend", T.DoubleType())])
    text = df.select(sinks.payload_json(df, ["ad_id", "spend"]).alias("p"))
    assert text.select(sinks.read_payload(F.col("p"), kind)["spend"]).first()[0] == 1.5
