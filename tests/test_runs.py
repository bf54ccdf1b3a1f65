"""Whole jobs on the smallest tables."""

from pyspark.sql import functions as F

from kpicast.config import AnchorRules, ExtractRules, platform_tenant
from kpicast.names import METRICS
from kpicast.operators import models
from kpicast.plans import jobs, score
from kpicast.sources import lens, sinks

SF = "/root/testdata/sf0.001"
TINY = {m: models.TreeParams(iterations=2, depth=2, min_rows=1) for m in METRICS}


def reader(spark):
    """Tables of a tenant that names conversions and revenue the platform's way."""
    dims = lens.hierarchy(spark, SF)
    names = {"tracker_conversions": "conversions", "tracker_revenue": "conversions_value"}
    tables = {
        "t_traffic_source_accounts": dims.accounts,
        "t_traffic_source_campaigns": dims.campaigns,
        "t_traffic_source_adsets": dims.adsets,
        "t_traffic_source_ads": dims.ads,
        "t_traffic_source_reports": lens.hourly_reports(spark, SF).withColumnsRenamed(names),
        "t_daily_breakdown_kpis": lens.daily_facts(spark, SF).withColumnsRenamed(names),
    }
    return tables.__getitem__


def test_forecasts_of_both_horizons_share_a_table(spark, tmp_path):
    tenant = platform_tenant("t", "t_")
    anchor = F.lit("2024-01-31 00:00:00").cast("timestamp")
    out, cache = str(tmp_path / "out"), str(tmp_path / "cache")
    rules = AnchorRules(enough_hours=8)
    first = jobs.run_6h(reader(spark), tenant, anchor, out, anchors=rules, cache_root=cache)
    again = jobs.run_6h(
        lambda name: None, tenant, anchor, out, anchors=rules, cache_root=cache, reuse_features=True
    )
    drop = ["created_at"]
    assert sorted(map(str, first.drop(*drop).collect())) == sorted(map(str, again.drop(*drop).collect()))
    days = jobs.run_24h(reader(spark), tenant, anchor, out, rules=ExtractRules(ads_per_account=1))
    accounts = days.select("account_id").distinct().count()
    assert days.count() == accounts > 1
    stored = sinks.read_forecasts(spark, f"{out}/{tenant.forecast_table}")
    counts = {r["forecast_horizon"]: r["count"] for r in stored.groupBy("forecast_horizon").count().collect()}
    assert counts == {"6h": first.count(), "24h": accounts}
    used = spark.read.parquet(f"{out}/extracts").collect()
    assert [(r["lookback_days"], r["ads_per_account"]) for r in used] == [(21, 1)]


def test_training_to_monitor(spark, tmp_path):
    path = str(tmp_path)
    backtest = jobs.run_training_24h(
        lens.sources(spark, SF), f"{path}/m", f"{path}/r", train_end="2024-01-20", valid_end="2024-01-25",
        recency_start="2024-01-15", revenue_focus=True, trees=TINY,
    )
    assert {r["split"] for r in backtest.select("split").distinct().collect()} == {"valid", "test"}
    assert spark.read.parquet(f"{path}/r/metrics").count() == 44
    monitor = jobs.run_monitor(spark, f"{path}/r/backtest", f"{path}/r/monitor", "calibrated")
    assert monitor.filter("group_name = 'all'").count() == 9
    served = score.forecast_24h(
        lens.daily_facts(spark, SF), score.model_24h(models.Routing.single(f"{path}/m"))
    )
    assert served.count() == 15
    assert models.is_ready(spark, f"{path}/m")


def test_hourly_training_selects_a_model_per_target(spark, tmp_path):
    path = str(tmp_path)
    best = jobs.run_training_6h(
        lens.hourly_facts(spark, SF), f"{path}/a", f"{path}/b", f"{path}/r",
        AnchorRules(min_observed_hours=12), search_iterations=2, trees=TINY,
    )
    assert {r["metric"] for r in best.collect()} == set(METRICS)
    served = score.forecast_6h(
        lens.hourly_facts(spark, SF), score.model_6h(jobs.routing_6h(f"{path}/a", f"{path}/b")), max_ads=4
    )
    assert served.count() == 4
