"""Plans and results of pruned reads, clustered tables, distributed offsets, counters."""

import datetime as dt

import pytest
from pyspark.sql import Observation, functions as F

from kpicast.operators import daily, grid, hourly, rollup, samples
from kpicast.plans import score, train
from kpicast.sources import clustered, extract, lens, points

SF = "/root/testdata/sf0.001"


def plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_old_folders_are_not_read(spark, tmp_path):
    path = str(tmp_path / "reports")
    days = spark.range(40).selectExpr("date_add(DATE'2024-01-01', CAST(id AS int)) AS day", "id AS v")
    days.write.partitionBy("day").parquet(path)
    newest = extract.newest_folder(spark, path, "day")
    assert newest == dt.date(2024, 2, 9)
    rows = extract.recent_rows(spark.read.parquet(path), "day", 10, newest)
    assert rows.count() == rows.select(F.input_file_name()).distinct().count() == 11
    # The scan gets the constant as a filter on its folders: it opens no others.
    assert "PartitionFilters: [isnotnull(day" in plan(rows) and ">= 2024-01-30" in plan(rows)
    assert extract.newest_folder(spark, str(tmp_path / "none"), "day") is None


def test_a_known_newest_time_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "events")
    spark.range(100).selectExpr("timestamp'2024-01-01' + make_interval(0,0,0,0,id) AS ts", "id").write.parquet(path)
    rows = spark.read.parquet(path)
    newest = extract.newest_time(rows, "ts")
    kept = extract.recent_rows(rows, "ts", 1, newest)
    assert "GreaterThanOrEqual(ts" in plan(kept) and "Subquery" not in plan(kept)
    assert kept.count() == extract.recent_rows(rows, "ts", 1).count() == 25


def test_features_of_clustered_tables_need_no_exchange(spark, tmp_path):
    facts = rollup.daily_rollup(rollup.clean_daily(lens.daily_facts(spark, SF)))
    stored = clustered.write_clustered(facts, "t_days", str(tmp_path / "d"), ["ad_id"], ["local_date"], 4)
    made = daily.daily_features(grid.dense_days(stored))
    assert "Exchange" not in plan(made)
    key = ["local_date", "ad_id", "spend_roll_sum_7d"]
    want = daily.daily_features(grid.dense_days(facts))
    rounded = lambda df: sorted((r[0], r[1], round(r[2], 6)) for r in df.select(*key).collect())
    assert rounded(made) == rounded(want)
    hours = rollup.hourly_rollup(rollup.clean_hourly(lens.hourly_facts(spark, SF)))
    stored = clustered.write_clustered(hours, "t_hours", str(tmp_path / "h"), ["ad_id"], ["hour_idx"], 4)
    built = hourly.block_windows(hourly.hour_blocks(stored, stored_by_ad=True))
    assert "Exchange" not in plan(built)
    assert built.count() == hourly.block_windows(hourly.hour_blocks(hours)).count()
    schema = ", ".join(f"`{n}` {t}" for n, t in hours.dtypes)
    again = clustered.open_clustered(spark, "t_again", str(tmp_path / "h"), schema, ["ad_id"], ["hour_idx"], 4)
    totals = again.groupBy("ad_id").agg(F.sum("spend"))
    assert "Exchange" not in plan(totals) and again.count() == hours.count()
    for name in ("t_days", "t_hours", "t_again"):
        spark.sql(f"DROP TABLE {name}")


def test_bucket_counts():
    assert [clustered.bucket_count(n) for n in (0, 32_000_000, 32_000_001, 200_000_000)] == [8, 8, 16, 64]


@pytest.mark.parametrize("skip", [1, 7, 250, 999, 1000, 5000])
def test_rows_after_an_offset(spark, skip):
    rows = spark.range(1000).selectExpr("id", "id % 10 AS k").repartition(7)
    found = points.find_all(rows, sort=[("k", 1), ("id", -1)], skip=skip)
    assert "SinglePartition" not in plan(found)
    want = sorted(range(1000), key=lambda i: (i % 10, -i))[skip:]
    assert [r["id"] for r in found.collect()] == want


def test_offset_of_filtered_rows(spark):
    rows = spark.range(100).selectExpr("id", "id % 2 AS k")
    found = points.find_all(rows, {"k": 1}, [("id", 1)], skip=45, projection={"id": 1})
    assert [r["id"] for r in found.collect()] == [91, 93, 95, 97, 99]
    assert points.find_all(rows, {"k": 7}, [("id", 1)], skip=3).count() == 0


def test_rejected_rows_are_counted_in_one_scan(spark):
    rows = [
        ("2024-01-01 00:00:00", "1", "UTC", "1.5"), ("soon", "1", "UTC", "1"), ("1890-01-01", "1", "", "1"),
        ("2024-01-01 01:00:00", " ", "UTC", "x"), ("2024-01-01 02:00:00", None, None, None), (None, "2", "UTC", "1"),
    ]
    df = spark.createDataFrame(rows, "date string, ad_id string, timezone string, spend string")
    df = df.withColumns({c: F.lit("1") for c in ("account_id", "campaign_id", "adset_id")})
    counts = Observation("c")
    kept = rollup.clean_hourly(df, counts=counts)
    assert kept.count() == 1
    kept = rollup.clean_hourly(df, counts=(again := Observation("d")))
    text = kept._jdf.queryExecution().executedPlan().toString()
    assert text.count("Scan") == 1
    assert [r["spend"] for r in kept.collect()] == [1.5]
    assert again.get == {
        "rows": 6, "unreadable_dates": 2, "impossible_dates": 1, "blank_ads": 2, "unmatched_zones": 2, "rejected_numbers": 1
    }


def test_one_wrong_date_opens_no_calendar(spark):
    facts = lens.daily_facts(spark, SF)
    wrong = facts.limit(1).withColumn("date", F.lit("9999-01-01").cast("date"))
    rows = rollup.daily_rollup(rollup.clean_daily(facts.unionByName(wrong)))
    assert grid.dense_days(rows).count() == grid.dense_days(rollup.daily_rollup(rollup.clean_daily(facts))).count()


def test_given_dates_that_leave_a_part_empty_stop_training(spark, tmp_path):
    rows = spark.sql("SELECT timestamp_ntz'2024-01-01' + make_interval(0,0,0,CAST(id AS int)) AS anchor_ts FROM range(20)")
    for fit in (lambda: train.train_6h(rows, str(tmp_path), "2024-01-10", "2025-01-01"),
                lambda: train.search_6h(rows, str(tmp_path), 1, "2024-01-10", "2025-01-01")):
        with pytest.raises(Exception, match="a part is empty"):
            fit()
    assert samples.time_split(rows, "anchor_ts", "2024-01-10", "2025-01-01").count() == 20


def test_the_forecast_reads_a_week_behind_the_oldest_anchor(spark):
    facts = lens.hourly_facts(spark, SF)
    newest = facts.agg(F.max("date")).first()[0]
    idle = facts.filter("ad_id = '1'").filter(F.col("date") <= F.lit(newest - dt.timedelta(days=4)))
    rows = facts.filter("ad_id <> '1'").unionByName(idle)
    whole = {r["ad_id"]: r for r in score.forecast_6h(rows, recent_days=None).collect()}
    some = {r["ad_id"]: r for r in score.forecast_6h(rows, recent_days=6).collect()}
    assert "1" in some and some["1"]["observed_history_hours"] == whole["1"]["observed_history_hours"]
    assert all(some[a]["recommended_6h_spend"] == pytest.approx(whole[a]["recommended_6h_spend"]) for a in some)
