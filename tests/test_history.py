"""Training and scoring see the same history; no ad is lost."""

from __future__ import annotations

import random

from frames import HOURLY, hour_row
from pyspark.sql import functions as F

from kpicast.operators import hourly, samples, topk
from kpicast.sources import sinks

START = 473_004  # an anchor


def test_features_do_not_depend_on_how_long_the_history_is(spark):
    rng = random.Random(4)
    rows = []
    for ad, last in (("1", 0), ("2", -75), ("3", -3)):  # the second is idle for three days
        for hour in range(START - 720, START + last + 1):
            if rng.random() < 0.4:
                v = rng.randint(1, 9)
                rows.append(hour_row(hour, ad, [v, v * 10, v, v + 1, v % 2, v * 2]))
    whole = spark.createDataFrame(rows, HOURLY)
    # What the serving extract reads: a week before the oldest anchor that is scored.
    part = whole.filter(F.col("hour_idx") > START - (8 + 7) * 24)
    names = ["anchor_idx", "ad_id", *hourly.hourly_feature_names()]
    one, two = (
        sorted(map(tuple, hourly.hourly_features(hourly.latest_windows(x)).select(names).collect()))
        for x in (whole, part)
    )
    assert one == two and len(one) == 3
    blocks = hourly.latest_anchors(hourly.block_windows(hourly.hour_blocks(whole)))
    three = sorted(map(tuple, hourly.hourly_features(blocks).select(names).collect()))
    assert [r[:2] for r in three] == [r[:2] for r in one]
    assert all(abs((a or 0) - (b or 0)) < 1e-9 for x, y in zip(one, three) for a, b in zip(x[2:], y[2:]))


def test_top_ads_rank_inside_their_account(spark):
    rows = spark.range(3_000).select(
        F.concat(F.lit("a"), F.col("id") % 3).alias("account_id"),
        F.col("id").cast("string").alias("ad_id"),
        F.col("id").cast("double").alias("spend"),
        F.lit("2024-01-01").alias("date"),
    )
    got = topk.top_ads_per_account(rows, 600)
    assert {r["account_id"]: r["count"] for r in got.groupBy("account_id").count().collect()} == {
        "a0": 600, "a1": 600, "a2": 600,
    }
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_given_split_dates_are_kept_or_refused(spark):
    rows = spark.range(10).selectExpr("date_add(DATE '2024-01-01', CAST(id AS int)) AS d")
    cut = samples.time_split(rows, "d", "2024-01-04", "2024-01-08", on_empty="error")
    assert dict(cut.groupBy("split").count().collect()) == {"train": 4, "valid": 4, "test": 2}
    refused = samples.time_split(rows, "d", "2024-01-04", "2024-02-08", on_empty="error")
    try:
        refused.collect()
    except Exception as error:  # noqa: BLE001
        assert "a part is empty" in str(error)
    else:
        raise AssertionError("an empty part was accepted")


def test_runs_have_names_of_their_own():
    assert sinks.run_name("t", ["1"]) == sinks.run_name("t", ["1"])
    assert sinks.run_name("t", ["1"]) != sinks.run_name("t", [])
    assert sinks.feature_cache_path("r", "6h", "x", "a") != sinks.feature_cache_path("r", "6h", "x", "b")
