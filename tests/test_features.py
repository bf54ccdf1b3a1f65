"""Feature operators against brute force on small series."""

import random

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from frames import DAILY, HOURLY, START, day_row, hour_row
from kpicast.config import AnchorRules
from kpicast.names import HOURLY_METRICS, METRICS
from kpicast.operators import daily, grid, hourly, rollup
from kpicast.plans import score, train


def test_feature_counts():
    for names, count in (
        (daily.daily_feature_names(), 84),
        (daily.wide_feature_names(), 195),
        (hourly.hourly_feature_names(), 289),
    ):
        assert len(names) == len(set(names)) == count


def test_dense_days_fill_gaps_and_carry_ids(spark):
    rows = [
        day_row(0, tz="A"),
        day_row(3, tz="B"),
        # Two hierarchies on one day: the last one stays.
        day_row(3, tz="B", ids=("1", "1", "2"), values=(9, 9, 9, 9, 9)),
        day_row(5, ad="2"),
    ]
    got = grid.dense_days(spark.createDataFrame(rows, DAILY)).orderBy("ad_id", "local_date").collect()
    one = [(r["local_date"].day, r["timezone"], r["adset_id"], r["spend"]) for r in got if r["ad_id"] == "1"]
    assert one == [(1, "A", "1", 1.0), (2, "A", "1", 0.0), (3, "A", "1", 0.0), (4, "B", "2", 9.0)]
    assert [r["local_date"].day for r in got if r["ad_id"] == "2"] == [6]


def test_scoring_days_add_one_zero_day(spark):
    rows = [day_row(d) for d in range(20)] + [day_row(2, ad="2")]
    got = grid.scoring_days(spark.createDataFrame(rows, DAILY), 16).collect()
    one = sorted(r["local_date"] for r in got if r["ad_id"] == "1")
    assert len(one) == 17 and (one[0] - START).days == 4
    future = {r["ad_id"]: r for r in got if r["history_cutoff_local_date"] is not None}
    assert {k: (r["local_date"] - START).days for k, r in future.items()} == {"1": 20, "2": 3}
    assert all(r[m] == 0.0 for r in future.values() for m in METRICS)


def test_daily_features_by_hand(spark):
    spend = {0: 1, 1: 2, 2: 4, 5: 8, 9: 16}
    rows = [day_row(d, values=(v, 0, 0, 0, v * 3)) for d, v in spend.items()]
    got = daily.daily_features(grid.dense_days(spark.createDataFrame(rows, DAILY)))
    r = {(x["local_date"] - START).days: x for x in got.collect()}
    assert r[0]["days_active"] == 1 and r[0]["spend_roll_mean_7d"] == 0.0
    assert r[1]["spend_roll_sum_14d"] == 0.0  # two rows are needed
    assert r[2]["spend_roll_sum_14d"] == 3.0 and r[2]["spend_roll_mean_14d"] == 1.5
    assert r[5]["spend_roll_mean_3d"] == pytest.approx(4 / 3)
    assert r[9]["spend_lag_7d"] == 4.0 and r[9]["spend_same_weekday_last_week"] == 4.0
    assert r[9]["spend_roll_sum_7d"] == 12.0 and r[9]["cum_spend"] == 15.0
    assert r[9]["zero_spend_to_date"] == 5.0
    assert r[9]["tracker_revenue_nonzero_count_7d"] == 2.0
    assert r[9]["spend_positive_revenue_zero_count_7d"] == 0.0
    assert r[9]["revenue_density_7d"] == 3.0
    assert r[0]["day_of_week"] == 0  # 1 January 2024 was a Monday


def test_totals_can_include_the_day(spark):
    dense = grid.dense_days(spark.createDataFrame([day_row(0), day_row(1)], DAILY))
    got = daily.daily_features(dense, inclusive_totals=True).orderBy("local_date").collect()
    assert [r["cum_spend"] for r in got] == [1.0, 2.0]


hours_of_ads = st.dictionaries(
    st.sampled_from(["1", "2"]),
    st.dictionaries(st.integers(473_000, 473_260), st.integers(0, 9), min_size=1, max_size=60),
    min_size=1,
    max_size=2,
)


@settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(hours_of_ads)
def test_block_windows_equal_sums_over_hours(spark, series):
    rows = [
        hour_row(h, ad, [v, v * 10, v, v + 1, v % 2, v * 2])
        for ad, hours in series.items()
        for h, v in hours.items()
    ]
    random.Random(1).shuffle(rows)
    windows = hourly.block_windows(hourly.hour_blocks(spark.createDataFrame(rows, HOURLY)))
    for r in windows.collect():
        a, hours = r["anchor_idx"], series[r["ad_id"]]
        assert a % 6 == 0

        def total(low, high):
            return sum(v for h, v in hours.items() if low <= h <= high)

        for w in hourly.WINDOWS:
            assert r[f"spend_sum_{w}h"] == total(a - w + 1, a)
        for d in hourly.SAME_WINDOW_DAYS:
            assert r[f"spend_same_target_6h_d{d}"] == total(a + 1 - 24 * d, a + 6 - 24 * d)
        assert r["spend_cum"] == total(a - 167, a)
        recent = [h for h in hours if a - 168 < h <= a]
        assert r["recent_first"] == min(recent, default=None)
        assert r["target_spend"] == total(a + 1, a + 6)
        assert r["observed_history_hours"] == sum(a - 168 < h <= a for h in hours)
        assert r["observed_recent_24h"] == sum(a - 24 < h <= a for h in hours)
        assert (r["first_hour"], r["last_hour"]) == (min(hours), max(hours))


@settings(
    max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(hours_of_ads)
def test_scoring_windows_equal_training_windows(spark, series):
    rows = [
        hour_row(h, ad, [v, v * 10, v, v + 1, v % 2, v * 2], tz="UTC" if h % 2 else "")
        for ad, hours in series.items()
        for h, v in hours.items()
    ]
    df = spark.createDataFrame(rows, HOURLY)
    direct = hourly.latest_windows(df)
    names = sorted(c for c in direct.columns if not c.startswith("target_"))
    blocks = hourly.latest_anchors(hourly.block_windows(hourly.hour_blocks(df)))
    assert sorted(map(tuple, direct.select(names).collect())) == sorted(
        map(tuple, blocks.select(names).collect())
    )


def test_latest_anchor(spark):
    # 473 004 is an anchor; ad 2 is first seen after its only anchor.
    rows = [hour_row(473_004), hour_row(473_009), hour_row(473_005, ad="2"), hour_row(473_010, ad="3")]
    windows = hourly.block_windows(hourly.hour_blocks(spark.createDataFrame(rows, HOURLY)))
    got = {r["ad_id"]: r["anchor_idx"] for r in hourly.latest_anchors(windows).collect()}
    assert got == {"1": 473_004, "3": 473_010}


def test_training_gates(spark):
    long = [hour_row(473_004 + h) for h in range(0, 190)]
    rules = AnchorRules()
    windows = hourly.block_windows(hourly.hour_blocks(spark.createDataFrame(long, HOURLY)))
    got = [r["anchor_idx"] - 473_004 for r in hourly.training_anchors(windows, rules).collect()]
    assert sorted(got) == [168, 174, 180]
    thin = AnchorRules(min_observed_hours=169)
    assert hourly.training_anchors(windows, thin).count() == 0
    costly = AnchorRules(min_spend=25.0)
    assert hourly.training_anchors(windows, costly).count() == 0


def test_same_window_statistics(spark):
    import numpy as np

    values = [3.0, 0.0, 7.0, 1.0, 5.0, 2.0, 9.0]
    anchor = 473_004 + 168
    rows = [hour_row(anchor + 1 - 24 * d, values=[v] * 6) for d, v in zip(range(1, 8), values)]
    rows.append(hour_row(anchor))
    windows = hourly.block_windows(hourly.hour_blocks(spark.createDataFrame(rows, HOURLY)))
    r = hourly.hourly_features(windows.filter(f"anchor_idx = {anchor}")).first()
    name = "tracker_revenue_same_6h_7d_"
    for stat, want in {
        "mean": np.mean(values),
        "median": np.median(values),
        "std": np.std(values),
        "min": 0.0,
        "max": 9.0,
        "p75": np.percentile(values, 75),
        "p90": np.percentile(values, 90),
        "last_over_mean": 3.0 / np.mean(values),
    }.items():
        assert r[name + stat] == pytest.approx(want)
    assert r["kpi_same_6h_7d_mean_roas"] == pytest.approx(1.0)
    assert r["kpi_same_6h_7d_median_profit"] == pytest.approx(0.0)


def test_later_source_replaces(spark):
    early = spark.createDataFrame([day_row(0), day_row(1)], DAILY)
    late = spark.createDataFrame([day_row(1, values=(5, 0, 0, 0, 0)), day_row(2)], DAILY)
    got = rollup.merge_sources([early, late]).orderBy("local_date").collect()
    assert [r["spend"] for r in got] == [1.0, 5.0, 1.0]


def test_seven_and_eight_days(spark):
    rows = [day_row(d) for d in range(8)] + [day_row(d, ad="2") for d in range(7)]
    df = spark.createDataFrame(rows, DAILY)
    assert [r["ad_id"] for r in rollup.eligible_ads(df).collect()] == ["1"]


def test_short_history_is_scored(spark):
    rows = [day_row(d) for d in range(3)] + [day_row(0, ad="2")]
    df = spark.createDataFrame(rows, DAILY)
    out = score.score_24h(score.next_day_features(df, summary=rollup.lifetime_summary(df)))
    got = {r["ad_id"]: (r["days_active"], r["history_segment"]) for r in out.collect()}
    assert got == {"1": (3.0, "new_ad"), "2": (1.0, "new_ad")}


def test_nothing_eligible_gives_the_same_columns(spark):
    full = spark.createDataFrame([day_row(0)], DAILY)
    empty = full.filter("false")
    a, b = (score.score_24h(score.next_day_features(df)) for df in (full, empty))
    assert b.count() == 0 and a.schema == b.schema


def test_row_order_and_partitions_do_not_matter(spark):
    rng = random.Random(5)
    rows = [
        hour_row(473_000 + rng.randrange(300), ad=str(rng.randrange(6)), ids=("1", str(rng.randrange(2)), "1"),
                 values=[rng.randrange(9) for _ in HOURLY_METRICS], tz=rng.choice(["UTC", ""]))
        for _ in range(500)
    ]
    want = None
    for seed, parts in ((1, 1), (2, 7), (3, 23)):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, HOURLY).repartition(parts)
        rolled = df.groupBy("hour_idx", "timezone", "account_id", "campaign_id", "adset_id", "ad_id").sum(*HOURLY_METRICS)
        rolled = rolled.withColumnsRenamed({f"sum({m})": m for m in HOURLY_METRICS})
        got = sorted(map(tuple, score.score_6h(score.latest_features_6h(rolled)).collect()))
        want = want or got
        assert got == want


def test_daily_samples_from_two_sources(spark):
    facts = "entity_type string, date date, timezone string, account_id string, campaign_id string, " \
        "adset_id string, ad_id string, " + ", ".join(f"{m} double" for m in METRICS)
    rows = [("ad", *day_row(d)) for d in range(12)]
    a = spark.createDataFrame(rows[:8], facts)
    b = spark.createDataFrame(rows[6:], facts)
    got = train.daily_samples([a, b])
    assert sorted(r["days_active"] for r in got.collect()) == [8, 9, 10, 11, 12]
