"""Peers, labels, recommendations and guards."""

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from kpicast.config import GuardRules
from kpicast.functions import labels, ratios
from kpicast.functions.text import add
from kpicast.names import ENTITY, METRICS
from kpicast.operators import peers, recommend

AD = ", ".join(f"{c} string" for c in ENTITY)


def one(spark, sql):
    return spark.sql(f"SELECT {sql} AS x").first()["x"]


def test_peer_counts(spark):
    rows = [
        ("1", "1", "1", "a", 2.0),
        ("1", "1", "1", "b", 4.0),
        ("1", "1", "1", "c", 6.0),
        ("1", "1", "2", "d", 8.0),
        ("1", "2", "3", "e", 0.0),
        ("2", "9", "9", "f", 5.0),
        ("2", "9", "9", "g", 7.0),
    ]
    df = spark.createDataFrame(rows, AD + ", v double")
    got = peers.peer_means(df, {"v": "v"}, 2)
    got = {r["ad_id"]: r for r in add(got, {"s": peers.fallback_source("v"), "f": peers.fallback_value("v")}).collect()}
    assert got["a"]["v_adset_peer"] == 5.0  # b and c
    assert got["d"]["v_adset_peer"] is None and got["d"]["v_campaign_peer"] == 4.0
    assert got["e"]["s"] == "account_same_window_benchmark" and got["e"]["f"] == 5.0
    assert got["f"]["s"] == "insufficient_history" and got["f"]["f"] == 0.0


ads = st.lists(
    st.tuples(st.integers(0, 1), st.integers(0, 2), st.integers(0, 2), st.integers(0, 5)),
    min_size=1,
    max_size=30,
)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(ads)
def test_leave_one_out_equals_brute_force(spark, table):
    rows = [(str(a), f"{a}-{c}", f"{a}-{c}-{s}", str(i), float(v)) for i, (a, c, s, v) in enumerate(table)]
    df = spark.createDataFrame(rows, AD + ", v double")
    for r in peers.peer_means(df, {"v": "v"}, 2).collect():
        for n, level in ((3, "adset"), (2, "campaign"), (1, "account")):
            mine = (r["account_id"], r["campaign_id"], r["adset_id"])[:n]
            others = [x[4] for x in rows if x[:n] == mine and x[3] != r["ad_id"] and x[4] > 0]
            want = sum(others) / len(others) if len(others) >= 2 else None
            assert r[f"v_{level}_peer"] == (None if want is None else pytest.approx(want))


def test_one_account_with_a_third_of_all_ads(spark):
    """The hot account's rows do not meet in one partition."""
    from kpicast.operators.joins import spread_lookup

    rows = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id"
    )
    table = rows.select("k").distinct().withColumn("v", F.length("k"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = spread_lookup(rows, table, ["k"], ["id"])
        spread = joined.filter("k = 'hot'").groupBy(F.spark_partition_id().alias("p")).count()
        assert spread.count() > 1
        assert joined.count() == 9000 and joined.filter("v IS NULL").count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


BASE = dict(
    days_active=20,
    history_spend_sum_7d=70.0,
    history_impressions_sum_7d=7000.0,
    history_clicks_sum_7d=70.0,
    history_conversions_sum_7d=7.0,
    history_revenue_sum_7d=70.0,
    history_revenue_nonzero_days_7d=5.0,
    history_conversion_nonzero_days_7d=5.0,
    history_zero_spend_days_7d=0.0,
    history_zero_revenue_days_7d=2.0,
    history_revenue_spike_ratio_7d=1.0,
)
ZERO = {k: 0.0 for k in BASE if k.endswith("sum_7d")}


@pytest.mark.parametrize(
    "change, want",
    [
        ({}, ("stable_history", "LOW", "HIGH")),
        (ZERO, ("inactive", "LOW_DATA", "INACTIVE")),
        ({"days_active": 6}, ("new_ad", "LOW_DATA", "LOW")),
        ({"history_spend_sum_7d": 6.9}, ("low_volume", "LOW_DATA", "LOW")),
        ({"history_zero_spend_days_7d": 5.0}, ("mostly_zero_history", "HIGH", "RISKY")),
        ({"history_zero_revenue_days_7d": 5.0}, ("mostly_zero_history", "HIGH", "RISKY")),
        ({"history_revenue_spike_ratio_7d": 3.0}, ("spiky_history", "HIGH", "RISKY")),
        ({"history_revenue_nonzero_days_7d": 2.0}, ("spiky_history", "HIGH", "RISKY")),
        ({"history_conversion_nonzero_days_7d": 2.0}, ("spiky_history", "HIGH", "RISKY")),
        ({"history_zero_spend_days_7d": 3.0}, ("mixed_history", "MEDIUM", "MEDIUM")),
        ({"days_active": 13}, ("mixed_history", "MEDIUM", "MEDIUM")),
    ],
)
def test_history_labels(spark, change, want):
    df = spark.createDataFrame([tuple((BASE | change).values())], list(BASE))
    r = add(df, labels.history_labels()).first()
    assert (r["history_segment"], r["spike_risk"], r["forecast_data_quality"]) == want


@pytest.mark.parametrize(
    "value, bucket",
    [(-1, "zero"), (0, "zero"), (1, "tiny"), (1.01, "small"), (10, "small"), (50, "medium"), (51, "large")],
)
def test_scale_bucket(spark, value, bucket):
    assert one(spark, labels.scale_bucket(f"{value}D")) == bucket


@pytest.mark.parametrize(
    "given_, source, confidence, want",
    [
        ("'x'", "'model_point'", "'LOW'", "x"),
        ("NULL", "'insufficient_history'", "'HIGH'", "insufficient_history_monitoring"),
        ("''", "'account_same_window_benchmark'", "'LOW'", "hierarchical_benchmark_forecast"),
        ("NULL", "'model_point'", "' low '", "low_confidence_forecast"),
        ("NULL", "NULL", "'HIGH'", "model_forecast"),
    ],
)
def test_sink_status(spark, given_, source, confidence, want):
    given_ = f"CAST({given_} AS string)"
    assert one(spark, labels.sink_status(given_, f"CAST({source} AS string)", confidence)) == want


def test_confidence_score(spark):
    got = [one(spark, labels.confidence_score("CAST(NULL AS string)", f"'{c}'")) for c in ("HIGH", "medium", "LOW", "")]
    assert got == [0.9, 0.6, 0.3, None]
    assert one(spark, labels.confidence_score("'0.75'", "'LOW'")) == 0.75


def test_log_transform_is_bounded(spark):
    df = spark.createDataFrame([(-3.0,), (0.0,), (500.0,)], "x double")
    got = [r["y"] for r in df.select(ratios.from_log(F.col("x"), 20.0).alias("y")).collect()]
    assert got[0] == 0.0 and got[1] == 0.0 and got[2] == pytest.approx(485165194.4097903)


def guard_rows(spark, rows):
    columns = ["ad_id", "hours", "pred", "history"]
    frame = spark.createDataFrame(rows, columns)
    ids = {"account_id": "'1'", "campaign_id": "'1'", "adset_id": "'1'"}
    frame = add(frame, ids | {"observed_history_hours": "hours", "spend_sum_24h": "1D"})
    for m in METRICS:
        mine = m == "tracker_revenue"
        frame = add(
            frame,
            {
                f"pred_6h_{m}": "pred" if mine else "100D",
                f"{m}_same_6h_7d_mean": "history" if mine else "0D",
            },
        )
    rules = GuardRules(caps={"tracker_revenue": 50.0, "tracker_conversions": 1000.0})
    return {r["ad_id"]: r for r in recommend.recommend_6h(frame, rules).collect()}


def test_guard_below_at_and_above_the_cap(spark):
    # No two peers have a positive history: the cap is 5 x 12 = 60.
    got = guard_rows(spark, [("a", 30, 59.9, 12.0), ("b", 30, 60.1, 12.0), ("c", 30, 60.0, 12.0)])
    # Each ad has the two others as peers here, at 12 each.
    assert got["a"]["recommended_6h_tracker_revenue"] == 59.9
    assert got["c"]["recommended_6h_tracker_revenue"] == 60.0
    assert got["b"]["recommended_6h_tracker_revenue"] == 12.0
    assert got["b"]["recommended_6h_tracker_revenue_source"] == "guarded_peer_benchmark"
    assert got["b"]["forecast_status"] == "guarded_model_forecast"
    assert got["a"]["benchmark_source"] == "model_point"


def test_guard_without_peers_uses_the_cap(spark):
    got = guard_rows(spark, [("a", 30, 60.1, 12.0), ("b", 3, 60.1, 0.0)])
    assert got["a"]["recommended_6h_tracker_revenue"] == 60.0
    assert got["a"]["benchmark_source"] == "guarded_history_cap"
    assert got["b"]["recommended_6h_tracker_revenue"] == 0.0
    assert got["b"]["forecast_status"] == "insufficient_history_monitoring"
    assert got["b"]["forecast_confidence"] == "LOW"


def test_roas_limit(spark):
    got = guard_rows(spark, [("a", 30, 20_000.0, 5000.0)])
    assert got["a"]["recommended_6h_tracker_revenue"] == 100.0 * 100.0
    assert got["a"]["recommended_6h_tracker_revenue_source"] == "guarded_roas_cap"


def test_most_common_label(spark):
    mode = recommend.most_common(["'b'", "'a'", "'b'", "'a'", "'c'"])
    assert one(spark, mode) == "a"
    assert one(spark, recommend.most_common(["'b'", "'b'", "'a'", "'c'", "'c'", "'c'"])) == "c"
