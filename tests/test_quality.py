"""Calibration, metrics and the monitor."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from kpicast.names import METRICS
from kpicast.operators import calibration, metrics, samples

ROWS = "account_id string, campaign_id string, ad_id string, segment string, target string, " \
    "actual double, pred double, bucket string, recent_mean double"


def rows(spark, entries):
    return spark.createDataFrame(entries, ROWS)


def entry(ad, segment, actual, pred, bucket="small", mean=1.0, account="1", campaign="1"):
    return (account, campaign, ad, segment, "spend", float(actual), float(pred), bucket, float(mean))


def test_factors_need_enough_rows(spark):
    table = rows(
        spark,
        [entry(str(i), "stable", 3, 2) for i in range(25)]
        + [entry(str(100 + i), "spiky", 100, 2, "tiny", account="2") for i in range(24)],
    )
    got = {(r["level"], r["bucket"] or r["segment"] or r["account_id"]): r["factor"]
           for r in calibration.factor_table(table).collect() if r["level"] != "ad" and r["level"] != "campaign"}
    assert got[("segment", "stable")] == 1.5 and got[("bucket", "small")] == 1.5
    assert ("segment", "spiky") not in got and ("bucket", "tiny") not in got
    assert got[("global", None)] == 5.0  # (75 + 2400) / 98, clipped
    assert got[("account", "2")] == 3.0


def test_nothing_predicted(spark):
    table = rows(spark, [entry(str(i), "new", 3, 0) for i in range(30)])
    got = calibration.factor_table(table).collect()
    assert [(r["level"], r["factor"]) for r in got] == [("global", 1.0)]
    assert calibration.range_table(table).count() == 0


def test_ranges_per_segment(spark):
    table = rows(
        spark,
        [entry(str(i), "stable", i, 10) for i in range(1, 26)]
        + [entry(str(i), "new", 7, 10) for i in range(100, 124)],
    )
    got = {r["segment"]: r for r in calibration.range_table(table).collect()}
    assert set(got) == {"all", "stable"}
    ratios = np.arange(1, 26) / 10
    assert got["stable"]["p10"] == pytest.approx(np.quantile(ratios, 0.1))
    assert got["stable"]["p90"] == pytest.approx(np.quantile(ratios, 0.9))


def test_caps(spark):
    table = rows(spark, [entry(str(i), "stable", i, 1, mean=0) for i in range(11)])
    cap = calibration.cap_table(table).first()
    assert cap["max_multiplier"] == 4.0 and cap["fallback_cap"] == pytest.approx(9.5)
    table = rows(spark, [entry(str(i), "stable", 0, 1, mean=i) for i in range(3)])
    assert calibration.cap_table(table).first()["fallback_cap"] == pytest.approx(1.95 * 4)


def frame(spark, ads, segment="stable"):
    df = spark.createDataFrame([(a, "1", "1", float(p)) for a, p in ads], "ad_id string, account_id string, campaign_id string, p double")
    out = {"prediction_segment": F.lit(segment)}
    for m in METRICS:
        out |= {
            f"target_24h_{m}": F.col("p") * 2,
            f"pred_24h_{m}": F.col("p"),
            f"{m}_recent_mean_7d": F.lit(50.0),
            f"{m}_recent_sum_7d": F.lit(350.0),
            f"{m}_recent_lag_1d": F.lit(10.0),
        }
    return df.withColumns(out)


def test_calibration_prefers_the_finest_level(spark):
    valid = frame(spark, [("a", 10)] * 6 + [("b", 20)] * 30)
    spec = calibration.fit_calibration(valid)
    got = {r["ad_id"]: r for r in calibration.apply_calibration(frame(spark, [("a", 10), ("new", 10)]), spec).collect()}
    # Everything doubles: sqrt(2 * 2) from bucket and segment times sqrt(2).
    for ad in ("a", "new"):  # an unknown ad takes the factor of its campaign
        assert got[ad]["pred_calibrated_24h_spend"] == pytest.approx(20 * 2**0.5)
    r = got["a"]
    assert r["pred_p10_24h_spend"] <= r["pred_p50_24h_spend"] <= r["pred_p90_24h_spend"]
    assert r["pred_p90_24h_spend"] == pytest.approx(40 * 2**0.5)


def test_thin_ads_are_capped_for_sparse_targets_only(spark):
    spec = calibration.fit_calibration(frame(spark, [("a", 1000)] * 30))
    r = calibration.apply_calibration(frame(spark, [("a", 1000)], "new"), spec).first()
    cap = {c["target"]: c["fallback_cap"] for c in spec.caps.collect()}
    assert r["pred_calibrated_24h_tracker_revenue"] == pytest.approx(max(100.0, cap["tracker_revenue"] * 0.25))
    assert r["pred_calibrated_24h_spend"] == pytest.approx(min(1000 * 2 * 2**0.5, cap["spend"]))


def test_regression_metrics(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0), ("a", 3.0, 3.0), ("b", 5.0, 4.0), ("c", 0.0, 0.0), ("c", 0.0, 0.0)], "k string, y double, p double")
    got = {r["k"]: r for r in metrics.regression_metrics(df, ["k"], "y", "p").collect()}
    assert (got["a"]["mae"], got["a"]["r2"], got["a"]["wmape"], got["a"]["bias"]) == (0.5, 0.5, 0.25, 0.25)
    assert got["b"]["r2"] == 0.0 and got["b"]["underprediction_rate"] == 1.0
    assert (got["c"]["wmape"], got["c"]["r2"]) == (0.0, 1.0)


def monitor_table(spark):
    rng = np.random.default_rng(2)
    out = []
    for i in range(400):
        segment = ["stable", "spiky", None][i % 3]
        y = 7.0 if segment == "spiky" else float(rng.gamma(1, 50))
        out.append((str(i), "test" if i % 2 else "valid", segment, y, float(rng.gamma(1, 50))))
    return out, spark.createDataFrame(
        out, "ad_id string, split string, prediction_segment string, actual_24h_spend double, pred_24h_spend double"
    )



def test_monitor(spark):
    table, df = monitor_table(spark)
    got = {(r["group_name"], r["group_value"]): r for r in metrics.quality_monitor(df).collect()}
    assert set(got) == {("all", "all"), ("split", "test"), ("split", "valid"), ("prediction_segment", "stable"),
                        ("prediction_segment", "spiky"), ("prediction_segment", "UNKNOWN")}
    for (name, value), r in got.items():
        part = [x for x in table if name == "all" or (x[1] if name == "split" else x[2] or "UNKNOWN") == value]
        y, p = np.array([x[3] for x in part]), np.array([x[4] for x in part])
        ape = np.abs(p - y) / np.maximum(np.abs(y), 1) * 100
        assert r["rows"] == len(part) and r["metric"] == "spend" and r["prediction_column"] == "pred_24h_spend"
        assert r["median_abs_pct_error"] == pytest.approx(np.median(ape))
        assert r["p75_abs_pct_error"] == pytest.approx(np.percentile(ape, 75))
        sst = ((y - y.mean()) ** 2).sum()
        assert r["r2"] == pytest.approx(1 - ((y - p) ** 2).sum() / sst if sst > 1e-9 else 0.0)
        assert r["wmape"] == pytest.approx(np.abs(p - y).sum() / np.abs(y).sum())


def test_monitor_prefers_the_asked_family(spark):
    columns = ["pred_24h_spend", "pred_calibrated_24h_spend", "recommended_24h_spend"]
    got = [metrics.prediction_column(columns, "spend", m) for m in ("serving", "calibrated", "base")]
    assert got == ["recommended_24h_spend", "pred_calibrated_24h_spend", "pred_24h_spend"]
    assert metrics.prediction_column(columns[:1], "spend", "serving") == "pred_24h_spend"


def test_split_uses_given_dates_only_when_all_parts_have_rows(spark):
    df = spark.sql("SELECT date_add(DATE'2024-01-01', CAST(id AS int)) AS d FROM range(20)")
    count = lambda out: {r["split"]: r["count"] for r in out.groupBy("split").count().collect()}
    assert count(samples.time_split(df, "d", "2024-01-10", "2024-01-15")) == {"train": 10, "valid": 5, "test": 5}
    assert count(samples.time_split(df, "d", "2024-01-10", "2024-03-15")) == {"train": 14, "valid": 3, "test": 3}


def test_best_model_breaks_ties_by_name(spark):
    table = spark.createDataFrame([("t", "b", 0.5), ("t", "a", 0.5), ("t", "c", 0.4)], "target string, model string, r2 double")
    assert metrics.best_models(table, ["target"]).first()["model"] == "a"
