"""Commits of the forecast table, and tables stored by key."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from kpicast.sources import clustered, sinks, snapshots

DAY = dt.date(2024, 1, 5)


def rows_of(spark, days, ads=4, value=1.0, extra=()):
    """Forecast rows of some days; ``extra`` names columns to add."""
    data = [("24h", str(a), DAY + dt.timedelta(d), dt.datetime(2024, 1, 5) + dt.timedelta(d), value) for d in days for a in range(ads)]
    schema = "forecast_horizon string, ad_id string, forecast_local_date date, forecast_window_start timestamp, result_spend double"
    df = spark.createDataFrame(data, schema)
    return df.withColumns({name: F.lit(2.0) for name in extra})


def stored(spark, path, **which):
    rows = sinks.read_forecasts(spark, path, **which).collect()
    return sorted((str(r["forecast_local_date"])[-2:], r["ad_id"], r["result_spend"]) for r in rows)


def test_a_rerun_replaces_all_its_days(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_forecasts(rows_of(spark, [0, 1], 2), path, "a")
    sinks.write_forecasts(rows_of(spark, [0], 1, 5.0), path, "b")
    sinks.write_forecasts(rows_of(spark, [1], 1, 7.0), path, "a")
    assert stored(spark, path) == [("05", "0", 5.0), ("06", "0", 7.0)]
    sinks.write_forecasts(rows_of(spark, [1], 1, 9.0), path)
    sinks.write_forecasts(rows_of(spark, [1], 1, 9.0), path)
    assert [v for *_, v in stored(spark, path)] == [5.0, 7.0, 9.0, 9.0]
    sinks.write_forecasts(rows_of(spark, [], 1), path, "a")  # nothing to forecast any more
    assert [v for *_, v in stored(spark, path)] == [5.0, 9.0, 9.0]


def test_a_killed_job_leaves_the_old_rows(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    sinks.write_forecasts(rows_of(spark, [0]), path, "a")
    before = stored(spark, path)

    def killed(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(snapshots, "commit", killed)
        with pytest.raises(KeyboardInterrupt):
            sinks.write_forecasts(rows_of(spark, [0, 1], value=3.0), path, "a")
    assert stored(spark, path) == before
    # Also with the manifest written but not yet moved.
    open(os.path.join(path, "manifests", ".a.2.x.json"), "w").write("{}")
    assert stored(spark, path) == before
    sinks.write_forecasts(rows_of(spark, [0], value=4.0), path, "a")
    assert {v for *_, v in stored(spark, path)} == {4.0}


def test_interleaved_jobs(spark, tmp_path):
    path = str(tmp_path / "t")
    one = snapshots.write_attempt(rows_of(spark, [0], 2, 1.0), path)
    two = snapshots.write_attempt(rows_of(spark, [0], 2, 2.0), path)
    snapshots.commit(spark, path, "two", two)
    snapshots.commit(spark, path, "one", one)
    assert [v for *_, v in stored(spark, path)] == [1.0, 2.0, 1.0, 2.0]
    # Two jobs of one run that don't know of one another: one of them counts, whole.
    three = snapshots.write_attempt(rows_of(spark, [0, 1], 2, 3.0), path)
    four = snapshots.write_attempt(rows_of(spark, [0], 1, 4.0), path)
    number = lambda *_: [{"run": "one", "number": 1}]
    manifests, snapshots.manifests = snapshots.manifests, number
    try:
        snapshots.commit(spark, path, "one", three)
        snapshots.commit(spark, path, "one", four)
    finally:
        snapshots.manifests = manifests
    assert [v for *_, v in stored(spark, path)] == [2.0, 4.0, 2.0]


def test_columns_may_come_and_days_are_pruned(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_forecasts(rows_of(spark, [0]).withColumn("result_spend", F.lit(1).cast("int")), path, "a")
    sinks.write_forecasts(rows_of(spark, [1, 2], extra=["result_spend_p10", "unknown"]), path, "b")
    table = sinks.read_forecasts(spark, path)
    assert table.filter("result_spend_p10 IS NULL").count() == 4
    assert table.filter("result_spend_p10 = 2").count() == 8
    assert "unknown" not in table.columns and dict(table.dtypes)["result_spend"] == "double"
    some = sinks.read_forecasts(spark, path, horizon="24h", first=DAY + dt.timedelta(2))
    assert some.count() == 4
    assert all("2024-01-07" in f for f in some.inputFiles())
    assert sinks.read_forecasts(spark, path, horizon="6h").count() == 0
    assert sinks.read_forecasts(spark, str(tmp_path / "none")).count() == 0


def test_files_hold_ranges_of_ads(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(snapshots, "ROWS_PER_FILE", 50)
    path = str(tmp_path / "t")
    sinks.write_forecasts(rows_of(spark, [0, 1], 200), path, "a")
    table = sinks.read_forecasts(spark, path)
    spans = table.groupBy("forecast_local_date", F.input_file_name().alias("f")).agg(F.min("ad_id").alias("l"), F.max("ad_id").alias("m")).collect()
    assert len(spans) >= 6
    for day in {s[0] for s in spans}:
        own = sorted((s["l"], s["m"]) for s in spans if s[0] == day)
        assert all(a[1] < b[0] for a, b in zip(own, own[1:]))


def test_vacuum_deletes_what_nobody_reads(spark, tmp_path):
    path = str(tmp_path / "t")
    for value in (1.0, 2.0):
        sinks.write_forecasts(rows_of(spark, [0], value=value), path, "a")
    snapshots.write_attempt(rows_of(spark, [0], value=3.0), path)
    assert snapshots.vacuum(spark, path, dt.timedelta(hours=1)) == []
    assert len(snapshots.vacuum(spark, path, dt.timedelta(0))) == 2
    assert {v for *_, v in stored(spark, path)} == {2.0}
    assert len(os.listdir(os.path.join(path, "data"))) == 1
    assert snapshots.vacuum(spark, str(tmp_path / "none"), dt.timedelta(0)) == []
