import datetime as dt

import pytest
from pyspark.sql import functions as F, types as T

from kpicast.functions import clean, localtime
from kpicast.operators import rollup
from kpicast.sources import readers, sinks
from kpicast.schema import DAILY_KPIS


def values(df, column):
    return [row[column] for row in df.orderBy("i").collect()]


def test_ids(spark):
    raw = ["12", "12.0", " 12 ", "nan", "None", "<NA>", None, "", "1.05", " 7.0 "]
    df = spark.createDataFrame(list(enumerate(raw)), "i int, x string")
    got = values(df.withColumn("id", clean.text_id(F.col("x"))), "id")
    assert got == ["12", "12", "12", "", "", "", "", "", "1.05", "7"]


def test_numbers(spark):
    raw = ["3.5", "x", None, "NaN", "Infinity", " 4 "]
    df = spark.createDataFrame(list(enumerate(raw)), "i int, x string")
    df = df.withColumn("n", clean.number(F.col("x"))).withColumn("f", clean.finite(F.col("n")))
    assert values(df, "n") == [3.5, 0.0, 0.0, 0.0, float("inf"), 4.0]
    assert values(df, "f") == [3.5, 0.0, 0.0, 0.0, 0.0, 4.0]


def test_missing_model_columns_become_zero(spark):
    df = spark.createDataFrame([(1, float("nan"))], "i int, a double")
    row = clean.align_features(df, ["a", "b"]).first()
    assert (row["a"], row["b"]) == (0.0, 0.0)


def test_every_known_zone_is_accepted(spark):
    zones = localtime.known_zones()
    df = spark.createDataFrame([(i, z) for i, z in enumerate(zones)], "i int, z string")
    ts = F.lit("2024-07-01 12:00:00").cast("timestamp")
    hours = df.withColumn("h", localtime.local_hour(ts, "z"))
    assert hours.filter("h IS NOT NULL").count() == len(zones)


@pytest.mark.parametrize(
    "utc, zone, local",
    [
        ("2024-01-01 10:00:00", "Asia/Kolkata", "2024-01-01 15:00:00"),
        # Clocks in New York go forward on 10 March and back on 3 November.
        ("2024-03-10 06:00:00", "America/New_York", "2024-03-10 01:00:00"),
        ("2024-03-10 07:00:00", "America/New_York", "2024-03-10 03:00:00"),
        ("2024-11-03 05:00:00", "America/New_York", "2024-11-03 01:00:00"),
        ("2024-11-03 06:00:00", "America/New_York", "2024-11-03 01:00:00"),
        ("2024-01-01 10:30:00", "", "2024-01-01 10:00:00"),
        ("2024-01-01 10:30:00", "Not/AZone", "2024-01-01 10:00:00"),
        ("1969-12-31 23:30:00", "UTC", "1969-12-31 23:00:00"),
    ],
)
def test_local_hours(spark, utc, zone, local):
    df = spark.createDataFrame([(utc, zone)], "t string, z string")
    hour = localtime.local_hour(F.col("t").cast("timestamp"), "z")
    got = df.select(localtime.wall_clock(hour).alias("w")).first()["w"]
    assert got == dt.datetime.fromisoformat(local)


def test_hours_repeated_by_the_clock_change_are_summed(spark):
    rows = [(f"2024-11-03 0{h}:00:00", "America/New_York", "1", "1", "1", "1", 2.0) for h in (5, 6)]
    df = spark.createDataFrame(
        rows, "date string, timezone string, account_id string, campaign_id string, "
        "adset_id string, ad_id string, spend double",
    )
    got = rollup.hourly_rollup(rollup.clean_hourly(df)).collect()
    assert [(r["spend"], r["impressions"]) for r in got] == [(4.0, 0.0)]


def test_timezone_is_optional_in_daily_facts(spark):
    df = spark.createDataFrame(
        [("AD", "2024-01-02", "1.0", "1", "1", "9", "x", "3")],
        "entity_type string, date string, account_id string, campaign_id string, "
        "adset_id string, ad_id string, spend string, impressions string",
    )
    row = rollup.clean_daily(df).first()
    assert (row["timezone"], row["account_id"], row["spend"], row["impressions"]) == ("", "1", 0.0, 3.0)


def test_header_aliases(spark, tmp_path):
    path = str(tmp_path / "facts")
    text = spark.createDataFrame(
        [("ad", "2024-01-01", "5", "7.5")],
        "entity_type string, date string, conversions string, conversions_value string",
    )
    text.coalesce(1).write.option("header", True).csv(path)
    df = readers.read_csv(spark, path, DAILY_KPIS)
    named = readers.resolve_columns(df)
    assert named.first().asDict() == {
        "entity_type": "ad",
        "date": "2024-01-01",
        "tracker_conversions": "5",
        "tracker_revenue": "7.5",
    }


def test_empty_extract_names_its_arguments(spark):
    empty = spark.createDataFrame([], "a int")
    with pytest.raises(readers.EmptyExtract, match="'days': 3"):
        readers.require_non_empty(empty, "daily", days=3)


def test_one_attempt_unless_others_are_asked_for(spark):
    tried = []

    def extract(days, limit):
        tried.append((days, limit))
        return spark.range(len(tried) // 3)

    steps = ((21, 500), (7, 500), (3, 200))
    rows, used = readers.extract_with_fallback(extract, attempts=steps)
    assert rows.count() == 1 and used == {"lookback_days": 3, "ads_per_account": 200}
    assert tried == list(steps)
    with pytest.raises(readers.EmptyExtract):
        readers.extract_with_fallback(lambda days, limit: spark.range(0), attempts=steps)
    with pytest.raises(readers.EmptyExtract):
        readers.extract_with_fallback(lambda days, limit: spark.range(0))


def test_a_failing_read_is_raised(spark):
    def extract(days, limit):
        raise PermissionError("no access")

    with pytest.raises(PermissionError):
        readers.extract_with_fallback(extract, attempts=((21, 0), (7, 0)))


def test_csv_files_are_matched_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("ad_id,spend\n7,1.5\n")
    (tmp_path / "b.csv").write_text("spend,ad_id\n2.5,8\n")
    (tmp_path / "c.csv").write_text("ad_id,clicks\n9,3\n")
    wanted = T.StructType().add("ad_id", "string").add("spend", "string").add("other", "string")
    rows = readers.read_csv(spark, str(tmp_path), wanted).collect()
    assert sorted(map(tuple, rows)) == [("7", "1.5"), ("8", "2.5"), ("9", None)]


def test_feature_cache_is_built_once(spark, tmp_path):
    built = []

    def build():
        built.append(1)
        return spark.range(3)

    path = sinks.feature_cache_path(str(tmp_path), "6h", "2024-01-01T00")
    for _ in range(2):
        assert sinks.cached_features(spark, build, path).count() == 3
    assert len(built) == 1
