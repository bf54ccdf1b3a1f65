"""Copies and salt for measured hot keys alone."""

from pyspark.sql import functions as F

from kpicast.operators import joins, peers


def tables(spark, hot):
    rows = spark.range(20_000).selectExpr(f"CAST(if(id % 2 = 0 AND {hot}, 0, id % 1000 + 1) AS string) AS k", "id AS ad_id")
    table = rows.select("k").distinct().withColumn("v", F.concat(F.lit("v"), "k"))
    return rows, table, rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"))


def test_a_key_with_half_of_all_rows_is_spread(spark):
    rows, table, counts = tables(spark, "true")
    found = joins.hot_keys(counts, ["k"]).collect()
    assert [(r["k"], r["_copies"]) for r in found] == [("0", joins.HITTERS // 2)]
    joined = joins.measured_lookup(rows, table, counts, ["k"], ["ad_id"])
    assert joined.columns == ["k", "ad_id", "v"]
    assert joined.count() == 20_000 and joined.filter("v = concat('v', k)").count() == 20_000


def test_without_a_hot_key_nothing_is_repeated(spark):
    rows, table, counts = tables(spark, "false")
    assert joins.hot_keys(counts, ["k"]).count() == 0
    assert joins.measured_lookup(rows, table, counts, ["k"], ["ad_id"], "inner").count() == 20_000


def test_keys_without_a_partner_and_null_keys_stay(spark):
    rows = spark.createDataFrame([("a", 1), (None, 2), ("b", 3)], "k string, ad_id int")
    table = spark.createDataFrame([("a", 5)], "k string, v int")
    counts = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    got = joins.measured_lookup(rows, table, counts, ["k"], ["ad_id"]).collect()
    assert sorted((r["ad_id"], r["v"]) for r in got) == [(1, 5), (2, None), (3, None)]


def test_peers_of_an_adset_with_half_of_all_ads(spark):
    rows = spark.range(4000).selectExpr(
        "CAST(id AS string) AS ad_id", "'a' AS account_id", "'c' AS campaign_id",
        "if(id % 2 = 0, 'hot', CAST(id % 500 AS string)) AS adset_id", "CAST(id % 7 AS double) AS v",
    )
    got = {r["ad_id"]: r["v_adset_peer"] for r in peers.peer_means(rows, {"v": "v"}, 2).collect()}
    values = [float(i % 7) for i in range(4000) if i % 2 == 0]
    total, n = sum(values), sum(v > 0 for v in values)
    assert len(got) == 4000
    for i in (0, 2, 8, 14):
        own = float(i % 7)
        assert abs(got[str(i)] - (total - own) / (n - (own > 0))) < 1e-9
