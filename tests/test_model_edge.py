"""The vector that models see, and how often it is built."""

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from kpicast.functions.clean import align_features
from kpicast.operators import hourly, models

ODD = [
    (1, 1.0, None, 3), (2, float("nan"), float("inf"), None), (3, -0.0, -float("inf"), 7),
    (4, 0.0, 0.0, 0), (5, 1.5, 2.5, 4), (6, None, None, None), (1, 1.0, None, 3),
]


def test_vector_is_that_of_aligned_columns(spark):
    df = spark.createDataFrame(ODD, "id int, a double, b double, c int")
    names = ["a", "b", "c", "missing"]
    plain = VectorAssembler(inputCols=names, outputCol="features").transform(align_features(df, names))
    got = [(r["id"], r["features"]) for r in models.assemble(df, names, ["id"]).collect()]
    assert got == [(r["id"], r["features"]) for r in plain.collect()]


def test_no_expression_per_feature(spark):
    names = [f"f{k}" for k in range(40)]
    df = spark.range(3).select("id", *[(F.col("id") * k).cast("double").alias(n) for k, n in enumerate(names)])
    plan = models.assemble(df, names, ["id"])._jdf.queryExecution().analyzed().toString()
    assert plan.lower().count("isnan(") <= 1


def test_folders_with_the_same_features_share_a_vector(spark, tmp_path, monkeypatch):
    rows = spark.createDataFrame(
        [(float(k), float(k % 3), "train" if k < 20 else "test") for k in range(30)], "a double, t double, split string"
    )
    rows = rows.withColumns({"target_x": F.col("t"), "target_y": F.col("t") * 2})
    few = models.TreeParams(iterations=1, depth=1, bins=8, min_rows=1)
    folders = {}
    for m in ("x", "y"):
        folders[m] = str(tmp_path / m)
        models.fit_targets(rows, ["a"], {m: f"target_{m}"}, {m: few}, folders[m])
    targets, outputs = {m: f"target_{m}" for m in folders}, {m: f"p_{m}" for m in folders}
    built, real = [], models.with_vector
    monkeypatch.setattr(models, "with_vector", lambda df, f, name: built.append(name) or real(df, f, name))
    both = models.predict_targets(rows, models.Routing(folders), targets, outputs)
    assert len(built) == 1 and set(both.columns) == {*rows.columns, "p_x", "p_y"}
    for m in folders:
        one = models.predict_targets(rows, models.Routing({m: folders[m]}), targets, outputs)
        assert [r[f"p_{m}"] for r in one.collect()] == pytest.approx([r[f"p_{m}"] for r in both.collect()])


def test_week_totals_run_no_second_window(spark):
    hours = spark.createDataFrame(
        [("z", *"abcd", k, *[float(k % 7 + n) for n in range(5)]) for k in range(0, 400, 5)],
        f"timezone string, {', '.join(f'{c} string' for c in hourly.ENTITY)}, hour_idx long, "
        + ", ".join(f"{m} double" for m in hourly.METRICS),
    )
    rows = hourly.block_windows(hourly.hour_blocks(hours))
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("sum(spend_6") and all(f"AS {m}_cum" not in line for m in hourly.METRICS for line in plan.splitlines() if "windowspecdefinition" in line)
    for r in rows.collect():
        assert all(r[f"{m}_cum"] == r[f"{m}_sum_168h"] for m in hourly.METRICS)
