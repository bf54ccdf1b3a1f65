import numpy as np
import pytest
from pyspark.sql import functions as F

from kpicast.operators.quantiles import exact_quantiles

PROBS = {"low": 0.1, "mid": 0.5, "high": 0.9, "top": 0.995}


def frame(spark, groups):
    rows = [(k, i, float(v)) for k, vs in groups.items() for i, v in enumerate(vs)]
    return spark.createDataFrame(rows, "k string, i int, v double")


@pytest.mark.parametrize("few", [True, False])
def test_equals_numpy(spark, few):
    rng = np.random.default_rng(3)
    groups = {
        "one": [5.0],
        "two": [1.0, 2.0],
        "ties": [3.0] * 40 + [4.0],
        "zeros": [0.0] * 90 + list(range(10)),
        "many": rng.gamma(0.4, 100.0, 4000),
        "odd": rng.normal(size=37),
    }
    got = exact_quantiles(frame(spark, groups), ["k"], "v", PROBS, ["i"], few_keys=few).collect()
    assert {r["k"] for r in got} == set(groups)
    for r in got:
        assert r["n"] == len(groups[r["k"]])
        for name, p in PROBS.items():
            assert r[name] == pytest.approx(np.quantile(groups[r["k"]], p), abs=1e-12)


@pytest.mark.parametrize("size", [8, 50, 200])
@pytest.mark.parametrize("order", ["mixed", "rising", "falling", "zigzag"])
def test_exact_where_the_sketch_is_not(spark, size, order):
    rng = np.random.default_rng(size)
    values = rng.permutation(np.concatenate([rng.normal(size=3000), np.zeros(1500)]))
    if order != "mixed":
        values = np.sort(values)[:: -1 if order == "falling" else 1]
    if order == "zigzag":
        values = np.ravel(np.stack([values[: len(values) // 2], values[::-1][: len(values) // 2]], 1))
    df = frame(spark, {"g": values}).repartition(13)
    got = exact_quantiles(df, ["k"], "v", PROBS, ["i"], size=size).first()
    for name, p in PROBS.items():
        assert got[name] == pytest.approx(np.quantile(values, p), abs=1e-12)


@pytest.mark.parametrize("few", [True, False])
def test_thresholds_that_are_all_wrong(spark, monkeypatch, few):
    """Whatever the sketch says, the values are exact."""
    from kpicast.operators import quantiles

    wrong = F.array(*(F.lit(float(x)) for _ in PROBS for x in (-3, -2, -2, -2, 0, 0)))
    monkeypatch.setattr(quantiles, "thresholds", lambda s, probs, size: F.when(F.max(F.lit(1)) > 0, wrong))
    rng = np.random.default_rng(1)
    groups = {"a": rng.normal(size=500), "b": np.round(rng.normal(size=300), 1), "c": [1.0, 2.0], "d": [-2.5]}
    for r in exact_quantiles(frame(spark, groups), ["k"], "v", PROBS, ["i"], few_keys=few).collect():
        for name, p in PROBS.items():
            assert r[name] == pytest.approx(np.quantile(groups[r["k"]], p), abs=1e-12)


def test_nan_is_no_value(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", float("nan")), ("b", float("nan"))], "k string, v double")
    got = exact_quantiles(df, ["k"], "v", {"q": 0.5}, [], few_keys=True).collect()
    assert [(r["k"], r["n"], r["q"]) for r in got] == [("a", 1, 1.0)]


def test_whole_frame_and_nulls(spark):
    df = spark.createDataFrame([(1.0,), (None,), (4.0,)], "v double")
    got = exact_quantiles(df, [], "v", {"q": 0.5}, []).first()
    assert (got["n"], got["q"]) == (2, 2.5)


def test_empty(spark):
    df = spark.createDataFrame([], "k string, i int, v double")
    assert exact_quantiles(df, ["k"], "v", {"q": 0.5}, ["i"]).count() == 0
    assert exact_quantiles(df.filter(F.lit(True)), [], "v", {"q": 0.5}, []).count() == 0
