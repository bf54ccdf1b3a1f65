"""Shapes that stress one mechanism: hot groups, parts of candidates, cut blocks."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from reference import jaccard_links, roots, shingles

from kpicast.llm import itq, line_dedup, mixing, ngram_lm, partenum
from kpicast.llm.components import components


def _near_copies(n: int, seed: int = 5) -> list[tuple[int, str]]:
    rng = np.random.default_rng(seed)
    base = [f"w{k}" for k in rng.integers(0, 500, 120)]
    out = []
    for i in range(n):
        own = list(base)
        for k in rng.integers(0, len(own), int(rng.integers(0, 5))):
            own[k] = f"x{rng.integers(0, 9)}"
        out.append((i, " ".join(own)))
    return out


@pytest.mark.parametrize("elements", [8 << 20, 1500])
def test_large_groups_of_near_copies(spark, monkeypatch, elements):
    monkeypatch.setattr(partenum, "PART_ELEMENTS", elements)
    rows = _near_copies(60) + [(100 + i, t) for i, t in _near_copies(40, 9)]
    got = {r["doc_id"]: r["component_id"] for r in partenum.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    sets = {i: shingles(t) for i, t in rows}
    assert got == roots(sets, jaccard_links(sets))


def test_chains_become_one_component(spark):
    edges = spark.range(200).selectExpr("id + 1 AS a", "id AS b").unionByName(
        spark.range(1000, 1010).selectExpr("id AS a", "1000L AS b")
    )
    found = {r["id"]: r["component"] for r in components(edges).collect()}
    assert {found[k] for k in range(201)} == {0} and {found[k] for k in range(1000, 1010)} == {1000}
    assert components(edges.limit(0)).count() == 0


def test_full_buckets_are_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(itq, "BLOCK", 16)
    rng = np.random.default_rng(2)
    centre = rng.normal(size=64)
    near = [(i, 1, (centre + 0.02 * rng.normal(size=64)).tolist()) for i in range(100)]
    far = [(1000 + i, 1, rng.normal(size=64).tolist()) for i in range(50)]
    rows = spark.createDataFrame(near + far, "vec_id long, label int, embedding array<double>")
    got = {r["vec_id"]: r for r in itq.near_duplicates(rows).collect()}
    assert all(got[i]["n_links"] == 99 and got[i]["component_id"] == 0 for i in range(100))
    assert all(got[1000 + i]["n_links"] == 0 for i in range(50))


def test_a_passage_goes_from_all_later_documents(spark):
    passage = " ".join(f"p{k}" for k in range(55))
    rows = [(i, f"own {i} line\n{passage}\nend {i}" if i % 3 == 0 else f"own {i} line") for i in range(90)]
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [i for i in got if passage in got[i]] == [0]
    assert got[3] == "own 3 line\nend 3" and got[4] == "own 4 line"


def test_targets_are_met_or_limited(spark):
    totals = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 500), (None, 90)], "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(totals).collect()}
    # Weights 1, 2, 3, 1: "a" stops at three times its size, the others share 1570 by 2, 3, 1.
    assert got["a"] == 30.0
    assert [got[k] for k in ("b", "c", None)] == pytest.approx([1570 * 2 / 6, 1570 * 3 / 6, 1570 / 6])


def test_levels_in_many_segments_score_alike(spark, monkeypatch):
    rows = spark.createDataFrame(_near_copies(50), "doc_id long, text string")
    one = {r["doc_id"]: r["_score"] for r in ngram_lm.score(rows, ngram_lm.train(rows)).collect()}
    monkeypatch.setattr(ngram_lm, "SEGMENT", 20)
    model = ngram_lm.train(rows)
    assert len(model.grams[1].names) > 3
    two = {r["doc_id"]: r["_score"] for r in ngram_lm.score(rows, model).collect()}
    # Code books differ by segment.
    assert all(abs(one[i] - two[i]) < 0.02 * 121 for i in one)


def test_repeated_rows_get_equal_copies(spark):
    rows = spark.range(100).select("id").unionAll(spark.range(100)).select(
        F.col("id").alias("doc_id"), F.lit("some words here").alias("text"),
        F.when(F.col("id") < 10, "a").otherwise("b").alias("source"),
    )
    planned = mixing.planned(rows)
    assert planned.groupBy("doc_id").agg(F.count_distinct("_copies").alias("n")).filter("n > 1").count() == 0
