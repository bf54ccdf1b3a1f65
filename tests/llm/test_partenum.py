"""Sketches lose no similar pair, and classes are exact with passages and copies."""

import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from reference import jaccard_links, roots, shingles

from kpicast.llm import partenum


@settings(deadline=None, max_examples=300)
@given(st.integers(1, 400), st.integers(0, 60), st.integers(0, 60), st.integers(0, 9))
def test_sketches_keep_similar_pairs(common, left, right, seed):
    drawn = np.unique(np.random.default_rng(seed).integers(0, 1 << 63, common + left + right, dtype=np.uint64))
    both, one, two = np.split(drawn, [common, common + left])
    a, b = np.sort(np.append(both, one)), np.sort(np.append(both, two))
    kept = partenum.may_be_similar(len(a), partenum.parity(a), len(b), partenum.parity(b))
    if 100 * len(both) >= 80 * len(drawn):
        assert kept
    assert kept == partenum.may_be_similar(len(b), partenum.parity(b), len(a), partenum.parity(a))


def test_sketches_drop_pairs_that_share_a_passage():
    rng = np.random.default_rng(2)
    for size in (100, 250, 1000, 5000):
        passage = rng.integers(0, 1 << 63, int(0.6 * size), dtype=np.uint64)
        sets = [np.unique(np.append(passage, rng.integers(0, 1 << 63, int(0.4 * size), dtype=np.uint64))) for _ in range(6)]
        dropped = [not partenum.may_be_similar(len(x), partenum.parity(x), len(y), partenum.parity(y)) for x in sets[:3] for y in sets[3:]]
        assert sum(dropped) >= 8


@pytest.mark.parametrize(("paired", "sieved"), [(8, 4096), (1, 4096), (2, 3), (8, 0)])
def test_bands_of_sizes_and_shared_passages(spark, monkeypatch, paired, sieved):
    monkeypatch.setattr(partenum, "PAIRED", paired)
    monkeypatch.setattr(partenum, "SIEVED", sieved)
    rng = random.Random(4)
    word = lambda: f"w{rng.randrange(4000)}"
    passages = [[word() for _ in range(60)] for _ in range(3)]
    rows = []
    for size in (6, 12, 30, 80, 200, 500):
        for _ in range(4):
            base = [word() for _ in range(size)] + rng.choice(passages)
            rows.append(list(base))
            for _ in range(4):  # near copies on both sides of the threshold
                own = list(base)
                for _ in range(rng.randrange(1, 2 + len(own) // 30)):
                    own[rng.randrange(len(own))] = word()
                rows.append(own[: len(own) - rng.randrange(0, 1 + len(own) // 12)])
    texts = [(k, " ".join(r)) for k, r in enumerate(rows)]
    found = partenum.near_duplicates(spark.createDataFrame(texts, "doc_id long, text string").repartition(5))
    sets = {k: shingles(t) for k, t in texts}
    assert {r["doc_id"]: r["component_id"] for r in found.collect()} == roots(sets, jaccard_links(sets))
