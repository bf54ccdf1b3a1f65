"""Counting of n-grams by ranges of keys."""

import numpy as np
import pandas as pd
import pytest

from kpicast.llm import ngram_lm


def _rows(counts):
    return pd.DataFrame([ngram_lm._totals(np.array(c)) for c in counts])


@pytest.mark.parametrize("n", [1, 2, 5000])
def test_keys_come_back_in_fewer_bytes(n):
    rng = np.random.default_rng(n)
    keys = np.unique(rng.integers(0, 1 << 14, n) << ngram_lm.ID_BITS | rng.integers(0, 1 << 14, n))
    counts = rng.integers(1, 3, len(keys))
    counts[0] = 1 << 40
    blob = ngram_lm._packed(keys, counts)
    back = ngram_lm._unpacked(blob, len(keys))
    assert (back[0] == keys).all() and (back[1] == counts).all()
    assert n < 5000 or len(blob) < 5 * len(keys)
    edge = np.array([0, 1, ngram_lm._LOW, 1 << 31, (1 << 63) - 1])
    assert (ngram_lm._unpacked(ngram_lm._packed(edge, edge + 1), 5)[0] == edge).all()


def test_shards_get_as_many_words_each():
    counts = [np.ones(1000, int), np.ones(3000, int)]
    bounds = ngram_lm._bounds(_rows(counts), 4, 100)
    assert (np.diff(np.concatenate([[0], bounds >> ngram_lm.ID_BITS, [4000]])) < 1200).all()


def test_a_context_of_most_words_is_cut():
    counts = np.ones(1000, int)
    counts[500] = 9000
    bounds = ngram_lm._bounds(_rows([counts]), 10, 5000)
    assert (np.diff(bounds) >= 0).all() and len(bounds) == 9
    hot = bounds[bounds >> ngram_lm.ID_BITS == 500] & ngram_lm._LOW
    assert len(hot) >= 8 and np.diff(hot).max() < 1000


def test_places_by_segment():
    of = np.array([3, -1, 3, 0, 0, -1, 7])
    got = {k: at.tolist() for k, at in ngram_lm._by_segment(of)}
    assert got == {-1: [1, 5], 0: [3, 4], 3: [0, 2], 7: [6]}
    assert list(ngram_lm._by_segment(np.zeros(0, int))) == []


def test_contexts_in_several_shards_keep_their_sums(spark, monkeypatch):
    texts = [" ".join(f"the w{(i * 7 + k) % 40}" for k in range(30)) for i in range(12)] + [None, "", "the the the"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    one = {r["doc_id"]: r["_score"] for r in ngram_lm.score(rows, ngram_lm.train(rows)).collect()}
    monkeypatch.setattr(ngram_lm, "SEGMENT", 100)
    model = ngram_lm.train(rows)
    starts = model.grams[0].first >> ngram_lm.ID_BITS
    assert len(starts) > 2 and len(np.unique(starts)) < len(starts)
    two = {r["doc_id"]: r["_score"] for r in ngram_lm.score(rows, model).collect()}
    assert all(abs(one[i] - two[i]) < 0.02 * 62 for i in one)

