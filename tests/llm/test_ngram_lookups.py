"""Look-ups in the levels: passes, groups of tokens and contexts that segments share."""

import sys

import numpy as np
import pyarrow as pa
import pytest

from kpicast.llm import common, ngram_lm
from kpicast.llm.eliasfano import EliasFano


def _calls(work) -> int:
    """Calls of built-in functions that the work makes."""
    found = []
    sys.setprofile(lambda frame, event, arg: found.append(event) if event == "c_call" else None)
    try:
        work()
    finally:
        sys.setprofile(None)
    return len(found)


def test_long_runs_and_gaps_take_no_more_passes():
    n = 200_000
    sequence = EliasFano.build(np.repeat([0, 1 << 30], n // 2))
    edge = np.array([0, n // 2 - 1, n - 2])
    assert _calls(lambda: sequence.pair(edge)) < 200
    assert [x.tolist() for x in sequence.pair(edge)] == [[0, 0, 1 << 30], [0, 1 << 30, 1 << 30]]
    dense = EliasFano.build(np.concatenate([np.arange(n), [1 << 40]]))
    wanted = np.array([0, 77, n - 1, n, 1 << 40, 1 << 41])
    assert _calls(lambda: dense.find(wanted)) < 400
    place, equal = dense.find(wanted)
    assert equal.tolist() == [True, True, True, False, True, False]
    assert place[equal].tolist() == [0, 77, n - 1, n]


@pytest.mark.parametrize("universe", [1, 9, 1 << 9, 1 << 12, 1 << 20, 1 << 36])
def test_pairs_and_ranges(universe):
    rng = np.random.default_rng(universe)
    values = np.sort(rng.integers(0, 500 * universe, 500))
    sequence = EliasFano.build(values)
    at = np.arange(499)
    assert (np.stack(sequence.pair(at)).astype(np.int64) == np.stack([values[:-1], values[1:]])).all()
    begin = np.searchsorted(values, values, "right") - 1
    place, equal = sequence.find(values, begin, begin + 1)
    assert equal.all() and (place == begin).all()
    assert not sequence.find(values, begin, begin)[1].any()


def _model(spark, monkeypatch):
    texts = [" ".join(f"the w{(i * 7 + k) % 40}" for k in range(30)) for i in range(12)] + [None, "", "the the the"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    monkeypatch.setattr(ngram_lm, "SEGMENT", 100)
    return texts, ngram_lm.train(rows)


def test_places_among_successors_span_segments(spark, monkeypatch):
    _, model = _model(spark, monkeypatch)
    level, n = model.grams[0], model.distinct
    keys = (np.repeat(np.arange(n), n) << ngram_lm.ID_BITS) | np.tile(np.arange(n), n)
    ids, share, rank = level.find(keys)
    hit = np.flatnonzero(ids >= 0)
    parent = keys[hit] >> ngram_lm.ID_BITS
    assert ids[hit].tolist() == list(range(level.n))
    assert (rank[hit] == ids[hit] - level.start(parent)).all()
    assert (level.share(keys) == share).all() and (share[hit] > 0).all()
    assert sum(level._skipped(k) > 0 for k in range(len(level.names))) > 1


def test_look_ups_hold_no_more_than_the_files(spark, monkeypatch):
    texts, model = _model(spark, monkeypatch)
    model.score(*ngram_lm.tokens(pa.array(texts)))
    for level in model.grams:
        for k in range(len(level.names)):
            for sequence in (level.segment(k)["pointers"], level.segment(k)["children"]):
                assert not any(getattr(sequence, x).flags.owndata for x in ngram_lm._STORED)


def test_groups_of_any_size_score_alike(spark, monkeypatch):
    texts, model = _model(spark, monkeypatch)
    whole = model.score(*ngram_lm.tokens(pa.array(texts)))
    monkeypatch.setattr(ngram_lm, "CUT", 50)
    monkeypatch.setattr(ngram_lm, "GROUP", 70)
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    groups = list(ngram_lm._grouped(iter([batch, batch.slice(0, 0)])))
    assert len(groups) > 3 and sum(b.num_rows for rows, _, _ in groups for b in rows) == len(texts)
    parts = [model.score(hashes, n) for _, hashes, n in groups]
    for k in (0, 1):
        assert (np.concatenate([p[k] for p in parts]) == whole[k]).all()


def test_sums_of_pieces():
    rng = np.random.default_rng(5)
    keys, counts = rng.integers(0, 50, 300), rng.integers(1, 4, 300)
    counts[7] = 1 << 40
    distinct, sums = ngram_lm._summed(keys, counts)
    assert {int(k): int(c) for k, c in zip(distinct, sums)} == {int(k): int(counts[keys == k].sum()) for k in keys}
    assert (np.diff(distinct) > 0).all()


@pytest.mark.parametrize("n", [1, 5000, common.SMALL_SLICE + 3])
def test_hashes_of_spans_are_polynomials(n):
    rng = np.random.default_rng(n)
    buf = rng.integers(0, 256, n).astype(np.uint8)
    at = np.unique(np.concatenate([[0, n], rng.integers(0, n, min(n, 40))]))
    step, most = int(common._STEP) | 1, 1 << 64
    sums = []
    for a, b in zip(at[:-1], at[1:]):
        total, power = 0, 1
        for x in buf[a : min(b, a + 99)].tolist():
            power = power * step % most
            total += int(common._BYTE_VALUE[x]) * power
        sums.append(total % most)
    ends = np.minimum(at[1:], at[:-1] + 99)
    sums = np.array(sums, np.uint64)
    wanted = common.mix(sums ^ common.mix((ends - at[:-1]).astype(np.uint64)))
    assert (common.span_hashes(buf, at[:-1], ends) == wanted).all()
