"""The machines inside the operators against plain versions of themselves."""

import itertools

import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st

from kpicast.llm import crf, itq, packing, partenum, pstable, token_fst
from kpicast.llm.eliasfano import EliasFano
from kpicast.llm.encode import Encoder
from kpicast.llm.line_dedup import common_blocks, patience
from kpicast.llm.queries import vocabulary


@settings(deadline=None, max_examples=60)
@given(st.lists(st.integers(0, 1 << 50), min_size=1, max_size=300), st.lists(st.integers(0, 1 << 51), max_size=50))
def test_elias_fano(values, asked):
    values = np.sort(np.array(values, np.int64))
    sequence = EliasFano.build(values)
    assert (sequence.get(np.arange(len(values))).astype(np.int64) == values).all()
    wanted = np.concatenate([values, np.array(asked, np.int64)])
    place, equal = sequence.find(wanted)
    assert (equal == np.isin(wanted, values)).all()
    assert (place[equal] == np.searchsorted(values, wanted)[equal]).all()


PARTS = ["a", "don", "'s", "'", "'ll", "'re", " ", "  ", "\n", "1", "22", "!", "é", "中文", "the", "😀", "<|endoftext|>", "K", "Σ", "é"]


@settings(deadline=None, max_examples=25)
@given(st.lists(st.lists(st.sampled_from(PARTS), max_size=40).map("".join), min_size=1, max_size=8))
def test_tokenizers_agree(texts):
    machine = token_fst.machine(vocabulary("byte_bpe_50k.json"))
    encoder = _encoder()
    from tokenizers import Tokenizer

    library = _library.setdefault("t", Tokenizer.from_file(vocabulary("byte_bpe_50k.json")))
    column = pa.array(texts, pa.string())
    assert machine.count(column)[1].tolist() == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]
    for text, ids in zip(texts, encoder.encode(column)):
        assert ids.tolist() == encoder.library.encode(text, add_special_tokens=False).ids


_library: dict = {}


def _encoder():
    return _library.setdefault("e", Encoder(vocabulary("word_bpe_49k.json")))


def test_long_words_cross_chunks():
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    texts = ["ab" * 4000, "a" * 5000, "中" * 3000, "x" * 511 + " " + "y" * 700]
    small = token_fst.Transducer(vocabulary("byte_bpe_50k.json"), max_transitions=50)  # starts anew all the time
    for _ in range(2):
        assert small.count(pa.array(texts))[1].tolist() == [
            len(library.encode(t, add_special_tokens=False).ids) for t in texts
        ]


@settings(deadline=None, max_examples=60)
@given(st.lists(st.integers(1, 50), min_size=1, max_size=80))
def test_local_search_keeps_bins_valid(lengths):
    lengths = np.array(lengths)
    first = packing.best_fit(lengths, 50)
    bins = packing.local_search(lengths, first, 50)
    assert np.bincount(bins, weights=lengths).max() <= 50
    assert len(set(bins)) <= len(set(first))


def test_local_search_empties_a_bin():
    # Best fit decreasing needs three bins here, two are enough.
    lengths = np.array([6, 5, 5, 3, 3, 2])
    first = np.array([0, 1, 1, 0, 2, 2])
    bins = packing.local_search(lengths, first, 12)
    assert len(set(bins)) == 2 and np.bincount(bins, weights=lengths).max() <= 12


@settings(deadline=None, max_examples=40)
@given(st.integers(1, 400), st.integers(0, 1000), st.integers(0, 80), st.integers(0, 80))
def test_similar_sets_share_a_signature(size, seed, less, more):
    rng = np.random.default_rng(seed)
    a = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64))
    kept = a[rng.permutation(len(a))[: len(a) - min(less, len(a) - 1)]]
    b = np.unique(np.concatenate([kept, rng.integers(0, 1 << 63, more, dtype=np.uint64)]))
    both = len(np.intersect1d(a, b))
    if 100 * both >= 80 * (len(a) + len(b) - both):
        assert set(partenum.signatures(a).tolist()) & set(partenum.signatures(b).tolist())


@settings(deadline=None, max_examples=60)
@given(st.lists(st.integers(0, 6), max_size=14), st.lists(st.integers(0, 6), max_size=14))
def test_patience_aligns(a, b):
    pairs = patience(a, b)
    assert all(a[i] == b[j] for i, j in pairs)
    assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))


def test_common_blocks_need_enough_words():
    line = lambda n, h, w: (n, n, h, w)
    later = [line(0, 1, 30), line(1, 2, 30), line(2, 9, 5), line(3, 3, 40)]
    earlier = [line(0, 1, 30), line(1, 2, 30), line(2, 3, 40)]
    assert common_blocks(later, earlier, 50) == [(0, 1)]


def test_perturbations_come_in_order():
    inside = np.array([0.1, 0.5, 0.8])
    steps = pstable.perturbations(inside, 27)
    cost = [sum((inside[k] if s < 0 else 1 - inside[k]) ** 2 for k, s in enumerate(step) if s) for step in steps]
    assert cost == sorted(cost) and len({tuple(s) for s in steps}) == 27


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(1)
    counts = np.array([4, 1, 0, 3])
    evidence, steps = rng.normal(size=8), rng.normal(size=(2, 2))
    got, at = crf.marginals(evidence, counts, steps), 0
    for n in counts:
        own = evidence[at : at + n]
        weight = {
            y: np.exp(sum(own[k] * y[k] for k in range(n)) + sum(steps[a, b] for a, b in zip(y, y[1:])))
            for y in itertools.product((0, 1), repeat=int(n))
        }
        for k in range(n):
            good = sum(w for y, w in weight.items() if y[k]) / sum(weight.values())
            assert abs(got[at + k] - good) < 1e-9
        at += n


def test_rotation_loses_less_than_axes():
    x = np.random.default_rng(3).normal(size=(500, 16)) @ np.diag(np.linspace(3, 0.3, 16))
    codes, start = itq.learn(x, rounds=50), itq.learn(x, rounds=0)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)

    def loss(c):
        low = (unit - c.centre) @ c.turn
        return ((np.sign(low) - low) ** 2).sum()

    assert loss(codes) < loss(start)
    assert abs(codes.bits(unit).mean() - 0.5) < 0.1
