"""Results that an earlier version left out: blocks, alignments, n-grams, characters."""

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from reference import words

from kpicast.llm import line_dedup, ngram_lm, packing, queries
from kpicast.llm.encode import Encoder
from kpicast.llm.queries import vocabulary


def _common_lines(later, earlier, min_words):
    """Places of the later document's lines in any common run of ``min_words``."""
    gone = set()
    for i in range(len(later)):
        for j in range(len(earlier)):
            k = 0
            while i + k < len(later) and j + k < len(earlier) and later[i + k] == earlier[j + k]:
                k += 1
            if sum(x[1] for x in later[i : i + k]) >= min_words:
                gone |= set(range(i, i + k))
    return gone


def _line(k, words):
    return " ".join(f"l{k}w{n}" for n in range(words))


def _deduped(spark, rows):
    found = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    return {r["doc_id"]: r["text"] for r in found}


def test_a_block_goes_though_each_line_is_in_an_earlier_document(spark):
    one, two = _line(1, 30), _line(2, 30)
    rows = [(1, f"a\n{one}\nb"), (2, f"c\n{two}\nd"), (3, f"e\n{one}\n{two}\nf"), (4, f"g\n{one}\n{two}\nh")]
    got = _deduped(spark, rows)
    assert got[4] == "g\nh"
    assert all(got[i] == text for i, text in rows[:3])


def test_blocks_among_many_documents_are_found(spark):
    rng = np.random.default_rng(3)
    sizes = [1, 20, 25, 30, 49, 60]
    docs = [[(int(k), sizes[k]) for k in rng.integers(0, 6, int(rng.integers(1, 7)))] for _ in range(60)]
    # A blank line between all lines, which goes only inside a block.
    rows = [(i, "\n\n".join(_line(*x) for x in doc)) for i, doc in enumerate(docs)]
    got = _deduped(spark, rows)
    for i, doc in enumerate(docs):
        gone = set().union(*(_common_lines(doc, docs[j], 50) for j in range(i)), set())
        assert [x for x in got[i].split("\n") if x] == [_line(*x) for k, x in enumerate(doc) if k not in gone]


LINES = st.lists(st.sampled_from([(0, 50), (1, 30), (2, 20), (3, 49), (4, 70)]), max_size=9)


@settings(deadline=None, max_examples=300)
@given(LINES, LINES)
def test_common_blocks_are_all_common_runs(later, earlier):
    lines = lambda rows: [(n, n, *x) for n, x in enumerate(rows)]
    got = {k for a, b in line_dedup.common_blocks(lines(later), lines(earlier), 50) for k in range(a, b + 1)}
    assert got == _common_lines(later, earlier, 50)


def test_repeated_and_reordered_passages_go():
    lines = lambda rows: [(n, n, x, 50) if x.isupper() else (n, n, x, 2) for n, x in enumerate(rows)]
    assert line_dedup.common_blocks(lines(["h", "P", "f"]), lines(["g", "P", "s", "P", "e"]), 50) == [(1, 1)]
    assert line_dedup.common_blocks(lines(["h", "P", "f", "P"]), lines(["g", "P", "s"]), 50) == [(1, 1), (3, 3)]
    assert line_dedup.common_blocks(lines(["Q", "P"]), lines(["P", "Q"]), 50) == [(0, 0), (1, 1)]


@pytest.mark.parametrize("least", [1, 2])
def test_language_model_of_all_ngrams(spark, least):
    folder = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    tokens = {r["doc_id"]: [*words(r["text"]), None] for r in rows.collect()}
    train = [x for i, x in tokens.items() if zlib.crc32(str(i).encode()) % 7 != 2]
    counts = [Counter(g for x in train for g in zip(*(x[k:] for k in range(n)))) for n in (1, 2, 3)]
    total, distinct = sum(counts[0].values()), len(counts[0])
    off = [sum(c == 1 for c in n.values()) / sum(c * (c < 3) for c in n.values()) for n in counts]
    if least > 1:
        off[1:] = ngram_lm.DISCOUNT, ngram_lm.DISCOUNT
    kept = [counts[0], *({g: c for g, c in n.items() if c >= least} for n in counts[1:])]
    mass = [Counter(), Counter(), Counter()]
    for n in (1, 2):
        for g, c in kept[n].items():
            mass[n][g[:-1]] += c - off[n]

    def logp(x, k):
        own = counts[0][(x[k],)]
        p = (own - off[0]) / total if own else off[0] * distinct / total
        for n in (1, 2):
            h = tuple(x[k - n : k]) if k >= n else ()
            if h in kept[n - 1]:
                below = kept[n - 1][h]
                p = max(kept[n].get((*h, x[k]), 0) - off[n], 0) / below + (1 - mass[n][h] / below) * p
        return math.log10(p)

    if least == 1:
        found = queries.op1_ngram_lm(spark, folder).selectExpr("doc_id", "score AS _score")
    else:
        held_out = queries.fold(rows["doc_id"], 7) == 2
        found = ngram_lm.score(rows, ngram_lm.train(rows.filter(~held_out), min_count=2))
    for r in found.collect():
        x = tokens[r["doc_id"]]
        assert abs(r["_score"] - sum(logp(x, k) for k in range(len(x)))) < 0.03 * len(x) + 0.05


def test_lower_case_beyond_the_table():
    encoder = Encoder(vocabulary("word_bpe_49k.json"))
    texts = ["aȺb Ⱦ", "Ⴀ and ჅX", "plain words", "ȺȾ Ⱥ", "Ꭰ K Å"]
    for text, ids in zip(texts, encoder.encode(pa.array(texts))):
        assert ids.tolist() == encoder.library.encode(text, add_special_tokens=False).ids


def test_exchanges_reach_all_pieces_of_a_bin():
    # The only exchange gives the two last pieces of the emptiest bin for one of 19.
    lengths = np.array([3] * 32 + [10] * 2 + [19, 980] * 120)
    bins = np.array([0] * 34 + [k for k in range(1, 121) for _ in range(2)])
    found = packing.local_search(lengths, bins, 1000)
    fill = np.bincount(found, weights=lengths)
    assert fill.max() == 1000 and fill.sum() == lengths.sum()
