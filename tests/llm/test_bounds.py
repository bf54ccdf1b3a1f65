"""Bounds of what reaches the driver or a batch, ids that are texts, vectors of other lengths."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from kpicast.llm import crf, line_dedup, ngram_lm, partenum, pstable
from kpicast.llm.common import BATCH_BYTES


def test_batches_are_bounded_in_bytes(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([batch.nbytes], pa.int64())})

    long_ = spark.range(0, 60, 1, 1).select(F.repeat(F.lit("x"), 2 << 20).alias("text"))
    found = [r["n"] for r in long_.mapInArrow(sizes, "n long").collect()]
    assert sum(found) >= 120 << 20 and max(found) <= BATCH_BYTES + (4 << 20)


def test_ids_may_be_texts(spark):
    passage = " ".join(f"p{k}" for k in range(60))
    rows = [("b", f"one\n{passage}\ntwo"), ("a", f"three\n{passage}"), (None, "four words are here"), ("c", None)]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    found = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(docs).collect()}
    assert found == {"a": f"three\n{passage}", "b": "one\ntwo", None: "four words are here", "c": None}
    labels = spark.createDataFrame([("a", 1), ("b", 0), ("b", 1)], "doc_id string, quality int")
    assert crf.score(docs, crf.fit(docs, labels)).count() == 4
    linked = {r["doc_id"]: r["component_id"] for r in partenum.near_duplicates(docs).collect()}
    assert linked["c"] == "c"


def test_the_fit_takes_a_bounded_number_of_lines(spark, monkeypatch):
    taken = []
    monkeypatch.setattr(crf, "fit_chains", lambda features, counts, labels: taken.append((len(features), len(counts))))
    text = "\n".join(f"line {k}" for k in range(1000))
    docs = spark.createDataFrame([(k % 2, text) for k in range(6)], "doc_id long, text string")
    labels = spark.createDataFrame([(0, 1), (1, 0)], "doc_id long, quality int")
    crf.fit(docs, labels)
    crf.fit(docs, labels, max_chains=5)
    # An id counts once, however many rows have it.
    assert taken[0][0] == 2000 and taken[1] == (5 * crf.CHAIN, 5)


def test_vectors_of_other_lengths_take_no_part(spark):
    rng = np.random.default_rng(4)
    data = [(k, rng.normal(size=8).tolist()) for k in range(60)] + [(100, [1.0, 2.0]), (101, [1.0])]
    rows = spark.createDataFrame(data, "vec_id long, vec array<double>")
    found = pstable.search(rows, rows.filter("vec_id % 50 = 0"), pstable.fit(rows)).collect()
    assert {r["query_id"] for r in found} == {0, 50} and len(found) == 20
    assert all(r["vec_id"] < 60 for r in found)


def test_keys_that_would_wrap_are_refused():
    top = (1 << 63 - ngram_lm.ID_BITS) - 1
    key = np.array([top], np.int64) << ngram_lm.ID_BITS | ngram_lm._LOW
    assert key.view(np.uint64)[0] >> np.uint64(ngram_lm.ID_BITS) == top
    ngram_lm._require_room(top + 1, 63 - ngram_lm.ID_BITS, "2-grams")
    with pytest.raises(OverflowError, match="2-grams"):
        ngram_lm._require_room(top + 2, 63 - ngram_lm.ID_BITS, "2-grams")
