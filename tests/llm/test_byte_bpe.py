"""Ids and bytes against the library and an exact round trip."""

import base64
import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st
from llm_inputs import EXTRA, documents

from kpicast.llm import byte_bpe, queries

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@settings(deadline=None, max_examples=400)
@given(st.text(st.sampled_from("ab'sStll1² \t\n\x1c\x85\xa0　.!é中。ァ̀Ⅷ​😀"), max_size=40))
def test_texts_cut_at_safe_places_have_the_same_ids(text):
    codec = byte_bpe.codec(PATH)
    ids = codec.encode(text, 2)
    assert ids.tolist() == codec.library.encode_ordinary(text)
    assert codec.decode(ids, 3) == text.encode()


@pytest.mark.parametrize("text", [" " * 300_000 + "a", "\n" * 70_000, "x" * 400_000, "中" * 100_000, "a1" * 90_000])
def test_long_texts_come_back(text):
    codec = byte_bpe.codec(PATH)
    ids = codec.encode(text)
    assert codec.decode(ids) == text.encode()
    if " " * 2 not in text:
        assert ids.tolist() == codec.library.encode_ordinary(text)


def test_rows_of_every_kind(spark, library):
    docs = documents(spark).withColumnRenamed("_bytes", "other").selectExpr("*", "row AS _ids", "row AS _bytes")
    texts = dict(docs.select("row", "text").collect())
    rows = byte_bpe.decode(byte_bpe.encode(docs, PATH).selectExpr("*", "_ids AS ids"), PATH, "ids")
    assert set(EXTRA) - {"_bytes"} <= set(rows.columns) and rows.count() == len(texts)
    for r in rows.collect():
        text = texts[r["row"]] or ""
        assert np.frombuffer(r["_ids"], "<u4").tolist() == library.encode_ordinary(text)
        assert bytes(r["_bytes"]) == text.encode()
    assert byte_bpe.encode(docs.limit(0), PATH).count() == 0


def test_query(spark, library):
    folder = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    found = queries.op13_byte_bpe(spark, folder).collect()
    assert len(found) == len(texts)
    for r in found:
        ids = np.array(library.encode_ordinary(texts[r["doc_id"]]), "<u4")
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(ids.tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()
