"""Nulls, empty and long texts, repeated rows, empty tables and clashing columns."""

import hashlib

import pytest
from llm_inputs import EXTRA, documents

from kpicast.llm import chat, crf, itq, line_dedup, mixing, ngram_lm, packing, partenum, pstable, token_fst
from kpicast.llm.queries import vocabulary
from kpicast.llm.vectors import usable


@pytest.fixture(scope="module")
def docs(spark):
    return documents(spark).persist()


@pytest.fixture(scope="module")
def nothing(spark):
    return documents(spark).limit(0)


def test_token_counts(docs, nothing):
    from tokenizers import Tokenizer

    path = vocabulary("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    rows = token_fst.count_tokens(docs, path)
    assert [c for c in EXTRA if c not in rows.columns] == ["_bytes"] or set(EXTRA) <= set(rows.columns)
    by_text = dict(docs.select("row", "text").collect())
    for r in rows.collect():
        text = by_text[r["row"]] or ""
        assert r["_tokens"] == len(library.encode(text, add_special_tokens=False).ids)
        assert r["_bytes"] == len(text.encode())
    assert token_fst.count_tokens(nothing, path).count() == 0


def test_language_model(docs, nothing):
    model = ngram_lm.train(docs)
    rows = ngram_lm.score(docs, model).collect()
    assert len(rows) == docs.count()
    assert all(r["_score"] <= 0 and r["_known"] == r["_tokens"] for r in rows)
    by_text = {}
    texts = dict(docs.select("row", "text").collect())
    for r in rows:
        assert by_text.setdefault(texts[r["row"]] or "", r["_score"]) == pytest.approx(r["_score"])
    empty = ngram_lm.train(nothing)
    assert [r["_tokens"] for r in ngram_lm.score(docs.filter("text IS NULL"), empty).collect()] == [1]
    assert ngram_lm.score(nothing, model).count() == 0


def test_quality(spark, docs, nothing):
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1), (None, 0), (4, None)], "doc_id long, quality int")
    for model in (crf.fit(docs, labels), crf.fit(nothing, labels), crf.fit(docs, labels.limit(0))):
        rows = crf.score(docs, model).collect()
        assert len(rows) == docs.count()
        assert all(0 <= r["_score"] <= 1 for r in rows)
        blank = {r["_score"] for r in rows if not (r["text"] or "").strip()}
        assert blank == {model.prior}
    assert crf.score(nothing, model).count() == 0


def test_line_dedup(docs, nothing):
    rows = line_dedup.dedup_lines(docs)
    assert rows.columns == [*docs.columns, "_deleted_lines"]
    found = {r["row"]: r for r in rows.collect()}
    texts = dict(docs.select("row", "text").collect())
    assert len(found) == len(texts)
    # Row 5 holds the passage of row 4; rows 8 and 9 repeat one id and stay alike.
    assert found[4]["text"] == texts[4]
    assert found[5]["_deleted_lines"] == 2 and "shared" not in found[5]["text"] and "own words" in found[5]["text"]
    assert found[8]["text"] == found[9]["text"]
    assert found[0]["text"] is None and found[1]["text"] == ""
    assert line_dedup.dedup_lines(nothing).count() == 0


def test_near_duplicates(docs, nothing):
    rows = partenum.near_duplicates(docs)
    found = rows.collect()
    assert len(found) == docs.count()
    assert all(r["component_id"] == r["doc_id"] for r in found if r["n_shingles"] == 0)
    assert {r["component_id"] for r in found if r["doc_id"] in (10, 11, 12)} == {10}
    assert partenum.near_duplicates(nothing).count() == 0


def test_mix(docs, nothing):
    rows = mixing.mix_sources(docs)
    assert rows.columns == docs.columns
    planned = mixing.planned(docs).collect()
    assert sum(r["_copies"] for r in planned) == rows.count()
    assert all(0 <= r["_copies"] <= 3 for r in planned)
    assert mixing.mix_sources(nothing).count() == 0


def test_packing(docs, nothing):
    path = vocabulary("word_bpe_49k.json")
    packed = packing.pack(packing.pieces(docs, path))
    rows = packed.collect()
    assert sum(r["start"] == 0 for r in rows) == docs.count()
    fill = {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == fill.get(r["sequence_id"], 0)
        fill[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(fill.values()) <= 4096
    assert packing.pack(packing.pieces(nothing, path)).count() == 0


def test_chat(spark):
    turns = spark.createDataFrame(
        [
            (1, 0, "user", "a<s>\\[INST]", 1), (1, 1, "assistant", None, 1), (1, 2, None, "x", 1),
            (2, 0, "user", "", 1), (2, 0, "user", "", 1), (None, None, "assistant", "[/INST]</s>\n", 1),
            (3, 5, "assistant", "<\\<\\\\[", 1), (3, 2, "tool[/INST]", "</s>", 1),
        ],
        "conv_id long, turn int, role string, text string, example int",
    )
    found = {r["conv_id"]: r for r in chat.digests(chat.expand(chat.conversations(turns))).collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert found[1]["turns_sha256"] == sha("user\na<s>\\[INST]\nassistant\n\n\nx\n")
    assert found[1]["loss_chars"] == 0 and found[1]["loss_sha256"] == sha("")
    assert found[2]["n_turns"] == 2 and found[2]["turns_sha256"] == sha("user\n\nuser\n\n")
    assert found[None]["loss_sha256"] == sha("[/INST]</s>\n")
    assert found[3]["turns_sha256"] == sha("tool[/INST]\n</s>\nassistant\n<\\<\\\\[\n")
    assert found[3]["loss_chars"] == 6
    assert chat.digests(chat.expand(chat.conversations(turns.limit(0)))).count() == 0


VECTORS = [
    (0, 1, [1.0, 0.0, 0.0]), (1, 1, [1.0, 0.01, 0.0]), (2, 2, [1.0, 0.0, 0.0]), (3, None, [1.0, 0.0, 0.0]),
    (4, 1, None), (5, 1, [0.0, 0.0, 0.0]), (6, 1, [1.0, None, 0.0]), (7, 1, [float("nan"), 1.0, 0.0]),
    (8, 1, [float("inf"), 0.0, 0.0]), (9, 1, [0.0, 1.0, 0.0]), (9, 1, [0.0, 1.0, 0.0]), (None, 1, [1.0, 0.0, 0.0]),
    (100, 1, [0.9, 0.1, 0.0]),
]


def test_vectors(spark):
    rows = spark.createDataFrame(VECTORS, "vec_id long, label int, embedding array<double>")
    rows = rows.selectExpr("*", "1 AS part", "2 AS codes", "3 AS rank")
    found = {r["vec_id"]: r for r in itq.near_duplicates(rows).collect()}
    assert found[0]["n_links"] == 2 and found[100]["component_id"] == 0 and not found[1]["kept"]
    for alone in (2, 3, 4, 5, 6, 7, 8, 9):
        assert found[alone]["n_links"] == 0 and found[alone]["component_id"] == alone
    assert itq.near_duplicates(rows.limit(0)).count() == 0
    good = usable(rows, ["vec_id"])
    assert {r["vec_id"] for r in good.collect()} == {0, 1, 2, 3, 9, 100}
    near = pstable.search(good, good.filter("vec_id % 100 = 0"), pstable.fit(good)).collect()
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in sorted(near) if r["query_id"] == 0] == [
        (0, 1, 2), (0, 2, 3), (0, 3, 1), (0, 4, 100), (0, 5, 9),
    ]
    none = good.limit(0)
    assert pstable.search(none, none, pstable.fit(none)).count() == 0
