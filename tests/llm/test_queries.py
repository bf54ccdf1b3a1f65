"""Every registered query over whole tables: SQL where there is some, else brute force."""

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from compare import connect, differences
from reference import jaccard_links, roots, shingles, words

import corpus_pipeline
from kpicast.llm import line_dedup, queries
from kpicast.llm.queries import vocabulary

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").orderBy("doc_id").collect()
    return {r["doc_id"]: r["text"] for r in rows}


def result(spark, name):
    return queries.QUERIES[name](spark, SF_DIR).toPandas()


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql(spark, name):
    found, sql = result(spark, name), connect(SF_DIR).execute(queries.ORACLES[name]).df()
    whole = {c: "Int64" for c in ("parent_conv_id",) if c in found}  # a null makes pandas read doubles
    assert differences(found.astype(whole), sql.astype(whole)) == []


def test_language_model(spark, docs):
    got = result(spark, "op1_ngram_lm").set_index("doc_id")
    tokens = {i: [*words(t), None] for i, t in docs.items()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in docs}
    train = [x for i, x in tokens.items() if not held[i]]
    counts = [Counter(g for x in train for g in zip(*(x[k:] for k in range(n)))) for n in (1, 2, 3)]
    total, distinct = sum(counts[0].values()), len(counts[0])
    off = [sum(c == 1 for c in n.values()) / sum(c * (c < 3) for c in n.values()) for n in counts]
    mass = [Counter(), Counter(), Counter()]
    for n in (1, 2):
        for g, c in counts[n].items():
            mass[n][g[:-1]] += c - off[n]

    def logp(x, k):
        own = counts[0][(x[k],)]
        p = (own - off[0]) / total if own else off[0] * distinct / total
        for n in (1, 2):
            h = tuple(x[k - n : k]) if k >= n else ()
            if h in counts[n - 1]:
                below = counts[n - 1][h]
                p = max(counts[n].get((*h, x[k]), 0) - off[n], 0) / below + (1 - mass[n][h] / below) * p
        return math.log10(p)

    for i, x in tokens.items():
        r = got.loc[i]
        assert (r["held_out"], r["n_tokens"], r["train_tokens"]) == (held[i], len(x), total)
        assert r["n_known"] == sum((w,) in counts[0] for w in x)
        base = sum(math.log10((counts[0][(w,)] + 1) / (total + distinct + 1)) for w in x)
        assert r["base_score"] == pytest.approx(base, abs=1e-6)
        # Quantised factors: a few hundredths a token at most.
        assert abs(r["score"] - sum(logp(x, k) for k in range(len(x)))) < 0.03 * len(x) + 0.05
    out = got[got["held_out"]]
    assert out["score"].sum() > 0.9 * out["base_score"].sum()


def test_packing(spark, docs):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    got = result(spark, "op3_best_fit_packing")
    pieces = {(r.doc_id, r.piece): r for r in got.itertuples()}
    total = 0
    for i, text in docs.items():
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        total += len(ids)
        for p, s in enumerate(range(0, len(ids), 4096)):
            own, r = ids[s : s + 4096], pieces.pop((i, p))
            assert (r.start, r.length) == (s, len(own))
            assert r.ids_crc32 == zlib.crc32(np.array(own, "<u4").tobytes())
    assert not pieces
    for _, group in got.sort_values("offset").groupby("sequence_id"):
        ends = group["offset"] + group["length"]
        assert group["offset"].tolist() == [0, *ends.tolist()[:-1]] and ends.max() <= 4096
    assert got["sequence_id"].nunique() <= math.ceil(total / 4096) + 1


def test_line_dedup(spark, docs):
    got = result(spark, "op4_line_dedup").set_index("doc_id")

    def lines(text):
        full = [(k, x.strip()) for k, x in enumerate((text or "").split("\n")) if x.strip()]
        return [(n, k, x, len(x.split())) for n, (k, x) in enumerate(full)]

    parsed = {i: lines(t) for i, t in docs.items()}
    for i, text in docs.items():
        gone = set()
        for j in docs:
            if j < i and {x[2] for x in parsed[i]} & {x[2] for x in parsed[j]}:
                for a, b in line_dedup.common_blocks(parsed[i], parsed[j], line_dedup.MIN_WORDS):
                    gone |= set(range(a, b + 1))
        assert got.loc[i, "text"] == "\n".join(x for k, x in enumerate(text.split("\n")) if k not in gone)


@pytest.fixture(scope="module")
def vectors(spark):
    rows = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").toPandas().sort_values("vec_id")
    return rows["vec_id"].to_numpy(), rows["label"].to_numpy(), np.stack(rows["embedding"].to_list()).astype(float)


def test_neighbours(spark, vectors):
    ids, _, x = vectors
    got = result(spark, "op5_multiprobe_neighbours")
    hits = 0
    for query in ids[ids % 100 == 0]:
        distance = np.sqrt(((x - x[ids == query]) ** 2).sum(1))
        distance[ids == query] = np.inf
        own = got[got["query_id"] == query].sort_values("rank")
        assert own["rank"].tolist() == list(range(1, 11))
        assert own["score"].to_numpy() == pytest.approx([distance[ids == i][0] for i in own["vec_id"]], abs=1e-12)
        hits += len(set(ids[np.lexsort((ids, distance))][:10]) & set(own["vec_id"]))
    assert hits >= 9 * (ids % 100 == 0).sum()


def test_near_vectors(spark, vectors):
    ids, labels, x = vectors
    got = result(spark, "op6_itq_near_dup").set_index("vec_id").loc[ids]
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = (unit @ unit.T >= 0.93) & (labels[:, None] == labels)
    np.fill_diagonal(near, False)
    assert (got["n_links"].to_numpy() <= near.sum(1)).all()
    assert got["n_links"].sum() >= 0.9 * near.sum()
    assert (got["kept"] == (got["component_id"] == got.index)).all()


def test_token_counts(spark, docs):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    got = result(spark, "op7_token_counts").set_index("doc_id")
    for i, text in docs.items():
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        assert tuple(got.loc[i]) == (len((text or "").encode()), n, n > 512)


def test_ngram_join(spark, docs):
    got = result(spark, "op9_ngram_jaccard").set_index("doc_id")
    sets = {i: shingles(t) for i, t in docs.items()}
    root = roots(sets, jaccard_links(sets))
    assert {i: (got.loc[i, "n_shingles"], got.loc[i, "component_id"]) for i in sets} == {
        i: (len(sets[i]), root[i]) for i in sets
    }


def test_quality(spark):
    """Held-out documents of the next larger tables."""
    folder = SF_DIR.replace("0.001", "0.01")
    got = queries.QUERIES["op10_crf_quality"](spark, folder).toPandas()
    labels = spark.read.parquet(f"{folder}/labels.parquet").toPandas()
    both = got.merge(labels, on="doc_id")
    both = both[both["held_out"]]
    assert (both["predicted"] == both["quality"]).mean() > 0.95
    assert both.loc[both["quality"] == 1, "predicted"].mean() > 0.97
    assert (got["held_out"] == got["doc_id"].map(lambda i: zlib.crc32(str(i).encode()) % 5 == 0)).all()
    assert got["score"].between(0, 1).all()


def test_pipeline(spark, docs):
    """Every stage on what its predecessor kept."""
    columns = None
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    from kpicast.session import written

    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = rows.toPandas()
        columns = columns or rows.columns
        rows = written(stage(spark, rows, SF_DIR), "stage")
        assert rows.columns == columns
        after = rows.toPandas()
        if name == "source mix":
            assert set(after["doc_id"]) <= set(before["doc_id"])
            assert after["doc_id"].value_counts().max() <= 3
        else:
            assert after["doc_id"].is_unique and set(after["doc_id"]) <= set(before["doc_id"])
        if name == "n-gram jaccard join":
            sets = dict(zip(before["doc_id"], map(shingles, before["text"])))
            root = roots(sets, jaccard_links(sets))
            assert set(after["doc_id"]) == {i for i in sets if root[i] == i}
    packed = corpus_pipeline.STAGES[-1][1](spark, rows, SF_DIR)
    assert packed.filter("piece = 0").count() == rows.count()
    assert pa.Table.from_pandas(packed.toPandas()).num_rows == packed.count()
