"""Groups, links and counts against a plain version with the libraries themselves."""

import hashlib
import random
from collections import Counter, defaultdict
from functools import reduce

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st
from llm_inputs import documents
from tokenizers import Tokenizer

from kpicast.llm import alignment, queries

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


class Plain:
    """The contract, text by text."""

    def __init__(self):
        self.a = Tokenizer.from_file(PATHS[0])
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
        names = alignment._byte_names()
        self.raw = {i: bytes(names[c] for c in t) for t, i in self.a.get_vocab(with_added_tokens=False).items() if t != "<|endoftext|>"}

    def piece(self, i):
        p = self.b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()

    def groups(self, text):
        if not text:
            return []
        a = self.a.encode(" " + text, add_special_tokens=False).ids
        b = self.b.encode(text)
        if b"".join(map(self.raw.get, a)) != (" " + text).encode() or b"".join(map(self.piece, b)) != (" " + text).encode():
            return []
        out, own, at, j = [], ([], []), [0, 0], 0
        for i in a:
            own[0].append(i)
            at[0] += len(self.raw[i])
            while at[1] < at[0]:
                own[1].append(b[j])
                at[1] += len(self.piece(b[j]))
                j += 1
            if at[0] == at[1]:
                out.append(own)
                own = ([], [])
        assert own == ([], []) and j == len(b)
        return out

    def statistics(self, texts):
        groups = [self.groups(t) for t in texts]
        links = [Counter((a, b) for one, two in g for a in one for b in two) for g in groups]
        count, most = Counter(p for x in links for p in x), defaultdict(int)
        for (a, _), n in count.items():
            most[a] = max(most[a], n)
        out = []
        for g, x in zip(groups, links):
            text = ";".join(",".join(map(str, one)) + "|" + ",".join(map(str, two)) for one, two in g)
            out.append((
                sum(len(o) for o, _ in g), sum(len(t) for _, t in g), len(g), sum(x.values()),
                sum(n for p, n in x.items() if count[p] == most[p[0]]), sum(n * count[p] for p, n in x.items()),
                hashlib.sha256(text.encode()).hexdigest() if g else "",
            ))
        return out


@pytest.fixture(scope="module")
def plain():
    return Plain()


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
SPOTS = ["don't ", "a", "é", "中文", "\n\n", "  ", "x1", " <|endoftext|>", "<s>", "😀", "\x00", "<0x41>", "!?", "Wörter ", "ﬁ"]


@pytest.mark.parametrize("long_", [1 << 20, 40])
def test_statistics(spark, plain, monkeypatch, long_):
    monkeypatch.setattr(alignment, "LONG", long_)
    monkeypatch.setattr(alignment, "CHUNK", 7)
    monkeypatch.setattr(alignment, "FAN", 3)
    monkeypatch.setattr(alignment, "UNIT_LINKS", 100)
    rng = random.Random(3)
    texts = ["".join(rng.choice(SPOTS) for _ in range(rng.randint(0, 80))) for _ in range(60)]
    texts += [None, "", "▁x", "x" * 3000, "the same text", "the same text", "a ▁" * 40, " " * 500 + "b", "中" * 300]
    rows = spark.createDataFrame([(k % 67 or None, t, k) for k, t in enumerate(texts)], "doc_id long, text string, n_a int")
    found = alignment.link_statistics(rows.repartition(4), *PATHS).collect()
    got = sorted((r["doc_id"] or 0, *(r[c] for c in COLUMNS), r["digest"]) for r in found)
    assert got == sorted((k % 67, *s) for k, s in enumerate(plain.statistics(texts)))
    assert alignment.link_statistics(rows.limit(0), *PATHS).count() == 0


def test_groups_of_rows_of_every_kind(spark, plain, monkeypatch):
    monkeypatch.setattr(alignment, "LONG", 5000)
    monkeypatch.setattr(alignment, "CHUNK", 1000)
    docs = documents(spark)
    found = defaultdict(list)
    rows = alignment.align(docs.withColumn("doc_id", docs["row"]), *PATHS).collect()
    for r in sorted(rows, key=lambda r: r["_at"]):
        a, b, p, q = (np.frombuffer(r[c], "<i4").tolist() for c in alignment.GROUPS[1:])
        for m, n in zip(p, q):
            found[r["doc_id"]].append((a[:m], b[:n]))
            a, b = a[m:], b[n:]
        assert not a and not b
    for r in docs.collect():
        assert found[r["row"]] == plain.groups(r["text"])


@settings(deadline=None, max_examples=200)
@given(st.lists(st.integers(1, 3), min_size=1, max_size=30), st.data())
def test_fragments_compose_in_any_order(sizes, data):
    lengths = np.arange(4)
    total = sum(sizes)
    other, rest = [], total
    while rest:
        other.append(data.draw(st.integers(1, min(3, rest))))
        rest -= other[-1]
    a, b = np.array(sizes), np.array(other)
    ends_a, ends_b = np.cumsum(a), np.cumsum(b)
    # Cut both sides at places of their own.
    chunks, i, j = [], 0, 0
    for limit in [*range(5, total, 5), total]:
        k = int(np.searchsorted(ends_a, limit + data.draw(st.integers(0, 4)), "right")) if limit < total else len(a)
        m = int(np.searchsorted(ends_b, limit + data.draw(st.integers(0, 4)), "right")) if limit < total else len(b)
        k, m = max(k, i), max(m, j)
        at = int(ends_a[i - 1]) if i else 0, int(ends_b[j - 1]) if j else 0
        chunks.append(alignment.fragment(alignment.Span(at[0], a[i:k], at[1], b[j:m]), lengths, lengths))
        i, j = k, m
    join = lambda f, g: alignment.composed(f, g, lengths, lengths)
    left = reduce(join, chunks)
    while len(chunks) > 1:
        at = data.draw(st.integers(0, len(chunks) - 2))
        chunks[at : at + 2] = [join(*chunks[at : at + 2])]
    for f in (left, chunks[0]):
        spans = [f.head, *f.closed]
        assert not len(f.tail.a) and not len(f.tail.b)
        got = [alignment.group_sizes(s.a, s.b, lengths, lengths) for s in spans]
        want = alignment.group_sizes(a, b, lengths, lengths)
        assert np.concatenate([g[0] for g in got]).tolist() == want[0].tolist()
        assert np.concatenate([g[1] for g in got]).tolist() == want[1].tolist()


def test_query(spark, plain):
    folder = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{folder}/documents.parquet").collect()
    want = dict(zip((r["doc_id"] for r in rows), plain.statistics([r["text"] for r in rows])))
    found = queries.op11_token_alignment(spark, folder).collect()
    assert {r["doc_id"]: (*(r[c] for c in COLUMNS), r["groups_sha256"]) for r in found} == want
