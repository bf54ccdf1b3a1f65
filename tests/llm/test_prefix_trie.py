"""Tries against all prefixes one by one, in one block and in many."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from compare import connect, differences

from kpicast.llm import prefix_trie, queries


def brute(convs):
    """Rows of the contract from {conv_id: [(role, text), ...]}."""
    members, ends = defaultdict(set), defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].add(c)
        ends[tuple(turns)].append(c)
    children = defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, own in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(own) - 1) * len(p[-1][1]) if p else 0
    sha = lambda p: hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest()
    return sorted(
        (min(own), len(p), min(members[p[:-1]]) if p else None, len(own), children[p], leaves[p], saved[p], sha(p))
        for p, own in members.items()
    )


def rows_of(df):
    out = []
    for r in df.collect():
        ends = hashlib.sha256(",".join(map(str, r["ends"])).encode()).hexdigest()
        out.append((r["id"], r["depth"], r["parent_id"], r["members"], r["children"], r["leaves"], r["saved"], ends))
    return sorted(out, key=lambda x: (x[0], x[1]))


def turns_of(spark, convs):
    rows = [(c, k, *t) for c, turns in convs.items() for k, t in enumerate(turns)]
    return spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")


def tried(spark, convs):
    elements = prefix_trie.conversations(turns_of(spark, convs))
    bare = [c for c, t in convs.items() if not t]
    if bare:
        more = spark.createDataFrame([(c,) for c in bare], "id long").selectExpr("id", "array() AS elements")
        elements = elements.unionByName(more.selectExpr("id", "CAST(elements AS array<struct<name:string,size:bigint>>) AS elements"))
    return rows_of(prefix_trie.nodes(prefix_trie.sequences(elements)))


@pytest.mark.parametrize("block", [1 << 18, 60, 7])
def test_random_conversations(spark, monkeypatch, block):
    monkeypatch.setattr(prefix_trie, "BLOCK_ELEMENTS", block)
    monkeypatch.setattr(prefix_trie, "LANES", 16)
    rng = random.Random(block)
    convs = {c: [rng.choice([("u", "aé"), ("a", "b" * 3), ("u", "")]) for _ in range(rng.randint(0, 5))] for c in range(90)}
    convs |= {200 + c: [("u", "hot")] * 3 for c in range(40)}  # copies
    convs |= {300 + c: [("u", "hot"), ("a", f"own{c}")] for c in range(40)}  # one first turn
    convs[999] = [("u", str(k)) for k in range(30)]
    assert tried(spark, convs) == brute(convs)


@pytest.mark.parametrize("convs", [{5: []}, {5: [], 3: []}, {7: [("u", "x")]}, {}])
def test_few_conversations(spark, convs):
    assert tried(spark, convs) == (brute(convs) if convs else [])


def test_ranges_of_a_sparse_table():
    values = np.random.default_rng(1).integers(0, 5, 50)
    table = prefix_trie.Least(values)
    for row in range(50):
        for depth in range(6):
            l = row
            while l and values[l] >= depth:
                l -= 1
            r = row
            while r + 1 < 50 and values[r + 1] >= depth:
                r += 1
            one = np.array([row]), np.array([depth])
            assert (table.left(*one)[0], table.right(*one)[0]) == (l, r)
            assert table.between(np.array([l]), np.array([r]))[0] == values[l : r + 1].min()


def test_turns_of_every_kind(spark):
    rows = [
        (1, None, "user", "x", 0), (1, 0, None, None, 0), (1, None, "a", "y", 0), (1, 0, None, None, 0),
        (None, 0, "user", "lost", 0), (2, 3, "", "", 0), (2, -1, "a", "y", 0), (2, 0, "user", "x", 0),
    ]
    turns = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, id int")
    found = prefix_trie.nodes(prefix_trie.sequences(prefix_trie.conversations(turns)))
    one = [("a", "y"), ("user", "x"), ("", ""), ("", "")]
    assert rows_of(found) == brute({1: one, 2: one[:3]})
    assert prefix_trie.nodes(prefix_trie.sequences(prefix_trie.conversations(turns.limit(0)))).count() == 0


@pytest.mark.parametrize("block", [1 << 18, 500])
def test_query(spark, monkeypatch, block):
    monkeypatch.setattr(prefix_trie, "BLOCK_ELEMENTS", block)
    folder = "/root/testdata/sf0.01"
    got = queries.op12_prefix_trie(spark, folder).toPandas()
    sql = connect(folder).execute(queries.OP12_SQL).df()
    kinds = {"parent_conv_id": "Int64"}  # null for the root
    assert differences(got.astype(kinds), sql.astype(kinds)) == []
    own = defaultdict(list)
    for r in sorted(spark.read.parquet(f"{folder}/conversations.parquet").collect(), key=lambda r: r["turn"]):
        own[r["conv_id"]].append((r["role"], r["text"]))
    h = lambda c: zlib.crc32(str(c).encode()) % 6
    rebuilt = {c: own.get(c - c % 100, [])[: h(c)] + t[h(c) :] for c, t in own.items()}
    assert len(got) == len(brute(rebuilt))
