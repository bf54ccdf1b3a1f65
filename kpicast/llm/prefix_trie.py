"""The trie of shared prefixes of many sequences, from their sorted order.

Sequences are sorted by (elements, id), so the members of a node, which are all that
start with its prefix, are an interval. Two neighbours share as many elements as their
LCP says, and an interval of depth d is where no LCP inside is below d. A sparse table
holds the least LCP of 1, 2, 4, ... neighbours; every candidate prefix, given as a row
and a depth, finds its left and its right end by itself in a binary search over it.
Sums, counts and the smallest id of a node are then differences of running sums and
look-ups in another such table.

The order is dealt into blocks of rows, ranges of (elements, id), so that many copies of
one sequence and a prefix that most sequences share are spread as well. A block knows
what its neighbours end and begin with. Most nodes lie inside one block. The others are
open: they hold the first or the last row of a block, so there are as many a block as
these two rows are long; their parts are added up by the name of the prefix.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from kpicast.session import written

WIDTH = 16  # bytes of an element's name
BLOCK_ELEMENTS = 1 << 18
LANES = 1 << 16  # candidates searched side by side


def element(*parts: Column) -> Column:
    """A name of ``WIDTH`` bytes, in hexadecimal, for texts taken together; null is empty."""
    texts = [F.coalesce(p.cast("string"), F.lit("")) for p in parts]
    framed = F.concat(*(x for t in texts for x in (F.length(t).cast("string"), F.lit(":"), t)))
    return F.substring(F.sha2(framed, 256), 1, 2 * WIDTH)


class Least:
    """Sparse table of range minima."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        while 2 << (len(self.levels) - 1) <= len(values):
            last, half = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(np.minimum(last[:-half], last[half:]))

    def between(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Least value of first..last, both included, for many ranges."""
        out = np.empty(len(first), self.levels[0].dtype)
        level = np.log2(last - first + 1).astype(np.int64)
        for k in np.unique(level):
            at = np.flatnonzero(level == k)
            own = self.levels[k]
            out[at] = np.minimum(own[first[at]], own[last[at] + 1 - (1 << k)])
        return out

    def left(self, rows: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """The first row that every value after it, up to the row's, connects."""
        at = rows.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            step = 1 << k
            can = np.flatnonzero(at >= step)
            can = can[self.levels[k][at[can] - step + 1] >= depth[can]]
            at[can] -= step
        return at

    def right(self, rows: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """The last row that the values after the row's connect."""
        at, n = rows.copy(), len(self.levels[0])
        for k in range(len(self.levels) - 1, -1, -1):
            step = 1 << k
            can = np.flatnonzero(at + step < n)
            can = can[self.levels[k][at[can] + 1] >= depth[can]]
            at[can] += step
        return at


def shared(a: bytes | None, b: bytes | None) -> int:
    """Elements that two sequences begin with alike; -1 if one is not there."""
    if a is None or b is None:
        return -1
    n = min(len(a), len(b)) // WIDTH
    one = np.frombuffer(a, np.uint8)[: n * WIDTH].reshape(n, WIDTH)
    two = np.frombuffer(b, np.uint8)[: n * WIDTH].reshape(n, WIDTH)
    other = np.flatnonzero((one != two).any(1))
    return int(other[0]) if len(other) else n


def _neighbour_lcps(names: np.ndarray, first: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Elements that every row shares with the row before it; names has two numbers each."""
    lcp = np.zeros(len(lengths), np.int64)
    alive, depth = np.arange(1, len(lengths)), 0
    while len(alive):
        alive = alive[(lengths[alive] > depth) & (lengths[alive - 1] > depth)]
        alive = alive[(names[first[alive] + depth] == names[first[alive - 1] + depth]).all(1)]
        depth += 1
        lcp[alive] = depth
    return lcp


NODE = (
    "block long, name binary, parent_name binary, id long, depth long, parent_id long, members long, "
    "children long, leaves long, saved long, ends array<long>"
)


def _block_nodes(table: pa.Table, borders: pa.Table) -> pa.Table:
    """Nodes of one block: whole ones, and parts of those that go beyond it (with names).
    ``borders`` has the keys before and after the block."""
    table = table.combine_chunks().sort_by("place")
    keys = table["key"].to_pylist()
    ids = table["id"].to_numpy()
    before, after = borders["before"][0].as_py(), borders["after"][0].as_py()
    n = len(keys)
    lengths = np.array([len(k) // WIDTH for k in keys], np.int64)
    first = np.cumsum(lengths) - lengths
    names = np.frombuffer(b"".join(keys), np.uint64).reshape(-1, 2)
    sizes = table["sizes"].combine_chunks().flatten().to_numpy()
    upto = np.concatenate([[0], np.cumsum(sizes)])  # of text, over all rows
    lcp = _neighbour_lcps(names, first, lengths)
    lcp[0] = shared(before, keys[0])
    last = shared(keys[-1], after)
    text = lambda rows, depth: upto[first[rows] + depth] - upto[first[rows]]

    # Candidates: the prefixes a row does not share with the row before, and all of row 0.
    low = lcp + 1
    low[0] = 0
    count = lengths - low + 1
    count[count < 0] = 0
    rows = np.repeat(np.arange(n), count)
    depth = np.arange(len(rows)) - np.repeat(np.cumsum(count) - count, count) + low[rows]
    connects, smallest = Least(lcp), Least(ids)
    left, right, up, least = (np.empty(len(rows), np.int64) for _ in range(4))
    for k in range(0, len(rows), LANES):
        s = slice(k, k + LANES)
        left[s], right[s] = connects.left(rows[s], depth[s]), connects.right(rows[s], depth[s])
        up[s] = connects.left(rows[s], depth[s] - 1)
        least[s] = smallest.between(left[s], right[s])
    up[depth == 0] = -1
    begun = (left == 0) & (lcp[0] >= depth)
    goes_on = (right == n - 1) & (last >= depth)
    open_ = begun | goes_on

    following = np.append(lcp[1:], last)
    leaf = np.concatenate([[0], np.cumsum(following < lengths)])
    kept = np.concatenate([[0], np.cumsum(text(np.arange(n), np.maximum(lcp, 0)))])
    again = left + ~begun  # the first row that repeats the prefix
    saved = kept[right + 1] - kept[again]
    deeper = depth > 0
    saved[deeper] -= (right + 1 - again)[deeper] * text(left[deeper], depth[deeper] - 1)
    # Rows that end at a node come first in it, and are alike.
    unlike = np.flatnonzero((lcp != lengths) | (np.append(-1, lengths[:-1]) != lengths))
    stop = np.append(unlike, n)[np.searchsorted(unlike, left, "right")]
    stop = np.where(lengths[left] == depth, stop, left)

    base = int(lengths.max()) + 2
    code = left * base + depth
    order = np.argsort(code)
    parent = order[np.searchsorted(code[order], np.maximum(up * base + depth - 1, 0)) % max(len(code), 1)]
    parent[depth == 0] = -1
    children = np.bincount(parent[(depth > 0) & ~begun], minlength=len(rows))

    named: dict[tuple[int, int], bytes] = {}
    for row in sorted({0, n - 1}):
        digest = hashlib.blake2b(digest_size=16)
        depths = np.arange(lengths[row] + 1)
        for d, l in enumerate(connects.left(np.full(len(depths), row), depths).tolist()):
            named[l, d] = digest.copy().digest()
            digest.update(keys[row][d * WIDTH : (d + 1) * WIDTH])
    own_name = [named[l, d] if o else None for l, d, o in zip(left.tolist(), depth.tolist(), open_.tolist())]
    above = [own_name[p] if p >= 0 else None for p in parent.tolist()]
    flat, ends = _ranges(ids, left, stop)
    block = table["block"][0].as_py()
    return pa.table(
        {
            "block": pa.array(np.full(len(rows), block), pa.int64()),
            "name": pa.array(own_name, pa.binary()),
            "parent_name": pa.array(above, pa.binary()),
            "id": pa.array(least),
            "depth": pa.array(depth),
            "parent_id": pa.array(np.where(parent >= 0, least[parent], 0), mask=parent < 0),
            "members": pa.array(right - left + 1),
            "children": pa.array(children, pa.int64()),
            "leaves": pa.array(leaf[right + 1] - leaf[left]),
            "saved": pa.array(saved),
            "ends": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat)),
        }
    )


def _ranges(values: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slices of ``values`` one after the other, and their offsets."""
    sizes = stop - start
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    return values[np.repeat(start - offsets[:-1], sizes) + np.arange(offsets[-1])], offsets


def blocks(sequences: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``sequences`` (id, key, sizes) in order, with a block and a place in it; and for
    every block the key that comes before and the one that comes after it."""
    sequences = written(sequences.select("id", "key", "sizes"), "sequences")
    total = sequences.agg(F.sum(F.size("sizes") + 1)).first()[0] or 0
    number = max(1, -(-total // BLOCK_ELEMENTS))
    ranged = sequences.repartitionByRange(number, "key", "id").sortWithinPartitions("key", "id")
    ranged = ranged.select(
        "*",
        F.spark_partition_id().cast("long").alias("block"),
        F.monotonically_increasing_id().alias("place"),
    )
    ranged = written(ranged, "order")
    # One row a block.
    order = Window.orderBy("block")
    borders = ranged.groupBy("block").agg(F.min("key").alias("least"), F.max("key").alias("most"))
    borders = borders.select(
        "block", F.lag("most").over(order).alias("before"), F.lead("least").over(order).alias("after")
    )
    return ranged, borders


def nodes(sequences: DataFrame) -> DataFrame:
    """One row per distinct prefix of the ``sequences``, from the empty one on.

    ``sequences`` has id (long, unlike each other and not null), key (elements, each of
    ``WIDTH`` bytes, one after the other) and sizes (array of long: what every element
    takes up). Returns id (smallest of the members), depth, parent_id (null for the empty
    prefix), members (sequences that start with it), children, leaves (prefixes below or
    at it that no other extends), saved (what storing each element once saves: over all
    prefixes below or at it, members - 1 times the size of the last element) and ends
    (ids of the sequences that are the prefix, ascending).

    Sequences may be empty; equal ones are members and ends together. No sequence gives
    no prefix. A sequence has to fit into a row, and so have the ends of one prefix.
    """
    ranged, borders = blocks(sequences)
    made = ranged.groupBy("block").cogroup(borders.groupBy("block")).applyInArrow(_block_nodes, NODE)
    made = written(made, "nodes")
    parts = made.filter("name IS NOT NULL")
    whole = made.filter("name IS NULL")
    merged = parts.groupBy("name").agg(
        F.min("id").alias("id"),
        F.first("depth").alias("depth"),
        F.max("parent_name").alias("parent_name"),
        *(F.sum(c).alias(c) for c in ("members", "children", "leaves", "saved")),
        F.flatten(
            F.transform(F.array_sort(F.collect_list(F.struct("block", "ends"))), lambda x: x["ends"])
        ).alias("ends"),
    )
    merged = written(merged, "open-nodes")
    known = merged.select(F.col("name").alias("parent_name"), F.col("id").alias("_parent"))
    # A prefix that most others begin with is looked up block by block.
    of_block = parts.select("block", F.col("name").alias("parent_name")).join(known, "parent_name")
    columns = ["id", "depth", "parent_id", "members", "children", "leaves", "saved", "ends"]
    found = whole.filter("parent_name IS NOT NULL").join(of_block, ["block", "parent_name"])
    found = found.withColumn("parent_id", F.col("_parent"))
    tops = merged.join(known, "parent_name", "left").withColumn("parent_id", F.col("_parent"))
    return (
        whole.filter("parent_name IS NULL").select(columns)
        .unionByName(found.select(columns))
        .unionByName(tops.select(columns))
    )


def conversations(turns: DataFrame) -> DataFrame:
    """id and elements (struct of name and size in code points) of every conversation,
    ordered by turn (null first; turns of one number by role and text, so rows that repeat
    stay turns of their own). Null roles and texts are empty. Rows without a conv_id
    belong to no conversation and are left out."""
    turn = F.struct(
        F.col("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    rows = turns.filter("conv_id IS NOT NULL").groupBy(F.col("conv_id").alias("id")).agg(F.array_sort(F.collect_list(turn)).alias("t"))
    # array_sort puts structs with null fields last or first by field order: sort by flag.
    return rows.select(
        "id",
        F.transform(
            F.concat(F.filter("t", lambda x: x["turn"].isNull()), F.filter("t", lambda x: x["turn"].isNotNull())),
            lambda x: F.struct(
                element(x["role"], x["text"]).alias("name"), F.length(x["text"]).cast("long").alias("size")
            ),
        ).alias("elements"),
    )


def sequences(rows: DataFrame) -> DataFrame:
    """What :func:`nodes` takes, from rows of id and elements."""
    key = F.unhex(F.array_join(F.transform("elements", lambda x: x["name"]), ""))
    return rows.select("id", key.alias("key"), F.transform("elements", lambda x: x["size"]).alias("sizes"))
