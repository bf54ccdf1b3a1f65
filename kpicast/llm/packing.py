"""Pack documents into token sequences of fixed length, by best fit and local search.

Only documents longer than a sequence are cut. Pieces are dealt by a hash into shards
of about ``SHARD_TOKENS`` tokens, each packed by one task: best fit for the pieces in
falling size, then moves and exchanges between sequences that are not full.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from kpicast.llm.common import slices
from kpicast.llm.encode import encoder
from kpicast.session import written

CAPACITY = 4096
END_ID = 1
SHARD_TOKENS = 16 << 20
PATIENCE = 64


def best_fit(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """The bin of every piece: largest first, each into the fullest bin it fits."""
    bins = np.zeros(len(lengths), np.int64)
    gaps: list[int] = []  # distinct gaps of open bins, sorted
    open_: dict[int, list[int]] = {}
    n = 0
    for k in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[k])
        at = bisect_left(gaps, size)
        if at < len(gaps):
            gap = gaps[at]
            target = open_[gap].pop()
            if not open_[gap]:
                del open_[gap], gaps[at]
        else:
            gap, target, n = capacity, n, n + 1
        bins[k] = target
        rest = gap - size
        if rest:
            if rest not in open_:
                open_[rest] = []
                insort(gaps, rest)
            open_[rest].append(target)
    return bins


def _gifts(own: list[int], lengths: np.ndarray) -> dict[int, tuple[int, ...]]:
    """One piece, or else two, for every size that those of a bin can add up to; at
    most as many as the capacity."""
    out: dict[int, tuple[int, ...]] = {}
    twice: dict[int, list[int]] = {}
    for x in own:
        size = int(lengths[x])
        out.setdefault(size, (x,))
        if len(twice.setdefault(size, [])) < 2:
            twice[size].append(x)
    some = [x for same in twice.values() for x in same]
    for i, x in enumerate(some):
        for y in some[i + 1 :]:
            out.setdefault(int(lengths[x] + lengths[y]), (x, y))
    return out


def local_search(lengths: np.ndarray, bins: np.ndarray, capacity: int, patience: int = PATIENCE) -> np.ndarray:
    """Exchange pieces between underfull bins so that the sum of squared fills grows,
    until bins are empty.

    The emptiest bin gives: a piece moves into the tightest gap that takes it; else one
    piece, or two, are exchanged for a smaller piece of a fuller bin, the largest gain
    first; all sizes that one or two pieces make are tried. Ends at the lower bound on
    the bins, or when ``patience`` bins in a row could not be emptied, so a few bins more
    than needed may stay; no piece is left out.
    """
    bins = bins.copy()
    total = int(lengths.sum())
    least = -(-total // capacity)
    fill = np.bincount(bins, weights=lengths).astype(np.int64)
    used = int((fill > 0).sum())
    tried: set[int] = set()
    while used > least and len(tried) < patience:
        part = np.flatnonzero((fill > 0) & (fill < capacity))
        part = part[~np.isin(part, list(tried))] if tried else part
        if len(part) < 2:
            break
        source = int(part[np.argmin(fill[part])])
        # Pieces in underfull bins other than the source; few bins stay underfull.
        pool = np.flatnonzero((fill[bins] < capacity) & (bins != source))
        own = np.flatnonzero(bins == source).tolist()
        while own:
            gap = capacity - fill
            gap[fill == 0] = 0
            gap[source] = 0
            best = None
            for x in sorted(own, key=lambda k: -lengths[k]):
                fits = np.flatnonzero(gap >= lengths[x])
                if len(fits):
                    best = (x,), None, int(fits[np.argmin(gap[fits])])
                    break
            if best is None and len(pool):
                sizes, room = lengths[pool], gap[bins[pool]]
                top = 0
                for size, given in _gifts(own, lengths).items():
                    gain = np.where(size - sizes <= room, size - sizes, 0)
                    at = int(np.argmax(gain))
                    # The other bin is at least as full, so squared fills grow.
                    if gain[at] > top and fill[bins[pool[at]]] + gain[at] > fill[source] - gain[at]:
                        top, best = int(gain[at]), (given, int(pool[at]), int(bins[pool[at]]))
            if best is None:
                break
            given, back, target = best
            for x in given:
                bins[x] = target
                fill[target] += lengths[x]
                fill[source] -= lengths[x]
                own.remove(x)
            if back is not None:
                bins[back] = source
                fill[target] -= lengths[back]
                fill[source] += lengths[back]
                own.append(back)
                pool = np.append(pool[pool != back], given)
            else:
                pool = np.append(pool, given)
        if fill[source] == 0:
            used -= 1
            tried.clear()
        else:
            tried.add(source)
    return bins


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids) of every piece of every row.

    A document is its token ids and ``END_ID``; null and empty texts are that id alone.
    Repeated rows stay; other columns are left out.
    """
    fields = [("doc_id", docs.schema["doc_id"].dataType)]
    fields += [("piece", T.IntegerType()), ("start", T.LongType()), ("length", T.LongType()), ("ids_crc32", T.LongType())]
    if with_ids:
        fields.append(("ids", T.ArrayType(T.IntegerType())))
    schema = T.StructType([T.StructField(*f) for f in fields])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode
        for batch in slices(batches):
            row, piece, start, length, crc, kept = [], [], [], [], [], []
            for k, ids in enumerate(encode(batch.column("text"))):
                ids = np.append(ids, END_ID).astype("<u4")
                for p, s in enumerate(range(0, len(ids), capacity)):
                    own = ids[s : s + capacity]
                    row.append(k)
                    piece.append(p)
                    start.append(s)
                    length.append(len(own))
                    crc.append(zlib.crc32(own.tobytes()))
                    if with_ids:
                        kept.append(own.astype(np.int32))
            columns = [
                batch.column("doc_id").take(pa.array(row, pa.int64())),
                pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
            ]
            if with_ids:
                columns.append(pa.array(kept, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, [f[0] for f in fields])

    return docs.select("doc_id", "text").mapInArrow(cut, schema)


def pack(rows: DataFrame, capacity: int = CAPACITY, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """``rows`` (doc_id, piece, start, length, ids_crc32) with sequence_id and offset.

    The number of shards follows the tokens, so a task packs about as much at any
    size; equal rows may meet in one shard but never make it more than a few pieces
    larger, as the hash also takes a number drawn per row place. An empty table gives
    none.
    """
    rows = written(rows, "pieces")
    total = rows.agg(F.sum("length")).first()[0] or 0
    shards = max(1, round(total / shard_tokens))
    # The position within its file breaks up repeated rows; it is stable, as the
    # pieces are written.
    dealt = rows.withColumn("_shard", F.pmod(F.xxhash64("doc_id", "piece", F.monotonically_increasing_id()), F.lit(shards)))
    schema = T.StructType([
        *rows.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType()),
    ])
    names = rows.columns

    def one(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "doc_id", "piece"], kind="stable").reset_index(drop=True)
        lengths = group["length"].to_numpy(np.int64)
        bins = local_search(lengths, best_fit(lengths, capacity), capacity)
        order = np.argsort(bins, kind="stable")
        upto = np.cumsum(lengths[order]) - lengths[order]
        first = np.concatenate([[True], bins[order][1:] != bins[order][:-1]])
        offset = np.empty(len(bins), np.int64)
        offset[order] = upto - np.maximum.accumulate(np.where(first, upto, 0))
        return group[names].assign(sequence_id=(int(key[0]) << 32) + bins, offset=offset)

    return dealt.groupBy("_shard").applyInPandas(one, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id and its ids, for packed pieces that carry ids; at most one
    capacity of ids each."""
    part = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    grouped = packed.groupBy("sequence_id").agg(part.alias("parts"))
    return grouped.select("sequence_id", F.flatten(F.transform("parts", lambda p: p["ids"])).alias("ids"))
