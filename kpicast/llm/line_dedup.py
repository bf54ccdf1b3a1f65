"""Delete from later documents the blocks of lines they share with earlier ones.

Lines that occur in one document only drop out at once. Neighbouring shared lines are
keyed by the shortest runs that reach ``MIN_WORDS``, from every line on and back from
every line: any common block is a union of such runs. A document's partners are the
earliest documents that hold its runs, so the pairs grow with the shared lines and not
with the square of how often a line or block occurs. Each pair is aligned with patience
diff, and what that leaves is matched run by run; common blocks of ``MIN_WORDS`` go.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from kpicast.llm.common import WORD, mix
from kpicast.session import written

MIN_WORDS = 50


def _rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """A longest subsequence that rises in both, of pairs that rise in the first."""
    tails, at, before = [], [], [-1] * len(pairs)
    for k, (_, j) in enumerate(pairs):
        place = bisect_left(tails, j)
        before[k] = at[place - 1] if place else -1
        if place == len(tails):
            tails.append(j)
            at.append(k)
        else:
            tails[place], at[place] = j, k
    out, k = [], at[-1] if at else -1
    while k >= 0:
        out.append(pairs[k])
        k = before[k]
    return out[::-1]


def patience(a: list, b: list) -> list[tuple[int, int]]:
    """Matched places of two sequences: what is unique in both and in rising order
    anchors; between anchors again; equal ends of a stretch always match."""
    out, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 >= a1 or b0 >= b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        place = {h: j for j, h in enumerate(b[b0:b1], b0) if in_b[h] == 1}
        anchors = _rising([(i, place[h]) for i, h in enumerate(a[a0:a1], a0) if in_a[h] == 1 and h in place])
        if not anchors:
            continue
        out += anchors
        for (i, j), (i2, j2) in zip([(a0 - 1, b0 - 1), *anchors], [*anchors, (a1, b1)]):
            todo.append((i + 1, i2, j + 1, j2))
    return sorted(out)


def _runs(owner: np.ndarray, n: np.ndarray, words: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """First and past-the-end places of the shortest runs of neighbouring lines of one
    owner that reach ``min_words``, from every line on and back from every line, and of
    two neighbours that each reach it. Every longer run is a union of these, and so is
    every pair of neighbours in it."""
    if not len(n):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    follows = (owner[1:] == owner[:-1]) & (n[1:] == n[:-1] + 1)
    piece = np.concatenate([[0], np.cumsum(~follows)])
    upto = np.concatenate([[0], np.cumsum(words)])
    at = np.arange(len(n))
    both = at[:-1][(words[1:] >= min_words) & (words[:-1] >= min_words)]
    starts = np.concatenate([at, np.searchsorted(upto, upto[1:] - min_words, "right") - 1, both])
    stops = np.concatenate([np.searchsorted(upto, upto[:-1] + min_words, "left"), at + 1, both + 2])
    full = np.flatnonzero((starts >= 0) & (stops <= len(n)))
    starts, stops = starts[full], stops[full]
    whole = piece[starts] == piece[stops - 1]
    return np.unique(np.stack([starts[whole], stops[whole]]), axis=1)


def common_blocks(later: list, earlier: list, min_words: int) -> list[tuple[int, int]]:
    """First and last original line of the later document's blocks to delete: all that
    are inside a common run of ``min_words`` or more, wherever the earlier document has
    it. Lines are (n, line, hash, words), n counting the lines that are not blank."""
    matches = patience([x[2] for x in later], [x[2] for x in earlier])
    blocks, k = [], 0
    while k < len(matches):
        stop = k + 1
        while stop < len(matches) and all(
            rows[matches[stop][s]][0] == rows[matches[stop - 1][s]][0] + 1
            for s, rows in ((0, later), (1, earlier))
        ):
            stop += 1
        if sum(later[i][3] for i, _ in matches[k:stop]) >= min_words:
            blocks.append((matches[k][0], matches[stop - 1][0] + 1))
        k = stop
    blocks = _joined(blocks + _left_over(later, earlier, blocks, min_words))
    return [(later[i][1], later[j - 1][1]) for i, j in blocks]


def _left_over(later: list, earlier: list, blocks: list[tuple[int, int]], min_words: int) -> list[tuple[int, int]]:
    """Common runs outside the aligned blocks: of lines that are not unique on both
    sides, or in another order than the alignment."""

    def keyed(rows: list) -> Iterator[tuple[tuple, int, int]]:
        n, words = (np.array([x[k] for x in rows], np.int64) for k in (0, 3))
        hashes = [x[2] for x in rows]
        for i, j in zip(*(x.tolist() for x in _runs(np.zeros(len(n)), n, words, min_words))):
            yield tuple(hashes[i:j]), i, j

    block = np.full(len(later), -1)
    for k, (i, j) in enumerate(blocks):
        block[i:j] = k
    left = [x for x in keyed(later) if block[x[1]] < 0 or block[x[1]] != block[x[2] - 1]]
    if not left:
        return []
    held = {key for key, _, _ in keyed(earlier)}
    return [(i, j) for key, i, j in left if key in held]


def _joined(blocks: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Blocks in order, those that have lines in common as one."""
    out: list[tuple[int, int]] = []
    for i, j in sorted(blocks):
        if out and i < out[-1][1]:
            out[-1] = out[-1][0], max(j, out[-1][1])
        else:
            out.append((i, j))
    return out


def _lines(text: Column) -> Column:
    """(line, hash, words) of the lines that are not blank."""
    each = F.transform(
        F.split(text, "\n", -1),
        lambda x, i: F.struct(i.alias("line"), F.trim(F.regexp_replace(x, r"[\x09-\x0D]", " ")).alias("text")),
    )
    return F.transform(
        F.filter(each, lambda x: x["text"] != ""),
        lambda x: F.struct(
            x["line"].alias("line"), F.xxhash64(x["text"]).alias("hash"),
            F.regexp_count(x["text"], F.lit(WORD)).alias("words"),
        ),
    )


_KEY = ("_id", "_text")


def _keyed(docs: DataFrame) -> DataFrame:
    """Documents are ordered by id (null first), then by a hash of the text. Ids that are
    no whole numbers are ordered as texts, null with the empty one."""
    if docs.schema["doc_id"].dataType.simpleString() in ("tinyint", "smallint", "int", "bigint"):
        own = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    else:
        own = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return docs.withColumn("_id", own).withColumn("_text", F.xxhash64("text"))


def _id_type(rows: DataFrame) -> str:
    return rows.schema["_id"].dataType.simpleString()


def shared_lines(docs: DataFrame) -> DataFrame:
    """Per document its lines that another document has too: array of (n, line, hash,
    words)."""
    lines = _keyed(docs).select(*_KEY, F.posexplode(_lines(F.col("text"))).alias("n", "x"))
    lines = lines.select(*_KEY, "n", "x.line", "x.hash", "x.words")
    key = F.struct(*_KEY)
    stats = (
        lines.groupBy("hash")
        .agg(F.min(key).alias("first"), F.max(key).alias("last"))
        .filter("first <> last")
        .select("hash")
    )
    shared = lines.join(stats, "hash")
    row = F.struct("n", "line", "hash", "words")
    return shared.groupBy(*_KEY).agg(F.array_sort(F.collect_set(row)).alias("lines"))


_BASE = 0x9E3779B97F4A7C15
_BACK = np.uint64(pow(_BASE, -1, 1 << 64))


def _keyed_runs(batches: Iterator[pa.RecordBatch], min_words: int) -> Iterator[pa.RecordBatch]:
    """(run, _id, _text): hashes of the runs of every document."""
    for batch in batches:
        lists = batch.column("lines")
        lines = lists.flatten()
        n, words, hashes = (lines.field(c).to_numpy(zero_copy_only=False) for c in ("n", "words", "hash"))
        owner = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
        starts, stops = _runs(owner, n.astype(np.int64), words.astype(np.int64), min_words)
        step = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(n), _BASE, np.uint64)]))
        back = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(n), _BACK, np.uint64)]))
        sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(hashes.view(np.uint64)) * step[:-1], dtype=np.uint64)])
        keys = mix((sums[stops] - sums[starts]) * back[starts] + (stops - starts).astype(np.uint64)).view(np.int64)
        who, keys = np.unique(np.stack([owner[starts], keys]), axis=1)
        own = [batch.column(c).take(pa.array(who)) for c in _KEY]
        yield pa.RecordBatch.from_arrays([pa.array(keys), *own], ["run", *_KEY])


def partners(shared: DataFrame, min_words: int) -> DataFrame:
    """Pairs of a document and the earliest one that holds one of its runs."""
    runs = shared.select(*_KEY, "lines").mapInArrow(
        lambda rows: _keyed_runs(rows, min_words), f"run long, _id {_id_type(shared)}, _text long"
    )
    runs = written(runs, "runs")
    first = (
        runs.groupBy("run")
        .agg(F.min(F.struct(*_KEY)).alias("first"), F.max("_id").alias("last"))
        .filter("first._id < last")
    )
    return (
        runs.join(first.select("run", "first"), "run")
        .filter("first._id < _id")
        .select(*_KEY, F.col("first._id").alias("e_id"), F.col("first._text").alias("e_text"))
        .distinct()
    )


def _align(rows: Iterator[pd.DataFrame], min_words: int) -> Iterator[pd.DataFrame]:
    for part in rows:
        out = []
        for own, text, later, earlier in zip(part["_id"], part["_text"], part["lines"], part["e_lines"]):
            lists = ([(x["n"], x["line"], x["hash"], x["words"]) for x in side] for side in (later, earlier))
            out += [(own, text, *block) for block in common_blocks(*lists, min_words)]
        made = pd.DataFrame(out, columns=["_id", "_text", "start", "stop"])
        yield made.astype({c: "int64" for c in ("_text", "start", "stop")})


def deletions(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """_id, _text and the blocks (start, stop: first and last line) to delete."""
    shared = written(shared_lines(docs), "shared-lines")
    pairs, own = partners(shared, min_words), shared
    other = own.select(F.col("_id").alias("e_id"), F.col("_text").alias("e_text"), F.col("lines").alias("e_lines"))
    aligned = (
        pairs.join(own, list(_KEY)).join(other, ["e_id", "e_text"])
        .mapInPandas(lambda rows: _align(rows, min_words), f"_id {_id_type(shared)}, _text long, start long, stop long")
    )
    return aligned.groupBy(*_KEY).agg(F.collect_set(F.struct("start", "stop")).alias("_blocks"))


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Every row of ``docs``, its text without the deleted blocks, and the number of
    lines (blank ones inside a block too) in _deleted_lines.

    The text stays in the document with the smallest id. Documents with one id are
    one: nothing is deleted between them, and repeated rows end alike. Null and empty
    texts stay as they are; a text may become empty; other columns pass through, but for
    one named _deleted_lines.
    """
    inside = lambda i: F.exists("_blocks", lambda b: (i >= b["start"]) & (i <= b["stop"]))
    lines = F.split("text", "\n", -1)
    kept = F.filter(lines, lambda x, i: ~inside(i))
    hit = F.col("_blocks").isNotNull()
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    columns = [F.col("text") if c == "text" else F.col(f"_row.`{c}`") for c in docs.columns if c != "_deleted_lines"]
    return (
        _keyed(docs.select("doc_id", "text", whole))
        .join(deletions(docs.select("doc_id", "text"), min_words), list(_KEY), "left")
        .withColumn("_kept", F.when(hit, kept))
        .withColumn("_deleted_lines", F.when(hit, (F.size(lines) - F.size("_kept")).cast("long")).otherwise(F.lit(0).cast("long")))
        .withColumn("text", F.when(hit, F.array_join("_kept", "\n")).otherwise(F.col("text")))
        .select(*columns, "_deleted_lines")
    )
