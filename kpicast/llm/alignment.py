"""Tokens of two tokenizers aligned by bytes, and how often token pairs go together.

Both tokenizers' tokens cover the same bytes. Where a token of each ends at one offset
the tokens so far are cut off: the tokens between two such offsets are a group, and
every token of one side is linked with every token of the other inside it.

What is known of a byte range is a fragment: an open prefix (the tokens up to the first
common end, or all of them if there is none), closed groups, and an open suffix (the
tokens after the last common end). Two fragments that follow one another make one: the
suffix of the first and the prefix of the second are put together and cut anew. This is
associative, so a long document is cut into chunks (each tokenizer at places of its own
where it cuts in any case), the chunks become fragments in tasks of their own, and
rounds of ``FAN`` neighbours at a time make one fragment of them. Closed groups leave
the rounds as rows; only the open ends travel on. Other documents are one chunk each.

Counts of pairs are made in units of about ``UNIT_LINKS`` links: a unit sends each of
its distinct pairs once, with the number of its documents, and gets the counts over all
documents back, so a pair that most documents have is one row a unit and not one a
document.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F, types as T

from kpicast.llm.byte_bpe import Codec, safe_cut
from kpicast.llm.common import slices
from kpicast.llm.token_fst import _byte_names
from kpicast.session import written

LONG = 1 << 20  # bytes from which a document is dealt into chunks
CHUNK = 1 << 16  # characters
FAN = 8
UNIT_LINKS = 1 << 20
SLICE = 1 << 20  # bytes of texts or ids that a task works on at a time
SMALL = 64  # links of a group that are listed one by one


class ByteTokens:
    """A byte-level vocabulary of a tokenizers file. Merges are made by tiktoken, ranked
    in the file's order."""

    def __init__(self, path: str):
        import public_tokenizers

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        names = _byte_names()
        raw = lambda token: bytes(names[c] for c in token)
        added = {t["content"] for t in spec["added_tokens"]}
        vocabulary = {raw(t): i for t, i in spec["model"]["vocab"].items() if t not in added}
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        ranks = {t: k for k, t in enumerate(t for t in vocabulary if len(t) == 1)}
        for a, b in merges:
            ranks.setdefault(raw(a) + raw(b), len(ranks))
        self.ids = np.zeros(len(ranks), np.int32)
        self.size = max(vocabulary.values()) + 1
        self.lengths = np.zeros(self.size, np.int64)
        for token, rank in ranks.items():
            self.ids[rank] = vocabulary[token]
            self.lengths[vocabulary[token]] = len(token)
        self.codec = Codec(ranks, public_tokenizers.PATTERN)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [self.ids[self.codec.encode(t)] for t in texts]

    def cut(self, text: str, at: int) -> int:
        return safe_cut(text, at)


class PieceTokens:
    """A sentencepiece model with byte fallback that puts a space before a text."""

    BREAK = "\n"  # in no piece with other characters, so nothing merges across it

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(k) for k in range(len(self.model))]
        self.size = len(pieces)
        self.bytes = [
            bytes([int(p[3:5], 16)]) if self.model.is_byte(k) else p.replace("▁", " ").encode()
            for k, p in enumerate(pieces)
        ]
        self.lengths = np.array([len(b) for b in self.bytes], np.int64)
        plain = [p for k, p in enumerate(pieces) if not self.model.is_byte(k) and not self.model.is_control(k)]
        if any(self.BREAK in p and len(p) > 1 for p in plain):
            raise ValueError("the model merges line ends: texts can't be cut for it")
        # Characters that stand side by side in some piece; merges cross no other place.
        self.pairs = {p[k : k + 2] for p in plain for k in range(len(p) - 1)}
        self.lead = len(self.model.encode(self.BREAK))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of texts, each with the space before it that the model adds."""
        return [np.array(x, np.int32) for x in self.model.encode([t[1:] for t in texts], num_threads=1)]

    def encode_inner(self, text: str) -> np.ndarray:
        """Ids of a part of a text, to which the model shall add nothing."""
        return np.array(self.model.encode(self.BREAK + text)[self.lead :], np.int32)

    def joined(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids.tolist()))

    def cut(self, text: str, at: int) -> int:
        while 0 < at < len(text) and text[at - 1 : at + 1].replace(" ", "▁") in self.pairs:
            at += 1
        return min(at, len(text))


_loaded: dict[tuple[str, str], tuple[ByteTokens, PieceTokens]] = {}


def tokenizers(path_a: str, path_b: str) -> tuple[ByteTokens, PieceTokens]:
    """Both, once per worker process."""
    if (path_a, path_b) not in _loaded:
        _loaded[path_a, path_b] = ByteTokens(path_a), PieceTokens(path_b)
    return _loaded[path_a, path_b]


class Span(NamedTuple):
    """Tokens of both sides that follow one another, and the byte where each side begins."""

    at_a: int
    a: np.ndarray
    at_b: int
    b: np.ndarray


class Fragment(NamedTuple):
    """``tail`` is None if there is no common end; then ``head`` is all."""

    head: Span
    closed: list[Span]
    tail: Span | None


def cut(span: Span, size_a: np.ndarray, size_b: np.ndarray) -> tuple[Span | None, Span]:
    """The tokens up to the last common end (None if there is none), and those after it."""
    ends_a, ends_b = span.at_a + np.cumsum(size_a[span.a]), span.at_b + np.cumsum(size_b[span.b])
    common = np.intersect1d(ends_a, ends_b, assume_unique=True)
    if not len(common):
        return None, span
    k, j = int(np.searchsorted(ends_a, common[-1])) + 1, int(np.searchsorted(ends_b, common[-1])) + 1
    end = int(common[-1])
    return Span(span.at_a, span.a[:k], span.at_b, span.b[:j]), Span(end, span.a[k:], end, span.b[j:])


def first_cut(span: Span, size_a: np.ndarray, size_b: np.ndarray) -> tuple[Span, Span]:
    """A span that holds common ends at its first one."""
    ends_a, ends_b = span.at_a + np.cumsum(size_a[span.a]), span.at_b + np.cumsum(size_b[span.b])
    end = int(np.intersect1d(ends_a, ends_b, assume_unique=True)[0])
    k, j = int(np.searchsorted(ends_a, end)) + 1, int(np.searchsorted(ends_b, end)) + 1
    return Span(span.at_a, span.a[:k], span.at_b, span.b[:j]), Span(end, span.a[k:], end, span.b[j:])


def fragment(span: Span, size_a: np.ndarray, size_b: np.ndarray) -> Fragment:
    """What a chunk's tokens tell."""
    whole, tail = cut(span, size_a, size_b)
    if whole is None:
        return Fragment(span, [], None)
    head, closed = first_cut(whole, size_a, size_b)
    return Fragment(head, [closed] if len(closed.a) else [], tail)


def composed(f: Fragment, g: Fragment, size_a: np.ndarray, size_b: np.ndarray) -> Fragment:
    """Two fragments that follow one another as one."""
    open_ = f.head if f.tail is None else f.tail
    joint = Span(open_.at_a, np.append(open_.a, g.head.a), open_.at_b, np.append(open_.b, g.head.b))
    whole, rest = cut(joint, size_a, size_b)
    if whole is None:
        return Fragment(f.head, f.closed, joint) if f.tail is not None else Fragment(joint, [], None)
    # If g has a common end its head ends with it, so nothing of the joint is left over.
    tail = rest if g.tail is None else g.tail
    if f.tail is not None:
        return Fragment(f.head, [*f.closed, whole, *g.closed], tail)
    head, closed = first_cut(whole, size_a, size_b)
    return Fragment(head, [*([closed] if len(closed.a) else []), *g.closed], tail)


def group_sizes(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each side in every group of spans that cover the same bytes."""
    ends_a, ends_b = np.cumsum(size_a[a]), np.cumsum(size_b[b])
    total = int(ends_a[-1]) if len(ends_a) else 0
    flags = np.zeros(total + 1, np.uint8)
    flags[ends_a] = 1
    flags[ends_b] += 1
    common = flags == 2
    return np.diff(np.flatnonzero(common[ends_a]), prepend=-1), np.diff(np.flatnonzero(common[ends_b]), prepend=-1)


GROUPS = ["_at", "_a", "_b", "_a_sizes", "_b_sizes"]
_GROUP_FIELDS = [
    T.StructField("_at", T.LongType()), *(T.StructField(c, T.BinaryType()) for c in GROUPS[1:])
]


def _packed(values: np.ndarray) -> bytes:
    return values.astype("<i4").tobytes()


def _short(path_a: str, path_b: str):
    """Batches of doc_id and text to batches with a row of groups per document; without
    tokens where there are none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = tokenizers(path_a, path_b)
        none = np.zeros(0, np.int32)
        for batch in slices(batches, size=SLICE):
            texts = [" " + t if t else "" for t in batch.column("text").to_pylist()]
            rows = []
            for text, a, b in zip(texts, one.encode(texts), two.encode(texts)):
                if not text or two.joined(b) != text.encode():
                    a = b = none
                p, q = group_sizes(a, b, one.lengths, two.lengths)
                rows.append((_packed(a), _packed(b), _packed(p), _packed(q)))
            made = [pa.array([r[k] for r in rows], pa.binary()) for k in range(4)]
            at = pa.array(np.zeros(len(rows), np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), at, *made], ["doc_id", *GROUPS])

    return run


_PART = "row long, no long, kind long, ok boolean, at_a long, a binary, at_b long, b binary"
_COLUMNS = ["row", "no", "kind", "ok", "at_a", "a", "at_b", "b"]
_HEAD, _CLOSED, _TAIL = 0, 1, 2


def _parts(row: int, no: int, ok: bool, f: Fragment) -> list[tuple]:
    spans = [(_HEAD, f.head), *((_CLOSED, s) for s in f.closed), *([(_TAIL, f.tail)] if f.tail else [])]
    return [(row, no, kind, ok, s.at_a, _packed(s.a), s.at_b, _packed(s.b)) for kind, s in spans]


def _chunks(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Texts of both sides' chunks of every document, numbered."""
    key = [f for f in docs.schema.fields if f.name == "doc_id"]
    schema = T.StructType(
        [T.StructField("row", T.LongType()), *key, T.StructField("no", T.LongType())]
        + [T.StructField(c, t) for c, t in (("at_a", T.LongType()), ("text_a", T.StringType()), ("at_b", T.LongType()), ("text_b", T.StringType()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = tokenizers(path_a, path_b)
        row = TaskContext.get().partitionId() << 32
        for batch in slices(batches):
            for k, text in enumerate(batch.column("text").to_pylist()):
                text, out = " " + text, []
                from_a = from_b = at_a = at_b = 0
                for no in range(-(-len(text) // CHUNK)):
                    to_a = one.cut(text, max(from_a, (no + 1) * CHUNK))
                    to_b = two.cut(text, max(from_b, (no + 1) * CHUNK))
                    out.append((row, no, at_a, text[from_a:to_a], at_b, text[from_b:to_b]))
                    at_a, at_b = at_a + len(out[-1][3].encode()), at_b + len(out[-1][5].encode())
                    from_a, from_b = to_a, to_b
                made = [pa.array([r[c] for r in out], t) for c, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string()))]
                ids = batch.column("doc_id").take(pa.array([k] * len(out)))
                yield pa.RecordBatch.from_arrays([made[0], ids, *made[1:]], schema.fieldNames())
                row += 1

    return docs.mapInArrow(run, schema)


def _fragments(chunks: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Every chunk's fragment, as rows of its parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = tokenizers(path_a, path_b)
        for batch in batches:
            for r in batch.to_pylist():
                a, text = one.encode([r["text_a"]])[0], r["text_b"]
                b = two.encode([text])[0] if r["no"] == 0 else two.encode_inner(text)
                ok = two.joined(b) == text.encode()
                made = fragment(Span(r["at_a"], a, r["at_b"], b), one.lengths, two.lengths)
                columns = zip(*_parts(r["row"], r["no"], ok, made))
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], _COLUMNS)

    return chunks.mapInArrow(run, _PART)


def _span(r) -> Span:
    return Span(r.at_a, np.frombuffer(r.a, "<i4"), r.at_b, np.frombuffer(r.b, "<i4"))


def _composer(path_a: str, path_b: str):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        one, two = tokenizers(path_a, path_b)
        ok, fragments = bool(rows["ok"].all()), []
        for _, own in rows.sort_values(["no", "kind"]).groupby("no"):
            parts = {r.kind: _span(r) for r in own.itertuples()}
            fragments.append(Fragment(parts[_HEAD], [], parts.get(_TAIL)))
        made = reduce(lambda f, g: composed(f, g, one.lengths, two.lengths), fragments)
        return pd.DataFrame(_parts(rows["row"].iloc[0], rows["no"].iloc[0] // FAN, ok, made), columns=_COLUMNS)

    return run


def _aligned_long(docs: DataFrame, path_a: str, path_b: str) -> tuple[DataFrame, DataFrame]:
    """(row, doc_id) of the documents, and rows of their groups (row and group columns)."""
    spark = docs.sparkSession
    chunks = written(_chunks(docs.select("doc_id", "text"), path_a, path_b), "chunks")
    number = chunks.count()
    dealt = chunks.repartition(max(1, min(number, 8 * spark.sparkContext.defaultParallelism)), "row", "no")
    parts = written(_fragments(dealt, path_a, path_b), "fragments")
    closed = parts.filter(F.col("kind") == _CLOSED)
    longest = (chunks.agg(F.max("no")).first()[0] or 0) + 1
    while longest > 1:
        open_ = parts.filter(F.col("kind") != _CLOSED)
        level = open_.groupBy("row", F.expr(f"no DIV {FAN}")).applyInPandas(_composer(path_a, path_b), _PART)
        parts = written(level, "fragments")
        closed = closed.unionByName(parts.filter(F.col("kind") == _CLOSED))
        longest = -(-longest // FAN)
    # The last fragment's head is the first group; it ends as the document does.
    closed = closed.unionByName(parts.filter(F.col("kind") == _HEAD))
    right = parts.groupBy("row").agg(F.min("ok").alias("right")).filter("right").select("row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = tokenizers(path_a, path_b)
        for batch in batches:
            made = []
            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
                sizes = group_sizes(np.frombuffer(a, "<i4"), np.frombuffer(b, "<i4"), one.lengths, two.lengths)
                made.append([_packed(s) for s in sizes])
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("at_a"), batch.column("a"), batch.column("b")]
                + [pa.array([m[k] for m in made], pa.binary()) for k in range(2)],
                ["row", *GROUPS],
            )

    schema = T.StructType([T.StructField("row", T.LongType()), *_GROUP_FIELDS])
    groups = closed.join(right, "row").select("row", "at_a", "a", "b").mapInArrow(run, schema)
    return chunks.filter("no = 0").select("row", "doc_id"), written(groups, "groups")


def _is_long() -> str:
    return f"octet_length(text) > {LONG}"


def align(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """doc_id and groups of every document, as rows of _at (byte of space + text where
    the row's groups begin), _a and _b (ids) and _a_sizes and _b_sizes (how many of them
    every group has), packed as little-endian 32-bit numbers.

    ``path_a`` is a byte-level vocabulary (tokenizers file), ``path_b`` a sentencepiece
    model. A document of up to ``LONG`` bytes is one row, a longer one several. Null and
    empty texts, and those whose bytes one tokenizer doesn't give back, have no tokens
    (no row, if long). Rows that repeat are documents of their own.
    """
    docs = docs.select("doc_id", "text")
    short = docs.filter(f"NOT coalesce({_is_long()}, false)")
    short = short.mapInArrow(_short(path_a, path_b), T.StructType([docs.schema["doc_id"], *_GROUP_FIELDS]))
    long_ = docs.filter(_is_long())
    if long_.isEmpty():
        return short
    keys, groups = _aligned_long(long_, path_a, path_b)
    return short.unionByName(groups.join(keys, "row").select("doc_id", *GROUPS))


def group_text(a: np.ndarray, b: np.ndarray, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Groups as bytes ``a1,a2|b1;a3|b2,b3;``, with a semicolon after the last one too."""
    n = len(a) + len(b)
    if not n:
        return np.zeros(0, np.uint8)
    before = np.cumsum(p + q) - (p + q)  # tokens before each group
    mark = np.full(n, ord(","), np.uint8)
    mark[before + p - 1] = ord("|")
    mark[before + p + q - 1] = ord(";")
    place = np.empty(n, np.int32)
    first = np.repeat(before - (np.cumsum(p) - p), p) + np.arange(len(a))
    place[first] = a
    place[np.repeat(before + p - (np.cumsum(q) - q), q) + np.arange(len(b))] = b
    digits = np.ones(n, np.int64)
    top = int(place.max())
    power = 10
    while power <= top:
        digits += place >= power
        power *= 10
    ends = np.cumsum(digits + 1)
    out = np.empty(int(ends[-1]), np.uint8)
    out[ends - 1] = mark
    left, at, rest = np.arange(n), ends - 2, place
    while len(left):
        tens = rest // 10
        out[at] = (rest - 10 * tens).astype(np.uint8) + ord("0")
        more = tens > 0
        left, at, rest = left[more], at[more] - 1, tens[more]
    return out


def pairs(
    a: np.ndarray, b: np.ndarray, p: np.ndarray, q: np.ndarray, owner: np.ndarray, base: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (owner, a * base + b) in order, and how many links each has. ``owner``
    is the document of every group. Links of large groups are counted by distinct ids."""
    starts_a, starts_b = np.cumsum(p) - p, np.cumsum(q) - q
    a, b, links = a.astype(np.int64), b.astype(np.int64), p.astype(np.int64) * q
    single = np.flatnonzero(links == 1)
    few = np.flatnonzero((links > 1) & (links <= SMALL))
    n = links[few]
    k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    each = np.repeat(q[few], n)
    codes = [
        a[starts_a[single]] * base + b[starts_b[single]],
        a[np.repeat(starts_a[few], n) + k // each] * base + b[np.repeat(starts_b[few], n) + k % each],
    ]
    owners = [owner[single], np.repeat(owner[few], n)]
    weights = [np.ones(len(c), np.int64) for c in codes]
    for g in np.flatnonzero(links > SMALL).tolist():
        own_a, times_a = np.unique(a[starts_a[g] : starts_a[g] + p[g]], return_counts=True)
        own_b, times_b = np.unique(b[starts_b[g] : starts_b[g] + q[g]], return_counts=True)
        codes.append((own_a[:, None] * base + own_b).ravel())
        weights.append((times_a[:, None] * times_b).ravel())
        owners.append(np.full(len(codes[-1]), owner[g]))
    top = np.int64(base) ** 2 if not len(a) else np.int64(max(int(a.max()) + 1, 1)) * base
    keys = np.concatenate(owners) * top + np.concatenate(codes)
    if len(codes) == 2:
        found, times = np.unique(keys, return_counts=True)
    else:
        found, where = np.unique(keys, return_inverse=True)
        times = np.zeros(len(found), np.int64)
        np.add.at(times, where, np.concatenate(weights))
    return found // top, found % top, times


_UNIT = [
    *(T.StructField(c, T.BinaryType()) for c in ("stats", "digests", "entries", "low", "high", "times", "over_at", "over")),
    T.StructField("codes", T.ArrayType(T.LongType())),
    T.StructField("holders", T.ArrayType(T.IntegerType())),
]
STATS = ["n_a", "n_b", "n_groups", "n_links"]


def _unit_row(unit: int, ids: list, parts: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    """One row for the documents of a unit: distinct pairs with the number of documents,
    and for every document which of them it has, how often."""
    codes = np.unique(np.concatenate([x[2] for x in parts]))
    index = np.searchsorted(codes, np.concatenate([x[2] for x in parts]))
    times = np.concatenate([x[3] for x in parts])
    over = np.flatnonzero(times > 254)
    binary = {
        "stats": np.concatenate([x[0] for x in parts]).astype("<i8"),
        "digests": np.frombuffer(b"".join(x[4] for x in parts), np.uint8),
        "entries": np.concatenate([x[1] for x in parts]).astype("<i4"),
        "low": (index & 0xFFFF).astype("<u2"), "high": (index >> 16).astype("<u2"),
        "times": np.minimum(times, 255).astype(np.uint8),
        "over_at": over.astype("<i8"), "over": times[over].astype("<i8"),
    }
    holders = np.bincount(index, minlength=len(codes))
    columns = {
        "unit": pa.array([unit], pa.int64()), "ids": pa.array([ids], pa.list_(kind)),
        **{c: pa.array([v.tobytes()], pa.binary()) for c, v in binary.items()},
        "codes": pa.ListArray.from_arrays(pa.array([0, len(codes)], pa.int32()), pa.array(codes)),
        "holders": pa.ListArray.from_arrays(pa.array([0, len(codes)], pa.int32()), pa.array(holders, pa.int32())),
    }
    return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def _joined(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of a packed column one after the other, and how many each row has."""
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), "<i4"), np.array([len(v) // 4 for v in values], np.int64)


def _units(docs: DataFrame, path_a: str, path_b: str, base: int) -> DataFrame:
    """Units of documents that are one row of groups each."""
    key = docs.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("unit", T.LongType()), T.StructField("ids", T.ArrayType(key)), *_UNIT])
    aligned = _short(path_a, path_b)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, ids, parts, held, kind = TaskContext.get().partitionId() << 32, [], [], 0, None
        for batch in aligned(batches):
            kind = batch.column("doc_id").type
            a, n_a = _joined(batch.column("_a"))
            b, n_b = _joined(batch.column("_b"))
            p, n_groups = _joined(batch.column("_a_sizes"))
            q, _ = _joined(batch.column("_b_sizes"))
            owner = np.repeat(np.arange(len(n_a)), n_groups)
            links = np.concatenate([[0], np.cumsum(p.astype(np.int64) * q)])
            upto = np.cumsum(n_groups)
            n_links = links[upto] - links[upto - n_groups]
            whose, codes, times = pairs(a, b, p, q, owner, base)
            text, tokens = group_text(a, b, p, q), np.cumsum(n_a + n_b)
            semicolons = np.flatnonzero(text == ord(";"))
            ends = np.where(n_groups > 0, semicolons[upto - 1] if len(semicolons) else 0, 0)
            starts = np.concatenate([[0], semicolons + 1])[upto - n_groups]
            data = memoryview(text.tobytes())
            digests = b"".join(
                hashlib.sha256(data[s:e]).digest() if n else bytes(32)
                for s, e, n in zip(starts.tolist(), ends.tolist(), tokens.tolist() and n_groups.tolist())
            )
            stats = np.stack([n_a, n_b, n_groups, n_links], 1).ravel()
            ids += batch.column("doc_id").to_pylist()
            parts.append((stats, np.bincount(whose, minlength=len(n_a)), codes, times, digests))
            held += len(codes)
            if held > UNIT_LINKS:
                yield _unit_row(unit, ids, parts, kind)
                unit, ids, parts, held = unit + 1, [], [], 0
        if parts:
            yield _unit_row(unit, ids, parts, kind)

    return docs.mapInArrow(run, schema)


def _long_links(groups: DataFrame, base: int) -> DataFrame:
    """unit (below 0: one document), code and how many links have it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = [_joined(batch.column(c)) for c in GROUPS[1:]]
            owner = np.repeat(np.arange(batch.num_rows), sides[2][1])
            whose, codes, times = pairs(*(s[0] for s in sides), owner, base)
            rows = batch.column("row").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [pa.array(-1 - rows[whose]), pa.array(codes), pa.array(times)], ["unit", "code", "times"]
            )

    found = groups.mapInArrow(run, "unit long, code long, times long")
    return found.groupBy("unit", "code").agg(F.sum("times").alias("times"))


def _long_texts(groups: DataFrame) -> DataFrame:
    """row, _stats of the groups and digest of their text, read in order row by row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = digest = None
        stats = np.zeros(4, np.int64)

        def done() -> pa.RecordBatch:
            values = [pa.array([row], pa.int64()), *(pa.array([int(s)], pa.int64()) for s in stats)]
            return pa.RecordBatch.from_arrays([*values, pa.array([digest.hexdigest()])], ["row", *STATS, "digest"])

        for batch in batches:
            for r in batch.to_pylist():
                if r["row"] != row:
                    if row is not None:
                        yield done()
                    row, digest, stats = r["row"], hashlib.sha256(), np.zeros(4, np.int64)
                else:
                    digest.update(b";")
                a, b, p, q = (np.frombuffer(r[c], "<i4") for c in GROUPS[1:])
                digest.update(group_text(a, b, p, q)[:-1].tobytes())
                stats += [len(a), len(b), len(p), int((p.astype(np.int64) * q).sum())]
        if row is not None:
            yield done()

    ordered = groups.repartition("row").sortWithinPartitions("row", "_at")
    return ordered.mapInArrow(run, "row long, n_a long, n_b long, n_groups long, n_links long, digest string")


def _counted(units: pa.Table, looked: pa.Table) -> pa.Table:
    """Per document of a unit: statistics, links that are their id's best, sum of counts."""
    r = {c: units[c][0].as_py() for c in units.column_names if c not in ("codes", "holders", "ids")}
    n = len(r["digests"]) // 32
    stats = np.frombuffer(r["stats"], "<i8").reshape(n, 4)
    index = np.frombuffer(r["high"], "<u2").astype(np.int64) << 16 | np.frombuffer(r["low"], "<u2")
    times = np.frombuffer(r["times"], np.uint8).astype(np.int64)
    times[np.frombuffer(r["over_at"], "<i8")] = np.frombuffer(r["over"], "<i8")
    count, best = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if looked.num_rows:
        order = np.argsort(looked["code"].to_numpy())
        count, best = (looked[c].to_numpy()[order].astype(np.int64) for c in ("count", "best"))
    upto = np.concatenate([[0], np.cumsum(np.frombuffer(r["entries"], "<i4"))])
    total = lambda x: np.diff(np.concatenate([[0], np.cumsum(x)])[upto])
    kind = units["ids"].type.value_type
    digests = [r["digests"][32 * k : 32 * k + 32].hex() if stats[k, 0] else "" for k in range(n)]
    return pa.table(
        {
            "doc_id": pa.array(units["ids"][0].as_py(), kind),
            **{c: pa.array(stats[:, k]) for k, c in enumerate(STATS)},
            "n_best": pa.array(total(times * best[index])),
            "count_sum": pa.array(total(times * count[index])),
            "digest": pa.array(digests, pa.string()),
        }
    )


def link_statistics(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Per document: n_a and n_b (tokens), n_groups, n_links, n_best (links of a pair that
    no other pair of its first id beats), count_sum (over links, in how many documents
    the pair is linked) and digest (SHA-256 of the groups as ``a1,a2|b1;a3|b2,b3``, of
    what :func:`align` gives). Documents without tokens have zeros and an empty digest;
    rows that repeat are documents of their own, and an empty table stays empty.
    """
    docs = docs.select("doc_id", "text")
    spark = docs.sparkSession
    base = tokenizers(path_a, path_b)[1].size
    short = docs.filter(f"NOT coalesce({_is_long()}, false)")
    units = written(_units(short, path_a, path_b, base), "units")
    zipped = F.explode(F.arrays_zip("codes", "holders")).alias("x")
    sent = units.select("unit", zipped).select("unit", F.col("x.codes").alias("code"), F.col("x.holders").cast("long").alias("holders"), F.lit(None).cast("long").alias("times"))
    long_ = docs.filter(_is_long())
    has_long = not long_.isEmpty()
    if has_long:
        keys, groups = _aligned_long(long_, path_a, path_b)
        links = _long_links(groups, base)
        sent = sent.unionByName(links.select("unit", "code", F.lit(1).cast("long").alias("holders"), "times"))
    count = F.sum("holders").over(Window.partitionBy("code")).alias("count")
    counted = written(sent.select("unit", "code", "times", count), "counts")
    # At most one row per id of the first vocabulary.
    most = counted.groupBy(F.expr(f"code DIV {base}").alias("a")).agg(F.max("count").alias("most"))
    looked = counted.withColumn("a", F.expr(f"code DIV {base}")).join(F.broadcast(most), "a")
    looked = looked.select("unit", "code", "times", "count", (F.col("count") == F.col("most")).cast("int").alias("best"))
    key = docs.schema["doc_id"].dataType.simpleString()
    columns = f"doc_id {key}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, digest string"
    mine = looked.filter("unit >= 0").select("unit", "code", "count", "best")
    out = units.drop("codes", "holders").groupBy("unit").cogroup(mine.groupBy("unit")).applyInArrow(_counted, columns)
    if not has_long:
        return out
    sums = looked.filter("unit < 0").groupBy((-1 - F.col("unit")).alias("row")).agg(
        F.sum(F.col("times") * F.col("best")).alias("n_best"), F.sum(F.col("times") * F.col("count")).alias("count_sum")
    )
    found = keys.join(_long_texts(groups), "row", "left").join(sums, "row", "left")
    names = [*STATS, "n_best", "count_sum"]
    return out.unionByName(
        found.select("doc_id", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in names), F.coalesce("digest", F.lit("")).alias("digest"))
    )
