"""Language-model scoring with an n-gram trie in Elias-Fano levels.

Words are 63-bit hashes. Level 1 holds the training words in order of hash with their
counts; level n all n-grams (n = 2, 3), or those met ``min_count`` times if asked. An n-gram
hangs below its first n - 1 words, and its last word is written relative to the shorter
context: for a trigram, its place among the successors of the middle word. Pointers to
the children of every n-gram above, and the children of one parent after the other, each
group raised by the end of the one before, are non-decreasing and stored as Elias-Fano
sequences; finding a word is a successor search inside its parent's range.

Smoothing is absolute discounting, interpolated:

    p(w | h) = (c(h w) - D) / c(h) + left(h) p(w | shorter h)

over kept n-grams; left(h) is what they leave of 1, so pruning keeps a distribution. D is
n1 / (n1 + 2 n2) by how many n-grams of the level were met once and twice, or ``DISCOUNT``
where either is none or those met once are left out. A
word seen in training has (c - D1) / N, and all unseen words together the rest, D1 V / N.
Both factors are quantised to 8 bits with a code book per segment.

A level is a set of segment files in the shared folder, each a range of keys of at most
about ``SEGMENT`` n-grams built by one task. Counts are shuffled once a level, by these ranges:
they come from the counts of the level below, and only sums of contexts that two ranges
share pass through the driver. Scoring tasks map them into memory and touch the
pages they need; files of a folder that is not local are copied into a temporary folder
of the worker first. Levels are built in order, each by looking words up in those below.
"""

from __future__ import annotations

import atexit
import json
import os
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, functions as F, types as T

from kpicast.llm.common import n_shards, slices, word_hashes
from kpicast.llm.eliasfano import EliasFano
from kpicast.session import shared_dir, written

MIN_COUNT = 1
DISCOUNT = 0.75
SEGMENT = 1 << 20  # words of training text whose n-grams one shard and segment holds
POINTS = 64  # of a shard, where those of the next level may be cut
ID_BITS = 31  # of a word's number, and of a place among successors
_LOW = (1 << ID_BITS) - 1
GROUP = 1 << 20  # tokens looked up together
FLUSH = 2 << 20  # keys a task sums before it sends them
CUT = 1 << 18  # bytes of text cut into words together
RECENT = 1 << 18
SHARD_BYTES = 16 << 20  # of text whose words one task merges
END = 0x5E0D_0F_7E87 << 20  # stands for the end of a text; words have odd hashes


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of words and the end of every text, and the number of them per text."""
    hashes, counts = word_hashes(column)
    hashes = (hashes >> np.uint64(1)) | np.uint64(1)
    at = np.cumsum(counts)
    return np.insert(hashes.astype(np.int64), at, END), counts + 1


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[pa.RecordBatch], np.ndarray, np.ndarray]]:
    """Rows of about ``GROUP`` tokens with those and their numbers. Levels are looked up
    for a whole group, as every segment costs the same few passes for one key or many;
    words are cut in smaller slices, which stay in the cache."""
    held, n = [], 0
    for batch in slices(batches, size=CUT):
        held.append((batch, *tokens(batch.column("text"))))
        n += len(held[-1][1])
        if n >= GROUP:
            rows, hashes, counts = zip(*held)
            held, n = [], 0
            yield list(rows), np.concatenate(hashes), np.concatenate(counts)
    if held:
        rows, hashes, counts = zip(*held)
        yield list(rows), np.concatenate(hashes), np.concatenate(counts)


# -- files -------------------------------------------------------------------


def _open_folder(uri: str) -> tuple[arrow_fs.FileSystem, str]:
    if re.match(r"file:|/", uri):
        return arrow_fs.LocalFileSystem(), re.sub(r"^file:/*", "/", uri)
    return arrow_fs.FileSystem.from_uri(uri)


def _write(folder: str, name: str, arrays: dict[str, np.ndarray], about: dict) -> None:
    """One file: a line that says where each array is, and the arrays, 8-byte aligned.
    Written under a name of its own and moved, so repeated attempts do no harm."""
    places, at = {}, 0
    for key, a in arrays.items():
        places[key] = (at, len(a), a.dtype.str)
        at += -(-a.nbytes // 8) * 8
    head = json.dumps({"arrays": places, **about}).encode()
    head += b" " * (-(len(head) + 1) % 8) + b"\n"
    store, path = _open_folder(folder)
    store.create_dir(path, recursive=True)
    draft = f"{path}/.{name}-{uuid.uuid4().hex}"
    with store.open_output_stream(draft) as out:
        out.write(head)
        for a in arrays.values():
            out.write(a.tobytes() + b"\0" * (-a.nbytes % 8))
    store.move(draft, f"{path}/{name}")


_copies: list[str] = []


def _mapped(folder: str, name: str) -> tuple[dict[str, np.ndarray], dict]:
    store, path = _open_folder(folder)
    file = f"{path}/{name}"
    if not isinstance(store, arrow_fs.LocalFileSystem):
        if not _copies:
            _copies.append(tempfile.mkdtemp(prefix="lm-"))
            atexit.register(shutil.rmtree, _copies[0], ignore_errors=True)
        local = os.path.join(_copies[0], name)
        arrow_fs.copy_files(file, local, source_filesystem=store, destination_filesystem=arrow_fs.LocalFileSystem())
        file = local
    data = np.asarray(np.memmap(file, np.uint8, "r"))
    first = int(np.flatnonzero(data[: 1 << 16] == 0x0A)[0]) + 1
    about = json.loads(bytes(data[:first]))
    arrays = {
        key: data[first + at : first + at + n * np.dtype(kind).itemsize].view(kind)
        for key, (at, n, kind) in about["arrays"].items()
    }
    return arrays, about


_STORED = ("low", "high", "zeros", "ones")


def _pack(name: str, sequence: EliasFano) -> tuple[dict, dict]:
    arrays = {f"{name}.{k}": getattr(sequence, k) for k in _STORED}
    return arrays, {name: (sequence.n, sequence.low_bits)}


def _unpack(name: str, arrays: dict, about: dict) -> EliasFano:
    return EliasFano(*about[name], *(arrays[f"{name}.{k}"] for k in _STORED))


def quantised(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes below 255 and the code book: bins of equal population, each its mean."""
    edges = np.unique(np.quantile(values, np.linspace(0, 1, 256)[1:-1])) if len(values) else np.zeros(0)
    codes = np.searchsorted(edges, values, "left")
    sums = np.bincount(codes, weights=values, minlength=len(edges) + 1)
    return codes.astype(np.uint8), sums / np.maximum(np.bincount(codes, minlength=len(edges) + 1), 1)


# -- levels ------------------------------------------------------------------


@dataclass
class Level:
    """Segments in order: file names, first keys and the numbers of n-grams before."""

    folder: str
    names: list[str]
    first: np.ndarray
    base: np.ndarray
    n: int
    _maps: dict = field(default_factory=dict, repr=False)

    def __getstate__(self) -> dict:
        return {**self.__dict__, "_maps": {}}

    def segment(self, k: int) -> dict:
        if k not in self._maps:
            arrays, about = _mapped(self.folder, self.names[k])
            found = {name: _unpack(name, arrays, about) for name in about["sequences"]}
            self._maps[k] = found | {name: a for name, a in arrays.items() if "." not in name}
        return self._maps[k]

    def split(self, keys: np.ndarray) -> Iterator[tuple[int, slice]]:
        """(segment, which of the sorted keys belong there)."""
        cut = np.append(np.searchsorted(keys, self.first), len(keys))
        for k in np.flatnonzero(cut[1:] > cut[:-1]):
            yield int(k), slice(cut[k], cut[k + 1])


def _by_segment(segments: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(segment number, its places in order) of those that occur, from -1 on. One sort,
    as a pass per segment would grow with their number."""
    small = len(segments) and segments.max() < 1 << 15
    order = np.argsort(segments.astype(np.int16) if small else segments, kind="stable")
    cut = np.flatnonzero(np.diff(segments[order])) + 1
    for at in np.split(order, cut) if len(order) else ():
        yield int(segments[at[0]]), at


class Words(Level):
    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers (-1: unseen) and counts of words. The last word looked up at each of
        ``RECENT`` places is remembered, as most words of a text are frequent ones."""
        if "recent" not in self._maps:
            self._maps["recent"] = tuple(np.full(RECENT, fill, np.int64) for fill in (-1, -1, 0))
        known, ids, counts = self._maps["recent"]
        place = (hashes >> 3) & (RECENT - 1)
        found, seen = ids[place], counts[place]
        missed = np.flatnonzero(known[place] != hashes)
        some, back = np.unique(hashes[missed], return_inverse=True)
        new, n = self._search(some)
        found[missed], seen[missed] = new[back], n[back]
        place = (some >> 3) & (RECENT - 1)
        known[place], ids[place], counts[place] = some, new, n
        return found, seen

    def _search(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of sorted words."""
        ids, counts = np.full(len(hashes), -1, np.int64), np.zeros(len(hashes), np.int64)
        for k, at in self.split(hashes):
            segment = self.segment(k)
            place, equal = segment["hashes"].find((hashes[at] - self.first[k]).astype(np.uint64))
            hit = np.flatnonzero(equal)
            ids[at][hit] = place[hit] + self.base[k]
            counts[at][hit] = _read_counts(segment, place[hit])
        return ids, counts


class Grams(Level):
    def _range(self, segment: dict, k: int, parent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and past-the-end place of the children that parents have in the segment.
        Pointers are indexed by the parent's number, counted from the segment's first."""
        at = parent - (self.first[k] >> ID_BITS)
        inside = at < segment["pointers"].n - 1
        begin, end = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        begin[inside], end[inside] = segment["pointers"].pair(at[inside])
        return begin, end

    def _hits(self, keys: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(segment, which of the sorted keys it has, their places, first places of their
        contexts). What the words of one context share is read once."""
        for k, at in self.split(keys):
            children = self.segment(k)["children"]
            parent = keys[at] >> ID_BITS
            new = np.flatnonzero(np.concatenate([[True], parent[1:] != parent[:-1]]))
            begin, end = self._range(self.segment(k), k, parent[new])
            raised = np.zeros(len(new), np.uint64)
            later = np.flatnonzero((0 < begin) & (begin < end))
            raised[later] = children.get(begin[later] - 1)
            own = np.repeat(np.arange(len(new)), np.diff(np.append(new, len(parent))))
            begin = begin[own]
            place, equal = children.find((keys[at] & _LOW).view(np.uint64) + raised[own], begin, end[own])
            hit = np.flatnonzero(equal)
            yield k, hit + at.start, place[hit], begin[hit]

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Numbers (-1: none), first factors and places among all successors of their
        context, of n-grams by sorted keys: the number of the context and the relative
        number of the word."""
        ids, share, rank = np.full(len(keys), -1, np.int64), np.zeros(len(keys)), np.zeros(len(keys), np.int64)
        for k, at, place, begin in self._hits(keys):
            segment = self.segment(k)
            ids[at] = place + self.base[k]
            share[at] = segment["share_book"][segment["share"][place]]
            rank[at] = place - begin
            # The segment's first context may have more words in those before.
            rank[at[: np.searchsorted(keys[at] >> ID_BITS, self.first[k] >> ID_BITS, "right")]] += self._skipped(k)
        return ids, share, rank

    def share(self, keys: np.ndarray) -> np.ndarray:
        """First factors of n-grams by sorted keys."""
        out = np.zeros(len(keys))
        for k, at, place, _ in self._hits(keys):
            segment = self.segment(k)
            out[at] = segment["share_book"][segment["share"][place]]
        return out

    def _skipped(self, k: int) -> int:
        """How many n-grams of its first context a segment leaves to those before."""
        if ("skipped", k) not in self._maps:
            self._maps["skipped", k] = int(self.base[k] - self.start(self.first[k : k + 1] >> ID_BITS)[0])
        return self._maps["skipped", k]

    def left(self, parent: np.ndarray) -> np.ndarray:
        """What contexts, in order, leave to the shorter one; 1 for those without n-grams."""
        out = np.ones(len(parent))
        for k, at in self.split((parent << ID_BITS) | _LOW):
            segment = self.segment(k)
            place = parent[at] - (self.first[k] >> ID_BITS)
            place = place[: np.searchsorted(place, len(segment["left"]))]
            out[at][: len(place)] = segment["left_book"][segment["left"][place]]
        return out

    def start(self, parent: np.ndarray) -> np.ndarray:
        """Number of the first n-gram of contexts that have some."""
        of = np.searchsorted(self.first, parent << ID_BITS, "left") - 1
        out = np.zeros(len(parent), np.int64)
        for k, at in _by_segment(of):
            # A context that is not in this segment starts the next one.
            start = np.full(len(at), self.base[k + 1] if k + 1 < len(self.base) else self.n)
            if k >= 0:
                begin, end = self._range(self.segment(k), k, parent[at])
                full = begin < end
                start[full] = self.base[k] + begin[full]
            out[at] = start
        return out

    def count(self, ids: np.ndarray) -> np.ndarray:
        """Training counts of n-grams by number."""
        of = np.searchsorted(self.base, ids, "right") - 1
        out = np.zeros(len(ids), np.int64)
        for k, at in _by_segment(of):
            out[at] = _read_counts(self.segment(k), ids[at] - self.base[k])
        return out


def _read_counts(segment: dict, place: np.ndarray) -> np.ndarray:
    out = segment["count"][place].astype(np.int64)
    large = np.flatnonzero(out == 255)
    out[large] = segment["large"][np.searchsorted(segment["large_at"], place[large])]
    return out


_levels: dict[str, Level] = {}


def _held(level: Level) -> Level:
    """One copy per worker process, so files stay mapped from task to task."""
    return _levels.setdefault(level.folder, level)


@dataclass
class Model:
    words: Words
    grams: list[Grams]  # of 2 and 3 words
    total: int
    distinct: int
    unseen_discount: float

    def unigram(self, counts: np.ndarray) -> np.ndarray:
        unseen = self.unseen_discount * self.distinct / max(self.total, 1)
        seen = (counts - self.unseen_discount) / max(self.total, 1)
        return np.where(counts > 0, seen, max(unseen, 1.0 / (self.total + self.distinct + 1)))

    def score(self, hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """log10 probability of every token, and its training count. ``counts``: tokens
        per text; contexts don't reach over the start of a text."""
        ids, seen = _held(self.words).find(hashes)
        p = self.unigram(seen)
        within = _place_in_text(counts)
        if len(self.grams) > 0:
            two = _Bigrams.of(self, ids, within)
            p = two.spread(two.share, 0.0) + self._left_by_word(ids, within, two) * p
        if len(self.grams) > 1:
            left = two.spread(self._left_by_bigram(two), 1.0)
            p *= np.where(within >= 2, np.roll(left, 1), 1.0)
            at, keys = _trigrams(two, within)
            # In order, so that neighbours in the files are read one after the other.
            order = np.argsort(keys)
            p[at[order]] += _held(self.grams[1]).share(keys[order])
        return np.log10(p), seen

    def _left_by_word(self, ids: np.ndarray, within: np.ndarray, two: _Bigrams) -> np.ndarray:
        """What the word before every token leaves."""
        level = _held(self.grams[0])
        words, own = _distinct(two.keys >> ID_BITS)
        out = two.spread(level.left(words)[own], 1.0)
        odd = np.flatnonzero((within >= 1) & (ids < 0) & (np.roll(ids, 1) >= 0))
        words, own = np.unique(ids[odd - 1], return_inverse=True)
        out[odd] = level.left(words)[own]
        return out

    def _left_by_bigram(self, two: _Bigrams) -> np.ndarray:
        """What every distinct bigram leaves as a context; their numbers are in order."""
        out = np.ones(len(two.keys))
        kept = two.number >= 0
        out[kept] = _held(self.grams[1]).left(two.number[kept])
        return out


def _distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ones of sorted values, and for each value which it is."""
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    return values[new], np.cumsum(new) - 1


def _place_in_text(counts: np.ndarray) -> np.ndarray:
    return np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)


@dataclass
class _Bigrams:
    """The distinct bigrams of known words among tokens: key, number (-1: not kept), first
    factor and place among the successors of the first word; where they end, and which."""

    keys: np.ndarray
    number: np.ndarray
    share: np.ndarray
    rank: np.ndarray
    at: np.ndarray
    back: np.ndarray
    tokens: int

    @classmethod
    def of(cls, model: Model, ids: np.ndarray, within: np.ndarray) -> _Bigrams:
        at = np.flatnonzero((within >= 1) & (ids >= 0) & (np.roll(ids, 1) >= 0))
        keys, back = np.unique((ids[at - 1] << ID_BITS) | ids[at], return_inverse=True)
        return cls(keys, *_held(model.grams[0]).find(keys), at, back, len(ids))

    def spread(self, values: np.ndarray, other) -> np.ndarray:
        """A value per bigram at the tokens that end one, ``other`` elsewhere."""
        out = np.full(self.tokens, other)
        out[self.at] = values[self.back]
        return out


def _trigrams(two: _Bigrams, within: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places whose two bigrams are kept, and keys: the trigram's context and its word
    relative to the successors of the middle word."""
    number = two.spread(two.number, -1)
    at = np.flatnonzero((within >= 2) & (number >= 0) & (np.roll(number, 1) >= 0))
    return at, (number[at - 1] << ID_BITS) | two.spread(two.rank, 0)[at]


# -- building ----------------------------------------------------------------


def _packed(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted distinct keys and their counts: the steps of the upper halves, the lower
    halves as steps while the upper stays, and counts; bytes of equal weight side by side."""
    high, low = (keys >> ID_BITS).astype(np.uint32), (keys & _LOW).astype(np.uint32)
    zero = np.zeros(1, np.uint32)
    step = np.diff(high, prepend=zero)
    move = np.where(step == 0, np.diff(low, prepend=zero), low)
    parts = (step, move, counts.astype(np.uint64))
    planes = np.concatenate([np.ascontiguousarray(a).view(np.uint8).reshape(len(keys), -1).T for a in parts])
    return pa.compress(planes.tobytes(), "zstd", asbytes=True)


def _unpacked(blob: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(pa.decompress(blob, 16 * n, "zstd", asbytes=True), np.uint8).reshape(16, n)
    step, move = (np.ascontiguousarray(planes[k : k + 4].T).view(np.uint32).ravel().astype(np.int64) for k in (0, 4))
    counts = np.ascontiguousarray(planes[8:].T).view(np.int64).ravel()
    start = step != 0
    start[0] = True
    at, total = np.flatnonzero(start), np.cumsum(move)
    low = total - np.repeat(total[at] - move[at], np.diff(np.append(at, n)))
    return (np.cumsum(step) << ID_BITS) | low, counts


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sums of their counts. Most counts are 1: keys are
    sorted without them, and what counts have above 1 is added to the sums."""
    distinct, sums = np.unique(keys, return_counts=True)
    more = np.flatnonzero(counts > 1)
    np.add.at(sums, np.searchsorted(distinct, keys[more]), counts[more] - 1)
    return distinct, sums


def _counted(docs: DataFrame, keys_of, bounds: np.ndarray, finish, schema: str, least: int = 1) -> DataFrame:
    """What ``finish`` gives per shard for its sorted keys and counts of at least ``least``.
    ``keys_of`` gives the 63-bit keys of tokens and their numbers per text, ``bounds`` are
    the first keys of all shards but the first. A task sums its keys and sends each shard
    its range in one piece; a shard's pieces are merged by one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def flush() -> pa.RecordBatch:
            keys, counts = np.unique(np.concatenate(held), return_counts=True)
            cut = np.concatenate([[0], np.searchsorted(keys, bounds), [len(keys)]])
            some = np.flatnonzero(cut[1:] > cut[:-1])
            blobs = [_packed(keys[cut[s] : cut[s + 1]], counts[cut[s] : cut[s + 1]]) for s in some]
            return pa.RecordBatch.from_arrays(
                [pa.array(some, pa.int32()), pa.array(np.diff(cut)[some], pa.int64()), pa.array(blobs, pa.binary())],
                ["shard", "n", "keys"],
            )

        for _, hashes, counts in _grouped(batches):
            held.append(keys_of(hashes, counts))
            n += len(held[-1])
            if n > FLUSH:
                yield flush()
                held, n = [], 0
        if n:
            yield flush()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, list] = {}
        for batch in batches:
            for row in batch.to_pylist():
                parts.setdefault(row["shard"], []).append((row["keys"], row["n"]))
        while parts:
            shard, own = parts.popitem()
            keys, sums = _summed(*map(np.concatenate, zip(*(_unpacked(*piece) for piece in own))))
            kept = sums >= least
            if kept.any():
                yield pa.RecordBatch.from_pylist([{"shard": shard, **finish(keys[kept], sums[kept])}])

    sent = docs.select("text").mapInArrow(run, "shard int, n long, keys binary")
    return sent.repartition(len(bounds) + 1, "shard").mapInArrow(merge, schema)


def _totals(counts: np.ndarray) -> dict:
    """Facts on a shard's counts. ``points``: places that cut their sum into ``POINTS``."""
    sums = np.cumsum(counts)
    points = np.searchsorted(sums, np.arange(1, POINTS + 1) * (sums[-1] / POINTS))
    return {
        "n": len(counts),
        "total": int(sums[-1]),
        "once": int((counts == 1).sum()),
        "twice": int((counts == 2).sum()),
        "points": np.minimum(points, len(counts) - 1).tobytes(),
    }


_TOTALS = "shard long, n long, total long, once long, twice long, points binary"


def _bounds(rows, shards: int, span: int) -> np.ndarray:
    """First keys of the shards of the level whose contexts ``rows`` sum up, in order, so
    that each holds about as many of the words that follow them. A context that has more
    than that is cut by its words, of which there are ``span``."""
    base = np.cumsum(rows["n"]) - rows["n"]
    places = [np.frombuffer(p, np.int64) + b for p, b in zip(rows["points"], base)]
    if shards == 1 or not places:
        return np.zeros(0, np.int64)
    weights = np.cumsum(np.repeat(rows["total"].to_numpy() / POINTS, POINTS))
    at = np.searchsorted(weights, np.arange(1, shards) * (weights[-1] / shards))
    parents, first, times = np.unique(
        np.concatenate(places)[np.minimum(at, len(weights) - 1)], return_index=True, return_counts=True
    )
    turn = np.arange(shards - 1) - np.repeat(first, times)
    times = np.repeat(times, times)
    return (np.repeat(parents, np.diff(np.append(first, shards - 1))) << ID_BITS) | (span * turn // times)


def _level(kind: type[Level], folder: str, rows) -> Level:
    """The level of segments that ``rows`` (first, n, name) name, in order."""
    sizes = rows["n"].to_numpy(np.int64)
    return kind(folder, rows["name"].to_list(), rows["first"].to_numpy(np.int64), np.cumsum(sizes) - sizes, int(sizes.sum()))


def _save(folder: str, first: int, built: tuple[dict, dict]) -> str:
    name = f"{first:016x}"
    _write(folder, name, *built)
    return name


def _sequences(**sequences: EliasFano) -> tuple[dict, dict]:
    arrays, about = {}, {"sequences": list(sequences)}
    for name, sequence in sequences.items():
        part, facts = _pack(name, sequence)
        arrays |= part
        about |= facts
    return arrays, about


def _counts(counts: np.ndarray) -> dict[str, np.ndarray]:
    """A byte per count; those of 255 and more apart, with their places."""
    large = np.flatnonzero(counts >= 255)
    return {"count": np.minimum(counts, 255).astype(np.uint8), "large_at": large, "large": counts[large]}


def _build_words(keys: np.ndarray, counts: np.ndarray) -> tuple[dict, dict]:
    arrays, about = _sequences(hashes=EliasFano.build(keys - keys[0]))
    return arrays | _counts(counts), about


def _groups(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Per context of sorted keys: its number, its place, its n-grams and their counts' sum."""
    parent = keys >> ID_BITS
    first = np.flatnonzero(np.concatenate([[True], parent[1:] != parent[:-1]]))
    return parent[first], first, np.diff(np.append(first, len(keys))), np.add.reduceat(counts, first)


def _build_grams(keys: np.ndarray, count: np.ndarray, context: np.ndarray, mass: np.ndarray, discount: float):
    """``context`` and ``mass``: per context its count and what its n-grams hold of it."""
    parent, first, lengths, _ = _groups(keys, count)
    child = keys & _LOW
    ends = child[np.append(first[1:], len(keys)) - 1]
    raised = np.repeat(np.cumsum(ends) - ends, lengths)
    every = np.arange(parent[0], parent[-1] + 2)
    arrays, about = _sequences(
        pointers=EliasFano.build(np.searchsorted(keys >> ID_BITS, every)),
        children=EliasFano.build(child + raised),
    )
    share, share_book = quantised((count - discount) / np.repeat(context, lengths))
    kept, left_book = quantised(np.clip(1 - mass / context, 1e-9, 1.0))
    # The last code stands for contexts without n-grams.
    left = np.full(len(every) - 1, len(left_book), np.uint8)
    left[parent - parent[0]] = kept
    left_book = np.append(left_book, 1.0)
    return arrays | _counts(count) | {"share": share, "share_book": share_book, "left": left, "left_book": left_book}, about


_ENDS = ("first_parent", "first_n", "first_c", "last_parent", "last_n", "last_c", "longest")


def _gram_shard(keys: np.ndarray, counts: np.ndarray) -> dict:
    """A shard's facts, those of its first and last context, which other shards may have
    as well, and the shard itself."""
    parent, _, n, c = _groups(keys, counts)
    ends = (parent[0], n[0], c[0], parent[-1], n[-1], c[-1], n.max())
    return {**_totals(counts), **{k: int(x) for k, x in zip(_ENDS, ends)}, "keys": _packed(keys, counts)}


_GRAM_SHARD = f"{_TOTALS}, {', '.join(f'{k} long' for k in _ENDS)}, keys binary"


def _shared_contexts(rows) -> dict[int, tuple[int, int]]:
    """(n-grams, sum of their counts) of the contexts that several shards have."""
    found: dict[int, list] = {}
    for r in rows.itertuples():
        found.setdefault(r.first_parent, []).append((r.first_n, r.first_c))
        if r.last_parent != r.first_parent:
            found.setdefault(r.last_parent, []).append((r.last_n, r.last_c))
    return {p: tuple(map(sum, zip(*x))) for p, x in found.items() if len(x) > 1}


def _segments(shards: DataFrame, shared: dict, model: Model, order: int, discount: float, folder: str) -> Level:
    """Segment files of the shards; a group of one context may span several."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                keys, counts = _unpacked(row["keys"], row["n"])
                parent, first, _, _ = _groups(keys, counts)
                mass = np.add.reduceat(counts - discount, first)
                for k in (0, -1):
                    if int(parent[k]) in shared:
                        n, c = shared[int(parent[k])]
                        mass[k] = c - discount * n
                context = _held(model.grams[0]).count(parent) if order == 3 else _word_counts(_held(model.words), parent)
                built = _build_grams(keys, counts, context.astype(float), mass, discount)
                name = _save(folder, int(keys[0]), built)
                yield pa.RecordBatch.from_pylist([{"first": int(keys[0]), "n": len(keys), "name": name}])

    found = shards.select("n", "keys").mapInArrow(run, "first long, n long, name string")
    # One row per segment of a million n-grams.
    return _level(Grams, folder, found.toPandas().sort_values("first"))


def _word_counts(words: Words, ids: np.ndarray) -> np.ndarray:
    return Grams.count(words, ids)


def _require_room(count: int, bits: int, what: str) -> None:
    """Numbers below ``count`` have to fit ``bits`` bits of a 64-bit key."""
    if count > 1 << bits:
        raise OverflowError(f"{count} distinct {what} are more than a key of {bits} bits can tell apart")


def train(docs: DataFrame, order: int = 3, min_count: int = MIN_COUNT) -> Model:
    """Model of the texts of ``docs`` (null counts as empty). Counts cover all rows;
    repeated rows count as often as they are there; an empty table gives a model in
    which every word is unseen. More than 2^31 distinct words, or 2^32 bigrams below a
    further level, stop the job: their keys would not be distinct."""
    folder = f"{shared_dir(docs.sparkSession)}/lm-{uuid.uuid4().hex}"
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = n_shards(docs.sparkSession, size, SHARD_BYTES)
    ends = np.array([(1 << 63) * k // shards for k in range(1, shards)], np.int64)

    def word_shard(keys: np.ndarray, counts: np.ndarray) -> dict:
        first = int(keys[0])
        return {**_totals(counts), "first": first, "name": _save(f"{folder}/1", first, _build_words(keys, counts))}

    found = _counted(docs, lambda hashes, n: hashes, ends, word_shard, f"{_TOTALS}, first long, name string")
    # One row per shard, here and below.
    rows = found.toPandas().sort_values("first")
    total, distinct, once, twice = (int(rows[k].sum()) for k in ("total", "n", "once", "twice"))
    _require_room(distinct, ID_BITS, "words")
    discount = once / (once + 2 * twice) if once and twice else 0.5
    model = Model(_level(Words, f"{folder}/1", rows), [], total, distinct, discount)
    span = distinct

    def bigram_keys(hashes: np.ndarray, n: np.ndarray) -> np.ndarray:
        ids, seen = _held(model.words).find(hashes)
        ids = np.where(seen >= min_count, ids, -1)
        at = np.flatnonzero((_place_in_text(n) >= 1) & (ids >= 0) & (np.roll(ids, 1) >= 0))
        return (ids[at - 1] << ID_BITS) | ids[at]

    def trigram_keys(hashes: np.ndarray, n: np.ndarray) -> np.ndarray:
        within = _place_in_text(n)
        return _trigrams(_Bigrams.of(model, _held(model.words).find(hashes)[0], within), within)[1]

    for n, keys in ((2, bigram_keys), (3, trigram_keys)):
        if n > order or not model.distinct:
            break
        shards = max(1, -(-total // SEGMENT))
        kept = written(_counted(docs, keys, _bounds(rows, shards, span), _gram_shard, _GRAM_SHARD, min_count), f"grams-{n}")
        rows = kept.drop("keys").toPandas().sort_values("shard")
        size, once, twice = (int(rows[k].sum()) for k in ("n", "once", "twice"))
        if n < order:
            _require_room(size, 63 - ID_BITS, f"{n}-grams")
        discount = once / (once + 2 * twice) if once and twice else DISCOUNT
        shared = _shared_contexts(rows)
        # Words that any context has after it, so places among successors.
        span = max([rows["longest"].max() if len(rows) else 1, *(x[0] for x in shared.values())])
        model.grams = [*model.grams, _segments(kept, shared, model, n, discount, f"{folder}/{n}")]
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` without text, with _tokens, _known, _base and _score: the tokens and
    those seen in training, the add-one unigram score and the model's log10
    probability. A null, empty or blank text is its end alone. Rows are scored alone;
    extra columns pass through, but for those that have the names of the results."""
    new = [("_tokens", T.LongType()), ("_known", T.LongType()), ("_base", T.DoubleType()), ("_score", T.DoubleType())]
    kept = [f for f in docs.schema.fields if f.name not in ("text", *dict(new))]
    schema = T.StructType([*kept, *(T.StructField(*f) for f in new)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, hashes, n in _grouped(batches):
            batch = pa.concat_batches(rows)
            logs, seen = model.score(hashes, n)
            row = np.repeat(np.arange(len(n)), n)
            base = np.log10((seen + 1) / (model.total + model.distinct + 1))
            sums = [np.bincount(row, weights=w, minlength=len(n)) for w in (base, logs)]
            known = np.bincount(row[seen > 0], minlength=len(n))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f.name) for f in kept), pa.array(n, pa.int64()), pa.array(known, pa.int64()), *map(pa.array, sums)],
                schema.names,
            )

    return docs.mapInArrow(run, schema)
