"""Token counts from a byte-level BPE vocabulary compiled into a transducer.

The greedy merges of BPE are local: a token sequence is the encoding of its bytes
exactly if every two neighbouring tokens are. So every prefix of a word has one last
token, and a deterministic machine over bytes can follow it: its state holds, for
each place where a token may still be open, the token before that place, the path of
the open bytes in the vocabulary's trie, and the token count there relative to the
current prefix. Each transition is annotated with the change of the token count of
the prefix. Transitions are compiled when first met and kept in a hash table, which
starts anew once it holds ``MAX_TRANSITIONS``.

A text is cut into chunks of equal size that run side by side. A chunk's state map
is tabulated for one start state, the one expected from the bytes before it, and not
for all: the maps compose in a prefix scan, in which a chunk whose expected start is
not where the map of the chunk before it ends is tabulated again from there. Starts
are rarely wrong, as a few bytes settle the state.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, types as T

from kpicast.llm.common import slices, text_buffer

CHUNK = 512
LOOK_BACK = 64
MAX_TRANSITIONS = 3 << 19
_LETTER, _NUMBER, _BLANK, _SPACE, _MARK, _NONE = 0, 1, 2, 3, 4, 5


def _character_classes() -> np.ndarray:
    every = "".join(map(chr, [c if not 0xD800 <= c < 0xE000 else 0 for c in range(0x110000)]))
    out = np.full(0x110000, _MARK, np.uint8)
    for kind, pattern in ((_LETTER, r"\p{L}+"), (_NUMBER, r"\p{N}+"), (_BLANK, r"\s+")):
        for m in regex.finditer(pattern, every):
            out[m.start() : m.end()] = kind
    out[0x20] = _SPACE
    return out


_classes: list[np.ndarray] = []


def classes() -> np.ndarray:
    if not _classes:
        _classes.append(_character_classes())
    return _classes[0]


def word_begins(points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where the words start into which texts are cut before merging:
    's|'t|'re|'ve|'m|'ll|'d, then letters, numbers or marks with one space before
    them, then blanks (the last one apart if something follows). ``first`` marks the
    characters that start a text. Each rule looks at a few neighbours only."""
    n = len(points)
    if not n:
        return np.zeros(0, bool)
    kind = classes()[points]
    before, after = np.full(n, _NONE, np.uint8), np.full(n, _NONE, np.uint8)
    before[1:], after[:-1] = kind[:-1], kind[1:]
    before[first] = _NONE
    after[:-1][first[1:]] = _NONE
    blank = (kind == _BLANK) | (kind == _SPACE)
    blank_before = (before == _BLANK) | (before == _SPACE)
    blank_after = (after == _BLANK) | (after == _SPACE)
    begins = np.where(
        blank,
        ~blank_before | (~blank_after & (after != _NONE)),
        (before == _BLANK) | (~blank_before & (before != kind)),
    )
    begins[first] = True
    # Contractions, where the apostrophe starts a word.
    for at in np.flatnonzero(begins & (points == 0x27) & (after == _LETTER)):
        if points[at + 1] in (0x73, 0x74, 0x6D, 0x64):  # s t m d
            stop = at + 2
        elif at + 2 < n and not first[at + 2] and (points[at + 1], points[at + 2]) in (
            (0x72, 0x65), (0x76, 0x65), (0x6C, 0x6C),  # re ve ll
        ):
            stop = at + 3
        else:
            continue
        begins[at + 1 : stop] = False
        if stop < n:
            begins[stop] = True
    return begins


class Transducer:
    """Compiled from a tokenizers file with a byte-level BPE model."""

    def __init__(self, path: str, max_transitions: int = MAX_TRANSITIONS):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        names = _byte_names()
        self.special = [t["content"].encode() for t in spec["added_tokens"] if t["special"]]
        special = {t["content"] for t in spec["added_tokens"]}
        raw = lambda name: bytes(names[c] for c in name)
        tokens = [raw(t) for t in spec["model"]["vocab"] if t not in special]
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        self.rank = {(raw(a), raw(b)): k for k, (a, b) in enumerate(merges)}
        self.children: list[dict[int, int]] = [{}]
        self.token: list[bytes | None] = [None]
        for token in tokens:
            node = 0
            for b in token:
                if b not in self.children[node]:
                    self.children[node][b] = len(self.children)
                    self.children.append({})
                    self.token.append(None)
                node = self.children[node][b]
            self.token[node] = token
        # A token that merging its own bytes doesn't give can't occur.
        for node, token in enumerate(self.token):
            if token is not None and self._merge(token) != [token]:
                self.token[node] = None
        self.max_transitions = max_transitions
        self._reset()

    def _reset(self) -> None:
        self.states = [((None, 0, 0),)]
        self.ids = {self.states[0]: 0}
        self.pairs: dict[tuple[bytes, bytes], bool] = {}
        self.filled = 0
        self.slots = 1 << 16
        self.keys = np.full(self.slots, -1, np.int64)
        self.to = np.zeros(self.slots, np.int32)
        self.change = np.zeros(self.slots, np.int8)

    def _merge(self, data: bytes) -> list[bytes]:
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            ranked = [self.rank.get(pair, 1 << 30) for pair in zip(parts, parts[1:])]
            best = min(ranked)
            if best == 1 << 30:
                break
            at = ranked.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _neighbours(self, a: bytes, b: bytes) -> bool:
        found = self.pairs.get((a, b))
        if found is None:
            found = self.pairs[a, b] = self._merge(a + b) == [a, b]
        return found

    def _compile(self, state: int, byte: int) -> tuple[int, int]:
        open_, last, count = [], None, 0
        for before, node, relative in self.states[state]:
            child = self.children[node].get(byte)
            if child is None:
                continue
            token = self.token[child]
            if token is not None and last is None and (before is None or self._neighbours(before, token)):
                last, count = token, relative + 1
            if self.children[child]:
                open_.append((before, child, relative))
        new = tuple((b, c, r - count) for b, c, r in open_) + ((last, 0, 0),)
        if new not in self.ids:
            self.ids[new] = len(self.states)
            self.states.append(new)
        return self.ids[new], count

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        shift = np.uint64(64 - (self.slots.bit_length() - 1))
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> shift).astype(np.int64)

    def _find(self, keys: np.ndarray) -> np.ndarray:
        """Slots of transitions (state * 256 + byte), compiling those not met before."""
        at = self._slot(keys)
        off = np.flatnonzero(self.keys[at] != keys)
        while len(off):
            empty = self.keys[at[off]] == -1
            if empty.any():
                slots = self.slots
                for key in np.unique(keys[off[empty]]).tolist():
                    self._add(key)
                if self.slots != slots:
                    return self._find(keys)
                at[off[empty]] = self._slot(keys[off[empty]])
            at[off[~empty]] = (at[off[~empty]] + 1) & (self.slots - 1)
            off = off[self.keys[at[off]] != keys[off]]
        return at

    def _grow(self) -> None:
        full = self.keys != -1
        keys, to, change = self.keys[full], self.to[full], self.change[full]
        self.slots *= 2
        self.keys = np.full(self.slots, -1, np.int64)
        self.to, self.change = np.zeros(self.slots, np.int32), np.zeros(self.slots, np.int8)
        at = self._slot(keys)
        todo = np.arange(len(keys))
        while len(todo):
            # The first key that asks for an empty slot gets it; the others go on.
            slot, first = np.unique(at[todo], return_index=True)
            first = todo[first[self.keys[slot] == -1]]
            self.keys[at[first]] = keys[first]
            self.to[at[first]], self.change[at[first]] = to[first], change[first]
            todo = todo[self.keys[at[todo]] != keys[todo]]
            at[todo] = (at[todo] + 1) & (self.slots - 1)

    def _add(self, key: int) -> None:
        if 2 * self.filled > self.slots:
            self._grow()
        at = int(self._slot(np.array([key]))[0])
        while self.keys[at] not in (-1, key):
            at = (at + 1) & (self.slots - 1)
        if self.keys[at] == -1:
            self.to[at], self.change[at] = self._compile(key >> 8, key & 255)
            self.keys[at] = key
            self.filled += 1

    def _run(self, state: np.ndarray, data: np.ndarray, begins: np.ndarray):
        """Chunks side by side, one per column: end states and changes of the count."""
        change = np.zeros(data.shape, np.int8)
        for k in range(len(data)):
            state = np.where(begins[k], 0, state)
            at = self._find((state.astype(np.int64) << 8) | data[k])
            state, change[k] = self.to[at], self.change[at]
        return state, change

    def changes(self, data: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """The change of the token count at every byte; a word's changes sum to its tokens."""
        if self.filled > self.max_transitions:
            self._reset()
        n = len(data)
        lanes = -(-n // CHUNK)
        padded = np.zeros(lanes * CHUNK, np.uint8)
        padded[:n] = data
        flags = np.ones(lanes * CHUNK, bool)
        flags[:n] = begins
        byte_at = np.ascontiguousarray(padded.reshape(lanes, CHUNK).T)
        flag_at = np.ascontiguousarray(flags.reshape(lanes, CHUNK).T)
        # Expected start states, from the last bytes of the chunk before.
        start = np.zeros(lanes, np.int32)
        start[1:] = self._run(start[1:], byte_at[-LOOK_BACK:, :-1], flag_at[-LOOK_BACK:, :-1])[0]
        end, change = self._run(start, byte_at, flag_at)
        while True:
            wrong = np.flatnonzero(end[:-1] != start[1:]) + 1
            wrong = wrong[~flag_at[0, wrong]]  # a chunk that begins a word starts anew
            if not len(wrong):
                return change.T.ravel()[:n]
            start[wrong] = end[wrong - 1]
            end[wrong], change[:, wrong] = self._run(start[wrong], byte_at[:, wrong], flag_at[:, wrong])

    def count(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """UTF-8 bytes and tokens of every text; null has none."""
        buf, offsets = text_buffer(column)
        if not len(buf):
            zero = np.zeros(len(offsets) - 1, np.int64)
            return zero, zero
        data = buf.tobytes()
        points = np.frombuffer(data.decode("utf-8").encode("utf-32-le"), np.uint32)
        place = np.flatnonzero((buf & 0xC0) != 0x80)  # first byte of every character
        first_byte = np.zeros(len(buf) + 1, bool)
        first_byte[offsets] = True
        spans = []
        for special in self.special:
            for m in regex.finditer(regex.escape(special), data):
                inner = np.searchsorted(offsets, m.start(), "right")
                if m.end() <= offsets[inner]:
                    spans.append(m.span())
                    first_byte[[*m.span()]] = True
        begins = np.zeros(len(buf), bool)
        begins[place] = word_begins(points, first_byte[place])
        change = self.changes(buf, begins)
        for start, stop in spans:
            change[start:stop] = 0
            change[start] = 1
        upto = np.concatenate([[0], np.cumsum(change, dtype=np.int64)])
        return np.diff(offsets), np.diff(upto[offsets])


def _byte_names() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary: printable
    Latin-1 for itself, the others from 256 on in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


_machines: dict[str, Transducer] = {}


def machine(path: str) -> Transducer:
    """One per worker process, so that compiled transitions serve all its tasks."""
    if path not in _machines:
        _machines[path] = Transducer(path)
    return _machines[path]


def count_tokens(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``docs`` without its text column, with _bytes and _tokens of every row.

    Null and empty texts have 0 of both; any length of text works in bounded memory
    beside the text itself; other columns pass through, but for those that have the names
    of the results.
    """
    kept = [f for f in docs.schema.fields if f.name not in (text, "_bytes", "_tokens")]
    schema = T.StructType([*kept, T.StructField("_bytes", T.LongType()), T.StructField("_tokens", T.LongType())])
    names = [f.name for f in kept]

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        transducer = machine(path)
        for batch in slices(batches, text):
            n_bytes, n_tokens = transducer.count(batch.column(text))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64())],
                [*names, "_bytes", "_tokens"],
            )

    return docs.mapInArrow(counted, schema)
