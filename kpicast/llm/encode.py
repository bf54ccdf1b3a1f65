"""Token ids of whole texts for a word-level BPE vocabulary, fast on many texts.

Texts are cut into the vocabulary's words with numpy, side by side, and only words
not met before go to the tokenizers library. Texts that hold anything for which
cutting and lower-casing one character at a time may differ from the library
(combining marks, special strings, scripts outside the tables) go to it as a whole.
"""

from __future__ import annotations

import os
import unicodedata

import numpy as np
import pyarrow as pa

from kpicast.llm.common import span_hashes, text_buffer
from kpicast.llm.token_fst import _LETTER, _MARK, _NUMBER, classes

MAX_WORDS = 1 << 20
_PLAIN = [*range(0x1100), *range(0x2010, 0x2070)]
_POINTS = 0x2100


def _plain_lower() -> np.ndarray:
    """Lower case of characters that normalisation leaves alone; -1 for others."""
    out = np.full(0x110000, -1, np.int16)
    for c in _PLAIN:
        char = chr(c)
        low = char.lower()
        if (
            len(low) == 1
            and ord(low) < _POINTS  # the words' hashes know no others
            and char != "Σ"  # its lower case depends on what follows
            and not unicodedata.category(char).startswith("M")
            and unicodedata.category(char) != "Cn"
            and unicodedata.normalize("NFC", char) == char
        ):
            out[c] = ord(low)
    return out


def _word_spans(points: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """'s|'t|'re|'ve|'m|'ll|'d, runs of letters, single numbers, runs of marks."""
    n = len(points)
    kind = classes()[points]
    before = np.full(n, 255, np.uint8)
    before[1:] = kind[:-1]
    before[first] = 255
    inside = (kind == _LETTER) | (kind == _NUMBER) | (kind == _MARK)
    begins = inside & ((kind != before) | (kind == _NUMBER))
    for at in np.flatnonzero(begins & (points == 0x27)):
        if at + 1 < n and not first[at + 1] and points[at + 1] in (0x73, 0x74, 0x6D, 0x64):  # s t m d
            stop = at + 2
        elif at + 2 < n and not first[at + 1] and not first[at + 2] and (points[at + 1], points[at + 2]) in (
            (0x72, 0x65), (0x76, 0x65), (0x6C, 0x6C),  # re ve ll
        ):
            stop = at + 3
        else:
            continue
        begins[at + 1 : stop] = False
        if stop < n and inside[stop]:
            begins[stop] = True
    starts = np.flatnonzero(begins)
    # A word ends where the next begins or at the first blank or text end after it.
    breaks = np.flatnonzero(~inside | first | begins)
    ends = np.append(breaks, n)[np.searchsorted(breaks, starts, "right")]
    return starts, ends


_POINT_VALUE = np.random.default_rng(49_000).integers(1, 1 << 63, _POINTS, dtype=np.uint64) | np.uint64(1)


class Encoder:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.word_ends = {i for t, i in self.library.get_vocab().items() if t.endswith("</w>")}
        self.lower = _plain_lower()
        self._reset()

    def _reset(self) -> None:
        self.known: dict[int, int] = {}
        self.size = np.zeros(1 << 12, np.int32)
        self.at = np.zeros(1 << 12, np.int32)
        self.pool = np.zeros(1 << 14, np.int32)
        self.used = 0

    def _encode_words(self, words: list[str]) -> list[list[int]]:
        """Ids of single words. Joined by spaces they go through the library at once;
        the last token of a word carries the vocabulary's word end."""
        ids = self.library.encode(" ".join(words), add_special_tokens=False).ids
        ends = [k + 1 for k, i in enumerate(ids) if i in self.word_ends]
        if len(ends) == len(words):
            return [ids[a:b] for a, b in zip([0, *ends[:-1]], ends)]
        return [e.ids for e in self.library.encode_batch(words, add_special_tokens=False)]

    def _learn(self, hashes: list[int], words: list[str]) -> None:
        for k in range(0, len(words), 1000):
            for h, ids in zip(hashes[k : k + 1000], self._encode_words(words[k : k + 1000])):
                n, size = len(self.known), len(ids)
                if n == len(self.size):
                    self.size, self.at = np.resize(self.size, 2 * n), np.resize(self.at, 2 * n)
                while self.used + size > len(self.pool):
                    self.pool = np.resize(self.pool, 2 * len(self.pool))
                self.pool[self.used : self.used + size] = ids
                self.size[n], self.at[n] = size, self.used
                self.used += size
                self.known[h] = n

    def encode(self, column: pa.Array) -> list[np.ndarray]:
        """Ids of every text, without added tokens; null and empty texts have none."""
        if len(self.known) > MAX_WORDS:
            self._reset()
        texts = column.to_pylist()
        data, offsets = text_buffer(column)
        points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        lead = np.flatnonzero((data & 0xC0) != 0x80)
        chars = np.searchsorted(lead, offsets)
        low = self.lower[points]
        strange = np.flatnonzero(low < 0)
        slow = set((np.searchsorted(chars, strange, "right") - 1).tolist())
        low[strange] = 0x20
        slow |= {k for k, t in enumerate(texts) if t and any(s in t for s in self.special)}
        first = np.zeros(len(points) + 1, bool)
        first[chars] = True
        starts, ends = _word_spans(low, first[:-1])
        hashes, where, word = np.unique(
            span_hashes(low, starts, ends, _POINT_VALUE), return_index=True, return_inverse=True
        )
        listed = hashes.tolist()
        new = [k for k, h in enumerate(listed) if h not in self.known]
        self._learn(
            [listed[k] for k in new],
            [low[starts[where[k]] : ends[where[k]]].tobytes().decode("utf-16-le") for k in new],
        )
        index = np.array([self.known[h] for h in listed], np.int64)[word] if listed else np.zeros(0, np.int64)
        sizes = self.size[index]
        upto = np.concatenate([np.zeros(1, np.int32), np.cumsum(sizes, dtype=np.int32)])
        ids = self.pool[np.repeat(self.at[index] - upto[:-1], sizes) + np.arange(upto[-1], dtype=np.int32)]
        cut = upto[np.searchsorted(starts, chars)]
        out = [ids[a:b] for a, b in zip(cut[:-1], cut[1:])]
        for k in slow:
            out[k] = np.array(self.library.encode(texts[k], add_special_tokens=False).ids, np.int32)
        return out


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One per worker process."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
