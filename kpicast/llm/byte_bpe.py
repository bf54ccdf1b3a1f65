"""Byte-level BPE by the tiktoken library and a local rank file, both ways.

The library cuts a text with its pattern and merges the bytes of every match by rank.
Long texts are cut beforehand where the pattern ends a match whatever stands around:
no match holds a blank after something else, or characters of two of the classes
letter, number and mark in the orders listed in ``_SAFE``. So the pieces of a text give
its ids one after the other, and one piece at a time is in the library's hands. Long
runs of blanks, on which its pattern would overflow a stack, and texts without any such
place are cut into single matches here.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, types as T

from kpicast.llm.common import slices

PIECE = 1 << 16  # characters
LONG_RUN = 1 << 10  # blanks
_WORDS = r"一-鿿ぁ-ゔァ-ヺ가-힣"
_SAFE = regex.compile(
    r"(?<=[!-~])(?=[ \t\r\n])|(?<=[A-Za-z])(?=[!-@\[-`{-~])|(?<=[0-9])(?=[!-/:-~])|(?<=[!-/:-@\[-`{-~])(?=[0-9])"
    rf"|(?<=[{_WORDS}])(?=[ \t\r\n0-9、。！，？])"
)
_RUN = regex.compile(rf"\s{{{LONG_RUN}}}")


def safe_cut(text: str, at: int) -> int:
    """The first place from ``at`` on where every text around is cut too; its end if
    there is none."""
    found = _SAFE.search(text, at) if 0 < at < len(text) else None
    return found.start() if found else len(text)


def pieces(text: str, size: int) -> Iterator[str]:
    """``text`` cut at safe places, each the first after ``size`` characters."""
    at = 0
    while at < len(text):
        end = safe_cut(text, at + size)
        yield text[at:end]
        at = end


class Codec:
    """Ranks of byte strings, applied match by match of ``pattern``."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import tiktoken

        self.library = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.matches = regex.compile(pattern)

    def encode(self, text: str, size: int = 0) -> np.ndarray:
        """Ids of a text of any length."""
        size = size or PIECE
        if len(text) <= size and not _RUN.search(text):
            return np.array(self.library.encode_ordinary(text), np.uint32)
        found = []
        for piece in pieces(text, size):
            if len(piece) <= 4 * size and not _RUN.search(piece):
                found.append(np.array(self.library.encode_ordinary(piece), np.uint32))
            else:
                single = self.library._core_bpe.encode_single_piece
                found.extend(np.array(single(m.group().encode()), np.uint32) for m in self.matches.finditer(piece))
        return np.concatenate(found)

    def decode(self, ids: np.ndarray, size: int = 0) -> bytes:
        """The bytes of all ids, which need not be UTF-8 on their own."""
        size = size or PIECE
        return b"".join(self.library.decode_bytes(ids[k : k + size].tolist()) for k in range(0, len(ids), size))


_codecs: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """One per worker process; ``path`` is a file of base64 byte strings and ranks."""
    if path not in _codecs:
        import public_tokenizers

        with open(path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        _codecs[path] = Codec(ranks, public_tokenizers.PATTERN)
    return _codecs[path]


def _replaced(df: DataFrame, old: str, new: str, function) -> DataFrame:
    """``df`` with the column ``old`` in exchange for the binary column ``new``."""
    kept = [f for f in df.schema.fields if f.name not in (old, new)]
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = function()
        for batch in slices(batches, old):
            made = pa.array([make(value) for value in batch.column(old).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), made], [*names, new])

    return df.mapInArrow(run, T.StructType([*kept, T.StructField(new, T.BinaryType())]))


def encode(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``docs`` with ``_ids`` in place of its texts: ids as little-endian unsigned 32-bit
    numbers, special strings as plain text.

    Null and empty texts have no ids, rows that repeat are encoded each, an empty table
    stays empty, and other columns pass through, but for one that is called ``_ids``.
    """
    return _replaced(docs, text, "_ids", lambda: lambda t: codec(path).encode(t or "").astype("<u4").tobytes())


def decode(tokens: DataFrame, path: str, ids: str = "_ids") -> DataFrame:
    """``tokens`` with ``_bytes`` in place of the ids that :func:`encode` gives; the bytes
    are those of the text, also where a token ends inside a character. Null ids and none
    have no bytes; other columns pass through, but for one that is called ``_bytes``."""
    return _replaced(tokens, ids, "_bytes", lambda: lambda b: codec(path).decode(np.frombuffer(b or b"", "<u4")))
