"""Helpers shared by the operators: text buffers, word hashes and folds.

Text reaches Python as Arrow batches. A batch is worked on as one byte buffer with
numpy, in slices of bounded size, so memory follows the slice and not the table.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Words: runs of characters that are neither space nor \t \n \v \f \r.
WORD = "[^\\x20\\x09-\\x0D]+"
SLICE_BYTES = 4 << 20
SMALL_SLICE = 1 << 20  # where a byte of text takes many times as much
BATCH_BYTES = 32 << 20
U64 = np.uint64

_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_BYTE_VALUE = np.random.default_rng(20_11).integers(1, 1 << 63, 256, dtype=np.uint64) | U64(1)
_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
_STEP = U64(0x9E3779B97F4A7C15)


def prepare(spark: SparkSession) -> SparkSession:
    """Arrow batches small in rows and in bytes, as texts may be very long; and Python workers that find this
    package where the driver did (a cluster may ship it in any other way as well)."""
    known = spark.sparkContext.environment
    paths = known.get("PYTHONPATH", "").split(os.pathsep)
    if _ROOT not in paths:
        known["PYTHONPATH"] = os.pathsep.join([_ROOT, *filter(None, paths)])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/documents.parquet")


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text modulo ``folds``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (a bijection)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def text_buffer(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the n + 1 offsets of its rows; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, at, data = column.buffers()
    offsets = np.frombuffer(at, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(
    batches: Iterator[pa.RecordBatch], text: str = "text", size: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Batches cut so that each holds about ``size`` bytes of text, or one text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = text_buffer(batch.column(text))
        start = 0
        while start < batch.num_rows:
            stop = int(np.searchsorted(offsets, offsets[start] + size, "right")) - 1
            stop = min(max(stop, start + 1), batch.num_rows)
            yield batch.slice(start, stop - start)
            start = stop


def word_spans(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and past-the-end byte of every word, and words per row."""
    inside = ~_SEPARATOR[buf]
    first = np.zeros(len(buf) + 1, bool)
    first[offsets] = True
    before = np.empty(len(buf), bool)
    if len(buf):
        before[0] = False
        before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | first[:-1]))
    after = np.zeros(len(buf), bool)
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | first[1:])) + 1
    counts = np.diff(np.searchsorted(starts, offsets))
    return starts, ends, counts


_kept_powers: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the step from the first on, and of its inverse from the zeroth on, n at
    least; those of a small slice are kept."""
    if _kept_powers and n <= len(_kept_powers[0]):
        return _kept_powers[0], _kept_powers[1]
    size = max(n, SMALL_SLICE)
    step = int(_STEP) | 1
    powers = np.cumprod(np.full(size, step, np.uint64))
    inverse = np.full(size, pow(step, -1, 1 << 64), np.uint64)
    inverse[0] = 1
    inverse = np.cumprod(inverse)
    if size == SMALL_SLICE:
        _kept_powers[:] = powers, inverse
    return powers, inverse


def span_hashes(
    buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, values: np.ndarray = _BYTE_VALUE
) -> np.ndarray:
    """64-bit hashes of spans that follow one another and are not empty; ``values`` has
    an odd random number for each thing in ``buf``."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    powers, inverse = _powers(len(buf))
    # Sums of things by powers of their place; the difference between the ends of a span,
    # times the inverse power of its start, is its polynomial (modulo 2^64).
    sums = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(values[buf] * powers[: len(buf)], out=sums[1:])
    sums = (sums[ends] - sums[starts]) * inverse[starts]
    return mix(sums ^ mix(lengths.astype(np.uint64)))


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of every row, A-Z lower-cased, and words per row."""
    buf, offsets = text_buffer(column)
    buf = _LOWER[buf]
    starts, ends, counts = word_spans(buf, offsets)
    return span_hashes(buf, starts, ends), counts


def n_shards(spark: SparkSession, rows: int, per_shard: int) -> int:
    """Shards so that each holds about ``per_shard`` rows; at least one per core slot."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // per_shard))
