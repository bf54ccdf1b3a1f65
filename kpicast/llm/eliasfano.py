"""Elias-Fano sequences: non-decreasing numbers in about 2 + log2(universe / n) bits each.

Low bits are side by side in the smallest unsigned type that holds them, so that one takes
a single read; where a bit or two less fit a smaller type, the high bits take them. High
bits are a unary bit vector with counts of zeros and of ones before every word. All
look-ups take arrays of places or values.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
_ONE = U(1)
_B01, _B0F, _B33, _B55, _B80 = (U(int(f"{x:02x}" * 8, 16)) for x in (0x01, 0x0F, 0x33, 0x55, 0x80))


def _places_in_bytes() -> np.ndarray:
    """Place of the r-th set bit of every byte, at byte * 8 + r."""
    out = np.zeros((256, 8), np.uint8)
    for byte in range(256):
        bits = [k for k in range(8) if byte >> k & 1]
        out[byte, : len(bits)] = bits
    return out.ravel()


_IN_BYTE = _places_in_bytes()


def _select(words: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Place of the set bit of that rank in every word: sums of set bits up to every
    byte side by side, the byte by comparing all of them at once, then a table."""
    rank = rank.astype(np.uint64)
    sums = words - ((words >> U(1)) & _B55)
    sums = (sums & _B33) + ((sums >> U(2)) & _B33)
    sums = ((sums + (sums >> U(4))) & _B0F) * _B01
    before = np.bitwise_count(((rank * _B01 | _B80) - sums) & _B80).astype(np.uint64) << U(3)
    before = np.minimum(before, U(56))
    rank -= ((sums << U(8)) >> before) & U(0xFF)
    inside = _IN_BYTE[(((words >> before) & U(0xFF)) << U(3) | (rank & U(7))).astype(np.int64)]
    return before.astype(np.int64) + inside


class EliasFano:
    """``low``, ``high``, ``zeros`` and ``ones`` are what is stored; plain or memory-mapped."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, zeros: np.ndarray, ones: np.ndarray):
        self.n, self.low_bits = n, low_bits
        self.low, self.high, self.zeros, self.ones = low, high, zeros, ones

    @classmethod
    def build(cls, values: np.ndarray) -> EliasFano:
        values = values.astype(np.uint64)
        n = len(values)
        universe = int(values[-1]) + 1 if n else 1
        bits = max(0, (universe // max(n, 1)).bit_length() - 1)
        bits = next((k for k in (8, 16, 32) if k < bits <= k + 2), bits)
        kind = next(k for k in (np.uint8, np.uint16, np.uint32, np.uint64) if bits <= 8 * np.dtype(k).itemsize)
        low = (values & U((1 << bits) - 1)).astype(kind) if bits else np.zeros(0, kind)
        place = (values >> U(bits)).astype(np.int64) + np.arange(n)
        high = np.zeros(((int(place[-1]) if n else 0) + 2 + 63) // 64 + 1, np.uint64)
        np.bitwise_or.at(high, place >> 6, _ONE << (place & 63).astype(np.uint64))
        ones = np.concatenate([[0], np.cumsum(np.bitwise_count(high).astype(np.int64))])
        zeros = np.arange(len(high) + 1) * 64 - ones
        kind = np.int32 if 64 * len(high) < 1 << 31 else np.int64
        return cls(n, bits, low, high, zeros.astype(kind), ones.astype(kind))

    def _low(self, at: np.ndarray) -> np.ndarray:
        return self.low[at] if self.low_bits else np.zeros(len(at), np.uint8)

    def _zero(self, k: np.ndarray) -> np.ndarray:
        """Place of the k-th zero; past the last one the number of bits."""
        word = np.searchsorted(self.zeros, k.astype(self.zeros.dtype), "right") - 1
        inside = word < len(self.high)
        word = np.minimum(word, len(self.high) - 1)
        place = 64 * word + _select(~self.high[word], k - self.zeros[word])
        return np.where(inside, place, 64 * len(self.high))

    def _ones_from(self, bit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of set bits in a row from each place on as far as its word goes, and
        where the word ends before they do."""
        shift = bit & 63
        rest = ~(self.high[bit >> 6] >> shift.astype(np.uint64))
        run = np.bitwise_count((rest & (~rest + _ONE)) - _ONE).astype(np.int64)
        return run, np.flatnonzero(run + shift >= 64)

    def _one(self, at: np.ndarray) -> np.ndarray:
        """Place of the set bit of that number."""
        word = np.searchsorted(self.ones, at.astype(self.ones.dtype), "right") - 1
        return 64 * word + _select(self.high[word], at - self.ones[word])

    def _value(self, at: np.ndarray, place: np.ndarray) -> np.ndarray:
        return ((place - at).astype(np.uint64) << U(self.low_bits)) | self._low(at)

    def get(self, at: np.ndarray) -> np.ndarray:
        """Values at places (0 <= at < n)."""
        return self._value(at, self._one(at))

    def pair(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values at places and at the places after them."""
        place = self._one(at)
        after = place + 1
        word = self.high[after >> 6] >> (after & 63).astype(np.uint64)
        far = np.flatnonzero(word == 0)  # mostly in the same word
        after += np.bitwise_count((word & (~word + _ONE)) - _ONE)
        after[far] = self._one(at[far] + 1)
        return self._value(at, place), self._value(at + 1, after)

    def find(self, values: np.ndarray, begin: np.ndarray | int = 0, end: np.ndarray | int | None = None):
        """Places of values in [begin, end), the first of equal ones, and whether they are
        there at all. What is before ``begin`` must not be greater than the value sought.
        The high bits give a short range, searched by low bits: mostly its first tells."""
        values = values.astype(np.uint64, copy=False)
        end = self.n if end is None else end
        want_high = (values >> U(self.low_bits)).astype(np.int64)
        want = (values & U((1 << self.low_bits) - 1)).astype(self.low.dtype)
        # Numbers past the last high part: no element can be there.
        top = int(self.zeros[-1])
        capped = np.minimum(want_high, top)
        place = np.maximum(np.where(capped > 0, self._zero(np.maximum(capped - 1, 0)) + 1 - capped, 0), begin)
        # The last bit of all is padding.
        bit = np.minimum(place + capped, 64 * len(self.high) - 1)
        some = self.high[bit >> 6] >> (bit & 63).astype(np.uint64) & _ONE
        todo = np.flatnonzero((some != 0) & (place < end) & (want_high <= top))
        first = self._low(place[todo])
        equal = np.zeros(len(values), bool)
        equal[todo] = first == want[todo]
        todo = todo[first < want[todo]]
        if not len(todo):
            return place, equal
        left, sought = place[todo] + 1, want[todo]
        run, far = self._ones_from(bit[todo])
        right = left + run - 1
        right[far] = self._zero(capped[todo[far]]) - capped[todo[far]]
        limit = right = np.minimum(right, end if np.isscalar(end) else end[todo])
        rest, low = np.flatnonzero(left < right), left.copy()
        left, right, own = left[rest], right[rest], sought[rest]
        while len(rest):
            mid = (left + right) >> 1
            less = self._low(mid) < own
            left, right = np.where(less, mid + 1, left), np.where(less, right, mid)
            low[rest] = left
            more = np.flatnonzero(left < right)
            rest, left, right, own = rest[more], left[more], right[more], own[more]
        place[todo] = low
        may = np.flatnonzero(low < limit)
        equal[todo[may]] = self._low(low[may]) == sought[may]
        return place, equal
