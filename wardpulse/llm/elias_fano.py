"""Elias-Fano code of a non-decreasing integer sequence, as bytes.

Value i keeps its ``low`` lowest bits in a packed array; its upper bits are a
set bit at ``(v >> low) + i`` of a bit vector.  ``2 + log2(universe / n)`` bits
a value; every SAMPLE-th set bit's place is stored, so ``at(i)`` (a select)
reads one stretch of the vector.
"""

from __future__ import annotations

import struct

import numpy as np

SAMPLE = 256
_HEAD = "<QQBxxxxxxxQQ"


def pack(values: np.ndarray) -> bytes:
    """``values``: non-decreasing, not negative, below 2**63."""
    v = np.asarray(values, np.uint64)
    n = len(v)
    top = int(v[-1]) if n else 0
    low = max(0, (top // n).bit_length() - 1) if n else 0
    lows = (v[:, None] >> np.arange(low, dtype=np.uint64)) & np.uint64(1)
    low_bytes = np.packbits(lows.astype(np.uint8).ravel(), bitorder="little")
    at = (v >> np.uint64(low)).astype(np.int64) + np.arange(n)
    bits = np.zeros((int(at[-1]) + 1 if n else 0), np.uint8)
    bits[at] = 1
    high = np.packbits(bits, bitorder="little")
    return b"".join((struct.pack(_HEAD, n, top, low, len(low_bytes), len(high)), low_bytes.tobytes(),
                     high.tobytes(), at[::SAMPLE].astype("<u8").tobytes()))


class EliasFano:
    def __init__(self, data: bytes | memoryview):
        self.n, self.top, self.low, n_low, n_high = struct.unpack_from(_HEAD, data)
        a = struct.calcsize(_HEAD)
        self._lows = np.frombuffer(data, np.uint8, n_low, a)
        self._high = np.frombuffer(data, np.uint8, n_high, a + n_low)
        self._samples = np.frombuffer(data, "<u8", -(-self.n // SAMPLE), a + n_low + n_high)

    def _low_bits(self, first: int, count: int) -> np.ndarray:
        if not self.low:
            return np.zeros(count, np.int64)
        start, end = first * self.low, (first + count) * self.low
        bits = np.unpackbits(self._lows[start // 8:-(-end // 8)], bitorder="little")
        bits = bits[start % 8:start % 8 + count * self.low].reshape(count, self.low)
        return bits.astype(np.int64) @ (np.int64(1) << np.arange(self.low, dtype=np.int64))

    def at(self, i: int) -> int:
        """Value ``i``: walk from the sampled set bit before it."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        place, left = int(self._samples[i // SAMPLE]), i % SAMPLE
        byte, skip = place // 8, place % 8
        while True:
            stretch = np.unpackbits(self._high[byte:byte + 64], bitorder="little")
            found = np.flatnonzero(stretch[skip:])
            if left < len(found):
                upper = byte * 8 + skip + int(found[left]) - i
                return (upper << self.low) | int(self._low_bits(i, 1)[0])
            left -= len(found)
            byte, skip = byte + 64, 0

    def all(self) -> np.ndarray:
        upper = np.flatnonzero(np.unpackbits(self._high, bitorder="little"))[:self.n] \
            - np.arange(self.n)
        return (upper.astype(np.int64) << self.low) | self._low_bits(0, self.n)
