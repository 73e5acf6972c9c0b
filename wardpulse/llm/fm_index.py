"""FM-index of a word sequence: wavelet matrix over the Burrows-Wheeler order.

Suffixes are sorted by their first ``depth`` words, which is all that backward
search for patterns of up to ``depth`` words needs.  The wavelet matrix keeps
one packed bit vector a level with a count per 64 bits; all queries of a call
advance together.
"""

from __future__ import annotations

import numpy as np

_ONE = np.uint64(1)


class Bits:
    """Bit vector with rank: packed words and the set bits before each."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.words = np.zeros(len(bits) // 64 + 1, np.uint64)
        self.words.view(np.uint8)[:len(packed)] = packed
        self.before = np.zeros(len(self.words), np.int32)
        np.cumsum(np.bitwise_count(self.words[:-1]), out=self.before[1:])
        self.ones = int(bits.sum())
        self.zeros = len(bits) - self.ones

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Set bits among the first ``i``."""
        w = i >> 6
        below = (_ONE << (i & 63).astype(np.uint64)) - _ONE
        return self.before[w] + np.bitwise_count(self.words[w] & below)


class WaveletMatrix:
    def __init__(self, symbols: np.ndarray, sigma: int):
        self.levels, seq = [], symbols
        self.shifts = range(max(1, (sigma - 1).bit_length()) - 1, -1, -1)
        for s in self.shifts:
            bit = ((seq >> s) & 1).astype(np.uint8)
            self.levels.append(Bits(bit))
            seq = np.concatenate([seq[bit == 0], seq[bit == 1]])

    def ranks(self, c: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Occurrences of ``c`` before ``lo`` and before ``hi``."""
        base = np.zeros(len(c), np.int64)
        for s, bits in zip(self.shifts, self.levels):
            one = ((c >> s) & 1).astype(bool)
            r = bits.rank(np.concatenate([base, lo, hi])).astype(np.int64).reshape(3, -1)
            at = np.stack([base, lo, hi])
            base, lo, hi = np.where(one, bits.zeros + r, at - r)
        return lo - base, hi - base


def _classes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Ranks of the pairs (a, b)."""
    return np.unique(a * (int(b.max()) + 1) + b, return_inverse=True)[1].reshape(-1)


def _ahead(r: np.ndarray, k: int) -> np.ndarray:
    out = np.zeros_like(r)
    out[:len(r) - k] = r[k:]
    return out


class FMIndex:
    """Over ``text``, an int64 array of word ids; 0 is the separator."""

    def __init__(self, text: np.ndarray, depth: int):
        self.depth = depth
        n = len(text)
        order, short = self._prefix_ranks(text, depth)
        self.sa = np.argsort(order, kind="stable")
        sigma = int(text.max()) + 1
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=sigma))])
        self.bwt = WaveletMatrix(text[self.sa - 1], sigma)  # the suffix at 0 wraps around
        self.full_lo, self.full_hi, self.full_group = self._groups(order[self.sa])
        self.short_lo, self.short_hi, _ = self._groups(short[self.sa])

    @staticmethod
    def _prefix_ranks(text: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """Ranks of all suffixes by their first ``depth`` and ``depth - 1`` words."""
        powers, size = {1: text}, 1
        while size * 2 <= depth:
            powers[size * 2] = _classes(powers[size], _ahead(powers[size], size))
            size *= 2

        def upto(d: int) -> np.ndarray:
            out, done = None, 0
            for p in sorted(powers, reverse=True):
                if d - done >= p:
                    part = _ahead(powers[p], done) if done else powers[p]
                    out, done = part if out is None else _classes(out, part), done + p
            return out

        return upto(depth), upto(depth - 1)

    @staticmethod
    def _groups(ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        new = np.concatenate([[True], ranks[1:] != ranks[:-1]])
        starts = np.flatnonzero(new)
        group = np.cumsum(new) - 1
        return starts[group], np.append(starts[1:], len(ranks))[group], group

    def extend(self, c: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Interval of ``c`` before the pattern of each interval."""
        a, b = self.bwt.ranks(c, lo, hi)
        return self.first[c] + a, self.first[c] + b

    def drop_last(self, lo: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Interval of the first ``depth - 1`` words of a full-depth match."""
        return self.short_lo[lo], self.short_hi[lo]

    def windows(self, text: np.ndarray, first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Stream stretches through the index, right to left: for ``count``
        windows of ``depth`` words from ``first`` on, give (window start, lowest
        suffix of its interval; -1 where it does not occur)."""
        order = np.argsort(-count, kind="stable")
        first, count = first[order], count[order]
        at = first + count + self.depth - 2  # last word of the last window
        lo = np.zeros(len(first), np.int64)
        hi = np.full(len(first), len(self.sa), np.int64)
        length = np.zeros(len(first), np.int64)
        starts, found = [], []
        while len(first):
            full = length == self.depth
            if full.any():
                lo[full], hi[full] = self.drop_last(lo[full])
                length[full] -= 1
            lo, hi = self.extend(text[at], lo, hi)
            length += 1
            lost = hi <= lo
            if lost.any():  # the word ends every match: start again before it
                lo[lost], hi[lost], length[lost] = 0, len(self.sa), 0
            done = length == self.depth
            starts.append(at[done])
            found.append(lo[done])
            at -= 1
            keep = at >= first
            if not keep.all():
                first, at, lo, hi, length = (x[keep] for x in (first, at, lo, hi, length))
        return np.concatenate(starts), np.concatenate(found)
