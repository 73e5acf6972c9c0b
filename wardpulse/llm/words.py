"""Word and window hashes for tasks (numpy, one document at a time).

Words are the runs of bytes that are not ASCII white space; ``bytes.split()``
cuts exactly at ``[\\x20\\x09-\\x0D]``.
"""

from __future__ import annotations

import numpy as np
import xxhash

_A = np.uint64(0x9E3779B97F4A7C15)
_B = np.uint64(0xD6E8FEB86659FD93)
_S32, _S29 = np.uint64(32), np.uint64(29)


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Ordered hash of two hashes."""
    x = a * _A + b
    x ^= x >> _S32
    x *= _B
    x ^= x >> _S29
    return x


def window_hashes(h: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` words, built by doubling."""
    n = len(h) - width + 1
    if n <= 0:
        return h[:0]
    out, done, block, size = None, 0, h, 1
    while True:
        if width & size:
            part = block[done:done + n]
            out = part.copy() if out is None else mix(out, part)
            done += size
        if done == width:
            return out
        block = mix(block[:-size], block[size:])
        size *= 2


def covered(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Mask of the ``n`` words that lie in a window starting at ``starts``."""
    d = np.zeros(n + 1, np.int64)
    np.add.at(d, starts, 1)
    np.add.at(d, np.minimum(starts + width, n), -1)
    return np.cumsum(d[:-1]) > 0
