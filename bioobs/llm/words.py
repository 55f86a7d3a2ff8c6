"""Words of a text and their hashes, for whole texts at once.

Words are runs of bytes other than space and 0x09-0x0D. A word hashes to the sum
of byte * B^j over its bytes modulo 2^64, taken from one prefix array, then mixed
with its length.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
BASE = 0xD6E8FEB86659FD93


def mixed(values: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit."""
    x = values + U((salt * 0x9E3779B97F4A7C15) & (2**64 - 1))
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


class _Powers:
    """B^j and B^-j modulo 2^64, grown when a longer text appears."""

    up = down = np.ones(1, np.uint64)

    @classmethod
    def grow(cls, n: int) -> None:
        while len(cls.up) < n:
            size = len(cls.up)
            cls.up = np.concatenate([cls.up, cls.up * U(pow(BASE, size, 2**64))])
            cls.down = np.concatenate([cls.down, cls.down * U(pow(BASE, -size, 2**64))])


def is_space(raw: np.ndarray) -> np.ndarray:
    """Space and 0x09-0x0D; what is below 9 wraps around to large numbers."""
    return (raw == 32) | (raw - np.uint8(9) < 5)


def word_bounds(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words, in bytes."""
    space = np.ones(len(raw) + 2, bool)
    space[1:-1] = is_space(raw)
    edges = np.flatnonzero(space[1:] != space[:-1])
    return edges[::2], edges[1::2]


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    _Powers.grow(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(raw * _Powers.up[: len(raw)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * _Powers.down[starts] + (ends - starts).astype(np.uint64))


def tail_hashes(raw: np.ndarray, ends: np.ndarray, size: int) -> np.ndarray:
    """``span_hashes`` of the ``size`` bytes before each end, for a few bytes."""
    sums = np.full(len(ends), size, np.uint64)
    for k in range(size):
        sums += raw.take(ends - (size - k)) * U(pow(BASE, k, 2**64))
    return mixed(sums)


def word_hashes(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8)
    return span_hashes(raw, *word_bounds(raw))


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all windows of ``size`` words."""
    count = max(0, len(hashes) - size + 1)
    rolled = np.full(count, size, np.uint64)
    for k in range(size):
        rolled = rolled * U(BASE) + hashes[k : k + count]
    return mixed(rolled)
