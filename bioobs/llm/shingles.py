"""Word shingles as 64-bit hashes, and parity sketches over them.

A sketch has blocks; a shingle belongs to the block its top bits name and XORs a
64-bit word into it. A shingle in only one of two sets changes exactly one block,
so the number of blocks that differ is at most the symmetric difference.
"""

from __future__ import annotations

import numpy as np

from bioobs.llm.words import U, mixed, window_hashes, word_hashes

WORDS = 5
LEAST_SKETCH_BITS = 256


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of the shingles of five words, A-Z lower-cased.

    Fewer words make one shingle of them all; no words make none. ``bytes.lower``
    knows ASCII only, which is just what the contract asks.
    """
    hashes = word_hashes((text or "").encode().lower())
    if not len(hashes):
        return hashes
    found = window_hashes(hashes, min(WORDS, len(hashes)))
    found.sort()
    return found[np.concatenate([[True], found[1:] != found[:-1]])]


def differences(size: int, grid: int) -> int:
    """Largest symmetric difference with any set that is 75 % like one of this size and meets it in a grid.

    The difference of like sets is at most a seventh of their sizes' sum, and the
    other set has at most 4/3 of this size and fits the grid.
    """
    return (size + min(4 * size // 3, (4 << 2 * grid) - 1)) // 7


def block_count(grid: int) -> int:
    """The sketch for sets of 4^grid to 4^(grid + 1) shingles has more blocks than they have shingles."""
    return 1 << (2 * grid + (3 if grid >= 3 else 6))


def grids_of(size: int) -> list[int]:
    """The size band of a set, and the next one if sets from there can be like this one."""
    own = (size.bit_length() - 1) // 2
    return [own, own + 1] if 4 * size >= 3 * (4 << 2 * own) else [own]


def sketch_keys(values: np.ndarray, grid: int, plain: bool) -> np.ndarray:
    """A 64-bit key for each block that is not empty: grid, block and content.

    With ``plain`` every shingle is a block of its own.
    """
    if plain:
        words = mixed(values, 1)
    else:
        shift = U(64 - (block_count(grid).bit_length() - 1))
        block = values >> shift
        starts = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
        words = np.bitwise_xor.reduceat(mixed(values, 1), starts) ^ mixed(block[starts], 2)
    return mixed(words, 3 + grid)


def chosen_keys(keys: np.ndarray, wanted: int, common: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """Pigeonhole: of two like sets at most ``differences`` blocks differ, so the first
    ``differences + 1`` (``wanted``) keys of each, in an order all sets share, meet in one.

    ``common`` (sorted) lists frequent keys, ``levels`` how frequent; they come last.
    """
    if len(common):
        at = np.minimum(np.searchsorted(common, keys), len(common) - 1)
        level = np.where(common[at] == keys, levels[at], 0)
        return keys[np.lexsort((keys, level))[:wanted]]
    return np.sort(keys)[:wanted]


def bit_sketch(values: np.ndarray) -> bytes:
    """One bit per value flipped in a sketch of two to four bits per value, a power of two long."""
    bits = max(LEAST_SKETCH_BITS, 2 << max(len(values), 1).bit_length())
    flips = np.bincount((mixed(values, 7) & U(bits - 1)).astype(np.intp), minlength=bits)
    return np.packbits((flips & 1).astype(bool)).tobytes()


def folded(sketch: np.ndarray, length: int) -> np.ndarray:
    """Sketches (rows of bytes) as they would be with fewer bits."""
    while sketch.shape[-1] > length:
        half = sketch.shape[-1] // 2
        sketch = sketch[..., :half] ^ sketch[..., half:]
    return sketch


def slack(size: int, sketch: np.ndarray, sizes: np.ndarray, sketches: np.ndarray) -> np.ndarray:
    """How far several sets are from being ruled out as 75 % like one set, negative if they are.

    Sizes must fit, and the bits that differ, never more than the symmetric difference,
    may be a seventh of the sizes' sum. 1 is no bit that differs.
    """
    length = min(sketch.shape[-1], sketches.shape[-1])
    apart = np.bitwise_count(folded(sketches, length) ^ folded(sketch, length)).sum(axis=-1, dtype=np.int64)
    low, high = np.minimum(sizes, size), np.maximum(sizes, size)
    return np.where((4 * low >= 3 * high) & (7 * apart <= low + high), 1 - 7 * apart / (low + high), -1.0)


def may_link(size: int, sketch: np.ndarray, sizes: np.ndarray, sketches: np.ndarray) -> np.ndarray:
    """Which of several sets can be 75 % like one set."""
    return slack(size, sketch, sizes, sketches) >= 0


def linked(one: np.ndarray, other: np.ndarray) -> bool:
    """100 * intersection >= 75 * union, for sorted distinct values."""
    small, large = sorted((one, other), key=len)
    if not len(small) or 4 * len(small) < 3 * len(large):
        return False
    both = np.concatenate([one, other])
    both.sort(kind="stable")
    shared = int(np.count_nonzero(both[1:] == both[:-1]))
    return 100 * shared >= 75 * (len(one) + len(other) - shared)
