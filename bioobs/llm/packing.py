"""Columns of integers in few bytes, for what tasks send each other."""

from __future__ import annotations

import numpy as np
import zstandard


def packed(values: np.ndarray) -> bytes:
    """Non-negative integers, as narrow as the largest allows, compressed byte by byte of the numbers."""
    most = int(values.max()) if len(values) else 0
    size = 2 if most < 1 << 16 else 4 if most < 1 << 32 else 8
    planes = np.ascontiguousarray(values.astype(f"u{size}").view(np.uint8).reshape(-1, size).T)
    return bytes([size]) + zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[1:]), np.uint8).reshape(data[0], -1)
    return np.ascontiguousarray(planes.T).view(f"u{data[0]}").ravel()
