"""Compact blocks of 64-bit values for shuffles: byte planes under zstd."""

from __future__ import annotations

import numpy as np
import zstandard

U = np.uint64


def planes(a: np.ndarray) -> bytes:
    """Integers as byte planes; planes that hardly vary take next to no room."""
    a = np.ascontiguousarray(a)
    raw = a.view(np.uint8).reshape(len(a), a.dtype.itemsize) if len(a) else np.empty((0, a.dtype.itemsize), np.uint8)
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(raw.T).tobytes())


def unplanes(blob: bytes, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    return np.ascontiguousarray(raw.reshape(size, -1).T).reshape(-1).view(dtype) if len(raw) else np.empty(0, dtype)


def pack_sorted(a: np.ndarray) -> bytes:
    """Ascending unsigned 64-bit integers as gaps."""
    return planes(np.diff(a, prepend=U(0)))


def unpack_sorted(blob: bytes) -> np.ndarray:
    return np.cumsum(unplanes(blob, U), dtype=U)


def mix(z: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser."""
    z = (z ^ (z >> U(30))) * U(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> U(27))) * U(0x94D049BB133111EB)
    return z ^ (z >> U(31))


def runs(sorted_values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of each run of equal values."""
    n = len(sorted_values)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    start = np.flatnonzero(np.concatenate(([True], sorted_values[1:] != sorted_values[:-1])))
    return start, np.diff(np.append(start, n))


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest member of the connected component of each of n nodes, by hooking and pointer jumping."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while not np.array_equal(label[label], label):
            label = label[label]
        open_ = label[a] != label[b]
        a, b = a[open_], b[open_]
    return label
