"""Hashes of words and of runs of words, vectorised over the bytes of many texts.

A word is a run without space, tab or line ends (\\x20, \\x09-\\x0D). It has two hashes of 64 bits. A word of under 8
bytes is one integer (its bytes and its length), mixed: no two such words share either hash. Longer words take the
two halves of XXH3's 128 bits. A run's hash in a lane is a polynomial, of the lane's own root, in the words' hashes of
that lane, mixed.
"""

from __future__ import annotations

import numpy as np
import xxhash

from .packing import U, mix

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_ROOTS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_SALT = (0x8CB92BA72F3D8DD7, 0xD6E8FEB86659FD93)
#: What a word's first 8 bytes are masked with, by its length.
_MASK = np.array([(1 << 8 * n) - 1 for n in range(8)], U)


def _powers(root: int, n: int) -> np.ndarray:
    out = np.empty(n, U)
    out[0], k = 1, 1
    while k < n:
        m = min(n - k, k)
        out[k : k + m] = out[:m] * U(pow(root, k, 1 << 64))
        k += m
    return out


_KEPT: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _tables(lane: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the lane's root and of its inverse, at least size of them; the largest so far are kept."""
    if lane not in _KEPT or len(_KEPT[lane][0]) < size:
        root = _ROOTS[lane]
        _KEPT[lane] = _powers(root, size), _powers(pow(root, -1, 1 << 64), size)
    return _KEPT[lane]


def _size(n: int) -> int:
    return max(1 << 16, 1 << (n - 1).bit_length() if n > 1 else 1)


def _piece(data: bytes, lanes: int) -> tuple[np.ndarray, list[np.ndarray]]:
    a = np.frombuffer(data, np.uint8)
    space = np.empty(len(a) + 2, bool)
    space[0] = space[-1] = True
    space[1:-1] = _SPACE[a]
    edge = np.flatnonzero(space[1:] != space[:-1])
    start, end = edge[::2], edge[1::2]
    size = end - start
    eight = np.ndarray(len(data), np.dtype("<u8"), data + b"\0" * 8, 0, (1,))
    key = eight[start] & _MASK[np.minimum(size, 7)] | size.astype(U) << U(56)
    long = np.flatnonzero(size > 7)
    out = [mix(key * U(_ROOTS[i]) + U(_SALT[i])) for i in range(lanes)]
    if len(long):
        digest = xxhash.xxh3_128_digest
        both = np.frombuffer(b"".join([digest(data[x:y]) for x, y in zip(start[long].tolist(), end[long].tolist())]), U).reshape(-1, 2)
        for i in range(lanes):
            out[i][long] = both[:, i]
    return start, out


def hash_words(texts: list[bytes | None], lanes: int = 1, piece: int = 1 << 20) -> tuple[list[np.ndarray], np.ndarray]:
    """The hashes of all words of the texts, in order, in each lane, and the number of words of each text."""
    texts = [t or b"" for t in texts]
    data = b" ".join(texts)
    starts, hashes, at = [], [], 0
    while at < len(data):
        stop = min(len(data), at + piece)
        if stop < len(data):
            cut = max(data.rfind(c, at, stop) for c in (b" ", b"\n"))
            if cut <= at:  # a word longer than a piece
                cut = next((i for i in range(stop, len(data)) if data[i] in b" \t\n\v\f\r"), len(data))
            stop = cut + 1 if cut < len(data) else cut
        s, h = _piece(data[at:stop], lanes)
        starts.append(s + at)
        hashes.append(h)
        at = stop
    if not starts:
        return [np.empty(0, U)] * lanes, np.zeros(len(texts), np.int64)
    ends = np.cumsum([len(t) + 1 for t in texts])
    counts = np.diff(np.searchsorted(np.concatenate(starts), ends), prepend=0)
    return [np.concatenate([h[i] for h in hashes]) for i in range(lanes)], counts


def hash_runs(words: np.ndarray, n: int, lane: int = 0) -> np.ndarray:
    """The hash of each run of n words, by its first word, not minding where texts end."""
    if len(words) < n:
        return np.empty(0, U)
    power, inverse = _tables(lane, _size(len(words) + 1))
    sums = np.zeros(len(words) + 1, U)
    np.cumsum(words * power[: len(words)], out=sums[1:])
    return mix((sums[n:] - sums[:-n]) * inverse[: len(words) + 1 - n])
