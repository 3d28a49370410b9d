"""Words of UTF-8 buffers as numpy arrays, for tasks."""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15 | 1          # odd, so it has an inverse modulo 2^64
_INVERSE = pow(_BASE, -1, 1 << 64)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_powers: dict[int, np.ndarray] = {}

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

# Which bytes are part of a word, after lower-casing A-Z.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[9, 10, 11, 12, 13, 32]] = False
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True


def powers(n: int, base: int) -> np.ndarray:
    """1, base, base^2, ... modulo 2^64; n of them at least."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, 1 << 16), base, np.uint64)
        steps[0] = 1
        have = _powers[base] = np.cumprod(steps, dtype=np.uint64)
    return have


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _MIX
    return h ^ (h >> np.uint64(29))


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """S with S[j] - S[i] = hash of data[i:j] times base^i."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(len(data), _BASE)[:len(data)], out=out[1:])
    return out


def range_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of data[start:end]; equal bytes have equal hashes."""
    return mix((prefix[end] - prefix[start]) * powers(len(prefix), _INVERSE)[start])


def find_words(data: np.ndarray, offsets: np.ndarray, part: np.ndarray):
    """(start, end, row) of every maximal run of ``part`` bytes in a row."""
    n = len(data)
    if not n:
        return (np.zeros(0, np.int64),) * 3
    inside = part[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:n]
    last[:-1] &= ~inside[1:] | edge[1:n]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, end, np.searchsorted(offsets, start, side="right") - 1
