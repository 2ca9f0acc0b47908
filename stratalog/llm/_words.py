"""Words of UTF-8 texts as hash vectors, shared by the operators that look at word sequences."""

from __future__ import annotations

from itertools import chain

import numpy as np
from xxhash import xxh3_64_intdigest

#: Odd multipliers of the two rolling hashes and of the finaliser (fixed values).
ROLL_A = np.uint64(0x9E3779B97F4A7C15)
ROLL_B = np.uint64(0xC2B2AE3D27D4EB4F)
MIX_1 = np.uint64(0xFF51AFD7ED558CCD)
MIX_2 = np.uint64(0xC4CEB9FE1A85EC53)
SHIFT = np.uint64(33)


def mix(x: np.ndarray) -> np.ndarray:
    """Avalanche of 64-bit values."""
    x = x ^ (x >> SHIFT)
    x *= MIX_1
    x ^= x >> SHIFT
    x *= MIX_2
    x ^= x >> SHIFT
    return x


def split_words(texts: list[bytes | None], lower: bool = False) -> list[list[bytes]]:
    """Maximal runs of bytes other than 0x20 and 0x09-0x0D: just what bytes.split() cuts at."""
    if lower:
        return [t.lower().split() if t else [] for t in texts]
    return [t.split() if t else [] for t in texts]


def hash_words(words: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """All word hashes in a row, and where each text's words begin (one more entry than texts)."""
    ends = np.zeros(len(words) + 1, np.int64)
    np.cumsum([len(w) for w in words], out=ends[1:])
    return np.fromiter(map(xxh3_64_intdigest, chain.from_iterable(words)), np.uint64, int(ends[-1])), ends


def rolling(h: np.ndarray, k: int, multiplier: np.uint64) -> np.ndarray:
    """Hash of each k neighbours, len(h) - k + 1 of them."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = h[:n].copy()
    for j in range(1, k):
        out *= multiplier
        out += h[j : j + n]
    return mix(out)


def window_starts(ends: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions where a window of k words of one text begins, and each one's text."""
    sizes = np.diff(ends)
    counts = np.maximum(sizes - k + 1, 0)
    owner = np.repeat(np.arange(len(sizes)), counts)
    first = np.cumsum(counts) - counts
    starts = np.arange(len(owner)) - first[owner] + ends[:-1][owner]
    return starts, owner
