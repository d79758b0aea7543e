"""Words and shingles of a text as 64-bit hashes, and the exact comparison of two sets."""

from __future__ import annotations

import numpy as np


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finalizer (splitmix64)."""
    x = x.copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_P = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_P, -1, 1 << 64)


#: Powers that are kept for each base, up to this many.
KEPT_POWERS = 1 << 21
_POWERS: dict[int, np.ndarray] = {}


def _powers(n: int, base: int) -> np.ndarray:
    kept = _POWERS.get(base)
    if kept is not None and n <= len(kept):
        return kept[:n]
    out = np.full(max(n, min(2 * n, KEPT_POWERS)), np.uint64(base), np.uint64)
    out[:1] = 1
    with np.errstate(over="ignore"):
        out = np.multiply.accumulate(out)
    if len(out) <= KEPT_POWERS:
        _POWERS[base] = out
    return out[:n]


def word_hashes(text: str | None) -> np.ndarray:
    """One 64-bit hash per word of the ASCII lower-cased text, in order."""
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass").lower(), np.uint8)
    if not len(raw):
        return np.zeros(0, np.uint64)
    inside = ~((raw == 0x20) | ((raw >= 0x09) & (raw <= 0x0D)))
    edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(start):
        return np.zeros(0, np.uint64)
    # polynomial over the bytes of a word; sums of the whole text, so powers are undone by the inverse
    with np.errstate(over="ignore"):
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(_BYTE[raw] * _powers(len(raw), _P), out=sums[1:])
        undo = _powers(len(raw), _INVERSE)
        return mix((sums[end] - sums[start]) * undo[start] + (end - start).astype(np.uint64))


def shingle_set(words: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct shingles; fewer words than ``width`` are one shingle."""
    if not len(words):
        return words
    with np.errstate(over="ignore"):
        n = max(1, len(words) - width + 1)
        h = np.full(n, np.uint64(min(len(words), width)), np.uint64)
        for j in range(min(len(words), width)):
            h = mix(h * np.uint64(0x100000001B3) + words[j : j + n])
    return np.unique(h)


def _intersections(a: np.ndarray, b: np.ndarray) -> int:
    return len(np.intersect1d(a, b, assume_unique=True))


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Exact: 100 |A n B| >= percent |A u B|."""
    small, large = sorted((len(a), len(b)))
    if not small or 100 * small < percent * large:
        return False
    both = _intersections(a, b)
    return 100 * both >= percent * (len(a) + len(b) - both)
