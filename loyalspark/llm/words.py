"""Words of whole texts as hashes, for all texts of an Arrow slice at once.

A word is a run of ``[0-9a-z]`` and characters from U+0080 on, after A-Z have
been lower-cased; that is ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` byte by byte
in UTF-8, as every byte of a longer character is 0x80 or more.
"""

from __future__ import annotations

import numpy as np

from .common import mix

_BASE = 0x9E3779B97F4A7C15 | 1
_INV = pow(_BASE, -1, 1 << 64)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[65:91] = _WORD[97:123] = _WORD[128:] = True
_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x632BE59BD9B4E019))[LOWER]

_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        have = np.full(size, np.uint64(base), np.uint64)
        have[0] = 1
        have = np.cumprod(have, dtype=np.uint64)
        if size <= 1 << 22:
            _powers[base] = have
    return have[:n]


def prefix_sums(values: np.ndarray) -> np.ndarray:
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(_BASE, len(values)), dtype=np.uint64, out=out[1:])
    return out


def words(raw: np.ndarray, offsets: np.ndarray):
    """(starts, ends, first): byte ranges of all words in order; text i has
    the words ``first[i]`` up to ``first[i + 1]``. No word spans two texts."""
    n = len(raw)
    inside = _WORD[raw]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | edge[1:n]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | edge[1:n]
    s = np.flatnonzero(starts)
    e = np.flatnonzero(ends) + 1
    return s, e, np.searchsorted(s, offsets)


def word_hashes(raw: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    total = prefix_sums(_VALUE[raw])
    return mix((total[e] - total[s]) * powers(_INV, len(raw) + 1)[s])


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every ``size`` consecutive words (by position of the first);
    the caller masks windows that run over the end of a text."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out *= np.uint64(0xD6E8FEB86659FD93)
        out += hashes[k: k + n]
    return mix(out)


def text_of(raw: np.ndarray, s: np.ndarray, e: np.ndarray, lo: int, hi: int) -> bytes:
    """Lower-cased words lo..hi joined by one space: what a window's hash
    stands for, to verify a hit."""
    return b" ".join(LOWER[raw[a:b]].tobytes() for a, b in zip(s[lo:hi], e[lo:hi]))
