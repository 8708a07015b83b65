"""Words of many texts at once: where they stand, and a 64-bit hash of each."""

from __future__ import annotations

import numpy as np

from .common import mix

#: Two bases, for hashes that are independent of each other, and their inverses modulo 2 ** 64.
BASES = (0x9E3779B97F4A7C15 | 1, 0xD1342543DE82EF95 | 1)
_powers: dict[int, np.ndarray] = {}

#: A-Z as a-z, every other byte as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def byte_set(*parts: tuple[int, int] | int) -> np.ndarray:
    """Which of the 256 bytes are in one of the (first, last) ranges."""
    out = np.zeros(256, bool)
    for p in parts:
        first, last = p if isinstance(p, tuple) else (p, p)
        out[first : last + 1] = True
    return out


#: Bytes of words that white space ends: all but space, tab, line ends, vertical tab and form feed.
SPACED = ~byte_set(0x20, (0x09, 0x0D))
#: Bytes of words of letters and digits; what isn't ASCII counts as a letter.
LETTERS = byte_set((48, 57), (65, 90), (97, 122), (128, 255))


def powers(n: int, which: int = 0) -> np.ndarray:
    """The first n powers of a base and of its inverse, modulo 2 ** 64."""
    if which not in _powers or _powers[which].shape[1] < n:
        steps = np.empty((2, max(n, 1 << 16)), np.uint64)
        steps[:, 0], steps[0, 1:], steps[1, 1:] = 1, BASES[which], pow(BASES[which], -1, 1 << 64)
        _powers[which] = np.cumprod(steps, axis=1)
    return _powers[which][:, :n]


def sums(raw: np.ndarray, lower: bool = False, which: int = 0) -> np.ndarray:
    """Running polynomial sums: n + 1 numbers, from which span_hashes takes any span's."""
    out = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(((LOWER[raw] if lower else raw).astype(np.uint64) + np.uint64(1)) * powers(len(raw) + 1, which)[0, : len(raw)], out=out[1:])
    return out


def span_hashes(running: np.ndarray, start: np.ndarray, end: np.ndarray, which: int = 0) -> np.ndarray:
    return mix((running[end] - running[start]) * powers(len(running), which)[1][start])


def word_spans(raw: np.ndarray, off: np.ndarray, of_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte, byte after the last, and text of each word; no word goes
    from one text into the next."""
    inside = of_word[raw]
    before, after = np.zeros(len(raw), bool), np.zeros(len(raw), bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    edges = off[1:-1]
    before[edges[edges < len(raw)]] = False
    after[edges[edges > 0] - 1] = False
    start, end = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    return start, end, np.searchsorted(off, start, "right") - 1
