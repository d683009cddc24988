"""Word shingles of one text as 64-bit hashes, in numpy; helpers for tasks."""

from __future__ import annotations

import numpy as np

WIDTH = 5
_PIECE = 1 << 20

_rng = np.random.default_rng(7)
_BYTE_VALUE = _rng.integers(1, 1 << 63, 256, dtype="u8")
_lower = np.arange(256)
_lower[65:91] += 32
_BYTE_VALUE = _BYTE_VALUE[_lower]
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C15 | 1
_ORDER = [np.uint64(x) for x in _rng.integers(1, 1 << 63, WIDTH, dtype="u8") | np.uint64(1)]


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, "u8")
    out[0] = 1
    return np.multiply.accumulate(out)


_POWERS = _powers(_BASE, 1 << 16)
_INVERSE = _powers(pow(_BASE, -1, 1 << 64), 1 << 16)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hashes_of_piece(raw: np.ndarray) -> np.ndarray:
    """Hashes of the words of a piece that begins and ends at word borders."""
    global _POWERS, _INVERSE
    n = len(raw)
    if n > len(_POWERS):
        _POWERS, _INVERSE = _powers(_BASE, 2 * n), _powers(pow(_BASE, -1, 1 << 64), 2 * n)
    blank = _BLANK[raw]
    edge = np.flatnonzero(np.diff(blank.view("i1"), prepend=1, append=1))
    start, end = edge[::2], edge[1::2]
    sums = np.zeros(n + 1, "u8")
    np.cumsum(_BYTE_VALUE[raw] * _POWERS[:n], out=sums[1:])
    words = (sums[end] - sums[start]) * _INVERSE[start]
    return mix(words + (end - start).astype("u8"))


def word_hashes(text: bytes) -> np.ndarray:
    """One hash per word, A-Z lower-cased; long texts piece by piece, cut at white space."""
    raw = np.frombuffer(text, "u1")
    if len(raw) <= _PIECE:
        return _hashes_of_piece(raw)
    parts, at = [], 0
    while at < len(raw):
        stop = at + _PIECE
        while stop < len(raw):
            gap = np.flatnonzero(_BLANK[raw[stop : stop + _PIECE]])
            if len(gap):
                stop += int(gap[0])
                break
            stop += _PIECE
        parts.append(_hashes_of_piece(raw[at:stop]))
        at = stop
    return np.concatenate(parts)


def shingle_set(text: bytes, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct hashes of all windows of ``width`` words; a shorter text is one window."""
    words = word_hashes(text)
    n = len(words) - width + 1
    if not len(words):
        return words
    if n < 1:
        total = np.uint64(len(words)) + sum(
            (words[k : k + 1] * _ORDER[k] for k in range(len(words))), np.zeros(1, "u8")
        )
        return mix(total)
    total = np.zeros(n, "u8")
    for k in range(width):
        total += words[k : k + n] * _ORDER[k]
    return np.unique(mix(total))


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether 100 * intersection >= percent * union, for sorted distinct arrays."""
    small, large = sorted((len(a), len(b)))
    if 100 * small < percent * large:
        return False
    at = np.searchsorted(a, b)
    at[at == len(a)] = 0
    shared = int((a[at] == b).sum())
    return 100 * shared >= percent * (len(a) + len(b) - shared)
