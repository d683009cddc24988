"""Anchors: for every 100-byte string of a text, one short string inside it, in numpy.

The anchor of a string is the ``GRAM``-byte string in it with the smallest hash, the leftmost
of equals, so equal strings have equal anchors in equal places.  Neighbouring strings mostly
share one: a text of n bytes has about n / 35.  An anchor *owns* the run of string starts
that chose it; the bytes of these strings are its context.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np

from touchline.llm.shingles import mix

LENGTH = 100
GRAM = 32
PIECE = 1 << 16
_SPAN = LENGTH - GRAM + 1
_LOW = np.uint64((1 << 20) - 1)
_BASE = 0xD6E8FEB86659FD93
_VALUES = np.random.default_rng(13).integers(1, 1 << 63, 256, dtype="u8")


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base & ((1 << 64) - 1), "u8")
    out[0] = 1
    return np.multiply.accumulate(out)


_POWERS = _powers(_BASE, GRAM)


class Anchors(NamedTuple):
    text: np.ndarray  # number of the text in the batch
    place: np.ndarray  # of the anchor in its text
    left: np.ndarray  # first owned start is place - left
    owned: np.ndarray  # number of owned starts
    gram: np.ndarray  # hash of the anchor
    context: np.ndarray  # hash of the context and its shape


def _pieces(offsets: np.ndarray) -> Iterator[tuple[int, int, list[tuple[int, int, int]]]]:
    """(from, to, [(text, from, to)]) over a buffer: whole texts, or parts of a long one.

    Parts overlap by ``LENGTH - 1`` bytes, so every string lies in exactly one part.
    """
    group: list[tuple[int, int, int]] = []
    for text in range(len(offsets) - 1):
        start, end = int(offsets[text]), int(offsets[text + 1])
        if end - start < LENGTH:
            continue
        if group and end - group[0][1] > PIECE:
            yield group[0][1], group[-1][2], group
            group = []
        if end - start <= PIECE:
            group.append((text, start, end))
            continue
        for at in range(start, end - LENGTH + 1, PIECE - LENGTH + 1):
            stop = min(at + PIECE, end)
            yield at, stop, [(text, at, stop)]
    if group:
        yield group[0][1], group[-1][2], group


def _context(gram: np.ndarray, start: np.ndarray, end: np.ndarray, shape: np.ndarray) -> np.ndarray:
    """Hash of the shape and of the bytes from start to end, by grams that cover them."""
    out = mix(shape)
    for at in range(0, LENGTH + _SPAN - 1, GRAM):
        out = mix(out + gram[np.minimum(start + at, end - GRAM)])
    return out


def find(data: np.ndarray, offsets: np.ndarray) -> Iterator[Anchors]:
    """Anchors of the texts ``data[offsets[i]:offsets[i + 1]]``, some texts at a time."""
    # Passes over a piece go to and fro between buffers that stay in the processor's cache.
    buffers, numbers = np.empty((3, PIECE), "u8"), np.arange(PIECE, dtype="u8")
    for begin, stop, texts in _pieces(offsets):
        gram, other, low = buffers
        n, size = stop - begin, 1
        # The indices are bytes, so no mode changes them; this one needs no copy of the result.
        np.take(_VALUES, data[begin:stop], out=gram[:n], mode="clip")
        while size < GRAM:
            n -= size
            np.multiply(gram[:n], _POWERS[size], out=other[:n])
            other[:n] += gram[size : n + size]
            gram, other, size = other, gram, size * 2
        np.bitwise_and(gram[:n], ~_LOW, out=low[:n])
        low[:n] |= numbers[:n]
        size = 1
        while size * 2 <= _SPAN:
            n -= size
            np.minimum(low[:n], low[size : n + size], out=other[:n])
            low, other, size = other, low, size * 2
        n = stop - begin - LENGTH + 1
        np.minimum(low[:n], low[_SPAN - size : n + _SPAN - size], out=other[:n])
        starts = np.concatenate([np.arange(s - begin, e - begin - LENGTH + 1) for _, s, e in texts])
        # The place is part of what is compared, so strings of one anchor, and only they, agree.
        least = other[starts]
        first = np.concatenate([[0], np.flatnonzero(least[1:] != least[:-1]) + 1])
        owned = np.diff(first, append=len(least))
        lo, place = starts[first], (least[first] & _LOW).astype("i8")
        shape = ((place - lo) * 128 + owned).astype("u8")
        bounds = np.array([s - begin for _, s, _ in texts])
        number = np.searchsorted(bounds, lo, side="right") - 1
        text_start = np.array([offsets[t] for t, _, _ in texts], "i8")[number]
        yield Anchors(
            np.array([t for t, _, _ in texts])[number],
            place + begin - text_start,
            place - lo,
            owned,
            mix(gram[place]),
            _context(gram, lo, lo + owned + LENGTH - 1, shape),
        )
