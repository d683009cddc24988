"""Suffix array of a few short strings by Lyndon grouping; for tasks.

Every suffix has a longest Lyndon prefix, which ends where the next smaller suffix of its
string begins.  Suffixes with the same one form a group, and the groups are in the order of
these words.  Inside a group, suffixes are in the order of what follows the word, that is of
their next smaller suffixes, which stand in front of them.  So one walk over the array in
ascending order completes it: the suffix met at a place sends those that point to it to the
heads of their groups.  No names are assigned anew and nothing recurses.
"""

from __future__ import annotations

from collections import Counter
from itertools import accumulate


def lyndon_words(text: bytes) -> tuple[list[int], list[bytes]]:
    """Per place, where its longest Lyndon prefix ends (the next smaller suffix), and that word.

    From right to left; a word absorbs the word after it while it is the smaller one, so
    each word is absorbed once.  The places left open are the previous-smaller chain.
    """
    n = len(text)
    end = [0] * n
    words = [text] * n
    for i in range(n - 1, -1, -1):
        j = i + 1
        word = text[i:j]
        while j < n and word < words[j]:
            j = end[j]
            word = text[i:j]
        end[i] = j
        words[i] = word
    return end, words


def _ordered(texts: list[bytes]) -> list[int]:
    """All suffixes in order, by their places in the texts put one after the other.

    Every text has one place more, of its empty suffix, which is not in the result.
    """
    words: list[bytes] = []
    first: list[int] = []  # per place, one place whose next smaller suffix it is
    after: list[int] = []  # per place, the next one with the same next smaller suffix
    for text in texts:
        base = len(first)
        end, found = lyndon_words(text)
        words += found
        words.append(b"")
        first += [-1] * (len(text) + 1)
        for i, j in enumerate(end, base):
            after.append(first[base + j])
            first[base + j] = i
        after.append(-1)
    # The empty words are the lowest group, so they keep the places in front.
    sizes = Counter(words)
    ranked = sorted(sizes)
    rank = dict(zip(ranked, range(len(ranked)), strict=True))
    group = [rank[word] for word in words]
    head = [0, *accumulate(sizes[word] for word in ranked)]
    order = [0] * len(words)
    at = -1
    for k, text in enumerate(texts):
        at += len(text) + 1
        order[k] = at
    for r in range(len(order)):
        i = first[order[r]]
        while i >= 0:
            g = group[i]
            order[head[g]] = i
            head[g] += 1
            i = after[i]
    return order[len(texts) :]


def suffix_array(texts: list[bytes]) -> list[tuple[int, int]]:
    """All suffixes of all strings in order, as (string, place); equal ones by string."""
    places = [(k, i) for k, text in enumerate(texts) for i in range(len(text) + 1)]
    return [places[p] for p in _ordered(texts)]


def prefix_intervals(texts: list[bytes], length: int) -> list[list[tuple[int, int]]]:
    """Intervals of the suffix array with a common prefix of ``length`` bytes or more."""
    # A shorter suffix never stands inside an interval.
    places: list[tuple[int, int] | None] = []
    for k, text in enumerate(texts):
        whole = max(0, len(text) - length + 1)
        places += [(k, i) for i in range(whole)]
        places += [None] * (len(text) + 1 - whole)
    found: list[list[tuple[int, int]]] = []
    last = None
    for p in _ordered(texts):
        place = places[p]
        if place is None:
            continue
        k, i = place
        window = texts[k][i : i + length]
        if window == last:
            found[-1].append(place)
        else:
            found.append([place])
            last = window
    return found
