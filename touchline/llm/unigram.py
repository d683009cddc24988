"""Token counts of a unigram vocabulary without writing tokens (op 10).

A text is segmented so that the sum of its pieces' scores is largest.  Only the number of
pieces is asked for, so the dynamic program carries two numbers per position, best score and
piece count, and no back pointers.  Matches of the vocabulary come from one Aho-Corasick
pass.  Tie rules are those of the ``tokenizers`` library's unigram model: positions are
relaxed from left to right, a later candidate replaces an earlier one only if its score is
strictly larger, so of equal scores the longest last piece stays; a character that no
one-character piece covers gets an unknown piece at the lowest score minus ten; neighbouring
unknown pieces are one, which counts as its UTF-8 bytes where the vocabulary falls back to
bytes and as one piece otherwise.  Scores are summed in doubles, as there.

White space becomes the metaspace sign, one in front of the text.  Where no piece of the
vocabulary holds that sign after another character, the best segmentation of a text is the
best one of each stretch that begins with such signs, because no piece crosses a border and
sums compare alike on either side.  Stretches repeat, so each is solved once per Python
worker, in a bounded memory, and those of many texts are solved together: one Aho-Corasick
pass over all of them, then one step of the dynamic program per position for all at once.
A vocabulary with crossing pieces is refused.  The score sums must be exact for this; the
given vocabulary's scores are whole numbers.

The public vocabulary is the pieces and scores of a sentencepiece file, read as a unigram
model.

Edge cases: null and empty texts have no tokens; any text length is one pass; other
columns are not read; repeated rows give repeated results.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterable, Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import text_of

SPACE = "▁"
UNKNOWN_PENALTY = 10.0
# A stretch: metaspace signs, then anything up to the next one.
_STRETCH = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
REMEMBERED = 200_000
_LONGEST_TOGETHER = 64  # longer stretches are solved alone and not remembered
_CHARS = 1 << 20  # of the texts that are counted together
_SOLVED = 1 << 15  # stretches that are solved together


class CountingViterbi:
    """Piece counts of best segmentations under one vocabulary."""

    def __init__(self, scores: dict[str, float], byte_fallback: bool = True):
        if any(SPACE in piece.lstrip(SPACE) for piece in scores):
            raise ValueError("a piece crosses the border of two words")
        if SPACE not in scores:
            raise ValueError("the metaspace sign is no piece, so unknown runs cross borders")
        self._automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for number, piece in enumerate(scores):
            if len(piece) > 1:  # single characters need no search
                self._automaton.add_word(piece, number)
        self._matches = [(len(piece), score) for piece, score in scores.items()]
        self._automaton.make_automaton()
        self._lengths = np.array([len(piece) for piece in scores])
        self._scores = np.array(list(scores.values()), float)
        used = set().union(*scores)
        self._border = next(c for c in map(chr, range(0x110000)) if c not in used)
        self._single = {p: score for p, score in scores.items() if len(p) == 1}
        self._single_scores = np.full(0x110000, -np.inf)
        self._single_scores[list(map(ord, self._single))] = list(self._single.values())
        self._unknown = min(scores.values()) - UNKNOWN_PENALTY
        self._bytes = byte_fallback
        self._known: dict[str, int] = {}

    def _solve(self, text: str) -> int:
        """Pieces of the best segmentation of one stretch.

        Candidates for an end position are compared from the earliest start on, which is
        the order in which a left-to-right relaxation meets them.
        """
        unknown, single = self._unknown, self._single
        best = [0.0] * (len(text) + 1)
        count = [0] * (len(text) + 1)
        # Whether the best segmentation up to here ends in an unknown piece.
        open_run = [False] * (len(text) + 1)
        matches: dict[int, list[tuple[int, float]]] = {}
        for end, match in self._found(text):
            matches.setdefault(end + 1, []).append(self._matches[match])
        for end in range(1, len(text) + 1):
            top, pieces, is_unknown = None, 0, False
            for length, score in sorted(matches.get(end, ()), reverse=True):
                start = end - length
                candidate = score + best[start]
                if top is None or candidate > top:
                    top, pieces = candidate, count[start] + 1
            letter = text[end - 1]
            if letter in single:
                candidate = single[letter] + best[end - 1]
                if top is None or candidate > top:
                    top, pieces = candidate, count[end - 1] + 1
            else:
                candidate = unknown + best[end - 1]
                if top is None or candidate > top:
                    top, is_unknown = candidate, True
                    if self._bytes:
                        pieces = count[end - 1] + len(letter.encode())
                    else:
                        pieces = count[end - 1] + (0 if open_run[end - 1] else 1)
            best[end], count[end], open_run[end] = top, pieces, is_unknown
        return count[-1]

    def _found(self, text: str) -> Iterable[tuple[int, int]]:
        """(last place, number) of the pieces of two characters or more in a text."""
        return self._automaton.iter(text) if len(self._automaton) else ()

    def _solve_together(self, stretches: list[str]) -> np.ndarray:
        """Pieces of the best segmentation of each of many short stretches, as ``_solve`` has it.

        All stretches stand in one text with borders that no piece holds.  The automaton gives
        matches by their end, and those of one end from the longest on; each step takes one
        match of every stretch that has one there.
        """
        joined = self._border.join(stretches)
        sizes = np.array([len(s) for s in stretches])
        starts = np.concatenate([[0], np.cumsum(sizes[:-1] + 1)])
        found = chain.from_iterable(self._found(joined))
        ends, pieces = np.fromiter(found, "i8").reshape(-1, 2).T
        word = np.repeat(np.arange(len(stretches)), sizes + 1)[ends]
        place, length = ends - starts[word] + 1, self._lengths[pieces]
        at = np.arange(len(ends))
        turn = at - np.maximum.accumulate(np.where(np.diff(ends, prepend=-1) != 0, at, 0))
        key = (place * (turn.max(initial=0) + 1) + turn).astype("u2")
        order = np.argsort(key, kind="stable")
        word, length, score, key = word[order], length[order], self._scores[pieces[order]], key[order]
        place = place[order]
        cuts = np.flatnonzero(np.diff(key.astype("i8"), prepend=-1))
        steps: dict[int, list[slice]] = {}
        for low, high in zip(cuts, [*cuts[1:], len(key)], strict=False):
            steps.setdefault(int(place[low]), []).append(slice(low, high))

        longest = int(sizes.max())
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "u4")
        width = 1 + (points >= 0x80).astype("i8") + (points >= 0x800) + (points >= 0x10000)
        best = np.zeros((longest + 1, len(stretches)))
        count = np.zeros((longest + 1, len(stretches)), "i8")
        open_run = np.zeros(len(stretches), bool)
        for p in range(1, longest + 1):
            top, number = np.full(len(stretches), -np.inf), np.zeros(len(stretches), "i8")
            for step in steps.get(p, ()):
                w, start = word[step], p - length[step]
                candidate = score[step] + best[start, w]
                better = candidate > top[w]
                w, start = w[better], start[better]
                top[w] = candidate[better]
                number[w] = count[start, w] + 1
            inside = np.flatnonzero(sizes >= p)
            letter = starts[inside] + p - 1
            single = self._single_scores[points[letter]]
            candidate = single + best[p - 1, inside]
            better = candidate > top[inside]
            w = inside[better]
            top[w] = candidate[better]
            number[w] = count[p - 1, w] + 1
            strange = np.isneginf(single)
            w, letter = inside[strange], letter[strange]
            candidate = self._unknown + best[p - 1, w]
            better = candidate > top[w]
            w, letter = w[better], letter[better]
            top[w] = candidate[better]
            more = width[letter] if self._bytes else 1 - open_run[w].astype("i8")
            number[w] = count[p - 1, w] + more
            open_run[:] = False
            open_run[w] = True
            best[p], count[p] = top, number
        return count[sizes, np.arange(len(stretches))]

    def _learn(self, stretches: set[str]) -> dict[str, int]:
        """Piece counts of all of the stretches; short ones are remembered."""
        known = self._known
        missing = [s for s in stretches if s not in known]
        if len(known) + len(missing) > REMEMBERED:
            known.clear()
            missing = list(stretches)
        solved = {s: self._solve(s) for s in missing if len(s) > _LONGEST_TOGETHER}
        short = sorted((s for s in missing if len(s) <= _LONGEST_TOGETHER), key=len)
        for k in range(0, len(short), _SOLVED):
            part = short[k : k + _SOLVED]
            known.update(zip(part, self._solve_together(part).tolist(), strict=True))
        return {**known, **solved} if solved else known

    def counts(self, texts: Iterable[str]) -> list[int]:
        """Pieces of each of many whole texts."""
        totals: list[int] = []
        waiting: list[tuple[int, list[str]]] = []
        held = 0

        def settle() -> None:
            pieces = self._learn(set().union(*(s for _, s in waiting)))
            for k, stretches in waiting:
                totals[k] += sum(map(pieces.__getitem__, stretches))
            waiting.clear()

        for k, text in enumerate(texts):
            totals.append(0)
            for part in _slices(SPACE + text.replace(" ", SPACE)) if text else ():
                waiting.append((k, _STRETCH.findall(part)))
                held += len(part)
                if held > _CHARS:
                    settle()
                    held = 0
        if waiting:
            settle()
        return totals

    def count(self, text: str) -> int:
        """Pieces of a whole text."""
        return self.counts([text])[0]


def _slices(marked: str) -> Iterator[str]:
    """A long text in slices that begin where stretches do."""
    at = 0
    while len(marked) - at > _CHARS:
        cut = at + _CHARS
        while cut < len(marked) and not (marked[cut] == SPACE and marked[cut - 1] != SPACE):
            found = marked.find(SPACE, cut + 1)
            cut = len(marked) if found < 0 else found
        yield marked[at:cut]
        at = cut
    if at < len(marked):
        yield marked[at:]


def vocabulary(model_file: str) -> dict[str, float]:
    """Pieces and scores of a sentencepiece file, without control, unknown and byte pieces."""
    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    return {
        model.id_to_piece(i): model.get_score(i)
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
    }


@functools.lru_cache(maxsize=2)
def _counter(model_file: str) -> CountingViterbi:
    return CountingViterbi(vocabulary(model_file))


def token_counts(
    docs: DataFrame, model_file: str, text: str = "text", id_column: str = "doc_id"
) -> DataFrame:
    """Per text: doc_id, n_chars, n_tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(model_file)
        for batch in batches:
            texts = batch.column(1)
            counts = counter.counts(value.as_py() for value in texts)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pc.utf8_length(texts).cast(pa.int64()),
                    pa.array(counts, pa.int64()),
                ],
                ["doc_id", "n_chars", "n_tokens"],
            )

    return docs.select(
        F.col(id_column).cast("long").alias("doc_id"), text_of(text).alias("text")
    ).mapInArrow(run, "doc_id long, n_chars long, n_tokens long")
