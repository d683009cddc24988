"""Spelling variants by a dictionary of trie-node pairs (op 11).

1. Words are counted with plain SQL functions.  A run is damaged by rule in one of 31 cases, so
   that the table holds variants; words of at least ``MIN_LENGTH`` code points that occur
   ``MIN_TIMES`` times or more go on.
2. The nodes of the forward trie and of the trie of reversed words are numbered
   (``tries.trie_nodes``).  A word of length L has prefix nodes P(0..L) and suffix nodes
   S(0..L), S(i) being reached by what follows the first i code points; roots are 0.
3. Each word enters the dictionary under the integer pairs (P(i), S(i+1)) that skip its i-th
   code point, and (P(i), S(i)) between two of them.  Words that meet with a skip each differ
   by one replaced code point; a word that skips and one that does not differ by one inserted
   code point.  Nodes are exact, so no pair needs a check.  In a run of equal code points only
   the last may be skipped for an insertion, so no pair of words is found twice.
4. The words under one pair are near each other as a whole.  A pair fixes all but one code
   point, so it holds at most as many skipping words as the alphabet has letters (90) and one
   that does not skip: short lists, however common the words are.  Each gives its members the
   number of near words and the best one; sums and maxima per word finish the search.
5. Forms are followed to their last by pointer doubling.  Each step multiplies n by ten, so the
   chains are short.

Edge cases: null and empty texts have no words; a null id counts as the empty text in front of
the colon; repeated rows count as often as they occur; words of any length are taken whole, at
a cost in proportion to their length; an empty table gives no rows; other columns are not
read.  Ties of n go to the word that is smaller in code-point order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.tries import trie_nodes
from touchline.scratch import spill

RUN = "[A-Za-z\\u00C0-\\u00FF]"
MIN_LENGTH = 7
MIN_TIMES = 2
FORM_FACTOR = 10
DAMAGE = 31
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
GAP, SKIP, LAST_SKIP = 0, 1, 2  # how a word enters under a pair


def _damaged(run: Column, doc_id: Column, every: int) -> Column:
    """The run without one code point, where its checksum says so."""
    check = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run))
    at = F.pmod(check, F.length(run)).cast("int")
    shorter = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    return F.when(F.pmod(check, F.lit(every)) == 0, shorter).otherwise(run)


def word_counts(
    docs: DataFrame,
    text: str = "text",
    id_column: str = "doc_id",
    min_length: int = MIN_LENGTH,
    min_times: int = MIN_TIMES,
    damage: int = DAMAGE,
) -> DataFrame:
    """(word, n) of the whole texts."""
    runs = F.regexp_extract_all(
        F.col(text).cast("string"), F.lit(f"{RUN}{{{min_length},}}"), F.lit(0)
    )
    run = F.col("run")
    lowered = F.when(run.rlike("[A-Z]"), F.translate(run, _UPPER, _UPPER.lower())).otherwise(run)
    return (
        docs.select(F.col(id_column).alias("id"), F.explode(runs).alias("run"))
        .select("id", lowered.alias("run"))
        .select(_damaged(run, F.col("id"), damage).alias("word"))
        .filter(F.length("word") >= min_length)
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") >= min_times)
    )


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(prefix, suffix, id, n, kind): every word under each of its pairs."""
    names = ["prefix", "suffix", "id", "n", "kind"]
    for batch in batches:
        parts: list[list[np.ndarray]] = []
        held = 0
        ids, counts, words = (batch.column(k).to_pylist() for k in (0, 1, 2))
        for k, word in enumerate(words):
            before = np.concatenate([[0], batch.column(3)[k].values.to_numpy()])
            after = np.concatenate([[0], batch.column(4)[k].values.to_numpy()])[::-1]
            points = np.frombuffer(word.encode("utf-32-le"), "u4")
            last = np.append(points[1:] != points[:-1], True)
            kinds = np.concatenate([np.where(last, LAST_SKIP, SKIP), np.full(len(before), GAP)])
            parts.append(
                [
                    np.concatenate([before[:-1], before]),
                    np.concatenate([after[1:], after]),
                    np.full(len(kinds), ids[k]),
                    np.full(len(kinds), counts[k]),
                    kinds,
                ]
            )
            held += len(kinds)
            if held > 1 << 18 or k == len(words) - 1:
                columns = [pa.array(np.concatenate(c).astype("i8")) for c in zip(*parts)]
                yield pa.RecordBatch.from_arrays(columns, names)
                parts, held = [], 0


def near_words(words: DataFrame) -> DataFrame:
    """(id, word, n, n_near, best_n, best) of distinct ``words`` (word, n).

    ``id`` is the place in code-point order; ``best`` the id of the near word of largest n.
    """
    forward = spill(
        trie_nodes(words.select("word", F.col("n").alias("tag")), "forward").select(
            F.col("rank").alias("id"), "word", F.col("tag").alias("n"), F.col("nodes").alias("before")
        ),
        "spelling-words",
    )
    turned = trie_nodes(
        forward.select(F.reverse("word").alias("word"), F.col("id").alias("tag")), "reversed"
    ).select(F.col("tag").alias("turned"), F.col("nodes").alias("after"))
    entries = (
        forward.join(turned, F.col("id") == F.col("turned"))
        .select("id", "n", "word", "before", "after")
        .mapInArrow(_entries, "prefix long, suffix long, id long, n long, kind long")
    )
    lists = (
        entries.groupBy("prefix", "suffix")
        .agg(F.collect_list(F.struct("id", "n", "kind")).alias("members"))
        .filter(F.size("members") > 1)
    )

    def near(x: Column, m: Column) -> Column:
        skips = (x["kind"] != GAP) & (m["kind"] != GAP)
        inserted = (x["kind"] + m["kind"] == LAST_SKIP) & (x["kind"] != m["kind"])
        return (x["id"] != m["id"]) & (skips | inserted)

    def outcome(m: Column) -> Column:
        others = F.filter("members", lambda x: near(x, m))
        best = F.array_max(F.transform(others, lambda x: F.struct(x["n"].alias("n"), (-x["id"]).alias("id"))))
        return F.struct(m["id"].alias("found"), F.size(others).alias("near"), best.alias("best"))

    found = (
        lists.select(F.inline(F.transform("members", outcome)))
        .filter("near > 0")
        .groupBy("found")
        .agg(F.sum("near").alias("n_near"), F.max("best").alias("best"))
    )
    return forward.join(found, F.col("id") == F.col("found"), "left").select(
        "id",
        "word",
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.col("best")["n"].alias("best_n"),
        (-F.col("best")["id"]).alias("best"),
    )


def last_forms(forms: DataFrame) -> DataFrame:
    """(id, root) of (id, form): the end of each chain, by pointer doubling."""
    ends = spill(forms.select("id", F.col("form").alias("root")), "spelling-roots")
    while True:
        beyond = ends.select(F.col("id").alias("__at"), F.col("root").alias("__next"))
        moved = spill(
            ends.join(beyond, F.col("root") == F.col("__at"), "left").select(
                "id", F.coalesce("__next", "root").alias("root"), F.col("__at").isNotNull().alias("moved")
            ),
            "spelling-roots",
        )
        ends = moved.select("id", "root")
        if moved.filter("moved").isEmpty():
            return ends


def spelling_groups(
    docs: DataFrame,
    text: str = "text",
    id_column: str = "doc_id",
    min_length: int = MIN_LENGTH,
    min_times: int = MIN_TIMES,
    factor: int = FORM_FACTOR,
    damage: int = DAMAGE,
) -> DataFrame:
    """Per word: word, form, root, n, n_near, form_n."""
    counted = word_counts(docs, text, id_column, min_length, min_times, damage)
    found = spill(near_words(spill(counted, "spelling-counts")), "spelling-near")
    forms = found.filter(F.col("best_n") >= factor * F.col("n")).select(
        "id", F.col("best").alias("form"), F.col("best_n").alias("form_n")
    )
    forms = spill(forms, "spelling-forms")
    ends = last_forms(forms)
    spelt = found.select(F.col("id").alias("__of"), F.col("word").alias("__word"))
    chosen = (
        forms.join(ends, "id")
        .join(spelt, F.col("form") == F.col("__of"))
        .select("id", "form_n", "root", F.col("__word").alias("form"))
        .join(spelt, F.col("root") == F.col("__of"))
        .select(F.col("id").alias("__id"), "form", "form_n", F.col("__word").alias("root"))
    )
    return found.join(chosen, F.col("id") == F.col("__id"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
