"""Numbers for the nodes of a trie over a table of distinct words.

The words are sorted across slices.  In sorted order a word shares its first nodes with the
word before it, as many as their common prefix has code points, and opens a new node for
every further one.  So each slice numbers its nodes in one pass that remembers one word.
Across slices only the last word of each slice matters: these are gathered, one row per
slice, and chained; a word of a later slice takes the nodes of the prefix that it shares with
the word chained before its slice, and all its others are moved beyond the numbers that
earlier slices used.  Nodes are thus equal exactly where prefixes are, without any hashing,
and nothing but the node numbers is held per word: memory and time follow the length of the
words, also for words of any length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.scratch import spill

_FLUSH = 1 << 20  # node numbers held before a batch goes out


def common_prefix(a: str, b: str) -> int:
    """Number of leading code points that two words share."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


class _Rows:
    """Output rows with one array of node numbers each, sent in bounded batches."""

    def __init__(self, names: list[str]) -> None:
        self.names = names
        self.clear()

    def clear(self) -> None:
        self.plain: list[tuple] = []
        self.nodes: list[np.ndarray] = []
        self.held = 0

    def add(self, plain: tuple, nodes: np.ndarray) -> bool:
        self.plain.append(plain)
        self.nodes.append(nodes)
        self.held += len(nodes) + 1
        return self.held > _FLUSH

    def batch(self) -> pa.RecordBatch:
        ends = np.cumsum([0, *map(len, self.nodes)]).astype("i4")
        values = np.concatenate(self.nodes) if self.nodes else np.empty(0, "i8")
        columns = [pa.array(c) for c in zip(*self.plain, strict=True)]
        columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(values.astype("i8"))))
        self.clear()
        return pa.RecordBatch.from_arrays(columns, self.names)


def _sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted words of one slice with their place and the nodes inside the slice, from 1."""
    rows = _Rows(["word", "tag", "slice", "place", "used", "nodes"])
    before, chain, used, place = "", np.empty(0, "i8"), 0, 0
    for batch in batches:
        for word, tag, number in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            shared = common_prefix(before, word)
            fresh = np.arange(used + 1, used + 1 + len(word) - shared, dtype="i8")
            chain = np.concatenate([chain[:shared], fresh])
            used += len(fresh)
            if rows.add((word, tag, number, place, used), chain):
                yield rows.batch()
            before, place = word, place + 1
    if rows.plain:
        yield rows.batch()


def trie_nodes(words: DataFrame, label: str) -> DataFrame:
    """(word, tag, rank, nodes) of the distinct ``words`` (word, tag).

    ``rank`` is the word's place in code-point order, from 0; ``nodes[k]`` the number, from 1,
    of the trie node that its first k + 1 code points lead to.  Words are not null.
    """
    ordered = (
        words.select("word", F.col("tag").cast("long").alias("tag"))
        .repartitionByRange("word")
        .sortWithinPartitions("word")
        .withColumn("slice", F.spark_partition_id().cast("long"))
    )
    inside = spill(
        ordered.mapInArrow(
            _sliced, "word string, tag long, slice long, place long, used long, nodes array<long>"
        ),
        f"trie-{label}",
    )
    last = (  # one row per slice
        inside.groupBy("slice")
        .agg(F.max_by(F.struct("word", "nodes", "used", "place"), "place").alias("last"))
        .orderBy("slice")
        .collect()
    )
    entered: dict[int, tuple[str, np.ndarray, int, int]] = {}
    word, chain, used, rank = "", np.empty(0, "i8"), 0, 0
    for row in last:
        entered[row["slice"]] = (word, chain, used, rank)
        end = row["last"]
        shared = common_prefix(word, end["word"])
        own = np.asarray(end["nodes"], "i8")
        chain = np.concatenate([chain[:shared], own[shared:] + used])
        word, used, rank = end["word"], used + end["used"], rank + end["place"] + 1

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = _Rows(["word", "tag", "rank", "nodes"])
        for batch in batches:
            text, tag, number, place = (batch.column(k).to_pylist() for k in range(4))
            for k, nodes in enumerate(batch.column(4)):
                word, chain, used, rank = entered[number[k]]
                shared = common_prefix(word, text[k])
                own = nodes.values.to_numpy()
                own = np.concatenate([chain[:shared], own[shared:] + used])
                if rows.add((text[k], tag[k], rank + place[k]), own):
                    yield rows.batch()
        if rows.plain:
            yield rows.batch()

    return inside.select("word", "tag", "slice", "place", "nodes").mapInArrow(
        across, "word string, tag long, rank long, nodes array<long>"
    )
