"""Line deduplication by a suffix array over line ids (op 1).

The lines of all documents with at least one word, in order of id and place, are one
sequence of line ids; suffixes never cross documents.  The suffix array is built by prefix
doubling: round j orders suffixes by their first 2**j lines, from pairs of the last round's
ranks.  A suffix whose prefix is unique is settled and leaves, so a round handles only lines
in repeats at least that long, and rounds end with the longest repeat.

A run may be a single line: a line that stands alone between unlike lines, or is a document of
its own, is a later copy like any other; runs of two and more take the blank lines inside them.

Suffixes of equal rank in round j are the suffix array's intervals whose longest common
prefix is at least 2**j.  In each interval the first suffix in document order is the
original; at every other one a run of 2**j lines is a later copy.  Intervals from depth
``min_lines`` on count; for a ``min_lines`` that is no power of two that depth is put
together from two overlapping ranks.  Overlapping and touching copies merge into maximal
runs, which are deleted; blank lines inside a run go with it.

All in built-in functions.  Ranks are numbered by ranges of the distinct pairs, so no rank
group, however large, is in one task; minima and counts of groups are combined map-side.

Edge cases: null text is one blank line; a text of blank lines is kept as it is; a repeat
within one document loses its later copy; a null id sorts after all others; rows that agree
in id and text are one document; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from touchline.llm.common import text_of
from touchline.llm.ranks import ranked
from touchline.scratch import spill

MIN_LINES = 1
_LAST = "9223372036854775807"
_ID = ["doc", "copy"]


def _identity(id_column: str, whole: Column) -> dict[str, Column]:
    return {
        "doc": F.coalesce(F.col(id_column).cast("long"), F.lit(_LAST).cast("long")),
        "copy": F.xxhash64(whole),
    }


def sequences(docs: DataFrame, text: str, id_column: str) -> DataFrame:
    """doc, copy, seq (place among lines with words), at (place among all), k1, k2 (line key)."""
    whole = text_of(text)
    placed = F.filter(
        F.transform(F.split(whole, "\n"), lambda x, i: F.struct(i.alias("at"), x.alias("line"))),
        lambda s: s["line"].rlike("[^\\x20\\x09-\\x0D]"),
    )
    return docs.select(
        *(c.alias(n) for n, c in _identity(id_column, whole).items()),
        F.posexplode(placed).alias("seq", "one"),
    ).select(
        *_ID,
        "seq",
        F.col("one")["at"].alias("at"),
        F.xxhash64("one.line").alias("k1"),
        F.xxhash64(F.lit(7), "one.line").alias("k2"),
    )


def _place() -> Column:
    return F.struct("doc", "copy", "seq")


def _settled_out(rows: DataFrame, by: list[str], label: str) -> DataFrame:
    """Rows of keys that occur twice or more, with the key's rank and first place."""
    groups = (
        rows.groupBy(*by)
        .agg(F.count(F.lit(1)).alias("n"), F.min(_place()).alias("first"))
        .filter("n > 1")
        .drop("n")
    )
    groups = spill(ranked(groups, by, "new_rank"), label)
    return rows.join(groups, by).select(
        *_ID, "seq", "at", "end", F.col("new_rank").alias("rank"), (F.col("first") != _place()).alias("later")
    )


def _ahead(column: str, by: int) -> Column:
    """The value of the row ``by`` places on in the same document; null if it is not there."""
    return F.max(column).over(W.partitionBy(*_ID).orderBy("seq").rangeBetween(by, by))


def suffix_levels(lines: DataFrame) -> list[DataFrame]:
    """Per round j: doc, copy, seq, at, end, rank, later, of suffixes with repeated 2**j lines.

    ``end`` is the place of the prefix's last line, ``later`` whether the prefix occurs earlier.
    """
    level = spill(
        _settled_out(lines.withColumn("end", F.col("at")), ["k1", "k2"], "line-ranks"), "line-level"
    )
    levels, depth = [], 1
    while not level.isEmpty():
        levels.append(level)
        pairs = level.select(
            *_ID, "seq", "at", "rank", _ahead("rank", depth).alias("rank2"), _ahead("end", depth).alias("end")
        ).filter("rank2 is not null")
        level = spill(_settled_out(pairs, ["rank", "rank2"], "line-ranks"), "line-level")
        depth *= 2
    return levels


def later_copies(levels: list[DataFrame], min_lines: int) -> DataFrame | None:
    """doc, copy, at, end of runs that occur earlier, of at least ``min_lines`` lines."""
    base = min_lines.bit_length() - 1
    if len(levels) <= base:
        return None
    found = [level for j, level in enumerate(levels) if 1 << j >= min_lines]
    if 1 << base < min_lines:
        level, gap = levels[base], min_lines - (1 << base)
        pairs = level.select(
            *_ID, "seq", "at", "rank", _ahead("rank", gap).alias("rank2"), _ahead("end", gap).alias("end")
        ).filter("rank2 is not null")
        found.append(_settled_out(pairs, ["rank", "rank2"], "line-ranks"))
    copies = [x.filter("later").select(*_ID, "at", "end") for x in found]
    out = copies[0]
    for more in copies[1:]:
        out = out.unionByName(more)
    return out


def _runs(copies: DataFrame) -> DataFrame:
    """doc, copy, runs: sorted array of maximal (start, end), of touching copies."""
    order = W.partitionBy(*_ID).orderBy("at", "end")
    reach = F.max("end").over(order.rowsBetween(W.unboundedPreceding, -1))
    opens = (F.col("at") > F.coalesce(reach, F.lit(-2)) + 1).cast("int")
    numbered = copies.select(*_ID, "at", "end", opens.alias("opens"))
    numbered = numbered.withColumn("run", F.sum("opens").over(order.rowsBetween(W.unboundedPreceding, 0)))
    runs = numbered.groupBy(*_ID, "run").agg(F.min("at").alias("start"), F.max("end").alias("end"))
    return runs.groupBy(*_ID).agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("runs"))


def deduplicated_lines(
    docs: DataFrame, text: str = "text", id_column: str = "doc_id", min_lines: int = MIN_LINES
) -> DataFrame:
    """Per row: doc_id, text (what stays), n_lines, n_removed (with blank ones), n_runs."""
    lines = sequences(docs, text, id_column)
    copies = later_copies(suffix_levels(lines), min_lines)
    whole = text_of(text)
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        whole.alias("whole"),
        *(c.alias(n) for n, c in _identity(id_column, whole).items()),
    )
    if copies is None:
        none = F.array().cast("array<struct<start:int,end:int>>")
        rows = rows.withColumn("runs", none)
    else:
        runs = spill(_runs(copies), "line-runs").withColumnsRenamed({"doc": "__doc", "copy": "__copy"})
        # Texts move to their runs at every size alike.
        rows = rows.join(
            runs.hint("merge"), (F.col("doc") == F.col("__doc")) & (F.col("copy") == F.col("__copy")), "left"
        )
    rows = rows.select("doc_id", F.split("whole", "\n").alias("lines"), "runs")
    runs, n = F.coalesce("runs", F.array()), F.size("lines")
    # What stays lies between a run's end and the next run's start.
    starts = F.concat(F.array(F.lit(0)), F.transform(runs, lambda r: r["end"] + 1))
    ends = F.concat(F.transform(runs, lambda r: r["start"]), F.array(n))
    rows = rows.select(
        "doc_id",
        "lines",
        n.alias("n"),
        F.size(runs).alias("n_runs"),
        F.arrays_zip(starts.alias("s"), ends.alias("e")).alias("gaps"),
    )
    kept = F.flatten(
        F.transform("gaps", lambda g: F.slice(F.col("lines"), g["s"] + 1, g["e"] - g["s"]))
    )
    rows = rows.select("doc_id", "n", "n_runs", kept.alias("kept"))
    return rows.select(
        "doc_id",
        F.array_join("kept", "\n").alias("text"),
        F.col("n").cast("long").alias("n_lines"),
        (F.col("n") - F.size("kept")).cast("long").alias("n_removed"),
        F.col("n_runs").cast("long").alias("n_runs"),
    )
