"""Removal of long repeated byte strings by suffix arrays from Lyndon groups (op 2).

A byte goes if it lies in a ``LENGTH``-byte string that also starts earlier, in a smaller id
or earlier in the same text.  A suffix array of everything would be one ordering over all
bytes; only suffixes that share a string need to meet.  So:

1. Anchors (see ``anchors``) send every string of ``LENGTH`` bytes to the bucket of its
   anchor; equal strings have equal anchors.  Buckets of one anchor are out at once, which
   is nearly all of a text without repeats.
2. Equal contexts of a bucket are combined: all but the earliest are later copies as a whole.
3. Of the distinct contexts of a bucket, cut to what agrees with any other one on either side of
   their anchors, a suffix array is built by Lyndon grouping (see ``grouping``); contexts that are
   equal as cut enter it once.  Its intervals with a common prefix of ``LENGTH`` bytes are the
   repeated strings, and the earliest suffix of an interval is the original.
4. A bucket of more than ``CONTEXTS`` distinct contexts is dealt to several tasks, by hashes
   of the contexts' places, so parts hold about ``CONTEXTS`` of them, also if all are in one
   text.  The originals of such parts are compared once more by digest, so nothing is lost
   and no task holds more than a part at a time.

Only anchors, contexts of unlike buckets and texts that lose bytes or own such contexts are
shuffled.  Context equality rests on two 64-bit hashes together, digests on 128 bits.

Edge cases: null text is empty; texts shorter than ``LENGTH`` lose nothing; any text length
is worked in pieces; a null id sorts after all others; rows that repeat id and text are one
document and get the same result; rows of one id (or without id) and unlike texts are documents
of their own, in the order of a hash of their texts; an empty table gives no rows; other columns
are not read.  Only where ids have unlike texts are documents numbered anew, by id and hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm import anchors
from touchline.llm.anchors import LENGTH
from touchline.llm.common import text_of
from touchline.llm.grouping import prefix_intervals
from touchline.operators.keys import dense_key
from touchline.scratch import spill

CONTEXTS = 500
_LAST = "9223372036854775807"
_END = (1 << 32) - 1


def _id(column: str) -> Column:
    return F.coalesce(F.col(column).cast("long"), F.lit(_LAST).cast("long")).alias("doc")


def _documents(rows: DataFrame) -> DataFrame:
    """Rows (doc, copy, text, doc_id), with ``doc`` one number per text, in the order of ids."""
    texts = rows.groupBy("doc").agg(F.min("copy").alias("low"), F.max("copy").alias("high"))
    if texts.filter("low != high").isEmpty():
        return rows
    known = dense_key(rows.select("doc", "copy").distinct(), "number", ["doc", "copy"])
    known = known.withColumnsRenamed({"doc": "__doc", "copy": "__copy"})
    same = (F.col("doc") == F.col("__doc")) & (F.col("copy") == F.col("__copy"))
    return spill(rows.join(known, same).withColumn("doc", F.col("number")).select(*rows.columns), "repeat-numbered")


def _found(column: pa.Array) -> Iterator[anchors.Anchors]:
    """Anchors of a column of texts."""
    if not len(column) or column.buffers()[2] is None:
        return
    offsets = np.frombuffer(column.buffers()[1], "i4")[column.offset :][: len(column) + 1]
    yield from anchors.find(np.frombuffer(column.buffers()[2], "u1"), offsets)


def _text_grams(texts: DataFrame) -> DataFrame:
    """(gram) of every anchor, from (doc, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in _found(batch.column(0)):
                yield pa.RecordBatch.from_arrays([pa.array(a.gram.view("i8"))], ["gram"])

    return texts.select("text").mapInArrow(run, "gram long")


def text_anchors(texts: DataFrame) -> DataFrame:
    """(gram, context, doc, at) from (doc, text); ``at`` is place, left and owned in one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for a in _found(batch.column(1)):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(a.gram.view("i8")),
                        pa.array(a.context.view("i8")),
                        pa.array(ids[a.text]),
                        pa.array(a.place << 16 | a.left << 8 | a.owned),
                    ],
                    ["gram", "context", "doc", "at"],
                )

    return texts.mapInArrow(run, "gram long, context long, doc long, at long")


def _start(at: Column) -> Column:
    return F.shiftright(at, 16) - (F.shiftright(at, 8).bitwiseAND(F.lit(255)))


def _end(at: Column) -> Column:
    return _start(at) + at.bitwiseAND(F.lit(255)) + (LENGTH - 1)


def _contexts(owners: DataFrame, texts: DataFrame) -> DataFrame:
    """(gram, part, parts, doc, start, bytes, left) of the contexts that ``owners`` names."""
    wanted = owners.groupBy(F.col("doc").alias("__doc")).agg(
        F.collect_list(
            F.struct(
                "gram",
                "parts",
                _start(F.col("at")).alias("s"),
                _end(F.col("at")).alias("e"),
                F.shiftright("at", 8).bitwiseAND(F.lit(255)).alias("left"),
            )
        ).alias("w")
    )
    cut = texts.join(wanted, F.col("doc") == F.col("__doc")).select("doc", "text", F.explode("w").alias("w"))
    raw = F.substring(F.col("text"), F.col("w")["s"].cast("int") + 1, (F.col("w")["e"] - F.col("w")["s"]).cast("int"))
    return cut.select(
        F.col("w")["gram"].alias("gram"),
        F.pmod(F.xxhash64("doc", F.col("w")["s"]), F.col("w")["parts"]).alias("part"),
        F.col("w")["parts"].alias("parts"),
        "doc",
        F.col("w")["s"].alias("start"),
        raw.alias("bytes"),
        F.col("w")["left"].alias("left"),
    )


def _shared(a: bytes, b: bytes, order: str) -> int:
    """Length of the common prefix ("big") or suffix ("little") of two strings of one length."""
    differ = int.from_bytes(a, order) ^ int.from_bytes(b, order)
    return len(a) - (differ.bit_length() + 7) // 8


def _reach(sides: list[bytes], order: str) -> list[int]:
    """Longest common prefix (suffix) of each string with any other; neighbours in order tell."""
    ranked = sorted(range(len(sides)), key=lambda k: sides[k] if order == "big" else sides[k][::-1])
    reach = [0] * len(sides)
    for i, k in zip(ranked, ranked[1:]):
        n = min(len(sides[i]), len(sides[k]))
        if order == "big":
            shared = _shared(sides[i][:n], sides[k][:n], order)
        else:
            shared = _shared(sides[i][len(sides[i]) - n :], sides[k][len(sides[k]) - n :], order)
        reach[i], reach[k] = max(reach[i], shared), max(reach[k], shared)
    return reach


def _repeating(rows: list[tuple]) -> list[tuple]:
    """Contexts of a whole bucket, cut to what may repeat in another one; the rest are left out.

    Equal strings have their anchor in the same place, so what two contexts share reaches from
    the anchor to either side, no farther than each side agrees with any other context.
    """
    right = _reach([r[5][r[6] :] for r in rows], "big")
    left = _reach([r[5][: r[6]] for r in rows], "little")
    return [
        (*r[:4], r[4] + r[6] - to_left, r[5][r[6] - to_left : r[6] + to_right], to_left)
        for r, to_left, to_right in zip(rows, left, right, strict=True)
        if to_left + to_right >= LENGTH
    ]


def _of_bucket(rows: list[tuple]) -> Iterator[tuple]:
    """(digest, doc, start, end) of one bucket part; digest only where parts must be compared.

    Contexts that are equal, as cut, enter the suffix array once.
    """
    whole = rows[0][2] == 1
    if whole:
        rows = _repeating(rows)
        if not rows:
            return
    holders: dict[bytes, list[tuple[int, int]]] = {}
    for place, raw in sorted(((r[3], r[4]), r[5]) for r in rows):
        holders.setdefault(raw, []).append(place)
    texts, places = list(holders), [held[0] for held in holders.values()]
    later: list[list[int]] = [[] for _ in texts]
    for interval in prefix_intervals(texts, LENGTH):
        original = interval[0]
        if len(interval) > 1:
            original = min(interval, key=lambda m: (places[m[0]][0], places[m[0]][1] + m[1]))
            for k, i in interval:
                if (k, i) != original:
                    later[k].append(i)
        if not whole:
            k, i = original
            digest = hashlib.blake2b(texts[k][i : i + LENGTH], digest_size=16).digest()
            start = places[k][1] + i
            yield digest, places[k][0], start, start + LENGTH
    spans = []
    for text, held, found in zip(texts, holders.values(), later, strict=True):
        doc, start = held[0]
        found.sort()
        at = 0
        while at < len(found):
            to = at
            while to + 1 < len(found) and found[to + 1] == found[to] + 1:
                to += 1
            spans.append((doc, start + found[at], start + found[to] + LENGTH))
            at = to + 1
        # Every string of the others is in the first one too.
        spans += [(doc, start, start + len(text)) for doc, start in held[1:] if len(text) >= LENGTH]
    for span in sorted(spans):
        yield None, *span


def _compared(contexts: DataFrame) -> DataFrame:
    """(digest, doc, start, end) over all buckets, each bucket part in one run of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(found: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*found, strict=True)) if found else [[], [], [], []]
            types = (pa.binary(), pa.int64(), pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                ["digest", "doc", "start", "end"],
            )

        bucket: list[tuple] = []
        for batch in batches:
            found: list[tuple] = []
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if bucket and bucket[0][:2] != row[:2]:
                    found.extend(_of_bucket(bucket))
                    bucket = []
                bucket.append(row)
            yield out(found)
        if bucket:
            yield out(list(_of_bucket(bucket)))

    dealt = contexts.repartition("gram", "part").sortWithinPartitions("gram", "part")
    return dealt.mapInArrow(run, "digest binary, doc long, start long, end long")


def repeated_spans(texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From (doc, text): (doc, start, end) of later copies, and the texts concerned."""
    twice = _text_grams(texts).groupBy("gram").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    # Written first: the join then has an exchange on either side, and a hot bucket is split.
    # Grams, and classes below, come once each: hashing their slices spares a sort of all anchors.
    twice = spill(twice.select("gram"), "repeat-grams")
    shared = spill(
        text_anchors(texts).join(twice.hint("shuffle_hash"), "gram", "left_semi"), "repeat-anchors"
    )
    place = F.struct("doc", "at")
    classes = spill(
        shared.groupBy("gram", "context").agg(F.min(place).alias("first")), "repeat-contexts"
    )
    copies = (
        shared.join(classes.hint("shuffle_hash"), ["gram", "context"])
        .filter(F.col("first") != place)
        .select("doc", _start(F.col("at")).alias("start"), _end(F.col("at")).alias("end"))
    )
    copies = spill(copies, "repeat-copies")
    unlike = classes.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    unlike = spill(unlike.select("gram", F.ceil(F.col("n") / CONTEXTS).alias("parts")), "repeat-unlike")
    owners = spill(
        classes.join(unlike, "gram").select("gram", "parts", "first.doc", "first.at"), "repeat-owners"
    )
    concerned = spill(
        owners.select(F.col("doc").alias("__doc")).union(copies.select("doc")).distinct(), "repeat-ids"
    )
    held = spill(
        # Texts move to the ids at every size alike.
        texts.join(concerned.hint("merge"), F.col("doc") == F.col("__doc"), "left_semi").dropDuplicates(
            ["doc"]
        ),
        "repeat-texts",
    )
    compared = spill(_compared(_contexts(owners, held)), "repeat-compared")
    parts = compared.filter("digest is not null")
    winners = parts.groupBy(F.col("digest").alias("__digest")).agg(
        F.min(F.struct("doc", "start")).alias("first")
    )
    across = (
        parts.join(spill(winners, "repeat-winners"), F.col("digest") == F.col("__digest"))
        .filter(F.col("first") != F.struct("doc", "start"))
        .select("doc", "start", "end")
    )
    local = compared.filter("digest is null").select("doc", "start", "end")
    return copies.unionByName(local).unionByName(across), held


def _merged(spans: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, end) of the maximal runs that packed spans, ascending in a row, cover."""
    packed = spans.flatten().to_numpy()
    row = np.repeat(np.arange(len(spans)), pc.list_value_length(spans).to_numpy())
    # Rows lie one after the other on one line, farther apart than a text is long.
    start = (row << 32) + (packed >> 32)
    end = np.maximum.accumulate((row << 32) + (packed & _END))
    first = np.flatnonzero(np.concatenate([[True], start[1:] > end[:-1]])[: len(row)])
    last = np.append(first[1:], len(row))[: len(first)] - 1
    return row[first], start[first] & _END, end[last] & _END


def remaining_text(texts: DataFrame, spans: DataFrame) -> DataFrame:
    """(doc, kept bytes, n_removed, n_spans) of texts that lose bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, start, end = _merged(batch.column(2))
            bounds = np.searchsorted(row, np.arange(len(batch) + 1))
            sums = np.concatenate([[0], np.cumsum(end - start)])[bounds]
            first, last, bounds = start.tolist(), end.tolist(), bounds.tolist()
            kept = []
            for text, low, high in zip(batch.column(1), bounds, bounds[1:], strict=False):
                raw, at, parts = memoryview(text.as_buffer()), 0, []
                for k in range(low, high):
                    parts.append(raw[at : first[k]])
                    at = last[k]
                parts.append(raw[at:])
                kept.append(b"".join(parts))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(kept, pa.binary()),
                    pa.array(np.diff(sums)),
                    pa.array(np.diff(np.array(bounds, "i8"))),
                ],
                ["doc", "kept", "n_removed", "n_spans"],
            )

    # A text is shorter than 2**31 bytes, so a span fits into one number and sorts by its start.
    packed = F.shiftleft("start", 32).bitwiseOR(F.col("end"))
    by_text = spans.groupBy(F.col("doc").alias("__doc")).agg(
        F.sort_array(F.collect_set(packed)).alias("spans")
    )
    return (
        texts.join(by_text, F.col("doc") == F.col("__doc"))
        .select("doc", "text", "spans")
        .mapInArrow(run, "doc long, kept binary, n_removed long, n_spans long")
    )


def without_repeats(docs: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    raw = text_of(text).cast("binary")
    rows = _documents(
        docs.select(
            F.col(id_column).cast("long").alias("doc_id"),
            _id(id_column),
            F.xxhash64(raw).alias("copy"),
            raw.alias("text"),
        )
    )
    spans, held = repeated_spans(rows.select("doc", "text"))
    changed = spill(
        remaining_text(held, spans).select(
            F.col("doc").alias("__doc"), "n_removed", "n_spans", F.sha2("kept", 256).alias("digest")
        ),
        "repeat-changed",
    )
    rows = rows.select(
        "doc_id",
        "doc",
        F.octet_length("text").cast("long").alias("n_bytes"),
        F.sha2("text", 256).alias("whole"),
    )
    return rows.join(changed, F.col("doc") == F.col("__doc"), "left").select(
        "doc_id",
        "n_bytes",
        F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0).cast("long")).alias("n_spans"),
        F.coalesce("digest", "whole").alias("kept_sha256"),
    )
