"""Change histories kept behind a pointer, where a batch touches only the tails it changes.

A history is two tables of one commit: the log of all changes and the versions.  Both are dealt
to buckets by key.  The open versions of a bucket are one part, its closed versions are others,
and every part of log or closed versions carries the sequence values it reaches up to.  A batch

* adds its rows to the log as new parts;
* reads the open part of the buckets it touches, and of the closed parts and the log only those
  that reach the earliest sequence value that came in for the bucket: none, as long as rows come
  in order;
* keeps all versions that end before the earliest value that came in for their key; of the
  others, the one that covers that moment is the state to go on from, and the rest follows again
  from the key's log from there on (``history_from_changes``), so late rows are exact;
* writes the new open part and the versions that closed, and commits.

Readers see the history as of a commit.  A failed batch leaves the commit before it, and the
same rows applied twice give the same history.  Small parts are merged level by level.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import (
    ByteType,
    DataType,
    DateType,
    IntegerType,
    LongType,
    ShortType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from touchline.operators.history import END, START, history_from_changes
from touchline.scratch import spill
from touchline.sinks.snapshots import Commit, Part, Parts, Snapshots, ripe

OPEN, CLOSED = "open", "closed"
LEVEL, REACHES = "level", "reaches"


def _reach(column: Column, kind: DataType) -> Column:
    """The sequence value as an integer or text that JSON keeps and Python compares alike.

    Null for types without such a form; their parts are read always.
    """
    if isinstance(kind, TimestampType):
        return F.unix_micros(column)
    if isinstance(kind, DateType):
        return F.unix_date(column)
    if isinstance(kind, ByteType | ShortType | IntegerType | LongType):
        return column.cast("bigint")
    if isinstance(kind, StringType):
        return column
    return F.lit(None).cast("bigint")


def _same_key(left: Sequence[str], right: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, (F.col(x).eqNullSafe(F.col(y)) for x, y in zip(left, right, strict=True)))


def _relevant(parts: Parts, lows: dict[str, object]) -> dict[str, Part]:
    """Parts of the touched buckets that reach the bucket's earliest new value."""

    def reached(part: Part, low: object) -> bool:
        high = part.notes[REACHES]
        return high is None or low is None or high >= low

    return {n: p for n, p in parts.items() if n.split(".")[0] in lows and reached(p, lows[n.split(".")[0]])}


class History:
    """One stored history: its keys, order and layout."""

    def __init__(
        self,
        snapshots: Snapshots,
        name: str,
        changes: StructType,
        keys: Sequence[str],
        sequence_by: str,
        ignore: Sequence[str] | None = None,
        tie_break: Sequence[str] = (),
        leave_out: Sequence[str] = (),
        delete_when: Column | None = None,
        buckets: int = 64,
        log: str | None = None,
    ) -> None:
        """``leave_out`` names columns of the log, such as ties, that versions do not carry."""
        self.snapshots, self.name, self.layout = snapshots, name, changes
        self.log = log or f"{name}_log"
        self.keys, self.sequence_by = list(keys), sequence_by
        self.ignore, self.tie_break, self.delete_when = ignore, tie_break, delete_when
        self._kind = changes[sequence_by].dataType
        self._bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("string")
        carried = [StructField(f.name, f.dataType) for f in changes if f.name not in leave_out]
        self.versions = StructType(
            [*carried, StructField(START, self._kind), StructField(END, self._kind)]
        )

    def read(self, commit: Commit | None = None) -> DataFrame:
        """All versions as of a commit, the newest by default."""
        commit = commit or self.snapshots.newest()
        return self.snapshots.read(commit.parts(self.name), self.versions)

    def advanced(self, base: Commit, rows: DataFrame) -> dict[str, dict[str, Part]]:
        """Stage ``rows`` on top of ``base``; the parts of both tables, ready to be committed."""
        sequence = F.col(self.sequence_by)
        refused = F.raise_error(F.lit(f"{self.name}: null in {self.sequence_by}")).cast(self._kind)
        checked = rows.select(*self.layout.names).withColumn(
            self.sequence_by, F.when(sequence.isNull(), refused).otherwise(sequence)
        )
        came = self.snapshots.stage(base, self.log, checked, by=self._bucket)
        if not came:
            return self._started(base)
        fresh = self.snapshots.read(came, self.layout)
        reach = _reach(sequence, self._kind)
        span = fresh.groupBy(self._bucket.alias("b")).agg(F.min(reach).alias("low"), F.max(reach).alias("high"))
        spans = {r["b"]: (r["low"], r["high"]) for r in span.collect()}  # one row per bucket
        lows = {b: low for b, (low, _) in spans.items()}

        stored = base.parts(self.name)
        closed = {n: p for n, p in stored.items() if n.split(".")[1] == CLOSED}
        old_open = {n: p for n, p in stored.items() if n.split(".")[1] == OPEN and n.split(".")[0] in lows}
        reopened = _relevant(closed, lows)
        for bucket in lows:  # parts that are many and small go along
            names = ripe({n: p for n, p in closed.items() if n.split(".")[0] == bucket})
            reopened.update({n: closed[n] for n in names})
        tail = _relevant(base.parts(self.log), lows)

        staged = self.snapshots.stage(
            base, self.name, self._rebuilt(fresh, {**old_open, **reopened}, {**tail, **came}),
            by=F.concat_ws(".", self._bucket, F.when(F.col(END).isNull(), OPEN).otherwise(CLOSED)),
        )
        return {
            self.log: self._log_parts(base, came, spans),
            self.name: self._version_parts(stored, {**old_open, **reopened}, staged),
        }

    def _started(self, base: Commit) -> dict[str, dict[str, Part]]:
        """Tables without rows, where there are none yet; nothing otherwise."""
        made = {}
        for table, layout, kind in ((self.log, self.layout, "log"), (self.name, self.versions, OPEN)):
            if not base.parts(table):
                empty = self.snapshots.spark.createDataFrame([], layout)
                (part,) = self.snapshots.stage(base, table, empty).values()
                made[table] = {f"0.{kind}": Part(part.folder, {LEVEL: 0, REACHES: None})}
        return made

    def _rebuilt(self, fresh: DataFrame, versions: Parts, log: Parts) -> DataFrame:
        """The versions of the parts read, with what the new rows make of them."""
        known = [f"__{k}" for k in self.keys]
        since = spill(
            fresh.groupBy(*self.keys)
            .agg(F.min(self.sequence_by).alias("__since"))
            .select(*[F.col(k).alias(n) for k, n in zip(self.keys, known, strict=True)], "__since"),
            "history-since",
        )
        same = _same_key(self.keys, known)
        old = self.snapshots.read(versions, self.versions).join(since, same, "left")
        ended = F.col("__since").isNull() | (F.col(END).isNotNull() & (F.col(END) < F.col("__since")))
        kept = old.filter(ended).select(*self.versions.names)
        # What covers the moment before the first new row; the log goes on from there.
        covering = old.filter(~ended & (F.col(START) < F.col("__since")))
        entry = covering.select(
            *[
                F.col(f.name) if f.name in self.versions.names else F.lit(None).cast(f.dataType).alias(f.name)
                for f in self.layout
            ]
        )
        tail = (
            self.snapshots.read(log, self.layout)
            .join(since, same)
            .filter(F.col(self.sequence_by) >= F.col("__since"))
            .select(*self.layout.names)
        )
        again = history_from_changes(
            entry.unionByName(tail), self.keys, self.sequence_by, self.ignore, self.tie_break, self.delete_when
        )
        return kept.unionByName(again.select(*self.versions.names))

    def _log_parts(self, base: Commit, came: Parts, spans: dict[str, tuple]) -> dict[str, Part]:
        """The log with its new parts; many small parts of a bucket become one."""
        stored = dict(base.parts(self.log))
        for bucket, part in came.items():
            stored[_named(bucket, part)] = Part(part.folder, {LEVEL: 0, REACHES: spans[bucket][1]})
        merged: dict[str, Part] = {}
        for bucket in came:
            names = ripe({n: p for n, p in stored.items() if n.split(".")[0] == bucket})
            merged.update({n: stored.pop(n) for n in names})
        if merged:
            rows = self.snapshots.read(merged, self.layout)
            for bucket, part in self.snapshots.stage(base, self.log, rows, by=self._bucket).items():
                own = [p.notes for n, p in merged.items() if n.split(".")[0] == bucket]
                reaches = [n[REACHES] for n in own]
                stored[_named(bucket, part)] = Part(
                    part.folder,
                    {LEVEL: own[0][LEVEL] + 1, REACHES: None if None in reaches else max(reaches)},
                )
        return stored

    def _version_parts(self, stored: Parts, read: Parts, staged: Parts) -> dict[str, Part]:
        """The versions without the parts that were read, with those written instead."""
        parts = {n: p for n, p in stored.items() if n not in read}
        closed = {n: p for n, p in staged.items() if n.split(".")[1] == CLOSED}
        reaches: dict[str, object] = {}
        if closed:
            ends = self.snapshots.read(closed, self.versions).groupBy(self._bucket.alias("b"))
            found = ends.agg(F.max(_reach(F.col(END), self._kind)).alias("high")).collect()  # per bucket
            reaches = {r["b"]: r["high"] for r in found}
        for name, part in staged.items():
            bucket, kind = name.split(".")
            if kind == OPEN:
                parts[name] = part
                continue
            levels = [p.notes[LEVEL] for n, p in read.items() if n.startswith(f"{bucket}.{CLOSED}")]
            level = max(levels) + 1 if len(levels) > 1 else max(levels, default=0)
            parts[_named(name, part)] = Part(part.folder, {LEVEL: level, REACHES: reaches[bucket]})
        return parts


def _named(prefix: str, part: Part) -> str:
    """A part name that no other batch gives: the bucket and the folder of the write."""
    return f"{prefix}.{part.folder.split('/')[-2].replace('.', '-')}"


def read_history(spark: SparkSession, root: str, name: str = "history") -> DataFrame:
    """The versions of a stored history as of its newest commit."""
    snapshots = Snapshots(spark, root)
    return snapshots.read(snapshots.newest().parts(name))
