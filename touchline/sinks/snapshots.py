"""Tables of unchanging parts behind one pointer, for several tables at once.

Writers put rows into new folders that nobody reads yet, and then publish one small commit
file that names the folders of every table.  The file is renamed into place, so readers see
all tables as of one commit or the one before, never a mixture, whatever fails in between.
Two writers on the same commit cannot both succeed.  A commit names one folder per part
(bucket, league, batch), so it stays small; part values that did not change keep their folder.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.types import StructType

from touchline.sinks.tables import EXACT_TIME, spread_for_write
from touchline.sources.files import Files

COMMITS = "_commits"
PART = "__part"

Stat = int | str | None


@dataclass(frozen=True)
class Part:
    """A folder of rows below the root, with what its writer noted about it."""

    folder: str
    notes: Mapping[str, Stat] = field(default_factory=dict)


Parts = Mapping[str, Part]


@dataclass(frozen=True)
class Commit:
    """The parts of every table as of one version."""

    version: int = 0
    tables: Mapping[str, Parts] = field(default_factory=dict)
    notes: Mapping[str, Stat] = field(default_factory=dict)

    def parts(self, table: str) -> Parts:
        return self.tables.get(table, {})


class Snapshots:
    """All tables below one root."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self._files = Files(spark, self.root)

    def versions(self) -> list[int]:
        found = self._files.names(COMMITS)
        return sorted(int(n.removesuffix(".json")) for n in found if n.endswith(".json") and n[0] != ".")

    def newest(self) -> Commit:
        """The last commit; an empty one before the first."""
        known = self.versions()
        return self.at(known[-1]) if known else Commit()

    def at(self, version: int) -> Commit:
        stored = json.loads(self._files.read(_commit_file(version)))
        tables = {
            table: {name: Part(p["folder"], p["notes"]) for name, p in parts.items()}
            for table, parts in stored["tables"].items()
        }
        return Commit(version, tables, stored["notes"])

    def stage(self, base: Commit, table: str, df: DataFrame, by: Column | None = None,
              partition_by: Sequence[str] = (), source: str = "parquet") -> dict[str, Part]:
        """Write rows to a new folder that becomes visible with a commit on ``base``.

        With ``by``, one part per value of it (simple texts or numbers); else one part.
        """
        folder = f"{table}/{base.version + 1:010d}-{uuid.uuid4().hex}"
        columns = [PART] if by is not None else list(partition_by)
        rows = df.withColumn(PART, by) if by is not None else df
        if columns:
            rows = spread_for_write(rows, *columns)
        writer = rows.write.format(source).option("timestampFormat", EXACT_TIME)
        if columns:
            writer = writer.partitionBy(*columns)
        writer.save(f"{self.root}/{folder}")
        if by is None:
            return {folder.rpartition("/")[2]: Part(folder)}
        named = [n for n in self._files.names(folder) if n.startswith(f"{PART}=")]
        return {n.partition("=")[2]: Part(f"{folder}/{n}") for n in named}

    def commit(self, base: Commit, tables: Mapping[str, Parts], notes: Mapping[str, Stat] | None = None) -> Commit:
        """Make the given tables visible as ``base`` plus one; tables not named stay as they are.

        Fails, with nothing changed, if another commit on ``base`` came first.
        """
        merged = Commit(base.version + 1, {**base.tables, **tables}, {**base.notes, **(notes or {})})
        stored = {
            "tables": {
                table: {name: {"folder": p.folder, "notes": dict(p.notes)} for name, p in parts.items()}
                for table, parts in merged.tables.items()
            },
            "notes": dict(merged.notes),
        }
        self._files.publish(_commit_file(merged.version), json.dumps(stored))
        return merged

    def read(self, parts: Parts, schema: StructType | None = None, source: str = "parquet") -> DataFrame:
        """Rows of the given parts; folders that were not named are not even listed."""
        if not parts:
            if schema is None:
                raise ValueError("a table without parts needs a schema to be read")
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        return reader.format(source).load([f"{self.root}/{p.folder}" for p in parts.values()])

    def expire(self, keep: int = 2) -> list[int]:
        """Remove all but the newest ``keep`` commits and the folders only they name.

        Readers of a removed commit lose their input, so keep as many as readers may lag.
        Folders of writes that never committed go too, once later commits have passed them.
        """
        known = self.versions()
        gone, kept = known[:-keep], [self.at(v) for v in known[-keep:]]
        if not gone:
            return []
        used = {p.folder for commit in kept for parts in commit.tables.values() for p in parts.values()}
        tables = {table for v in known for table in self.at(v).tables}
        for version in gone:
            self._files.delete(_commit_file(version))
        for table in tables:
            for name in self._files.names(table):
                folder = f"{table}/{name}"
                if not name[:10].isdigit() or int(name[:10]) > kept[0].version:
                    continue
                if folder in used:
                    continue
                below = [u for u in used if u.startswith(f"{folder}/")]
                if not below:
                    self._files.delete(folder)
                    continue
                for part in self._files.names(folder):
                    if part.startswith(f"{PART}=") and f"{folder}/{part}" not in below:
                        self._files.delete(f"{folder}/{part}")
        return gone


def ripe(parts: Parts, most: int = 16) -> list[str]:
    """The parts that should become one: those of the lowest level that holds ``most`` or more.

    Merging level by level rewrites each row a few times only, however many batches come.
    """
    levels: dict[int, list[str]] = {}
    for name, part in parts.items():
        levels.setdefault(part.notes.get("level", 0), []).append(name)
    full = [level for level, names in levels.items() if len(names) >= most]
    return sorted(levels[min(full)]) if full else []


def _commit_file(version: int) -> str:
    return f"{COMMITS}/{version:010d}.json"
