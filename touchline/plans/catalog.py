"""All tables in load order, and batch runs over a landing folder.

A run is one commit.  It lists the landed files once, takes those that its tables have not
taken yet, and publishes all its tables and the ledger of files together (``sinks.snapshots``),
so manifest, bronze and everything above agree on the same files, and readers see a run as a
whole or not at all.  A run that fails leaves nothing behind that anyone reads; the next one
does its work.  Files that land during a run belong to the next.

Bronze tables and manifests get the rows of new files, and only those files are opened.
Histories of teams and fixtures move on by those rows (``operators.tails``): versions that
ended before are not read again, late files are exact, and rows of one time are decided by file
time and name.  Statistics carry their stored history through each snapshot.  Tracking keeps its
rows and gets the new fixtures.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType

from touchline import schemas
from touchline.operators import progress
from touchline.operators.history import newest_per_key
from touchline.operators.tails import History
from touchline.plans import bronze, gold, silver
from touchline.scratch import spill
from touchline.sinks.manifests import landing_manifest, record_manifest
from touchline.sinks.snapshots import Commit, Part, Parts, Snapshots, ripe
from touchline.sinks.tables import conform
from touchline.sources import ledger
from touchline.sources.landing import FILE_TIME, INGESTED, SOURCE_FILE

Table = tuple[str, str]


def declared_layout(layer: str, name: str) -> StructType | None:
    """Columns and types of a table, if it has a declared layout.

    Nulls are let through: matches that are not played have no score, and facts keep rows
    whose team or league is unknown.
    """
    declared = {("silver", "fixtures"): "silver_fixture_history"}.get((layer, name), name)
    if layer not in ("silver", "gold") or declared not in schemas.TABLES:
        return None
    return StructType([StructField(f.name, f.dataType) for f in schemas.table_layout(declared)])


@dataclass(frozen=True)
class Load:
    """What one batch run works on."""

    spark: SparkSession
    landing: str  # folder with teams/, fixtures/, fixture_stats/ and leagues/ (envelopes)
    root: str  # layer tables go below this folder
    at: datetime
    seasons: str = "season"
    multi_line: bool = True  # files hold JSON arrays; False for one record per line
    _run: Run | None = field(default=None, repr=False, compare=False)

    @property
    def snapshots(self) -> Snapshots:
        return Snapshots(self.spark, self.root)

    def new(self, name: str, ddl: str) -> DataFrame:
        """Landed rows of the files that the table in work has not taken yet.

        Outside a run: those that the bronze table has not taken as of now.
        """
        run = self._run or Run(self, self.snapshots.newest())
        files = run.new_files(name, run.working or ("bronze", name))
        return ledger.read_files(self.spark, files, ddl, self.multi_line, f"{self.landing}/{name}")

    def stored(self, layer: str, name: str) -> DataFrame | None:
        """The table as an earlier run (or step) left it, if there was one."""
        parts = self._parts(layer, name)
        return self.snapshots.read(parts, declared_layout(layer, name)) if parts else None

    def table(self, layer: str, name: str) -> DataFrame:
        """A table as of the newest commit; inside a run, as the run has it so far."""
        parts, layout = self._parts(layer, name), declared_layout(layer, name)
        if not parts and layout is None:
            raise ValueError(f"{layer}/{name} has not been written")
        return self.snapshots.read(parts, layout)

    def added(self, layer: str, name: str) -> DataFrame:
        """Rows of an appended table that the table in work has not taken; all, outside a run."""
        if self._run is None:
            return self.table(layer, name)
        parts = self._run.added((layer, name))
        return self.snapshots.read(parts) if parts else self.table(layer, name).limit(0)

    def _parts(self, layer: str, name: str) -> Parts:
        table = f"{layer}/{name}"
        if self._run is not None and table in self._run.staged:
            return self._run.staged[table]
        commit = self._run.base if self._run is not None else self.snapshots.newest()
        return commit.parts(table)


class Run:
    """What a run has listed, taken and staged so far; nothing of it is visible yet."""

    def __init__(self, load: Load, base: Commit) -> None:
        self.load, self.base = load, base
        self.working: Table | None = None
        self.staged: dict[str, Parts] = {}
        self.notes: dict[str, int | str] = {"at": load.at.isoformat()}
        self._fresh: dict[str, Parts] = {}
        self._listed: dict[str, DataFrame] = {}
        self._taken: dict[str, DataFrame] = {}

    def new_files(self, feed: str, table: Table) -> DataFrame:
        """The run's files of a feed for one table; the same whenever it is asked."""
        name = f"ledger/{'/'.join(table)}"
        if name not in self._taken:
            if feed not in self._listed:
                landed = ledger.landed_files(self.load.spark, f"{self.load.landing}/{feed}")
                self._listed[feed] = spill(landed, "landed-files")
            files, parts = self._listed[feed], self.base.parts(name)
            if parts:
                files = ledger.new_files(files, self.load.snapshots.read(parts))
            self._taken[name] = spill(files, "new-files")
        return self._taken[name]

    def write(self, table: Table, df: DataFrame, partition_by: Sequence[str]) -> None:
        name = "/".join(table)
        staged = self.load.snapshots.stage(self.base, name, df, partition_by=partition_by)
        if table in APPENDED:
            self._fresh[name] = staged
            staged = self._added(name, staged)
        self.staged[name] = staged

    def added(self, source: Table) -> Parts:
        """What ``source`` got that the table in work has not taken: in this run, as a rule.

        Parts of earlier runs count if the table was left out of them.
        """
        name, mark = "/".join(source), f"{'/'.join(self.working)} took {'/'.join(source)}"
        taken = int(self.base.notes.get(mark, 0))
        self.notes[mark] = self.base.version + 1
        missed = {
            n: p for n, p in self.base.parts(name).items() if int(p.folder.split("/")[-1][:10]) > taken
        }
        return {**missed, **self._fresh.get(name, {})}

    def _added(self, name: str, staged: Parts) -> Parts:
        """The parts that a table has, and the new one; many small parts become one."""
        parts = {**self.base.parts(name), **staged}
        names = ripe(parts)
        if names:
            small = {n: parts.pop(n) for n in names}
            level = next(iter(small.values())).notes.get("level", 0) + 1
            rows = self.load.snapshots.read(small)
            for n, part in self.load.snapshots.stage(self.base, name, rows).items():
                parts[n] = Part(part.folder, {"level": level})
        return parts

    def commit(self) -> Commit:
        """Publish all staged tables with the ledger of the files behind them."""
        for name, files in self._taken.items():
            if not files.isEmpty():
                self.staged[name] = self._added(name, self.load.snapshots.stage(self.base, name, files))
        return self.load.snapshots.commit(self.base, self.staged, self.notes)


Step = Callable[[Load], DataFrame | None]


def _manifest(load: Load) -> DataFrame:
    rows = load.new("fixtures", schemas.RAW_FIXTURE)
    keyed = rows.withColumns(
        {"league_id": F.col("league.id"), "year": F.col("league.season")}
    )
    return landing_manifest(keyed, ["league_id", "year"], F.lit(load.at))


def _team_manifest(load: Load) -> DataFrame:
    return landing_manifest(load.new("teams", schemas.RAW_TEAM), [], F.lit(load.at))


def _stats_manifest(load: Load) -> DataFrame:
    rows = load.new("fixture_stats", schemas.RAW_FIXTURE_STATS)
    return record_manifest(rows, ["fixture_id", "league_id"], F.lit(load.at))


def _tracking(load: Load) -> DataFrame:
    """One row per fixture, from its newest payload; known fixtures keep their state."""
    rows = load.added("bronze", "fixtures").withColumnRenamed("league_season", "season")
    order = [INGESTED, FILE_TIME, SOURCE_FILE]
    newest = newest_per_key(
        rows.select("fixture_id", "league_id", "season", *order), ["fixture_id"], order
    )
    fresh, known = progress.initial_tracking(newest), load.stored("staging", "fixture_tracking")
    if known is None:
        return fresh
    added = fresh.join(known, "fixture_id", "left_anti")
    return known.unionByName(added)


def _stats_history(load: Load) -> DataFrame:
    known = load.stored("silver", "fixture_stats")
    rows = silver.merge_stats(load.table("silver_intermediate", "fixture_stats"))
    return silver.fixture_stats(known, rows, F.lit(load.at))


# The histories, by their key and how new bronze rows become changes.  Their log of changes is
# the table of the same name in the intermediate layer.
HISTORIES: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    "teams": ("team_id", silver.team_changes),
    "fixtures": ("fixture_id", silver.fixture_changes),
}


def _move_history(load: Load, name: str) -> None:
    """Stage a history and its log with the bronze rows they have not taken."""
    key, typed = HISTORIES[name]
    changes = typed(load.added("bronze", name))
    files = [c for c in silver.FILE_ORDER if c in changes.columns]
    stored = History(
        load.snapshots, f"silver/{name}", changes.schema, [key], INGESTED,
        ignore=(INGESTED, *files), tie_break=files, leave_out=files,
        log=f"silver_intermediate/{name}",
    )
    load._run.staged.update(stored.advanced(load._run.base, changes))


def _star(load: Load) -> list[DataFrame]:
    return [load.table("gold", f"dim_{d}") for d in ("fixtures", "teams", "leagues", "dates")]


def _stats(load: Load, *others: str) -> list[DataFrame]:
    return [load.table("gold", f"dim_{d}") for d in ("fixture_stats", "fixtures", "teams", *others)]


# (layer, table) -> how it is computed and how it is partitioned; order is load order.  Steps
# without a result stage their tables themselves, the history with its log of changes.
TABLES: dict[tuple[str, str], tuple[Step, tuple[str, ...]]] = {
    ("staging", "fixture_manifest"): (_manifest, ()),
    ("staging", "team_manifest"): (_team_manifest, ()),
    ("staging", "fixture_stats_manifest"): (_stats_manifest, ()),
    ("bronze", "leagues"): (
        lambda x: bronze.leagues(
            x.spark.read.schema(schemas.ENVELOPE).json(f"{x.landing}/leagues"), x.seasons
        ),
        (),
    ),
    ("bronze", "teams"): (
        lambda x: bronze.flattened(x.new("teams", schemas.RAW_TEAM), x.at), (),
    ),
    ("bronze", "fixtures"): (
        lambda x: bronze.flattened(x.new("fixtures", schemas.RAW_FIXTURE), x.at), (),
    ),
    ("bronze", "fixture_stats"): (
        lambda x: bronze.fixture_stats(
            x.new("fixture_stats", schemas.RAW_FIXTURE_STATS), x.at
        ),
        (),
    ),
    ("staging", "fixture_tracking"): (_tracking, ()),
    ("staging", "league_progress"): (
        lambda x: progress.league_progress(
            x.table("staging", "fixture_tracking"), F.lit(x.at)
        ),
        (),
    ),
    ("silver", "leagues"): (lambda x: silver.leagues(x.table("bronze", "leagues")), ()),
    ("silver_intermediate", "fixture_stats"): (
        lambda x: silver.stats_from_rows(x.added("bronze", "fixture_stats")), (),
    ),
    ("silver", "teams"): (lambda x: _move_history(x, "teams"), ()),
    ("silver", "fixtures"): (lambda x: _move_history(x, "fixtures"), ()),
    ("silver", "fixture_stats"): (_stats_history, ()),
    ("gold", "dim_dates"): (
        lambda x: gold.calendar_covering(x.table("silver", "fixtures"), "date"), (),
    ),
    ("gold", "dim_leagues"): (lambda x: gold.dim_leagues(x.table("silver", "leagues")), ()),
    ("gold", "dim_teams"): (
        lambda x: gold.dim_teams(x.table("silver", "teams"), F.lit(x.at)), (),
    ),
    ("gold", "dim_fixtures"): (lambda x: gold.dim_fixtures(x.table("silver", "fixtures")), ()),
    ("gold", "dim_fixture_stats"): (
        lambda x: gold.dim_fixture_stats(
            x.table("silver", "fixture_stats"), x.table("silver", "fixtures")
        ),
        (),
    ),
    ("gold", "fact_match_result"): (lambda x: gold.fact_match_result(*_star(x)), ("season",)),
    ("gold", "fact_match_stats"): (
        lambda x: gold.fact_match_stats(*_stats(x, "leagues", "dates")), ("season",),
    ),
    ("gold", "fact_team_result"): (
        lambda x: gold.fact_team_result(*_star(x)), ("season", "league_name"),
    ),
    ("gold", "fact_team_match_stats"): (
        lambda x: gold.fact_team_match_stats(*_stats(x, "dates")), (),
    ),
    ("gold", "fact_team_result_summary"): (
        lambda x: gold.fact_team_result_summary(x.table("gold", "fact_team_result")),
        ("season", "competition"),
    ),
}


# Tables that a run adds to; all others it replaces.
APPENDED = {
    ("staging", "fixture_manifest"),
    ("staging", "team_manifest"),
    ("staging", "fixture_stats_manifest"),
    ("bronze", "teams"),
    ("bronze", "fixtures"),
    ("bronze", "fixture_stats"),
    ("silver_intermediate", "fixture_stats"),
}


def run(load: Load, only: Sequence[Table] | None = None, keep: int | None = None) -> Commit:
    """Compute every table (or those of ``only``), in load order, and commit them together.

    A table with a declared layout is checked against it; a wrong frame stops the run, and
    nothing of it becomes visible.  With ``keep``, commits older than the newest so many are
    removed afterwards, with the folders that only they name.
    """
    run = Run(load, load.snapshots.newest())
    inside = replace(load, _run=run)
    for table, (step, partition_by) in TABLES.items():
        if only is not None and table not in only:
            continue
        run.working = table
        df, layout = step(inside), declared_layout(*table)
        if df is not None:
            run.write(table, conform(df, layout, "/".join(table)) if layout else df, partition_by)
    commit = run.commit()
    if keep is not None:
        load.snapshots.expire(keep)
    return commit
