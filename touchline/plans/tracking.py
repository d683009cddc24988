"""The statistics fetch loop over stored tracking tables.

State is kept as versions: tracking as JSON folders per league (B3), progress as one JSON
table (B4).  Each step reads the newest version and writes the next one, so lineage never
grows and a failed step leaves the state as it was.  A step writes the folders of the leagues it
touches only; a small file in the version says in which version the folder of every league is.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from touchline.operators import progress
from touchline.operators.quality import require_rows
from touchline.schemas import table_layout
from touchline.scratch import spill
from touchline.sinks.manifests import record_manifest
from touchline.sinks.tables import conform, write_version
from touchline.sources.files import Files
from touchline.sources.tables import VERSION, expire_versions, newest_version, read_version, versions

FIXTURES, LEAGUES = "fixture_tracking", "league_progress"
BY = "league_id"


@dataclass(frozen=True)
class State:
    """One stored version of the tracking tables."""

    version: int
    fixtures: DataFrame
    leagues: DataFrame
    folders: dict[str, int]  # league -> version that holds its folder


def start(fixtures: DataFrame, root: str, at: Column) -> None:
    """First version, nothing fetched."""
    fresh = progress.initial_tracking(fixtures)
    _store(root, 1, fresh, progress.league_progress(fresh, at))


def load(spark: SparkSession, root: str) -> State:
    """Newest version whose two tables are both written; an empty table is refused."""
    # progress is written last, so its newest version is the newest complete one
    version = newest_version(spark, f"{root}/{LEAGUES}")
    folders = _folders(Files(spark, f"{root}/{FIXTURES}"), version)
    leagues = read_version(spark, f"{root}/{LEAGUES}", table_layout(LEAGUES), "json", version)
    layout, base = table_layout(FIXTURES), f"{root}/{FIXTURES}"
    paths = [f"{base}/{VERSION}={v}/{BY}={league}" for league, v in folders.items()]
    fixtures = spark.createDataFrame([], layout)
    if paths:
        stored = spark.read.schema(layout).option("basePath", base).json(paths)
        fixtures = stored.select(*layout.names)
    return State(version, require_rows(fixtures, FIXTURES), require_rows(leagues, LEAGUES), folders)


def _index(version: int) -> str:
    return f"{VERSION}={version}/_leagues.json"


def _folders(files: Files, version: int) -> dict[str, int]:
    return json.loads(files.read(_index(version)))


def next_batch(spark: SparkSession, root: str, limit: int = 10) -> DataFrame:
    """M9: the fixtures to fetch next."""
    state = load(spark, root)
    return progress.next_batch(state.fixtures, state.leagues, limit)


def record(payloads: DataFrame, root: str, at: Column) -> DataFrame:
    """M3 for landed payloads (with their source file); returns the batch manifest.

    Every payload carries its own league, so a batch may span leagues.  A fixture that is not
    tracked yet needs a ``season`` in its payload; without one the step is refused.
    """
    state = load(payloads.sparkSession, root)
    given = [c for c in ("fixture_id", "league_id", "season") if c in payloads.columns]
    ids = payloads.select(*given)
    # Leagues of the payloads, and those that their fixtures were in before.
    before = state.fixtures.join(ids.select("fixture_id"), "fixture_id", "left_semi")
    touched = _touched(before.select(BY).union(payloads.select(F.col(BY).cast("bigint"))))
    fixtures = progress.mark_fetched(_of(state, touched), ids, at)
    leagues = progress.refresh_progress(state.leagues, fixtures, at, touched)
    _store(root, state.version + 1, fixtures, leagues, state, touched)
    return record_manifest(payloads, ["fixture_id", "league_id"], at)


def reset(spark: SparkSession, root: str, ids: DataFrame, at: Column, keep_rows: bool = False) -> None:
    """Forget fixtures (or mark them unfetched) and refresh the progress of their leagues."""
    state = load(spark, root)
    hit = state.fixtures.join(ids.select("fixture_id"), "fixture_id", "left_semi")
    touched = _touched(hit.select(BY))
    fixtures = progress.reset_fixtures(_of(state, touched), ids, keep_rows)
    leagues = progress.refresh_progress(state.leagues, fixtures, at, touched)
    _store(root, state.version + 1, fixtures, leagues, state, touched)


def _touched(leagues: DataFrame) -> DataFrame:
    return spill(leagues.distinct(), "touched-leagues")


def _of(state: State, touched: DataFrame) -> DataFrame:
    """Tracking rows of the touched leagues."""
    return state.fixtures.join(touched, BY, "left_semi").select(*state.fixtures.columns)


def reconcile(payloads: DataFrame, root: str, at: Column) -> DataFrame:
    """The payload rows that tracking knows as fetched; stored state follows the payloads.

    Fixtures marked as fetched without any payload are marked unfetched again, and the
    progress of their leagues is refreshed.
    """
    state = load(payloads.sparkSession, root)
    lost = progress.fetched(state.fixtures).join(
        payloads.select("fixture_id"), "fixture_id", "left_anti"
    )
    reset(payloads.sparkSession, root, lost.select("fixture_id"), at, keep_rows=True)
    return progress.reconcile(payloads, state.fixtures)


def expire(spark: SparkSession, root: str, keep: int = 2) -> None:
    """Remove all but the newest ``keep`` versions of the state, and what only they need.

    Progress goes first, as it says which versions are complete.  League folders that a kept
    version still points to stay.
    """
    expire_versions(spark, f"{root}/{LEAGUES}", keep)
    files = Files(spark, f"{root}/{FIXTURES}")
    kept = versions(spark, f"{root}/{LEAGUES}")
    used = {f"{VERSION}={v}/{BY}={league}" for k in kept for league, v in _folders(files, k).items()}
    for version in versions(spark, f"{root}/{FIXTURES}"):
        if version >= kept[0]:
            continue
        folder = f"{VERSION}={version}"
        named = [f"{folder}/{n}" for n in files.names(folder) if n.startswith(f"{BY}=")]
        for unused in sorted(set(named) - used):
            files.delete(unused)
        if not used.intersection(named):
            files.delete(folder)


def _store(
    root: str,
    version: int,
    fixtures: DataFrame,
    leagues: DataFrame,
    state: State | None = None,
    touched: DataFrame | None = None,
) -> None:
    """Both tables in their declared layouts; nulls where none may be stop the write.

    After a step on ``state``, ``fixtures`` are those of its touched leagues; the folders of all
    others stay where they are.
    """
    fixtures = conform(fixtures, table_layout(FIXTURES), FIXTURES)
    leagues = conform(leagues, table_layout(LEAGUES), LEAGUES)
    write_version(fixtures, f"{root}/{FIXTURES}", version, "json", [BY])
    files = Files(fixtures.sparkSession, f"{root}/{FIXTURES}")
    folders: dict[str, int] = {}
    if state is not None:
        gone = {str(r[BY]) for r in touched.collect()}  # at most the leagues of a batch
        folders = {league: v for league, v in state.folders.items() if league not in gone}
    written = [n for n in files.names(f"{VERSION}={version}") if n.startswith(f"{BY}=")]
    folders |= {n.partition("=")[2]: version for n in written}
    files.delete(_index(version))  # of an earlier try at this version
    files.publish(_index(version), json.dumps(folders))
    write_version(leagues, f"{root}/{LEAGUES}", version, "json")
