"""Incremental fetch tracking.

``tracking`` has one row per fixture (fixture_id, league_id, season, is_fetched_stat,
fetch_stat_time), ``progress`` one row per league and season.  All functions work on every
league at once; the per-league forms are filters.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from touchline.operators.history import newest_per_key
from touchline.scratch import spill

PROGRESS_KEYS = ("league_id", "year")


def upsert(
    target: DataFrame, updates: DataFrame, keys: Sequence[str], few: bool = False
) -> DataFrame:
    """A full outer merge on the keys; a non-null update wins over the target's value.

    Several updates of one key count as one, the largest by their columns, so no row of the
    target is multiplied.  The target is read once.  A caller who knows that updates are
    ``few`` gets a left join plus the updates of unknown keys: that reads the target twice,
    but the reduced updates are written first, so the planner knows their size, and as long as
    it broadcasts them the target stays where it is.
    """
    given = [c for c in target.columns if c not in keys and c in updates.columns]
    reduced = newest_per_key(updates.select(*keys, *given), keys)
    if few:
        reduced = spill(reduced, "updates")
    incoming = reduced.select(*keys, F.struct(*given).alias("__new"))
    merged = target.join(incoming, list(keys), "left" if few else "full_outer").select(
        *[
            F.coalesce(F.col("__new")[c], F.col(c)).alias(c) if c in given else F.col(c)
            for c in target.columns
        ]
    )
    if not few:
        return merged
    known = target.select(*keys).join(reduced.select(*keys), list(keys), "left_semi")
    unknown = reduced.join(known, list(keys), "left_anti")
    return merged.unionByName(unknown, allowMissingColumns=True)


def initial_tracking(fixtures: DataFrame) -> DataFrame:
    """M2: every fixture, not fetched yet."""
    return fixtures.select(
        F.col("fixture_id").cast("bigint"),
        F.col("league_id").cast("bigint"),
        F.col("season").cast("int"),
        F.lit(False).alias("is_fetched_stat"),
        F.lit(None).cast("timestamp").alias("fetch_stat_time"),
    )


def league_progress(tracking: DataFrame, at: Column) -> DataFrame:
    """Totals, fetched share and completeness per league and season."""
    fetched, total = F.col("fetched_count"), F.col("total_fixtures")
    return (
        tracking.groupBy("league_id", F.col("season").alias("year"))
        .agg(
            F.count(F.lit(1)).cast("int").alias("total_fixtures"),
            F.count_if("is_fetched_stat").cast("int").alias("fetched_count"),
        )
        .select(
            *PROGRESS_KEYS,
            total,
            fetched,
            _share(fetched, total).cast("float").alias("fetched_percentage"),
            (fetched >= total).alias("is_complete"),
            at.alias("last_updated"),
        )
    )


def _share(part: Column, whole: Column) -> Column:
    return F.coalesce(F.round(F.try_divide(part, whole) * 100, 2), F.lit(0.0))


def mark_fetched(tracking: DataFrame, ids: DataFrame, at: Column) -> DataFrame:
    """M3: set flag and time for the fixtures in ``ids``.

    ``ids`` has fixture_id and, for fixtures that are not tracked yet, league_id and season.
    """
    updates = ids.withColumns(
        {"is_fetched_stat": F.lit(True), "fetch_stat_time": at}
    )
    return upsert(tracking, updates, ["fixture_id"])


def refresh_progress(
    progress: DataFrame, tracking: DataFrame, at: Column, leagues: DataFrame | None = None
) -> DataFrame:
    """M3, M4: recompute progress from tracking (of some leagues only) and upsert it.

    A league and season of which tracking has no fixture any more gets zeros and is not
    complete.
    """
    known = progress.select(*PROGRESS_KEYS)
    if leagues is not None:
        wanted = leagues.select("league_id").distinct()
        tracking = tracking.join(wanted, "league_id", "left_semi")
        known = known.join(wanted, "league_id", "left_semi")
    counted = league_progress(tracking, at)
    emptied = _nothing(known.join(counted, list(PROGRESS_KEYS), "left_anti"), at)
    return upsert(progress, counted.unionByName(emptied), PROGRESS_KEYS)


def _nothing(keys: DataFrame, at: Column) -> DataFrame:
    """Progress rows without fixtures."""
    return keys.select(
        *PROGRESS_KEYS,
        F.lit(0).alias("total_fixtures"),
        F.lit(0).alias("fetched_count"),
        F.lit(0.0).cast("float").alias("fetched_percentage"),
        F.lit(False).alias("is_complete"),
        at.alias("last_updated"),
    )


def of_league(df: DataFrame, league_id: int) -> DataFrame:
    """Tracking or progress rows of one league."""
    return df.filter(F.col("league_id") == league_id)


def fetched(tracking: DataFrame, flag: bool = True) -> DataFrame:
    """Fixtures with (or without) statistics."""
    return tracking.filter(F.col("is_fetched_stat") == flag)


def league_ids(progress: DataFrame) -> DataFrame:
    """M7: all tracked leagues."""
    return progress.select("league_id").distinct()


def incomplete(progress: DataFrame) -> DataFrame:
    """M7: leagues and seasons that still miss fixtures."""
    return progress.filter(~F.col("is_complete"))


def progress_summary(progress: DataFrame) -> DataFrame:
    """M8: one row over all leagues; ``progress`` itself is the detail."""
    totals = progress.agg(
        F.count(F.lit(1)).alias("total_leagues"),
        F.coalesce(F.sum("total_fixtures"), F.lit(0)).alias("total_fixtures"),
        F.coalesce(F.sum("fetched_count"), F.lit(0)).alias("total_fetched"),
        F.count_if(~F.col("is_complete")).alias("incomplete_leagues"),
    )
    done = _share(F.col("total_fetched"), F.col("total_fixtures"))
    return totals.withColumn("overall_completion", done)


def next_batch(tracking: DataFrame, progress: DataFrame, limit: int = 10) -> DataFrame:
    """G1, M9: the next unfetched fixtures, incomplete leagues first, in a total order.

    Only leagues known to ``progress`` count.  A top-k: no full sort, no gathering.
    """
    leagues = progress.select("league_id", F.col("year").alias("season"), "is_complete")
    return (
        fetched(tracking, False)
        .join(leagues, ["league_id", "season"])
        .orderBy("is_complete", "league_id", "season", "fixture_id")
        .limit(limit)
        .select(*tracking.columns)
    )


def reset_fixtures(tracking: DataFrame, ids: DataFrame, keep_rows: bool = False) -> DataFrame:
    """Forget fixtures, or with ``keep_rows`` mark them unfetched for another fetch."""
    if not keep_rows:
        return tracking.join(ids.select("fixture_id"), "fixture_id", "left_anti").select(
            *tracking.columns
        )
    marked = ids.select("fixture_id").distinct().withColumn("__reset", F.lit(True))
    joined = tracking.join(marked, "fixture_id", "left")
    hit = F.col("__reset").isNotNull()
    return joined.withColumns(
        {
            "is_fetched_stat": F.when(hit, False).otherwise(F.col("is_fetched_stat")),
            "fetch_stat_time": F.when(~hit, F.col("fetch_stat_time")),
        }
    ).select(*tracking.columns)


def reset_league(tracking: DataFrame, league_id: int, keep_rows: bool = False) -> DataFrame:
    """M10 for every fetched fixture of a league."""
    return reset_fixtures(tracking, of_league(fetched(tracking), league_id), keep_rows)


def untracked(payloads: DataFrame, tracking: DataFrame) -> DataFrame:
    """Payload rows whose fixture is not marked as fetched."""
    return payloads.join(fetched(tracking).select("fixture_id"), "fixture_id", "left_anti")


def reconcile(payloads: DataFrame, tracking: DataFrame) -> DataFrame:
    """Payload rows without the untracked ones."""
    return payloads.join(fetched(tracking).select("fixture_id"), "fixture_id", "left_semi")


def fixture_status(tracking: DataFrame, fixture_id: int) -> DataFrame:
    """The tracking row of one fixture, if any."""
    return tracking.filter(F.col("fixture_id") == fixture_id)


def add_leagues(progress: DataFrame, leagues: DataFrame, at: Column) -> DataFrame:
    """Empty progress rows for the (league_id, year) pairs not tracked yet."""
    pairs = leagues.select(
        F.col("league_id").cast("bigint"), F.col("year").cast("int")
    ).distinct()
    empty = _nothing(pairs.join(progress, list(PROGRESS_KEYS), "left_anti"), at)
    return progress.unionByName(empty)


def league_season_grid(leagues: DataFrame, seasons: Sequence[int]) -> DataFrame:
    """Every league with every season of a given list, as rows to load.

    The seasons are call arguments, so each league row is expanded in place; no join.
    """
    wanted = F.array(*[F.lit(int(s)) for s in seasons])
    return leagues.select("league_id").distinct().select("league_id", F.explode(wanted).alias("year"))
