"""Typed tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from touchline.functions import parsing
from touchline.operators.history import (
    history_from_changes,
    history_from_snapshot,
    newest_per_key,
)
from touchline.operators.nested import column_or, map_columns
from touchline.operators.pivot import pivot_entries, pivot_rows
from touchline.operators.quality import drop_violations, gate
from touchline.schemas import table_layout
from touchline.sources.landing import FILE_PATH, FILE_TIME, INGESTED, SOURCE_FILE

# Fixed values: (flattened source, target, type) of every carried column.
LEAGUE_MAP = (
    ("league_id", "league_id", "bigint"),
    ("league_name", "name", "string"),
    ("league_type", "type", "string"),
    ("league_logo", "logo", "string"),
    ("country_name", "country", "string"),
    ("country_flag", "country_flag", "string"),
)

TEAM_MAP = (
    ("team_id", "team_id", "bigint"),
    ("team_name", "name", None),
    ("team_code", "code", None),
    ("team_country", "country", None),
    ("team_founded", "founded", "int"),
    ("team_national", "national", None),
    ("team_logo", "logo", None),
    ("venue_id", "stadium_id", "bigint"),
    ("venue_name", "stadium_name", None),
    ("venue_address", "stadium_address", None),
    ("venue_city", "city", None),
    ("venue_capacity", "capacity", "bigint"),
    ("venue_image", "stadium_image", None),
    ("venue_surface", "stadium_surface", None),
    ("ingestion_time", "ingestion_time", "timestamp"),
)

FIXTURE_MAP = (
    ("fixture_id", "fixture_id", "bigint"),
    ("fixture_referee", "referee", None),
    ("fixture_timezone", "timezone", None),
    ("fixture_day", "date", "date"),
    ("fixture_timestamp", "timestamp", "bigint"),
    ("fixture_periods_first", "first_period", "timestamp"),
    ("fixture_periods_second", "second_period", "timestamp"),
    ("fixture_venue_id", "stadium_id", "bigint"),
    ("fixture_status_long", "status", None),
    ("fixture_status_elapsed", "elapsed", "int"),
    ("league_id", "league_id", "bigint"),
    ("league_season", "season", "int"),
    ("league_round", "round", None),
    ("league_standings", "league_standings", None),
    ("teams_home_id", "home_team_id", "bigint"),
    ("teams_away_id", "away_team_id", "bigint"),
    ("goals_home", "goals_home", "int"),
    ("goals_away", "goals_away", "int"),
    ("score_halftime_home", "score_halftime_home", "int"),
    ("score_halftime_away", "score_halftime_away", "int"),
    ("score_fulltime_home", "score_fulltime_home", "int"),
    ("score_fulltime_away", "score_fulltime_away", "int"),
    ("score_extratime_home", "score_extratime_home", "int"),
    ("score_extratime_away", "score_extratime_away", "int"),
    ("score_penalty_home", "score_penalty_home", "int"),
    ("score_penalty_away", "score_penalty_away", "int"),
    ("ingestion_time", "ingestion_time", "timestamp"),
)

# Columns a payload may lack; they count as 0 then.
OPTIONAL_SCORES = tuple(
    f"score_{part}_{side}" for part in ("extratime", "penalty") for side in ("home", "away")
)

# Statistic type in the payload and its parser, by target column.
STATISTICS = {
    "shots_on_goal": ("Shots on Goal", parsing.whole),
    "shots_off_goal": ("Shots off Goal", parsing.whole),
    "blocked_shots": ("Blocked Shots", parsing.whole),
    "shots_insidebox": ("Shots insidebox", parsing.whole),
    "shots_outsidebox": ("Shots outsidebox", parsing.whole),
    "fouls": ("Fouls", parsing.whole),
    "offsides": ("Offsides", parsing.whole),
    "corner_kicks": ("Corner Kicks", parsing.whole),
    "ball_possession": ("Ball Possession", parsing.percent_whole),
    "yellow_cards": ("Yellow Cards", parsing.whole),
    "red_cards": ("Red Cards", parsing.whole),
    "goalkeeper_saves": ("Goalkeeper Saves", parsing.whole),
    "total_passes": ("Total passes", parsing.whole),
    "accurate_passes": ("Passes accurate", parsing.whole),
    "passes_success_percentage": ("Passes %", parsing.percent_real),
    "expected_goals_rate": ("expected_goals", parsing.real_2),
}

# Statistics that are left out of a payload when nothing happened.
ZERO_WHEN_MISSING = ("yellow_cards", "red_cards", "offsides", "fouls", "corner_kicks")


def leagues(bronze: DataFrame, check: bool = True) -> DataFrame:
    """One row per league; with ``check`` an invalid table is refused."""
    rows = newest_per_key(map_columns(bronze, LEAGUE_MAP), ["league_id"])
    return gate(rows, "silver_leagues") if check else rows


# Columns that order rows of one ingestion time: the later file, then the larger name and path.
FILE_ORDER = (FILE_TIME, SOURCE_FILE, FILE_PATH)


def _file_order(bronze: DataFrame) -> tuple[tuple[str, str, None], ...]:
    return tuple((c, c, None) for c in FILE_ORDER if c in bronze.columns)


def _history(changes: DataFrame, key: str, ignore: tuple[str, ...] | None) -> DataFrame:
    """Versions by ingestion time; equal times are decided by the file, which then goes."""
    files = [c for c in FILE_ORDER if c in changes.columns]
    ignored = (INGESTED,) if ignore is None else ignore
    return history_from_changes(changes, [key], INGESTED, (*ignored, *files), files).drop(*files)


def team_changes(bronze: DataFrame) -> DataFrame:
    """Typed team rows that have an id, ready for the history."""
    rows = map_columns(bronze, (*TEAM_MAP, *_file_order(bronze)))
    return drop_violations(rows, valid_team_id="team_id IS NOT NULL")


def teams(changes: DataFrame, ignore: tuple[str, ...] | None = None) -> DataFrame:
    """Team history."""
    return _history(changes, "team_id", ignore)


def fixture_changes(bronze: DataFrame) -> DataFrame:
    """Typed fixture rows, ready for the history."""
    optional = {c: column_or(bronze, c, 0, "int") for c in OPTIONAL_SCORES}
    day = parsing.iso_day(F.col("fixture_date"))
    described = bronze.withColumns(optional | {"fixture_day": day})
    return map_columns(described, (*FIXTURE_MAP, *_file_order(bronze)))


def fixtures(changes: DataFrame, ignore: tuple[str, ...] | None = None) -> DataFrame:
    """Fixture history."""
    return _history(changes, "fixture_id", ignore)


STAT_KEYS = ("fixture_id", "team_id", "ingestion_time")


def _filled(rows: DataFrame) -> DataFrame:
    return rows.fillna(0, list(ZERO_WHEN_MISSING)).select(
        *table_layout("silver_fixture_stats").names
    )


def stats_from_rows(bronze: DataFrame) -> DataFrame:
    """N19 pivot over the flattened rows of ``bronze.fixture_stats``."""
    renamed = bronze.withColumnRenamed("stats_team_id", "team_id")
    pivoted = pivot_rows(
        renamed, STAT_KEYS, "stats_statistics_type", "stats_statistics_value", STATISTICS
    )
    return _filled(pivoted)


def stats_from_payloads(raw: DataFrame) -> DataFrame:
    """N19 pivot straight from stamped payloads: no explode per statistic, no shuffle, and
    therefore no state on a stream (J3).  One row per payload and team."""
    per_team = raw.select("fixture_id", "ingestion_time", F.explode_outer("stats").alias("entry"))
    return _filled(
        pivot_entries(
            per_team,
            F.col("entry.statistics"),
            STATISTICS,
            "fixture_id",
            F.col("entry.team.id").alias("team_id"),
            "ingestion_time",
        )
    )


def merge_stats(rows: DataFrame) -> DataFrame:
    """One row per fixture, team and ingestion time: maximum of every statistic."""
    return rows.groupBy(*STAT_KEYS).agg(
        *[F.max(c).alias(c) for c in rows.columns if c not in STAT_KEYS]
    ).select(*rows.columns)


def newest_stats(rows: DataFrame) -> DataFrame:
    """The snapshot form: the latest ingestion of each fixture and team."""
    return newest_per_key(rows, ["fixture_id", "team_id"], ["ingestion_time"])


def fixture_stats(
    history: DataFrame | None, rows: DataFrame, at: Column, ignore: tuple[str, ...] = ("ingestion_time",)
) -> DataFrame:
    """Statistics history after one more snapshot (K2)."""
    return history_from_snapshot(
        history, newest_stats(rows), ["fixture_id", "team_id"], at, ignore
    )
