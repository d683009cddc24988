"""Declared layouts, one DDL text per table.

Fixed values: column names and types equal those of the data this library replaces
(two misspelt names are written correctly, see README).  ``NOT NULL`` marks the columns
the quality rules check (L1).
"""

from __future__ import annotations

from pyspark.sql.types import StructType

# --- landed payloads -------------------------------------------------------------

RAW_FIXTURE = """
    fixture STRUCT<
        id: INT, referee: STRING, timezone: STRING, date: STRING, timestamp: BIGINT,
        periods: STRUCT<first: TIMESTAMP, second: TIMESTAMP>,
        venue: STRUCT<id: BIGINT, name: STRING, city: STRING>,
        status: STRUCT<long: STRING, short: STRING, elapsed: INT, extra: INT>>,
    league STRUCT<
        id: BIGINT, name: STRING, country: STRING, logo: STRING, flag: STRING,
        season: INT, round: STRING, standings: BOOLEAN>,
    teams STRUCT<
        home: STRUCT<id: BIGINT, name: STRING, logo: STRING, winner: BOOLEAN>,
        away: STRUCT<id: BIGINT, name: STRING, logo: STRING, winner: BOOLEAN>>,
    goals STRUCT<home: INT, away: INT>,
    score STRUCT<
        halftime: STRUCT<home: INT, away: INT>,
        fulltime: STRUCT<home: INT, away: INT>,
        extratime: STRUCT<home: INT, away: INT>,
        penalty: STRUCT<home: INT, away: INT>>
"""

RAW_FIXTURE_STATS = """
    fixture_id BIGINT,
    stats ARRAY<STRUCT<
        statistics: ARRAY<STRUCT<type: STRING, value: STRING>>,
        team: STRUCT<id: BIGINT, name: STRING, logo: STRING>>>,
    fetched_at TIMESTAMP,
    league_id BIGINT
"""

RAW_TEAM = """
    team STRUCT<
        id: INT, name: STRING, code: STRING, country: STRING, founded: INT,
        national: BOOLEAN, logo: STRING>,
    venue STRUCT<
        id: INT, name: STRING, address: STRING, city: STRING, capacity: INT,
        image: STRING, surface: STRING>
"""

# The season array is called ``season`` or ``seasons`` depending on the feed, hence the slot.
_RAW_LEAGUE = """
    league STRUCT<id: BIGINT, name: STRING, type: STRING, logo: STRING>,
    {seasons} ARRAY<STRUCT<
        year: INT, start: STRING, end: STRING, current: BOOLEAN,
        coverage: STRUCT<
            fixtures: STRUCT<
                events: BOOLEAN, lineups: BOOLEAN,
                statistics_fixtures: BOOLEAN, statistics_players: BOOLEAN>,
            standings: BOOLEAN, players: BOOLEAN, top_scorers: BOOLEAN,
            top_assists: BOOLEAN, top_cards: BOOLEAN, injuries: BOOLEAN,
            predictions: BOOLEAN, odds: BOOLEAN>>>,
    country STRUCT<name: STRING, code: STRING, flag: STRING>
"""

ENVELOPE = "record_id BIGINT, json_data STRING, ingestion_timestamp STRING"

# --- typed tables ------------------------------------------------------------------

_FIXTURE_BODY = """
    fixture_id BIGINT NOT NULL, referee STRING, timezone STRING, date DATE NOT NULL,
    timestamp BIGINT, first_period TIMESTAMP, second_period TIMESTAMP, stadium_id BIGINT,
    status STRING NOT NULL, elapsed INT NOT NULL, league_id BIGINT NOT NULL,
    season INT NOT NULL, round STRING NOT NULL, league_standings BOOLEAN,
    home_team_id BIGINT NOT NULL, away_team_id BIGINT NOT NULL,
    goals_home INT NOT NULL, goals_away INT NOT NULL,
    score_halftime_home INT NOT NULL, score_halftime_away INT NOT NULL,
    score_fulltime_home INT NOT NULL, score_fulltime_away INT NOT NULL,
    score_extratime_home INT, score_extratime_away INT,
    score_penalty_home INT, score_penalty_away INT
"""

_STATISTICS = """
    shots_on_goal INT, shots_off_goal INT, blocked_shots INT, shots_insidebox INT,
    shots_outsidebox INT, fouls INT, offsides INT, corner_kicks INT, ball_possession INT,
    yellow_cards INT, red_cards INT, goalkeeper_saves INT, total_passes INT,
    accurate_passes INT, passes_success_percentage FLOAT, expected_goals_rate FLOAT
"""

_TEAM_BODY = """
    team_id BIGINT NOT NULL, name STRING NOT NULL, code STRING, country STRING,
    founded INT, national BOOLEAN, logo STRING, stadium_id BIGINT, stadium_name STRING,
    stadium_address STRING, city STRING, capacity BIGINT, stadium_image STRING,
    stadium_surface STRING
"""

_LEAGUE_BODY = """
    league_id BIGINT NOT NULL, name STRING NOT NULL, type STRING NOT NULL, logo STRING,
    country STRING, country_flag STRING
"""

_VALIDITY = "__START_AT TIMESTAMP NOT NULL, __END_AT TIMESTAMP"

TABLES = {
    "silver_fixtures": f"{_FIXTURE_BODY}, ingestion_time TIMESTAMP",
    "silver_fixture_history": f"{_FIXTURE_BODY}, ingestion_time TIMESTAMP, {_VALIDITY}",
    "silver_fixture_stats": f"""
        fixture_id BIGINT NOT NULL, team_id BIGINT NOT NULL, {_STATISTICS},
        ingestion_time TIMESTAMP NOT NULL""",
    "silver_teams": f"{_TEAM_BODY}, ingestion_time TIMESTAMP",
    "silver_leagues": _LEAGUE_BODY,
    "dim_dates": """
        date_key INT NOT NULL, date DATE NOT NULL, year INT NOT NULL, month INT NOT NULL,
        month_name STRING NOT NULL, quarter INT NOT NULL, week_of_year INT NOT NULL,
        day_of_month INT NOT NULL, day_of_week INT NOT NULL, day_of_year INT NOT NULL,
        is_weekend BOOLEAN NOT NULL, day_name STRING NOT NULL, day_name_short STRING,
        month_name_short STRING NOT NULL, season STRING, match_day_category STRING""",
    "dim_leagues": f"league_key BIGINT NOT NULL, {_LEAGUE_BODY}",
    "dim_teams": f"""
        team_key BIGINT NOT NULL, {_TEAM_BODY}, team_age INT,
        capacity_category STRING NOT NULL""",
    "dim_fixtures": f"""
        fixture_key BIGINT NOT NULL, {_FIXTURE_BODY}, score_fulltime STRING NOT NULL,
        score_halftime STRING NOT NULL, score_extratime STRING, {_VALIDITY}""",
    "dim_fixture_stats": f"""
        fixture_stat_key BIGINT NOT NULL, fixture_id BIGINT NOT NULL,
        team_id BIGINT NOT NULL, league_id BIGINT NOT NULL, {_STATISTICS}, {_VALIDITY}""",
    "fact_match_result": """
        match_key BIGINT NOT NULL, dim_fixture_key BIGINT NOT NULL,
        dim_date_key INT NOT NULL, dim_home_team_key BIGINT NOT NULL,
        dim_away_team_key BIGINT NOT NULL, dim_league_key BIGINT NOT NULL,
        league_name STRING NOT NULL, home_team_name STRING NOT NULL,
        away_team_name STRING NOT NULL, season STRING NOT NULL, round STRING NOT NULL,
        match_status STRING NOT NULL, first_period TIMESTAMP NOT NULL,
        second_period TIMESTAMP NOT NULL, elapsed INT NOT NULL,
        goals_home INT NOT NULL, goals_away INT NOT NULL,
        score_halftime_home INT NOT NULL, score_halftime_away INT NOT NULL,
        score_fulltime_home INT NOT NULL, score_fulltime_away INT NOT NULL,
        score_extratime_home INT NOT NULL, score_extratime_away INT NOT NULL,
        score_penalty_home INT NOT NULL, score_penalty_away INT NOT NULL,
        total_goals INT NOT NULL, goal_diff INT NOT NULL, match_result STRING NOT NULL,
        is_draw BOOLEAN NOT NULL, is_home_win BOOLEAN NOT NULL,
        is_away_win BOOLEAN NOT NULL, is_league_standings BOOLEAN NOT NULL""",
    "fact_match_stats": f"""
        match_statistic_key BIGINT NOT NULL, dim_fixture_key BIGINT NOT NULL,
        dim_fixture_stat_key BIGINT NOT NULL, dim_date_key BIGINT NOT NULL,
        dim_team_key BIGINT NOT NULL, dim_league_key BIGINT NOT NULL,
        fixture_id BIGINT NOT NULL, team_id BIGINT NOT NULL, league_name STRING NOT NULL,
        team_name STRING NOT NULL, season STRING NOT NULL, round STRING NOT NULL,
        is_league_standings BOOLEAN NOT NULL, match_result STRING NOT NULL,
        match_status STRING NOT NULL, first_period TIMESTAMP NOT NULL,
        second_period TIMESTAMP NOT NULL, elapsed INT NOT NULL,
        goals_scored INT NOT NULL, goals_conceded INT NOT NULL,
        goals_scored_first_half INT NOT NULL, goals_conceded_first_half INT NOT NULL,
        goals_scored_second_half INT NOT NULL, goals_conceded_second_half INT NOT NULL,
        goals_scored_extratime INT NOT NULL, goals_conceded_extratime INT NOT NULL,
        goals_scored_penalty INT NOT NULL, goals_conceded_penalty INT NOT NULL,
        {_STATISTICS}""",
    "fact_team_result": """
        round STRING, season STRING, dim_fixture_key BIGINT, league_name STRING,
        dim_team_key BIGINT, team_name STRING, goal_scored INT, goal_conceded INT,
        key BIGINT, win BOOLEAN, lose BOOLEAN, draw BOOLEAN""",
    "fact_team_result_summary": """
        dim_team_key BIGINT, team_name STRING, season STRING, competition STRING,
        match_played BIGINT, total_win BIGINT, total_lose BIGINT, total_draw BIGINT,
        total_goals_scored BIGINT, total_goals_conceded BIGINT, win_percentage DOUBLE""",
    "fixture_tracking": """
        fixture_id BIGINT NOT NULL, league_id BIGINT NOT NULL, season INT NOT NULL,
        is_fetched_stat BOOLEAN NOT NULL, fetch_stat_time TIMESTAMP""",
    "league_progress": """
        league_id BIGINT NOT NULL, year INT NOT NULL, total_fixtures INT NOT NULL,
        fetched_count INT NOT NULL, fetched_percentage FLOAT NOT NULL,
        is_complete BOOLEAN NOT NULL, last_updated TIMESTAMP""",
}


def layout(ddl: str) -> StructType:
    """DDL text to StructType."""
    return StructType.fromDDL(ddl)


def table_layout(name: str) -> StructType:
    return layout(TABLES[name])


def raw_league_ddl(seasons: str = "season") -> str:
    return _RAW_LEAGUE.format(seasons=seasons)
