"""Star schema: dimensions, facts and team summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from touchline.functions import scores
from touchline.functions.calendar import calendar, calendar_covering  # noqa: F401  (N1)
from touchline.operators.history import END, START, current
from touchline.operators.keys import dense_key, refusing_copies
from touchline.operators.sides import goals_of, split_sides
from touchline.schemas import table_layout


def _open_versions(silver: DataFrame, all_versions: bool) -> DataFrame:
    return silver if all_versions or END not in silver.columns else current(silver)


def _laid_out(df: DataFrame, table: str) -> DataFrame:
    """The declared columns in their order; a missing one is an error.

    Only the validity of versions is left out where the input has no versions.
    """
    names = [c for c in table_layout(table).names if c in df.columns or c not in (START, END)]
    missing = [c for c in names if c not in df.columns]
    if missing:
        raise ValueError(f"{table}: missing columns {', '.join(missing)}")
    return df.select(*names)


# --- dimensions --------------------------------------------------------------------


def dim_leagues(silver: DataFrame) -> DataFrame:
    """N2"""
    return _laid_out(dense_key(silver, "league_key", ["league_id"]), "dim_leagues")


def dim_teams(
    silver: DataFrame, as_of: Column | None = None, all_versions: bool = False
) -> DataFrame:
    """N3; ``as_of`` fixes the day for ``team_age`` (today when left out)."""
    rows = _open_versions(silver, all_versions)
    described = rows.withColumns(
        {
            "team_age": scores.years_since(F.col("founded"), as_of),
            "capacity_category": scores.venue_class(F.col("capacity")),
        }
    )
    order = ["team_id", START] if all_versions else ["team_id"]
    return _laid_out(dense_key(described, "team_key", order), "dim_teams")


def dim_fixtures(silver: DataFrame, all_versions: bool = False) -> DataFrame:
    """N4"""
    rows = _open_versions(silver, all_versions).drop("ingestion_time")
    texts = {
        f"score_{part}": scores.score_text(
            F.col(f"score_{part}_home"), F.col(f"score_{part}_away")
        )
        for part in ("fulltime", "halftime", "extratime")
    }
    order = ["fixture_id", START] if all_versions else ["fixture_id"]
    return _laid_out(dense_key(rows.withColumns(texts), "fixture_key", order), "dim_fixtures")


def dim_fixture_stats(
    silver_stats: DataFrame, silver_fixtures: DataFrame, all_versions: bool = False
) -> DataFrame:
    """Statistics with the league of their fixture."""
    rows = _open_versions(silver_stats, all_versions).drop("ingestion_time")
    leagues = _open_versions(silver_fixtures, False).select("fixture_id", "league_id")
    order = ["fixture_id", "team_id", *([START] if all_versions else [])]
    keyed = dense_key(rows, "fixture_stat_key", order)
    return _laid_out(keyed.join(leagues, "fixture_id", "left"), "dim_fixture_stats")


def unnumbered_fixtures(silver: DataFrame) -> DataFrame:
    """N4 for results that hold no fixture key: rows neither dealt by range nor written.

    Null keys are met first, since a join on the key drops them before their copies are.
    """
    rows = _open_versions(silver, False)
    if len(rows.filter("fixture_id is null").select("fixture_id").head(2)) > 1:
        raise ValueError("fixture_key: duplicate order key")
    return refusing_copies(rows, "fixture_key", ["fixture_id"])


def unnumbered_stats(silver_stats: DataFrame) -> DataFrame:
    """N5 likewise, without the league of the fixture."""
    rows = _open_versions(silver_stats, False)
    return refusing_copies(rows, "fixture_stat_key", ["fixture_id", "team_id"])


# --- match facts ---------------------------------------------------------------------


def _team_role(teams: DataFrame, role: str) -> DataFrame:
    """The team dimension in the role of home or away side."""
    return teams.select(
        F.col("team_id").alias(f"{role}_team_id"),
        F.col("team_key").alias(f"dim_{role}_team_key"),
        F.col("name").alias(f"{role}_team_name"),
    )


def _league_part(leagues: DataFrame) -> DataFrame:
    return leagues.select(
        "league_id",
        F.col("league_key").alias("dim_league_key"),
        F.col("name").alias("league_name"),
        *_copies(leagues),
    )


def _date_part(dates: DataFrame) -> DataFrame:
    return dates.select("date", F.col("date_key").alias("dim_date_key"), "season", *_copies(dates))


def match_star(
    fixtures: DataFrame, teams: DataFrame, leagues: DataFrame, dates: DataFrame
) -> DataFrame:
    """Fixtures with both teams, league and date; one without any of them is dropped.

    Dimensions are joined unhinted: the planner broadcasts a side it knows (or, at run
    time, measures) to be small and shuffles otherwise, splitting hot keys.
    """
    facts = fixtures.withColumnRenamed("season", "season_year").withColumnsRenamed(
        {
            "fixture_key": "dim_fixture_key",
            "status": "match_status",
            "league_standings": "is_league_standings",
        }
    )
    return (
        facts.join(_date_part(dates), "date")
        .join(_league_part(leagues), "league_id")
        .join(_team_role(teams, "home"), "home_team_id")
        .join(_team_role(teams, "away"), "away_team_id")
    )


def fact_match_result(
    fixtures: DataFrame, teams: DataFrame, leagues: DataFrame, dates: DataFrame
) -> DataFrame:
    """One row per fixture with its outcome."""
    home, away = F.col("goals_home"), F.col("goals_away")
    star = match_star(fixtures, teams, leagues, dates).select(
        "*",
        scores.total_goals(home, away).alias("total_goals"),
        scores.goal_difference(home, away).alias("goal_diff"),
        scores.match_label(home, away).alias("match_result"),
        *scores.outcome_flags(home, away, ("is_home_win", "is_away_win", "is_draw")),
    )
    keyed = dense_key(star, "match_key", ["dim_fixture_key"])
    return _laid_out(keyed, "fact_match_result")


def fact_team_result(
    fixtures: DataFrame, teams: DataFrame, leagues: DataFrame, dates: DataFrame
) -> DataFrame:
    """One row per team and fixture (H2).

    ``key`` is twice the fixture key plus the side: unique and the same in every run (F2).
    """
    star = match_star(fixtures, teams, leagues, dates)
    home, away = F.col("goals_home"), F.col("goals_away")
    fixture = F.col("dim_fixture_key")
    rows = split_sides(
        star,
        ["round", "season", "dim_fixture_key", "league_name"],
        {
            "dim_team_key": (F.col("dim_home_team_key"), F.col("dim_away_team_key")),
            "team_name": (F.col("home_team_name"), F.col("away_team_name")),
            "goal_scored": (home, away),
            "goal_conceded": (away, home),
            "key": (fixture * 2, fixture * 2 + 1),
        },
    )
    flags = scores.outcome_flags(
        F.col("goal_scored"), F.col("goal_conceded"), ("win", "lose", "draw")
    )
    return rows.select("*", *flags)


def fact_team_result_summary(team_results: DataFrame) -> DataFrame:
    """Results per team, season and competition.

    The team key is part of the group, so that teams of equal name stay apart.
    """
    played = F.count("key")
    return team_results.groupBy(
        "dim_team_key", "team_name", "season", F.col("league_name").alias("competition")
    ).agg(
        played.alias("match_played"),
        F.count_if("win").alias("total_win"),
        F.count_if("lose").alias("total_lose"),
        F.count_if("draw").alias("total_draw"),
        F.sum("goal_scored").alias("total_goals_scored"),
        F.sum("goal_conceded").alias("total_goals_conceded"),
        (F.count_if("win") / played * 100).alias("win_percentage"),
    )


COPY = "__copy_"


def _with_copies(df: DataFrame, key: str) -> DataFrame:
    """The rows of each key counted on; shares the exchange and the sort of a join on it."""
    place = F.row_number().over(Window.partitionBy(key).orderBy(key))
    return df.withColumn(f"{COPY}{key}", place)


def _copies(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.startswith(COPY)]


# --- statistics facts ----------------------------------------------------------------


def stats_star(
    stats: DataFrame, fixtures: DataFrame, teams: DataFrame, dates: DataFrame
) -> DataFrame:
    """Statistics with fixture, date, team and the goals of that team.

    All joins are left joins on unique keys, so every statistics row appears once.  The
    fixture row already holds both scores, so the goals need no second join.
    """
    match = fixtures.select(
        F.col("fixture_id"),
        F.col("fixture_key").alias("dim_fixture_key"),
        "date",
        "round",
        F.col("league_standings").alias("is_league_standings"),
        F.col("status").alias("match_status"),
        "first_period",
        "second_period",
        "elapsed",
        "home_team_id",
        "away_team_id",
        "goals_home",
        "goals_away",
        *[c for c in fixtures.columns if c.startswith("score_") and c.endswith(("_home", "_away"))],
        *_copies(fixtures),
    )
    team = teams.select(
        "team_id",
        F.col("team_id").alias("known_team_id"),
        F.col("team_key").alias("dim_team_key"),
        F.col("name").alias("team_name"),
        *_copies(teams),
    )
    joined = (
        stats.withColumnRenamed("fixture_stat_key", "dim_fixture_stat_key")
        .join(match.withColumn("known_fixture_id", F.col("fixture_id")), "fixture_id", "left")
        .join(_date_part(dates), "date", "left")
        .join(team, "team_id", "left")
    )
    goals = goals_of(F.col("known_team_id"), F.col("home_team_id"), F.col("away_team_id"))
    return joined.select(
        *[c for c in joined.columns if c not in ("fixture_id", "team_id", "known_fixture_id", "known_team_id")],
        F.col("known_fixture_id").alias("fixture_id"),
        F.col("known_team_id").alias("team_id"),
        *goals,
    )


def fact_match_stats(
    stats: DataFrame,
    fixtures: DataFrame,
    teams: DataFrame,
    leagues: DataFrame,
    dates: DataFrame,
) -> DataFrame:
    """One row per fixture and team with statistics, goals and result.

    The narrow statistics rows are numbered before the joins, which keep each of them once:
    one that meets a dimension's key twice is refused.
    """
    keyed = dense_key(stats, "match_statistic_key", ["fixture_stat_key"])
    star = stats_star(
        keyed,
        _with_copies(fixtures, "fixture_id"),
        _with_copies(teams, "team_id"),
        _with_copies(dates, "date"),
    ).join(_league_part(_with_copies(leagues, "league_id")), "league_id", "left")
    again = F.greatest(*[F.coalesce(F.col(c), F.lit(1)) for c in _copies(star)]) > 1
    refused = F.raise_error(F.lit("match_statistic_key: duplicate order key"))
    rows = star.withColumns(
        {
            "match_result": scores.team_label(F.col("goals_scored"), F.col("goals_conceded")),
            "dim_date_key": F.col("dim_date_key").cast("bigint"),
        }
    )
    return _laid_out(rows.filter(F.when(again, refused).otherwise(True)), "fact_match_stats")


# Output name of the total and of the average of each measure.
TEAM_TOTALS = {
    "total_goals_scored": "goals_scored",
    "total_goals_conceded": "goals_conceded",
    "total_goals_firsthalf": "goals_scored_first_half",
    "total_goals_secondhalf": "goals_scored_second_half",
    "total_shots_on_goal": "shots_on_goal",
    "total_shots_off_goal": "shots_off_goal",
    "total_blocked_shots": "blocked_shots",
    "total_shots_insidebox": "shots_insidebox",
    "total_shots_outsidebox": "shots_outsidebox",
    "total_goalkeeper_saves": "goalkeeper_saves",
    "total_fouls": "fouls",
    "total_corner_kicks": "corner_kicks",
    "total_offsides": "offsides",
    "total_yellow_cards": "yellow_cards",
    "total_red_cards": "red_cards",
    "total_passes": "total_passes",
    "total_accurate_passes": "accurate_passes",
}
TEAM_AVERAGES = {
    "avg_goals_scored": "goals_scored",
    "avg_goals_conceded": "goals_conceded",
    "avg_shots_on_goal": "shots_on_goal",
    "avg_shots_insidebox": "shots_insidebox",
    "avg_shots_outsidebox": "shots_outsidebox",
    "avg_fouls": "fouls",
    "avg_corner_kicks": "corner_kicks",
    "avg_yellow_cards": "yellow_cards",
    "avg_red_cards": "red_cards",
    "avg_ball_possession": "ball_possession",
    "avg_pass_success_percentage": "passes_success_percentage",
    "avg_expected_goals_rate": "expected_goals_rate",
}
TEAM_SHARES = {  # fraction of the matches in which the measure is above zero (E4)
    "score_firsthalf_percentage": "goals_scored_first_half",
    "score_secondhalf_percentage": "goals_scored_second_half",
    "conceded_firsthalf_percentage": "goals_conceded_first_half",
    "conceded_secondhalf_percentage": "goals_conceded_second_half",
}


def fact_team_match_stats(
    stats: DataFrame,
    fixtures: DataFrame,
    teams: DataFrame,
    dates: DataFrame,
    extra_groups: Sequence[str] = (),
) -> DataFrame:
    """Statistics per team and season.

    Groups by team key as well as name, so that teams of equal name stay apart.
    """
    groups = ["dim_team_key", "team_name", "season", *extra_groups]
    played = F.count("dim_fixture_stat_key")
    summed = (
        stats_star(stats, fixtures, teams, dates)
        .groupBy(*groups)
        .agg(
            played.alias("match_played"),
            *[F.sum(c).alias(n) for n, c in TEAM_TOTALS.items()],
            *[F.avg(c).alias(n) for n, c in TEAM_AVERAGES.items()],
            *[
                F.try_divide(F.count_if(F.col(c) > 0), played).alias(n)
                for n, c in TEAM_SHARES.items()
            ],
        )
    )
    order = ["team_name", "season", "dim_team_key", *extra_groups]
    return dense_key(summed, "fact_key", order)
