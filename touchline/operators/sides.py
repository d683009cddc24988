"""One row per match to one row per team and match."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from touchline.functions.scores import second_half

SidePair = tuple[Column, Column]


def split_sides(
    df: DataFrame, keep: Sequence[str], pairs: Mapping[str, SidePair]
) -> DataFrame:
    """H3: every row becomes a home row and an away row, matched by column name.

    ``pairs`` maps an output column to its (home view, away view).  One scan, no union.
    """
    views = [
        F.struct(*[pair[side].alias(name) for name, pair in pairs.items()]) for side in (0, 1)
    ]
    return df.select(*keep, F.inline(F.array(*views)))


def _both(home: Column, away: Column) -> dict[str, SidePair]:
    return {"scored": (home, away), "conceded": (away, home)}


def goal_pairs(prefix: str = "") -> dict[str, SidePair]:
    """The ten goal measures of a fixture as (home view, away view)."""

    def score(part: str) -> tuple[Column, Column]:
        return tuple(F.col(f"{prefix}score_{part}_{s}") for s in ("home", "away"))

    half, full = score("halftime"), score("fulltime")
    parts = {
        "": (F.col(f"{prefix}goals_home"), F.col(f"{prefix}goals_away")),
        "_first_half": half,
        "_second_half": tuple(second_half(f, h) for f, h in zip(full, half)),
        "_extratime": score("extratime"),
        "_penalty": score("penalty"),
    }
    return {
        f"goals_{role}{suffix}": pair
        for suffix, sides in parts.items()
        for role, pair in _both(*sides).items()
    }


def team_goals(fixtures: DataFrame) -> DataFrame:
    """H1: (fixture_id, team_id, ten goal measures), two rows per fixture."""
    teams = {"team_id": (F.col("home_team_id"), F.col("away_team_id"))}
    return split_sides(fixtures, ["fixture_id"], teams | goal_pairs())


def goals_summary(fixtures: DataFrame) -> DataFrame:
    """N11 for all teams and fixtures at once: H1 with unknown goals counted as 0."""
    measures = {
        name: f"total_{name}".replace("extratime", "extra_time") for name in goal_pairs()
    }
    renamed = team_goals(fixtures).withColumnsRenamed(measures)
    return renamed.fillna(0, list(measures.values()))


def goals_of(team: Column, home_team: Column, away_team: Column, prefix: str = "") -> list[Column]:
    """D5 without a join: goal measures of ``team`` on a row that holds its fixture.

    A team that did not play the fixture gets nulls, as the left join would give.
    """
    return [
        F.when(team == home_team, home).when(team == away_team, away).alias(name)
        for name, (home, away) in goal_pairs(prefix).items()
    ]
