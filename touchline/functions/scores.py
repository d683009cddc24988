"""Score, result and venue expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The venue classes and their lower bounds (exclusive).
LARGE_ABOVE = 100000
MEDIUM_ABOVE = 40000


def score_text(home: Column, away: Column) -> Column:
    """``"h-a"``; null when either side is null."""
    return F.concat(home.cast("string"), F.lit("-"), away.cast("string"))


def match_label(home: Column, away: Column) -> Column:
    """home_win / away_win / draw; null when either side is null."""
    return _three_way(home, away, "home_win", "away_win", "draw")


def team_label(scored: Column, conceded: Column) -> Column:
    """Win / loss / draw seen from one team; null when either side is null."""
    return _three_way(scored, conceded, "win", "loss", "draw")


def _three_way(left: Column, right: Column, more: str, less: str, same: str) -> Column:
    return F.when(left > right, more).when(left < right, less).when(left == right, same)


def total_goals(home: Column, away: Column) -> Column:
    """Goals of both sides."""
    return home + away


def goal_difference(home: Column, away: Column) -> Column:
    """Signed difference, positive for the home side."""
    return home - away


def second_half(full_time: Column, half_time: Column) -> Column:
    """Goals after the break."""
    return full_time - half_time


def outcome_flags(left: Column, right: Column, names: tuple[str, str, str]) -> list[Column]:
    """Three boolean columns (more, less, same); null scores give nulls."""
    more, less, same = names
    return [
        (left > right).alias(more),
        (left < right).alias(less),
        (left == right).alias(same),
    ]


def venue_class(
    capacity: Column, medium: int = MEDIUM_ABOVE, large: int = LARGE_ABOVE
) -> Column:
    """I8: large / medium / small; an unknown capacity counts as small."""
    return (
        F.when(capacity > large, "large").when(capacity > medium, "medium").otherwise("small")
    )


def years_since(year: Column, as_of: Column | None = None) -> Column:
    """Whole calendar years between ``year`` and the year of ``as_of`` (today)."""
    return F.year(F.current_date() if as_of is None else as_of) - year
