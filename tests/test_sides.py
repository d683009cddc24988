"""H1-H3, N11, D5"""

from pyspark.sql import functions as F

from touchline.operators import sides

DDL = (
    "fixture_id BIGINT, home_team_id BIGINT, away_team_id BIGINT, goals_home INT, goals_away INT, "
    "score_halftime_home INT, score_halftime_away INT, score_fulltime_home INT, "
    "score_fulltime_away INT, score_extratime_home INT, score_extratime_away INT, "
    "score_penalty_home INT, score_penalty_away INT"
)


def fixtures(spark):
    return spark.createDataFrame(
        [
            (1, 10, 20, 3, 1, 1, 0, 3, 1, None, None, None, None),
            (2, 20, 10, None, None, None, None, None, None, None, None, None, None),
            (3, 10, 30, 2, 2, 1, 2, 2, 2, 0, 0, 4, 5),
        ],
        DDL,
    )


def test_sides_are_not_swapped(spark, rows):
    got = rows(
        sides.team_goals(fixtures(spark)),
        "fixture_id", "team_id", "goals_scored", "goals_conceded", "goals_scored_first_half",
        "goals_scored_second_half", "goals_conceded_second_half", "goals_scored_penalty",
    )
    assert got == [
        (1, 10, 3, 1, 1, 2, 1, None),
        (1, 20, 1, 3, 0, 1, 2, None),
        (2, 10, None, None, None, None, None, None),
        (2, 20, None, None, None, None, None, None),
        (3, 10, 2, 2, 1, 1, 0, 4),
        (3, 30, 2, 2, 2, 0, 1, 5),
    ]


def test_scored_equals_conceded_in_total(spark):
    total = sides.team_goals(fixtures(spark)).agg(
        F.sum("goals_scored"), F.sum("goals_conceded")
    ).first()
    assert total[0] == total[1] == 8


def test_summary_counts_unknown_as_zero(spark, rows):
    got = sides.goals_summary(fixtures(spark)).filter("fixture_id = 2 AND team_id = 10").first()
    assert set(tuple(got)[2:]) == {0} and len(got) == 12
    assert "total_goals_scored_extra_time" in got.__fields__


def test_goals_of_agrees_with_the_join(spark, rows):
    games = fixtures(spark)
    teams = spark.createDataFrame(
        [(1, 10), (1, 20), (1, 30), (3, 30), (3, None)], "fixture_id BIGINT, team_id BIGINT"
    )
    joined = teams.join(sides.team_goals(games), ["fixture_id", "team_id"], "left")
    in_place = teams.join(games, "fixture_id").select(
        "fixture_id", "team_id",
        *sides.goals_of(F.col("team_id"), F.col("home_team_id"), F.col("away_team_id")),
    )
    assert rows(in_place) == rows(joined)


def test_one_scan(spark):
    plan = sides.team_goals(fixtures(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Union" not in plan and "Exchange" not in plan
