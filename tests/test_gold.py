"""Star schema on a small league, and the whole load from landed files."""

import json
import os
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from touchline.plans import bronze, catalog, gold, silver
from touchline.schemas import ENVELOPE, table_layout

AT = datetime(2024, 8, 1, 6)


def fixture(fid, home, away, day, goals, league=39, extra=None):
    pair = {"home": goals[0], "away": goals[1]}
    half = {"home": goals[0] and goals[0] // 2, "away": goals[1] and goals[1] // 2}
    return {
        "fixture": {
            "id": fid, "referee": "R", "timezone": "UTC", "date": f"{day}T15:00:00+00:00",
            "timestamp": 1700000000, "periods": {"first": 1700000000, "second": 1700003600},
            "venue": {"id": 1}, "status": {"long": "Match Finished", "elapsed": 90},
        },
        "league": {"id": league, "season": 2023, "round": "Regular Season - 1", "standings": True},
        "teams": {"home": {"id": home}, "away": {"id": away}},
        "goals": pair,
        "score": {"halftime": half, "fulltime": pair, "extratime": extra, "penalty": None},
    }


FIXTURES = [
    fixture(1, 10, 20, "2023-08-12", (3, 1)),
    fixture(2, 20, 10, "2024-02-29", (2, 2), extra={"home": 1, "away": 0}),
    fixture(3, 10, 20, "2024-07-31", (0, 1)),
    fixture(4, 10, 99, "2023-09-01", (5, 0)),  # unknown away team
    fixture(5, 10, 20, "2023-09-01", (4, 0), league=1000),  # unknown league
    fixture(6, 20, 10, "2023-10-01", (None, None)),  # not played
]


def entry(team, **values):
    return {"team": {"id": team}, "statistics": [{"type": k, "value": v} for k, v in values.items()]}


STATS = [
    {"fixture_id": 1, "league_id": 39, "stats": [
        entry(10, **{"Shots on Goal": "6", "Ball Possession": "60%", "Fouls": "3"}),
        entry(20, **{"Shots on Goal": "2", "Ball Possession": "40%"})]},
    {"fixture_id": 2, "league_id": 39, "stats": [
        entry(10, **{"Shots on Goal": "4", "Ball Possession": "50%"})]},
    {"fixture_id": 6, "league_id": 39, "stats": [entry(10, **{"Shots on Goal": "1"})]},
    {"fixture_id": 77, "league_id": 39, "stats": [entry(30, **{"Shots on Goal": "9"})]},
]


@pytest.fixture(scope="module")
def load(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    landing = root / "landing"
    files = {
        "fixtures/fixture_39_2023": FIXTURES,
        "fixture_stats/stats_39": STATS,
        "teams/teams_39": [
            {"team": {"id": 10, "name": "Reds", "founded": 1900}, "venue": {"id": 1, "capacity": 50000}},
            {"team": {"id": 20, "name": "Blues"}, "venue": {"id": 2, "capacity": None}},
        ],
        # the same team again in another file of the same load
        "teams/teams_140": [
            {"team": {"id": 10, "name": "Reds", "founded": 1900}, "venue": {"id": 1, "capacity": 50000}},
            {"team": {"name": "no id"}},
        ],
    }
    for name, records in files.items():
        path = landing / f"{name}.json"
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(json.dumps(records, indent=2))
    league = {
        "league": {"id": 39, "name": "First", "type": "League", "logo": "l"},
        "country": {"name": "England", "flag": "f"},
        "season": [{"year": 2022}, {"year": 2023}],
    }
    (landing / "leagues").mkdir()
    (landing / "leagues" / "l.json").write_text(
        json.dumps({"record_id": 0, "json_data": json.dumps(league), "ingestion_timestamp": "t"})
    )
    work = catalog.Load(spark, str(landing), str(root / "lake"), AT)
    catalog.run(work)
    return work


def test_every_table_is_written(load):
    for layer, name in catalog.TABLES:
        assert load.table(layer, name).columns, (layer, name)


@pytest.mark.parametrize(
    "name",
    ["dim_dates", "dim_leagues", "dim_fixture_stats", "dim_teams", "dim_fixtures",
     "fact_match_result", "fact_match_stats", "fact_team_result", "fact_team_result_summary"],
)
def test_layouts(load, name):
    declared = {f.name: f.dataType.simpleString() for f in table_layout(name)}
    step, _ = catalog.TABLES["gold", name]
    assert dict(step(load).dtypes) == declared


def test_silver(load, rows):
    assert load.table("bronze", "leagues").count() == 2
    assert rows(load.table("silver", "leagues"), "league_id", "country") == [(39, "England")]
    assert rows(load.table("silver", "teams"), "team_id", "name", "__END_AT") == [
        (10, "Reds", None), (20, "Blues", None),
    ]
    scores = rows(load.table("silver", "fixtures"), "fixture_id", "score_extratime_home")
    assert scores[:2] == [(1, None), (2, 1)]


def test_dimensions(load, rows):
    assert rows(load.table("gold", "dim_teams"), "team_key", "team_id", "team_age", "capacity_category") == [
        (1, 10, 124, "medium"), (2, 20, None, "small"),
    ]
    assert rows(load.table("gold", "dim_fixtures"), "fixture_key", "score_fulltime", "score_extratime")[:2] == [
        (1, "3-1", None), (2, "2-2", "1-0"),
    ]
    days = rows(load.table("gold", "dim_dates"), "date")
    assert (days[0][0], days[-1][0]) == (date(2023, 8, 12), date(2024, 7, 31))
    assert rows(load.table("gold", "dim_fixture_stats"), "fixture_stat_key", "fixture_id", "team_id", "league_id") == [
        (1, 1, 10, 39), (2, 1, 20, 39), (3, 2, 10, 39), (4, 6, 10, 39), (5, 77, 30, None),
    ]


def test_match_results(load, rows):
    got = rows(
        load.table("gold", "fact_match_result"),
        "match_key", "dim_fixture_key", "season", "match_result", "total_goals", "goal_diff", "is_draw",
    )
    assert got == [
        (1, 1, "2023-24", "home_win", 4, 2, False),
        (2, 2, "2023-24", "draw", 4, 0, True),
        (3, 3, "2023-24", "away_win", 1, -1, False),
        (4, 6, "2023-24", None, None, None, None),
    ]  # unknown team or league: dropped


def test_team_results_and_summary(load, rows):
    facts = load.table("gold", "fact_team_result")
    assert facts.select("key").distinct().count() == facts.count() == 8
    totals = facts.agg(F.sum("goal_scored"), F.sum("goal_conceded")).first()
    assert totals[0] == totals[1]
    got = rows(
        load.table("gold", "fact_team_result_summary"),
        "team_name", "season", "competition", "match_played", "total_win", "total_lose",
        "total_draw", "total_goals_scored", "total_goals_conceded", "win_percentage",
    )
    assert got == [
        ("Blues", "2023-24", "First", 4, 1, 1, 1, 4, 5, 25.0),
        ("Reds", "2023-24", "First", 4, 1, 1, 1, 5, 4, 25.0),
    ]


def test_match_statistics(load, rows):
    got = rows(
        load.table("gold", "fact_match_stats"),
        "match_statistic_key", "fixture_id", "team_id", "team_name", "shots_on_goal",
        "goals_scored", "goals_conceded", "match_result", "league_name",
    )
    assert got == [
        (1, 1, 10, "Reds", 6, 3, 1, "win", "First"),
        (2, 1, 20, "Blues", 2, 1, 3, "loss", "First"),
        (3, 2, 10, "Reds", 4, 2, 2, "draw", "First"),
        (4, 6, 10, "Reds", 1, None, None, None, "First"),
        (5, None, None, None, 9, None, None, None, None),
    ]


def test_team_statistics(load):
    reds = load.table("gold", "fact_team_match_stats").filter("team_name = 'Reds'").first()
    assert (reds.match_played, reds.total_goals_scored, reds.avg_goals_scored) == (3, 5, 2.5)
    assert (reds.total_shots_on_goal, reds.avg_ball_possession) == (11, 55.0)
    assert reds.score_firsthalf_percentage == pytest.approx(2 / 3)
    assert len(reds) == 34 + 4  # aggregates, three group columns and the key


def test_partial_dimension_is_numbered_anew(load, rows):
    stats = load.table("gold", "dim_fixture_stats").filter("fixture_stat_key > 2")
    others = [load.table("gold", f"dim_{n}") for n in ("fixtures", "teams", "leagues", "dates")]
    facts = gold.fact_match_stats(stats, *others)
    assert rows(facts, "match_statistic_key", "dim_fixture_stat_key") == [(1, 3), (2, 4), (3, 5)]


def test_teams_of_equal_name_stay_apart(load):
    teams = load.table("gold", "dim_teams").withColumn("name", F.lit("Same"))
    others = [load.table("gold", f"dim_{n}") for n in ("leagues", "dates")]
    facts = gold.fact_team_result(load.table("gold", "dim_fixtures"), teams, *others)
    assert gold.fact_team_result_summary(facts).count() == 2


def test_all_versions_option(spark, load):
    silver_teams = load.table("silver", "teams")
    closed = silver_teams.withColumns(
        {"__END_AT": F.col("__START_AT"), "__START_AT": F.lit(datetime(2020, 1, 1))}
    )
    both = silver_teams.unionByName(closed)
    assert gold.dim_teams(both).count() == 2
    assert gold.dim_teams(both, all_versions=True).count() == 4


def test_progress_tables(load, rows):
    got = rows(load.table("staging", "league_progress"), "league_id", "year", "total_fixtures", "is_complete")
    assert got == [(39, 2023, 5, False), (1000, 2023, 1, False)]
    manifest = load.table("staging", "fixture_manifest")
    assert rows(manifest, "league_id", "file_name", "row_counts") == [
        (39, "fixture_39_2023.json", 5), (1000, "fixture_39_2023.json", 1),
    ]


def test_absent_score_columns_count_as_zero(spark, load):
    flat = load.table("bronze", "fixtures").drop("score_extratime_home", "score_penalty_away")
    row = silver.fixture_changes(flat).filter("fixture_id = 2").first()
    assert (row.score_extratime_home, row.score_penalty_away, row.score_extratime_away) == (0, 0, 0)


def test_seasons_under_the_other_name(spark):
    league = {"league": {"id": 1, "name": "n", "type": "Cup"}, "seasons": [{"year": 1}, {"year": 2}]}
    df = spark.createDataFrame([(0, json.dumps(league), "t")], ENVELOPE)
    assert bronze.leagues(df).count() == 1
    assert bronze.leagues(df, "seasons").count() == 2
    assert silver.leagues(bronze.leagues(df, "seasons")).count() == 1


def test_star_joins_are_not_gathered(load):
    star = [load.table("gold", f"dim_{n}") for n in ("fixtures", "teams", "leagues", "dates")]
    plan = gold.match_star(*star)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_statistics_are_numbered_before_the_joins(load, rows, monkeypatch):
    stats = load.table("gold", "dim_fixture_stats")
    star = [load.table("gold", f"dim_{n}") for n in ("fixtures", "teams", "leagues", "dates")]
    number, numbered = gold.dense_key, []
    monkeypatch.setattr(gold, "dense_key", lambda df, *rest: (numbered.append(df.columns), number(df, *rest))[1])
    facts = gold.fact_match_stats(stats, *star)
    assert numbered == [stats.columns]
    want = rows(stats.select(F.col("fixture_stat_key"), F.col("fixture_stat_key")))
    assert rows(facts, "dim_fixture_stat_key", "match_statistic_key") == want and want
    for dim in star:
        twice = [dim.unionByName(dim) if d is dim else d for d in star]
        with pytest.raises(Exception, match="match_statistic_key: duplicate order key"):
            gold.fact_match_stats(stats, *twice).count()


def test_second_run_keeps_history_and_tracking(spark, rows, tmp_path):
    def land(name, records):
        path = tmp_path / "landing" / f"{name}.json"
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(json.dumps(records))

    tables = [t for t in catalog.TABLES if t[0] != "gold" and t[1] not in ("leagues",)]
    work = {
        day: catalog.Load(spark, str(tmp_path / "landing"), str(tmp_path / "lake"), datetime(2024, 8, day))
        for day in (1, 2)
    }
    land("teams/a", [{"team": {"id": 10, "name": "Reds"}}])
    land("fixtures/a", [fixture(1, 10, 20, "2023-08-12", (0, 0)), fixture(2, 10, 20, "2023-08-13", (1, 0))])
    land("fixture_stats/a", [{"fixture_id": 1, "league_id": 39, "stats": [entry(10, Fouls="3")]}])
    catalog.run(work[1], tables)
    # two files of one run say different things about team 10: the larger file name decides
    land("teams/b", [{"team": {"id": 10, "name": "Zzz"}}])
    land("teams/c", [{"team": {"id": 10, "name": "Crimson"}}])
    land("fixtures/b", [fixture(1, 10, 20, "2023-08-12", (2, 1)), fixture(3, 10, 20, "2023-08-14", (1, 1))])
    land("fixture_stats/b", [{"fixture_id": 1, "league_id": 39, "stats": [entry(10, Fouls="4")]}])
    for name in ("b", "c"):
        os.utime(tmp_path / "landing" / "teams" / f"{name}.json", (1.8e9, 1.8e9))
    catalog.run(work[2], tables)
    load, first, second = work[2], datetime(2024, 8, 1), datetime(2024, 8, 2)
    assert load.table("bronze", "fixtures").count() == 4
    assert rows(load.table("silver", "teams"), "name", "__START_AT", "__END_AT") == [
        ("Crimson", second, None), ("Reds", first, second),
    ]
    assert rows(load.table("silver", "fixtures"), "fixture_id", "goals_home", "__START_AT", "__END_AT") == [
        (1, 0, first, second), (1, 2, second, None), (2, 1, first, None), (3, 1, second, None),
    ]
    assert rows(load.table("silver", "fixture_stats"), "fouls", "__START_AT", "__END_AT") == [
        (3, first, second), (4, second, None),
    ]
    tracked = load.table("staging", "fixture_tracking")
    assert rows(tracked, "fixture_id") == [(1,), (2,), (3,)]
    assert load.table("staging", "team_manifest").count() == 3
    assert rows(load.table("staging", "fixture_stats_manifest"), "fixture_id", "batch_row_count") == [
        (1, 1), (1, 1),
    ]


def test_a_file_written_again_is_new(spark, rows, tmp_path):
    def land(part, name, time):
        path = tmp_path / "landing" / "teams" / f"part={part}" / "teams_39_2023.json"
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(json.dumps([{"team": {"id": 10 + part, "name": name}}]))
        os.utime(path, (time, time))

    tables = [t for t in catalog.TABLES if t[1] in ("teams", "team_manifest")]
    days = [datetime(2024, 8, day) for day in (1, 2, 3)]
    for day, landed in zip(days, ([(0, "Reds", 1.7e9)], [(0, "Blues", 1.8e9), (1, "Greens", 1.7e9)], [])):
        for one in landed:
            land(*one)
        load = catalog.Load(spark, str(tmp_path / "landing"), str(tmp_path / "lake"), day)
        catalog.run(load, tables)
    assert rows(load.table("silver", "teams"), "team_id", "name", "__START_AT", "__END_AT") == [
        (10, "Blues", days[1], None), (10, "Reds", days[0], days[1]), (11, "Greens", days[1], None),
    ]
    assert rows(load.table("staging", "team_manifest"), "file_name", "row_counts", "ingestion_timestamp") == [
        ("teams_39_2023.json", 1, days[0]),
        ("teams_39_2023.json", 1, days[1]),
        ("teams_39_2023.json", 1, days[1]),
    ]


def test_wrong_frames_stop_a_run(load, monkeypatch):
    where = ("gold", "dim_leagues")
    step, by = catalog.TABLES[where]
    for wrong in (lambda x: step(x).drop("country"), lambda x: step(x).withColumn("name", F.lit(1))):
        monkeypatch.setitem(catalog.TABLES, where, (wrong, by))
        with pytest.raises(ValueError, match="dim_leagues"):
            catalog.run(load, [where])
    leagues = load.table("silver", "leagues")
    with pytest.raises(ValueError, match="missing columns country"):
        gold.dim_leagues(leagues.drop("country"))


def test_team_statistics_number_no_statistics_or_fixtures(spark, monkeypatch, tmp_path):
    from workload import queries

    given = {
        "nation": "SELECT 1L n_nationkey, 'N' n_name, 0L n_regionkey",
        "customer": "SELECT id c_custkey, concat('C', id) c_name, 1L c_nationkey, 'M' c_mktsegment, "
        "1.0D c_acctbal FROM range(1, 30)",
        "orders": "SELECT id o_orderkey, id % 5 + 1 o_custkey, 'F' o_orderstatus, 100.0D + id o_totalprice, "
        "timestamp_ntz'2024-01-01 00:00:00' o_orderdate FROM range(8)",
        "lineitem": "SELECT id % 8 l_orderkey, id l_linenumber, 'R' l_returnflag, 'O' l_linestatus, "
        "3.0D l_quantity, 0.1D l_discount, 0.1D l_tax FROM range(24)",
    }
    for name, text in given.items():
        spark.sql(text).write.parquet(f"{tmp_path}/{name}.parquet")
    numbered = []

    def recorded(df, name, order_by):
        numbered.append(name)
        return gold_key(df, name, order_by)

    gold_key = gold.dense_key
    monkeypatch.setattr(gold, "dense_key", recorded)
    found = queries.team_match_stats(spark, str(tmp_path))
    assert found.agg(F.sum("match_played")).first()[0] == queries.frame(spark, str(tmp_path), "stats").count()
    assert sorted(numbered) == ["fact_key", "team_key"]


def test_unnumbered_rows_refuse_equal_keys(spark):
    def fixtures(*ids):
        return spark.createDataFrame([(i, "r") for i in ids], "fixture_id long, round string")

    def stats(*keys):
        return spark.createDataFrame(list(keys), "fixture_id long, team_id long")

    left = spark.range(3).withColumnRenamed("id", "fixture_id")
    assert left.join(gold.unnumbered_fixtures(fixtures(1, 2, None)), "fixture_id", "left").count() == 3
    assert gold.unnumbered_stats(stats((1, 1), (1, 2), (1, None), (None, 1))).count() == 4
    for twice in ((1, 2, 2), (1, None, None), (7, 7)):
        with pytest.raises(Exception, match="duplicate order key"):
            left.join(gold.unnumbered_fixtures(fixtures(*twice)), "fixture_id", "left").collect()
    for twice in ([(1, 1), (1, 1)], [(1, None), (1, None)], [(None, None), (None, None)]):
        with pytest.raises(Exception, match="duplicate order key"):
            gold.unnumbered_stats(stats(*twice)).collect()
