"""D6-D8, E10, G1, M1-M13"""

from datetime import datetime

from pyspark.sql import functions as F

from touchline.operators import progress

T0, T1 = datetime(2024, 8, 1), datetime(2024, 8, 2)


def tracking(spark, entries):
    return spark.createDataFrame(
        [(f, lg, 2023, done, T0 if done else None) for f, lg, done in entries],
        "fixture_id BIGINT, league_id BIGINT, season INT, is_fetched_stat BOOLEAN, "
        "fetch_stat_time TIMESTAMP",
    )


def ids(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "fixture_id BIGINT")


BASE = [(1, 100, False), (2, 100, True), (3, 200, True), (4, 200, True), (5, 300, False)]


def test_upsert(spark, rows):
    target = spark.createDataFrame([(1, "a", 10), (2, None, 20)], "k INT, v STRING, w INT")
    updates = spark.createDataFrame([(1, None), (2, "b"), (3, "c")], "k INT, v STRING")
    assert rows(progress.upsert(target, updates, ["k"])) == [
        (1, "a", 10), (2, "b", 20), (3, "c", None),
    ]
    assert rows(progress.upsert(target, updates.limit(0), ["k"])) == rows(target)


def test_progress_and_summary(spark, rows):
    done = progress.league_progress(tracking(spark, BASE), F.lit(T0))
    assert rows(done, "league_id", "total_fixtures", "fetched_count", "fetched_percentage", "is_complete") == [
        (100, 2, 1, 50.0, False), (200, 2, 2, 100.0, True), (300, 1, 0, 0.0, False),
    ]
    assert rows(progress.incomplete(done), "league_id") == [(100,), (300,)]
    assert rows(progress.league_ids(done)) == [(100,), (200,), (300,)]
    one = progress.progress_summary(done).first()
    assert (one.total_leagues, one.total_fixtures, one.total_fetched) == (3, 5, 3)
    assert (one.incomplete_leagues, one.overall_completion) == (2, 60.0)


def test_summary_of_nothing(spark):
    none = progress.league_progress(tracking(spark, BASE).limit(0), F.lit(T0))
    one = progress.progress_summary(none).first()
    assert (one.total_leagues, one.total_fixtures, one.overall_completion) == (0, 0, 0.0)


def test_initial_tracking(spark, rows):
    fixtures = spark.createDataFrame([(1, 100, 2023)], "fixture_id INT, league_id INT, season INT")
    fresh = progress.initial_tracking(fixtures)
    assert rows(fresh) == [(1, 100, 2023, False, None)]
    assert dict(fresh.dtypes)["fixture_id"] == "bigint"


def test_mark_and_refresh(spark, rows):
    before = tracking(spark, BASE)
    marked = progress.mark_fetched(before, ids(spark, 1, 1), F.lit(T1))
    assert rows(marked.filter("fixture_id = 1")) == [(1, 100, 2023, True, T1)]
    assert marked.count() == 5
    old = progress.league_progress(before, F.lit(T0))
    leagues = spark.createDataFrame([(100,)], "league_id BIGINT")
    fresh = progress.refresh_progress(old, marked, F.lit(T1), leagues)
    assert rows(fresh, "league_id", "is_complete", "last_updated") == [
        (100, True, T1), (200, True, T0), (300, False, T0),
    ]


def test_next_batch_prefers_incomplete_leagues(spark):
    entries = [(9, 50, True), (8, 60, False), (7, 60, False), (6, 40, False), (5, 40, True)]
    state = tracking(spark, entries)
    done = progress.league_progress(state, F.lit(T0))
    picked = progress.next_batch(state, done, 2).collect()
    assert [r.fixture_id for r in picked] == [6, 7]
    assert [r.fixture_id for r in progress.next_batch(state, done).collect()] == [6, 7, 8]
    # a league recorded as complete comes last even when tracking disagrees
    stale = done.withColumn("is_complete", F.col("is_complete") | (F.col("league_id") == 40))
    assert [r.fixture_id for r in progress.next_batch(state, stale, 2).collect()] == [7, 8]
    plan = progress.next_batch(state, done, 2)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_next_batch_when_all_is_complete(spark):
    state = tracking(spark, [(1, 100, True)])
    assert progress.next_batch(state, progress.league_progress(state, F.lit(T0))).count() == 0


def test_filters(spark, rows):
    state = tracking(spark, BASE)
    assert rows(progress.of_league(state, 100), "fixture_id") == [(1,), (2,)]
    assert rows(progress.fetched(state), "fixture_id") == [(2,), (3,), (4,)]
    assert rows(progress.fetched(state, False), "fixture_id") == [(1,), (5,)]
    assert progress.fixture_status(state, 3).first().is_fetched_stat is True
    assert progress.fixture_status(state, 99).isEmpty()


def test_reset(spark, rows):
    state = tracking(spark, BASE)
    assert rows(progress.reset_fixtures(state, ids(spark, 2, 99)), "fixture_id") == [(1,), (3,), (4,), (5,)]
    kept = progress.reset_fixtures(state, ids(spark, 2), keep_rows=True)
    assert rows(kept.filter("fixture_id = 2")) == [(2, 100, 2023, False, None)]
    assert kept.count() == 5
    assert rows(progress.reset_league(state, 200), "fixture_id") == [(1,), (2,), (5,)]


def test_reconcile(spark, rows):
    state = tracking(spark, BASE)
    payloads = ids(spark, 1, 2, 3, 77)
    assert rows(progress.reconcile(payloads, state)) == [(2,), (3,)]
    assert rows(progress.untracked(payloads, state)) == [(1,), (77,)]


def test_grid_and_new_leagues(spark, rows):
    leagues = spark.createDataFrame([(1,), (2,), (2,)], "league_id BIGINT")
    grid = progress.league_season_grid(leagues, [2023, 2024])
    assert rows(grid) == [(1, 2023), (1, 2024), (2, 2023), (2, 2024)]
    done = progress.league_progress(tracking(spark, [(1, 1, False)]), F.lit(T0))
    more = progress.add_leagues(done, grid, F.lit(T1))
    assert rows(more, "league_id", "year", "total_fixtures") == [
        (1, 2023, 1), (1, 2024, 0), (2, 2023, 0), (2, 2024, 0),
    ]
    assert more.schema["fetched_percentage"].dataType == done.schema["fetched_percentage"].dataType


def test_repeated_updates_are_one(spark, rows):
    target = spark.createDataFrame([(1, "a")], "k INT, v STRING")
    updates = spark.createDataFrame([(1, "b"), (1, "c"), (2, "d"), (2, "d")], "k INT, v STRING")
    for few in (False, True):
        assert rows(progress.upsert(target, updates, ["k"], few)) == [(1, "c"), (2, "d")]


def test_emptied_league_is_zero(spark, rows):
    state = tracking(spark, BASE)
    done = progress.league_progress(state, F.lit(T0))
    left = progress.reset_league(state, 200)
    leagues = spark.createDataFrame([(200,)], "league_id BIGINT")
    fresh = progress.refresh_progress(done, left, F.lit(T1), leagues)
    assert rows(fresh.filter("league_id = 200")) == [(200, 2023, 0, 0, 0.0, False, T1)]
    assert fresh.count() == 3
