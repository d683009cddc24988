"""The fetch loop over stored state."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from touchline.plans import tracking
from touchline.schemas import RAW_FIXTURE_STATS
from touchline.sources.landing import read_landing, with_source_file

T0, T1 = datetime(2024, 8, 1), datetime(2024, 8, 2)


@pytest.fixture
def root(spark, tmp_path):
    fixtures = spark.createDataFrame(
        [(f, lg, 2023) for f, lg in ((1, 10), (2, 10), (3, 20), (4, 30))],
        "fixture_id INT, league_id INT, season INT",
    )
    path = str(tmp_path / "state")
    tracking.start(fixtures, path, F.lit(T0))
    return path


def landed(spark, folder, ids):
    folder.mkdir(exist_ok=True)
    leagues = {1: 10, 2: 10, 3: 20, 4: 30}
    records = [{"fixture_id": i, "league_id": leagues[i], "stats": []} for i in ids]
    (folder / f"stats_{ids[0]}.json").write_text(json.dumps(records, indent=2))
    raw = read_landing(spark, str(folder / f"stats_{ids[0]}.json"), RAW_FIXTURE_STATS)
    return with_source_file(raw)


def test_loop_until_complete(spark, rows, root, tmp_path):
    assert (tmp_path / "state" / "fixture_tracking" / "version=1" / "league_id=10").is_dir()
    done = []
    for step in range(5):
        batch = [r.fixture_id for r in tracking.next_batch(spark, root, 3).collect()]
        if not batch:
            break
        done.append(batch)
        manifest = tracking.record(landed(spark, tmp_path / "in", batch), root, F.lit(T1))
        assert rows(manifest, "fixture_id", "batch_row_count") == [(i, len(batch)) for i in batch]
    assert done == [[1, 2, 3], [4]]
    state = tracking.load(spark, root)
    assert state.version == 3
    assert rows(state.leagues, "league_id", "is_complete", "last_updated") == [
        (10, True, T1), (20, True, T1), (30, True, T1),
    ]
    assert rows(state.fixtures, "fixture_id", "season", "is_fetched_stat")[3] == (4, 2023, True)


def test_a_batch_may_span_leagues(spark, rows, root, tmp_path):
    tracking.record(landed(spark, tmp_path / "in", [2, 3]), root, F.lit(T1))
    leagues = tracking.load(spark, root).leagues
    assert rows(leagues, "league_id", "fetched_count", "last_updated") == [
        (10, 1, T1), (20, 1, T1), (30, 0, T0),
    ]


def test_half_written_version_is_not_read(spark, rows, root):
    from touchline.sinks.tables import write_version

    state = tracking.load(spark, root)
    write_version(state.fixtures.limit(1), f"{root}/{tracking.FIXTURES}", 2, "json", ["league_id"])
    assert tracking.load(spark, root).version == 1
    assert tracking.load(spark, root).fixtures.count() == 4


def test_empty_state_is_refused(spark, tmp_path):
    empty = spark.createDataFrame([], "fixture_id INT, league_id INT, season INT")
    one = spark.createDataFrame([(1, 1, 1)], "fixture_id INT, league_id INT, season INT")
    path = str(tmp_path / "s")
    tracking.start(one, path, F.lit(T0))
    state = tracking.load(spark, path)
    tracking._store(path, 2, state.fixtures.limit(0), state.leagues)
    with pytest.raises(ValueError, match="fixture_tracking is empty"):
        tracking.load(spark, path)
    assert empty.isEmpty()


def test_reset_and_reconcile_are_stored(spark, rows, root, tmp_path):
    payloads = landed(spark, tmp_path / "in", [1, 2, 3])
    tracking.record(payloads, root, F.lit(T0))
    ids = spark.createDataFrame([(3,)], "fixture_id BIGINT")
    tracking.reset(spark, root, ids, F.lit(T1))
    state = tracking.load(spark, root)
    assert rows(state.fixtures, "fixture_id") == [(1,), (2,), (4,)]
    assert rows(state.leagues.filter("league_id = 20"), "total_fixtures", "is_complete") == [(0, False)]
    kept = tracking.reconcile(payloads.filter("fixture_id <> 2"), root, F.lit(T1))
    assert rows(kept, "fixture_id") == [(1,)]
    state = tracking.load(spark, root)
    assert rows(state.fixtures, "fixture_id", "is_fetched_stat") == [(1, True), (2, False), (4, False)]
    assert rows(state.leagues.filter("league_id = 10"), "fetched_count") == [(1,)]


def test_unknown_fixture_without_season_is_refused(spark, root, tmp_path):
    from pyspark.errors import PySparkException

    stray = landed(spark, tmp_path / "in", [1]).withColumn("fixture_id", F.lit(99).cast("bigint"))
    with pytest.raises(PySparkException, match="null in column season"):
        tracking.record(stray, root, F.lit(T1))
    known = stray.withColumn("season", F.lit(2024))
    tracking.record(known, root, F.lit(T1))
    assert tracking.load(spark, root).fixtures.filter("fixture_id = 99").first().season == 2024


def test_old_state_expires(spark, rows, root, tmp_path):
    for ids in ([1], [2], [3]):
        tracking.record(landed(spark, tmp_path / "in", ids), root, F.lit(T1))
    tracking.expire(spark, root, 2)
    kept = sorted(str(p.relative_to(tmp_path)) for p in (tmp_path / "state").glob("*/version=*/league_id=*"))
    # League 30 was never touched again, and version 3 still reads league 20 as it was.
    assert kept == [
        f"state/fixture_tracking/version={v}/league_id={league}" for v, league in ((1, 20), (1, 30), (3, 10), (4, 20))
    ]
    assert rows(tracking.load(spark, root).fixtures.filter("is_fetched_stat"), "fixture_id") == [(1,), (2,), (3,)]


def test_a_step_writes_its_leagues_only(spark, rows, root, tmp_path):
    def written(version):
        folder = tmp_path / "state" / "fixture_tracking" / f"version={version}"
        return sorted(p.name for p in folder.glob("league_id=*"))

    tracking.record(landed(spark, tmp_path / "in", [1]), root, F.lit(T1))
    assert written(2) == ["league_id=10"]
    ids = spark.createDataFrame([(3,)], "fixture_id BIGINT")
    tracking.reset(spark, root, ids, F.lit(T1))  # the only fixture of its league
    assert written(3) == []
    state = tracking.load(spark, root)
    assert rows(state.fixtures, "fixture_id", "is_fetched_stat") == [(1, True), (2, False), (4, False)]
    # A fixture that a payload puts into another league leaves its old one.
    moved = landed(spark, tmp_path / "in", [4]).withColumn("league_id", F.lit(10).cast("bigint"))
    tracking.record(moved, root, F.lit(T1))
    assert written(4) == ["league_id=10"]
    state = tracking.load(spark, root)
    assert rows(state.fixtures, "fixture_id", "league_id") == [(1, 10), (2, 10), (4, 10)]
