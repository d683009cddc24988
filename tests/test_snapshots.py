"""Tables behind a pointer, the ledger of files, and runs that are one commit."""

import json
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from touchline.plans import catalog
from touchline.sinks.snapshots import Commit, Part, Snapshots, ripe
from touchline.sources import ledger


def folders(path):
    return sorted(str(p.relative_to(path)) for p in path.rglob("*") if p.is_dir())


def test_commits_show_all_tables_at_once(spark, rows, tmp_path):
    snapshots = Snapshots(spark, str(tmp_path))
    start = snapshots.newest()
    assert start == Commit()
    numbers = spark.range(6).withColumn("k", F.col("id") % 2)
    parts = snapshots.stage(start, "layer/a", numbers, by=F.col("k"))
    assert snapshots.newest() == start  # staged rows are not visible
    first = snapshots.commit(start, {"layer/a": parts, "b": snapshots.stage(start, "b", numbers)}, {"x": 1})
    assert snapshots.newest() == first and set(first.parts("layer/a")) == {"0", "1"}
    changed = snapshots.stage(first, "layer/a", numbers.filter("id = 1"), by=F.col("k"))
    second = snapshots.commit(first, {"layer/a": {**first.parts("layer/a"), **changed}})
    assert rows(snapshots.read(second.parts("layer/a")), "id") == [(0,), (1,), (2,), (4,)]
    assert rows(snapshots.read(first.parts("layer/a")), "id") == [(k,) for k in range(6)]
    assert second.parts("b") == first.parts("b") and second.notes == {"x": 1}


def test_two_writers_on_one_commit(spark, tmp_path):
    snapshots = Snapshots(spark, str(tmp_path))
    base = snapshots.newest()
    snapshots.commit(base, {"a": snapshots.stage(base, "a", spark.range(1))})
    with pytest.raises(Exception, match="already exists"):
        snapshots.commit(base, {"a": snapshots.stage(base, "a", spark.range(2))})
    assert snapshots.read(snapshots.newest().parts("a")).count() == 1


def test_expiry_keeps_what_kept_commits_name(spark, rows, tmp_path):
    snapshots = Snapshots(spark, str(tmp_path))
    commit = snapshots.newest()
    parts = snapshots.stage(commit, "a", spark.range(4), by=F.col("id") % 2)
    commit = snapshots.commit(commit, {"a": parts})
    lost = snapshots.stage(commit, "a", spark.range(9))  # never committed
    for n in range(3):
        changed = snapshots.stage(commit, "a", spark.range(n, n + 1), by=F.lit(1))
        commit = snapshots.commit(commit, {"a": {**commit.parts("a"), **changed}})
    assert snapshots.expire(1) == [1, 2, 3] and snapshots.versions() == [4]
    assert rows(snapshots.read(commit.parts("a"))) == [(0,), (2,), (2,)]
    left = [f for f in folders(tmp_path / "a") if "=" in f]
    assert len(left) == 2 and not any(p.folder.endswith(f) for p in lost.values() for f in folders(tmp_path / "a"))
    assert snapshots.expire(1) == []


def test_small_parts_merge_level_by_level():
    parts = {f"{k}": Part("f", {"level": 0}) for k in range(4)}
    assert ripe(parts, 5) == [] and ripe(parts, 4) == ["0", "1", "2", "3"]
    assert ripe({**parts, "m": Part("f", {"level": 1})}, 4) == ["0", "1", "2", "3"]


def land(folder, name, records, time=None):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps(records, indent=1))
    if time:
        os.utime(path, (time, time))


def test_ledger_opens_new_files_only(spark, rows, tmp_path):
    landing = tmp_path / "in"
    names = ["a b.json", "c[1].json", "d%20.json", "e.json"]
    for name in names[:2]:
        land(landing, name, [{"id": 1}, {"id": 2}], 1.7e9)
    listed = ledger.landed_files(spark, str(landing))
    taken = spark.createDataFrame(listed.collect(), listed.schema)
    for name in names[2:]:
        land(landing, name, [{"id": 3}], 1.7e9)
    land(landing, names[0], [{"id": 9}], 1.8e9)  # written again
    fresh = ledger.new_files(ledger.landed_files(spark, str(landing)), taken)
    found = ledger.read_files(spark, fresh, "id INT", base=str(landing))
    assert rows(found, "id") == [(3,), (3,), (9,)]
    assert len(found.inputFiles()) == 3
    known = found.select("file_path", "file_time").distinct()
    assert ledger.new_files(fresh, known).count() == 0
    assert ledger.landed_files(spark, str(tmp_path / "none")).count() == 0
    assert ledger.read_files(spark, fresh.limit(0), "id INT").columns == found.columns


TABLES = (("staging", "team_manifest"), ("bronze", "teams"), ("silver", "teams"))


@pytest.fixture
def lake(spark, tmp_path):
    def load(day):
        return catalog.Load(spark, str(tmp_path / "landing"), str(tmp_path / "lake"), datetime(2024, 8, day))

    return load


def team(n, name):
    return {"team": {"id": n, "name": name}}


def test_second_run_opens_new_files_only(lake, tmp_path):
    land(tmp_path / "landing", "teams/a.json", [team(1, "Reds")])
    catalog.run(lake(1), TABLES)
    land(tmp_path / "landing", "teams/b.json", [team(2, "Blues")])
    fresh = lake(2).new("teams", catalog.schemas.RAW_TEAM)
    assert [os.path.basename(f) for f in fresh.inputFiles()] == ["b.json"]


def test_file_landing_during_a_run_belongs_to_the_next(lake, rows, tmp_path, monkeypatch):
    land(tmp_path / "landing", "teams/a.json", [team(1, "Reds")])
    step, by = catalog.TABLES["bronze", "teams"]

    def late(load):
        land(tmp_path / "landing", "teams/b.json", [team(2, "Blues")])
        return step(load)

    monkeypatch.setitem(catalog.TABLES, ("bronze", "teams"), (late, by))
    catalog.run(lake(1), TABLES)
    assert rows(lake(1).table("staging", "team_manifest"), "file_name") == [("a.json",)]
    assert rows(lake(1).table("bronze", "teams"), "team_id") == [(1,)]
    monkeypatch.setitem(catalog.TABLES, ("bronze", "teams"), (step, by))
    catalog.run(lake(2), TABLES)
    assert rows(lake(2).table("staging", "team_manifest"), "file_name") == [("a.json",), ("b.json",)]
    assert rows(lake(2).table("silver", "teams"), "team_id") == [(1,), (2,)]


def test_failed_run_leaves_the_tables_as_they_were(lake, rows, tmp_path, monkeypatch):
    land(tmp_path / "landing", "teams/a.json", [team(1, "Reds")])
    catalog.run(lake(1), TABLES)
    land(tmp_path / "landing", "teams/b.json", [team(1, "Crimson")])
    for broken in TABLES[1:]:
        def fails(load):
            raise RuntimeError("lost")

        with monkeypatch.context() as patch:
            patch.setitem(catalog.TABLES, broken, (fails, ()))
            with pytest.raises(RuntimeError, match="lost"):
                catalog.run(lake(2), TABLES)
        assert lake(2).table("staging", "team_manifest").count() == 1
        assert lake(2).table("bronze", "teams").count() == 1
    catalog.run(lake(2), TABLES)
    assert rows(lake(2).table("staging", "team_manifest"), "file_name") == [("a.json",), ("b.json",)]
    assert rows(lake(2).table("silver", "teams"), "name", "__END_AT") == [
        ("Crimson", None), ("Reds", datetime(2024, 8, 2)),
    ]


def test_tables_left_out_of_a_run_catch_up(lake, rows, tmp_path):
    land(tmp_path / "landing", "teams/a.json", [team(1, "Reds")])
    catalog.run(lake(1), TABLES[1:2])
    land(tmp_path / "landing", "teams/b.json", [team(1, "Crimson"), team(2, "Blues")])
    catalog.run(lake(2), TABLES, keep=1)
    assert rows(lake(2).table("staging", "team_manifest"), "file_name") == [("a.json",), ("b.json",)]
    assert rows(lake(2).table("silver", "teams"), "team_id", "name") == [
        (1, "Crimson"), (1, "Reds"), (2, "Blues"),
    ]


def test_nothing_landed_gives_empty_tables(lake):
    catalog.run(lake(1), TABLES)
    catalog.run(lake(2), TABLES)
    assert lake(2).table("silver", "teams").count() == 0


def test_many_runs_merge_their_parts(lake, rows, tmp_path, monkeypatch):
    monkeypatch.setattr(catalog, "ripe", lambda parts: ripe(parts, 3))
    for day in range(1, 6):
        land(tmp_path / "landing", f"teams/{day}.json", [team(day, "T")])
        catalog.run(lake(day), TABLES[1:2], keep=1)
    table = lake(5).table("bronze", "teams")
    assert rows(table, "team_id") == [(k,) for k in range(1, 6)]
    assert len(lake(5).snapshots.newest().parts("bronze/teams")) == 3
