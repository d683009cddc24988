"""Streams give what the batch gives, in any cut and on replay."""

import json
from datetime import datetime, timedelta
from glob import glob

import pytest
from pyspark.sql import functions as F

from touchline.operators.history import history_from_changes
from touchline.operators.tails import read_history
from touchline.plans import bronze, silver
from touchline.scratch import _root
from touchline.schemas import RAW_FIXTURE_STATS, RAW_TEAM, layout
from touchline.sources import landing
from touchline.streaming import counts, flows
from workload import queries

T0 = datetime(2024, 8, 1)


def run(query):
    query.awaitTermination()
    assert query.exception() is None


def land_teams(folder, batch, ids):
    folder.mkdir(exist_ok=True)
    records = [
        {"team": {"id": i, "name": f"team {i} v{batch}"}, "venue": {"id": 1, "capacity": 10}}
        for i in ids
    ]
    (folder / f"teams_{batch}.json").write_text(json.dumps(records, indent=2))


def test_bronze_stream_takes_each_file_once(spark, rows, tmp_path):
    src, out, cp = tmp_path / "in", str(tmp_path / "bronze"), str(tmp_path / "cp")
    land_teams(src, 1, [1, None])
    run(flows.bronze_stream(spark, str(src), layout(RAW_TEAM), out, cp))
    land_teams(src, 2, [2, 3])
    for _ in range(2):  # the second start finds nothing new
        run(flows.bronze_stream(spark, str(src), layout(RAW_TEAM), out, cp, max_files=1))
    table = spark.read.parquet(out)
    assert rows(table, "team_id") == [(None,), (1,), (2,), (3,)]
    assert "venue_capacity" in table.columns and table.filter("ingestion_time IS NULL").isEmpty()

    silver_out = str(tmp_path / "silver")
    run(flows.projected_stream(
        spark, out, table.schema, silver.team_changes, silver_out, str(tmp_path / "cp2")
    ))
    assert rows(spark.read.parquet(silver_out), "team_id", "capacity") == [(1, 10), (2, 10), (3, 10)]


def test_stream_with_source_file(spark, rows, tmp_path):
    land_teams(tmp_path / "in", 7, [1])
    named = landing.stream_with_source(spark, str(tmp_path / "in"), layout(RAW_TEAM))
    run(flows.append_stream(named, str(tmp_path / "out"), str(tmp_path / "cp")))
    assert rows(spark.read.parquet(str(tmp_path / "out")), "source_file") == [("teams_7.json",)]


CHANGES = [(k, n, "abc"[(k * n) % 3]) for k in range(6) for n in range(12)]
CHANGE_DDL = "k INT, seq TIMESTAMP, v STRING"


def change_frame(spark, entries):
    return spark.createDataFrame([(k, T0 + timedelta(days=n), v) for k, n, v in entries], CHANGE_DDL)


@pytest.mark.parametrize("cuts", [1, 2, 5])
def test_history_stream_equals_batch(spark, rows, tmp_path, cuts):
    src, out, cp = (str(tmp_path / n) for n in ("in", "tables", "cp"))
    shuffled = sorted(CHANGES, key=lambda e: (e[0] * 7 + e[1] * 13) % 11)  # late rows
    for i in range(cuts):
        change_frame(spark, shuffled[i::cuts]).coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(CHANGE_DDL).option("maxFilesPerTrigger", 1).parquet(src)
        run(flows.history_stream(stream, out, cp, ["k"], "seq", buckets=4))
    want = history_from_changes(change_frame(spark, CHANGES), ["k"], "seq")
    got = read_history(spark, out).select(*want.columns)
    assert rows(got) == rows(want)


def test_history_stream_replay_changes_nothing(spark, rows, tmp_path):
    src, out = (str(tmp_path / n) for n in ("in", "tables"))
    change_frame(spark, CHANGES).coalesce(1).write.parquet(src)
    results = []
    for attempt in range(2):  # a lost checkpoint makes the same batch id run again
        stream = spark.readStream.schema(CHANGE_DDL).parquet(src)
        run(flows.history_stream(stream, out, str(tmp_path / f"cp{attempt}"), ["k"], "seq"))
        results.append(rows(read_history(spark, out)))
    assert results[0] == results[1]


def test_statistics_stream_equals_batch(spark, rows, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    for i in range(3):
        records = [
            {"fixture_id": f, "league_id": 1, "stats": [
                {"team": {"id": 10}, "statistics": [{"type": "Fouls", "value": str(f + i)}]}]}
            for f in (1, 2)
        ]  # the same fixtures in every file
        (src / f"s{i}.json").write_text(json.dumps(records, indent=2))
    at = F.lit(T0)
    raw = landing.stamp(landing.stream_landing(spark, str(src), layout(RAW_FIXTURE_STATS)), at)
    run(flows.statistics_stream(raw, str(tmp_path / "out"), str(tmp_path / "cp")))
    streamed = spark.read.parquet(str(tmp_path / "out")).drop(flows.BATCH)
    batch = landing.read_landing(spark, str(src), layout(RAW_FIXTURE_STATS))
    want = silver.stats_from_rows(bronze.fixture_stats(batch, at))
    assert rows(streamed.select(*want.columns)) == rows(want)
    assert rows(streamed, "fixture_id", "fouls") == [(1, 3), (2, 4)]


def test_dropped_rows_are_counted_per_batch(spark, rows, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    for values in ([1, -2, None], [5, -6]):
        spark.createDataFrame([(v,) for v in values], "v INT").coalesce(1).write.mode("append").parquet(src)
    counter = counts.DropCounts("values")
    spark.streams.addListener(counter)
    stream = spark.readStream.schema("v INT").option("maxFilesPerTrigger", 1).parquet(src)
    query = flows.append_stream(
        counts.observed(stream, "values", positive="v > 0", small="v < 5"), out, str(tmp_path / "cp")
    )
    run(query)
    found = counter.batches(spark, query)
    spark.streams.removeListener(counter)
    assert found.select("batch_id").distinct().count() == 2
    totals = found.groupBy("rule").sum("seen", "kept", "dropped")
    assert rows(totals) == [("positive", 5, 1, 3), ("small", 5, 1, 2)]
    assert rows(spark.read.schema("v INT").parquet(out)) == [(1,)]


def test_stream_in_sql(spark, rows, tmp_path):
    land_teams(tmp_path / "in", 7, [1, 2])
    raw = landing.stream_landing(spark, str(tmp_path / "in"), layout(RAW_TEAM))
    named = flows.sql_stream(
        spark, raw, "landed_teams", "SELECT team.id AS id, source.file_name AS file FROM landed_teams WHERE team.id > 1"
    )
    run(flows.append_stream(named, str(tmp_path / "out"), str(tmp_path / "cp")))
    assert rows(spark.read.parquet(str(tmp_path / "out"))) == [(2, "teams_7.json")]


def test_payloads_land_compressed_and_a_batch_is_written_in_place(spark, monkeypatch):
    write, options = flows.replace_partitions, []

    def noted(*args, **named):
        options.append(named)
        write(*args, **named)

    monkeypatch.setattr(flows, "replace_partitions", noted)
    before = set(glob(f"{_root(spark)}/landed-stats-*"))
    assert queries.pivot_stream(spark, "/root/testdata/sf0.001").count() > 0
    (landed,) = set(glob(f"{_root(spark)}/landed-stats-*")) - before
    files = glob(f"{landed}/part-*")
    assert files and all(f.endswith(".json.gz") for f in files)
    assert options == [{"spread": False}]
