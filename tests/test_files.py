"""A1, A3, A6-A8, B1-B8"""

import json
from datetime import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from touchline.schemas import layout
from touchline.sinks import manifests, tables as sinks
from touchline.sources import landing, tables as sources
from workload import queries

T0 = datetime(2024, 8, 1)
SF_DIR = "/root/testdata/sf0.001"


def land(folder, **files):
    folder.mkdir(exist_ok=True)
    for name, records in files.items():
        (folder / f"{name}.json").write_text(json.dumps(records, indent=2))
    return str(folder)


def test_indented_arrays_need_multi_line(spark, rows, tmp_path):
    path = land(tmp_path / "in", a=[{"id": 1}, {"id": 2}], b=[{"id": 3}])
    assert rows(landing.read_landing(spark, path, "id INT")) == [(1,), (2,), (3,)]


def test_json_lines(spark, rows, tmp_path):
    (tmp_path / "x.json").write_text('{"id": 1}\n{"id": 2}\n')
    assert rows(landing.read_landing(spark, str(tmp_path), "id INT", multi_line=False)) == [(1,), (2,)]


def test_epoch_numbers_become_timestamps(spark, tmp_path):
    path = land(tmp_path / "in", a=[{"at": 1722470400}])
    assert landing.read_landing(spark, path, "at TIMESTAMP").first().at == T0


def test_stamp_and_rows(spark):
    df = landing.from_rows(spark, [(1, 2023)], "league_id INT, year INT")
    assert landing.stamp(df, T0).first().ingestion_time == T0
    assert landing.stamp(df, F.lit(T0)).first().ingestion_time == T0
    assert landing.stamp(df).first().ingestion_time is not None


def test_manifests(spark, rows, tmp_path):
    path = land(tmp_path / "in", l1=[{"lg": 1}, {"lg": 1}], l2=[{"lg": 2}])
    df = landing.with_source_file(landing.read_landing(spark, path, "lg INT"))
    files = manifests.landing_manifest(df, ["lg"], F.lit(T0))
    assert rows(files) == [(1, "l1.json", 2, T0), (2, "l2.json", 1, T0)]
    records = manifests.record_manifest(df, ["lg"], F.lit(T0))
    assert rows(records) == [(1, "l1.json", T0, 2), (1, "l1.json", T0, 2), (2, "l2.json", T0, 1)]


def test_declared_layout_is_enforced(spark, rows, tmp_path):
    expected = layout("a BIGINT NOT NULL, b STRING")
    df = spark.createDataFrame([("x", 1), (None, 2)], "b STRING, a BIGINT")
    path = str(tmp_path / "t")
    sinks.write_table(df, path, expected)
    back = spark.read.parquet(path)
    assert back.columns == ["a", "b"] and rows(back) == [(1, "x"), (2, None)]
    with pytest.raises(ValueError, match="is int, declared bigint"):
        sinks.write_table(df.withColumn("a", F.col("a").cast("int")), path, expected)
    with pytest.raises(ValueError, match="lacks columns"):
        sinks.write_table(df.drop("b"), path, expected)
    with pytest.raises(PySparkException, match="null in column a"):
        sinks.write_table(df.withColumn("a", F.lit(None).cast("bigint")), path, expected)


def test_partitioned_table_and_layer_read(spark, rows, tmp_path):
    df = spark.createDataFrame([(1, "s1"), (2, "s2"), (3, "s1")], "v INT, season STRING")
    path = sources.table_path(str(tmp_path), "gold", "facts")
    sinks.write_table(df, path, partition_by=["season"])
    assert (tmp_path / "gold" / "facts" / "season=s1").is_dir()
    back = sources.read_table(spark, str(tmp_path), "gold", "facts")
    assert rows(back, "v", "season") == rows(df)
    plan = back.filter("season = 's1'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(season" in plan


def test_catalog_table_has_comment_and_quality(spark, rows):
    spark.sql("DROP TABLE IF EXISTS touchline_tagged")
    df = spark.createDataFrame([(1,)], "v INT")
    sinks.write_catalog_table(df, "touchline_tagged", "Club's rows", {"quality": "gold"})
    tags = {r.key: r.value for r in spark.sql("SHOW TBLPROPERTIES touchline_tagged").collect()}
    assert tags["quality"] == "gold"
    described = spark.sql("DESCRIBE TABLE EXTENDED touchline_tagged").collect()
    assert ("Comment", "Club's rows") in {(r.col_name, r.data_type) for r in described}
    assert rows(spark.read.table("touchline_tagged")) == [(1,)]
    spark.sql("DROP TABLE touchline_tagged")


def test_json_groups(spark, rows, tmp_path):
    df = spark.createDataFrame([(1, 100), (2, 100), (3, 200)], "id INT, league_id INT")
    path = str(tmp_path / "groups")
    sinks.write_json_groups(df, path, "league_id")
    assert {p.name for p in (tmp_path / "groups").glob("league_id=*")} == {
        "league_id=100", "league_id=200",
    }
    assert rows(spark.read.schema(df.schema).json(path), "id", "league_id") == rows(df)


def test_versions_keep_what_is_being_read(spark, rows, tmp_path):
    path, ddl = str(tmp_path / "progress"), layout("k INT, v STRING")
    sinks.write_version(spark.createDataFrame([(1, "a")], "k INT, v STRING"), path, 1, "json")
    first = sources.read_version(spark, path, ddl, "json")
    sinks.write_version(first.withColumn("v", F.lit("b")), path, 2, "json")
    sinks.write_version(first.withColumn("v", F.lit("b")), path, 2, "json")  # a retry
    assert rows(sources.read_version(spark, path, ddl, "json")) == [(1, "b")]
    assert rows(sources.read_version(spark, path, ddl, "json", 1)) == [(1, "a")]


def test_replace_partitions_touches_only_its_own(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    sinks.replace_partitions(spark.createDataFrame([(1, 1), (2, 2)], "v INT, p INT"), path, "p")
    again = spark.createDataFrame([(9, 2)], "v INT, p INT")
    for _ in range(2):
        sinks.replace_partitions(again, path, "p")
    assert rows(spark.read.parquet(path), "v", "p") == [(1, 1), (9, 2)]


def test_newest_version_reads_no_data(spark, rows, tmp_path):
    path, ddl = str(tmp_path / "progress"), layout("k INT")
    with pytest.raises(FileNotFoundError):
        sources.newest_version(spark, path)
    for version in (1, 2, 10):
        sinks.write_version(spark.createDataFrame([(version,)], "k INT"), path, version, "json")
    (tmp_path / "progress" / "version=11").mkdir()  # a writer that never finished
    for part in (tmp_path / "progress" / "version=1").glob("part-*"):
        part.write_text("no json at all")
    assert sources.versions(spark, path) == [1, 2, 10]
    assert rows(sources.read_version(spark, path, ddl, "json")) == [(10,)]
    assert sources.expire_versions(spark, path, 2) == [1]
    assert sources.versions(spark, path) == [2, 10]
    assert rows(sources.read_version(spark, path, ddl, "json", 2)) == [(2,)]


def test_packed_files_grow_with_rows_not_with_names(spark, rows, tmp_path):
    df = spark.range(300).select(
        F.format_string("part %s/\u00e9.json", F.col("id") % 100).alias("file"),
        F.when(F.col("id") % 3 > 0, F.col("id")).alias("id"),
    )
    df = df.unionByName(df.limit(2))
    sinks.write_packed(df, str(tmp_path / "packed"), "file", pack=100)
    back = landing.read_packed(spark, str(tmp_path / "packed"), "id BIGINT")
    assert back.columns == ["id", "source_file"]
    assert len(back.inputFiles()) <= 4
    assert rows(back) == rows(df.select("id", "file"))
    assert rows(landing.read_packed(spark, str(tmp_path / "packed"), layout("other INT")).distinct(), "other") == [
        (None,)
    ] * 100


def test_packed_rows_of_nothing(spark, rows, tmp_path):
    empty = spark.createDataFrame([], "file STRING, id BIGINT")
    sinks.write_packed(empty, str(tmp_path / "packed"), "file")
    assert rows(landing.read_packed(spark, str(tmp_path / "packed"), "id BIGINT")) == []


def test_landed_orders_are_not_a_file_per_name(spark):
    landed = queries.multi_line_rows(spark, SF_DIR)
    assert len(landed.inputFiles()) < landed.select("source_file").distinct().count()
