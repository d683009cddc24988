"""One key with a third of all rows: joins and writes are split, results stay whole."""

import pytest
from pyspark.sql import functions as F

from touchline.plans import gold
from touchline.sinks.tables import write_json_groups
from touchline.scratch import dealt, drop_scratch, scratch_dir, spill

SHUFFLED = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture
def shuffled(spark):
    old = {k: spark.conf.get(k, None) for k in SHUFFLED}
    for k, v in SHUFFLED.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_team_is_split_when_teams_are_too_large_to_broadcast(shuffled):
    spark = shuffled
    n = 6000
    fixtures = spark.range(n, numPartitions=6).select(
        F.col("id").alias("fixture_id"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 500).alias("home_team_id"),
        (F.col("id") % 499 + 1).alias("away_team_id"),
        F.lit(1).cast("bigint").alias("league_id"),
        F.lit("2024-01-01").cast("date").alias("date"),
        F.repeat(F.lit("x"), 20).alias("round"),
        F.lit(2023).alias("season"),
    ).withColumn("fixture_key", F.col("fixture_id"))
    teams = spark.range(501).select(
        F.col("id").alias("team_id"), F.col("id").alias("team_key"), F.col("id").cast("string").alias("name")
    )
    leagues = spark.sql("SELECT 1L AS league_id, 1L AS league_key, 'L' AS name")
    dates = spark.sql("SELECT DATE '2024-01-01' AS date, 20240101 AS date_key, '2023-24' AS season")
    star = gold.match_star(fixtures, teams, leagues, dates)
    plan = final_plan(star)
    assert "SortMergeJoin(skew=true)" in plan
    assert star.count() == n
    assert star.filter("home_team_name = '0'").count() == sum(
        1 for i in range(n) if i % 3 == 0 or i % 500 == 0
    )


def test_hot_group_is_written_as_several_files(shuffled, rows, tmp_path):
    df = shuffled.range(9000, numPartitions=6).select(
        "id", F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 40 + 2).alias("league_id")
    )
    write_json_groups(df, str(tmp_path / "g"), "league_id")
    hot = list((tmp_path / "g" / "league_id=1").glob("*.json"))
    assert len(hot) > 1
    assert shuffled.read.schema(df.schema).json(str(tmp_path / "g")).count() == 9000


def test_scratch_is_shared_and_removable(spark, rows):
    df = spark.createDataFrame([(1, None)], "a INT, b TIMESTAMP")
    kept = spill(df, "sample")
    assert rows(kept) == rows(df) and kept.schema == df.schema
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        assert scratch_dir(spark, "x").startswith(shared)
    assert drop_scratch(spark)
    with pytest.raises(Exception):
        kept.count()


def test_slices_follow_the_rows_and_not_the_session(spark, rows):
    df = spark.range(2000).select((F.col("id") % 500).alias("k"), F.col("id").alias("v"))
    slices = dealt(df, "test-dealt", "k", rows=100)
    assert slices.rdd.getNumPartitions() == 20 > int(spark.conf.get("spark.sql.shuffle.partitions"))
    homes = slices.select("k", F.spark_partition_id().alias("slice")).distinct()
    assert homes.count() == 500
    assert rows(slices) == rows(df)
    assert "Exchange" not in slices.groupBy("k").count()._jdf.queryExecution().executedPlan().toString().replace(
        "Exchange hashpartitioning(k", "", 1
    )
    assert dealt(df.filter("v < 0"), "test-dealt", "k").count() == 0
