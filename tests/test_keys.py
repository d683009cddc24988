"""F1, F2"""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Window, functions as F

from touchline.operators.keys import dense_key, spread_key


def numbered(df, order):
    return {tuple(r[c] for c in order): r["k"] for r in dense_key(df, "k", order).collect()}


def test_equals_row_number(spark):
    df = spark.range(5000).select(
        (F.col("id") * 7919 % 5003).alias("a"), (F.col("id") % 13).cast("string").alias("b")
    )
    want = df.withColumn("k", F.row_number().over(Window.orderBy("b", "a")))
    assert numbered(df, ["b", "a"]) == {(r.b, r.a): r.k for r in want.collect()}


def test_many_slices(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(1000, numPartitions=7).select(F.col("id").alias("a"))
        got = numbered(df, ["a"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == {(i,): i + 1 for i in range(1000)}


def test_one_row_empty_and_more_partitions_than_rows(spark):
    one = spark.createDataFrame([(5, "x")], "a INT, v STRING").repartition(6)
    assert [tuple(r) for r in dense_key(one, "k", ["a"]).collect()] == [(5, "x", 1)]
    assert dense_key(one.filter("a > 5"), "k", ["a"]).count() == 0


def test_hot_leading_column_and_null_key(spark):
    df = spark.range(300).select(
        F.when(F.col("id") % 3 != 0, F.lit("hot")).alias("a"), F.col("id").alias("b")
    )
    got = numbered(df, ["a", "b"])
    assert sorted(got.values()) == list(range(1, 301))
    assert got[(None, 0)] == 1 and got[("hot", 1)] == 101


def test_duplicate_order_key_is_refused(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "a INT")
    with pytest.raises(PySparkException, match="duplicate order key"):
        dense_key(df, "k", ["a"]).collect()


def test_no_single_partition_over_the_rows(spark):
    """Only the per-slice counts, one row per slice, meet in one partition."""
    df = spark.range(1000).select(F.col("id").alias("a"))
    plan = dense_key(df, "k", ["a"])._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    gathered = [i for i, line in enumerate(lines) if "SinglePartition" in line]
    assert len(gathered) == 1 and "HashAggregate" in lines[gathered[0] + 1]


def test_input_is_computed_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = spark.range(100).mapInArrow(count, "id LONG")
    assert dense_key(df, "k", ["id"]).count() == 100
    # range bounds are taken from a sample of the rows, which reads them once more
    assert seen.value <= 200


def test_spread_key_is_unique(spark):
    df = spread_key(spark.range(100, numPartitions=5), "k")
    assert df.select("k").distinct().count() == 100
