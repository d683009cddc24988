"""Order-preserving numbers of distinct keys, without gathering them in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from touchline.scratch import spill


def ranked(keys: DataFrame, by: list[str], rank: str = "rank") -> DataFrame:
    """``keys`` (distinct in ``by``) with their place in the order of ``by``, from 0.

    The keys are dealt by range and written once, so both passes over them see the same
    slices; a slice is numbered on its own and one row per slice carries the offset.
    """
    parts = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = spill(
        keys.repartitionByRange(parts, *by).withColumn("__slice", F.spark_partition_id()), "ranks"
    )
    sizes = cut.groupBy("__slice").agg(F.count(F.lit(1)).alias("__n"))
    # At most one row per slice.
    offsets = sizes.select(
        F.col("__slice").alias("__of"),
        (F.sum("__n").over(W.orderBy("__slice")) - F.col("__n")).alias("__offset"),
    )
    place = F.row_number().over(W.partitionBy("__slice").orderBy(*by)) - 1
    return (
        cut.withColumn("__place", place)
        .join(F.broadcast(offsets), F.col("__slice") == F.col("__of"))
        .withColumn(rank, (F.col("__offset") + F.col("__place")).cast("long"))
        .drop("__slice", "__n", "__of", "__offset", "__place")
    )
