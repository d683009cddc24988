"""Surrogate keys (F1, F2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from touchline.scratch import spill

_LOCAL_BITS = (1 << 33) - 1  # monotonically_increasing_id keeps the row number in these


def dense_key(df: DataFrame, name: str, order_by: Sequence[str]) -> DataFrame:
    """append ``name`` = 1..N in the order of ``order_by``, a unique row key.

    Equal to ``row_number() OVER (ORDER BY ...)``, for any size by the same steps: whole rows
    are dealt by range, numbered inside each slice and written to scratch once, so that the
    slice sizes and the rows read back are the same even if executors are lost.  One small
    row per slice carries the offset.  ``df`` is computed once, with one exchange.  Equal
    keys are refused, since their numbers would depend on chance.
    """
    # Range partitioning keeps equal keys together and the local sort keeps them adjacent,
    # so the duplicate test adds no exchange.
    same_key = Window.partitionBy(*order_by).orderBy(*order_by)
    place = F.monotonically_increasing_id().bitwiseAND(F.lit(_LOCAL_BITS))
    sliced = (
        df.repartitionByRange(*order_by)
        .sortWithinPartitions(*order_by)
        .withColumn("__copy", F.row_number().over(same_key))
        .select(
            *df.columns,
            F.spark_partition_id().alias("__slice"),
            _refusing_copies(F.col("__copy"), name, place).alias("__place"),
        )
    )
    numbered = spill(sliced, f"key-{name}")
    earlier = Window.orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (  # one row per slice: bounded by the number of shuffle partitions
        numbered.groupBy("__slice")
        .agg(F.count(F.lit(1)).alias("__size"))
        .select("__slice", F.coalesce(F.sum("__size").over(earlier), F.lit(0)).alias("__before"))
    )
    return numbered.join(F.broadcast(offsets), "__slice").select(
        *df.columns, (F.col("__before") + F.col("__place") + 1).alias(name)
    )


def refusing_copies(df: DataFrame, name: str, order_by: Sequence[str]) -> DataFrame:
    """The rows of ``df`` as they are; equal keys are refused as by ``dense_key``.

    For results in which the numbers do not appear.  Rows meet by the first column, so the
    exchange is the one that a join on it needs anyway; ``name`` is 1 on each row.  Rows that a
    later step drops by a column of the key alone, as an inner join does null keys, are not met.
    """
    same_key = Window.partitionBy(*order_by).orderBy(*order_by)
    counted = df.repartition(order_by[0]).withColumn(name, F.row_number().over(same_key))
    copy = F.col(name)
    return counted.withColumn(name, _refusing_copies(copy, name, copy)).filter(F.col(name) == 1)


def _refusing_copies(copy: Column, name: str, number: Column) -> Column:
    refused = F.raise_error(F.lit(f"{name}: duplicate order key"))
    return F.when(copy > 1, refused).otherwise(number).cast("bigint")


def spread_key(df: DataFrame, name: str) -> DataFrame:
    """unique 64-bit key, neither dense nor stable between runs."""
    return df.withColumn(name, F.monotonically_increasing_id())
