"""Streams from landed files to bronze, silver and history."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from touchline.operators.tails import History
from touchline.plans import bronze, silver
from touchline.sinks.snapshots import Snapshots
from touchline.sinks.tables import replace_partitions
from touchline.sources.landing import stream_landing
from touchline.sources.tables import stream_table

BATCH = "batch_id"


def append_stream(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """B5 for stateless flows: append to a parquet table, then stop when caught up.

    The file sink records which files belong to which micro-batch, so a restart neither
    loses nor repeats rows.
    """
    return (
        rows.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def bronze_stream(
    spark: SparkSession,
    landing: str,
    schema: StructType | str,
    path: str,
    checkpoint: str,
    multi_line: bool = True,
    max_files: int | None = None,
) -> StreamingQuery:
    """New landed files, flattened and stamped, appended to a bronze table."""
    raw = stream_landing(spark, landing, schema, multi_line, max_files)
    return append_stream(bronze.flattened(raw), path, checkpoint)


def sql_stream(spark: SparkSession, raw: DataFrame, name: str, statement: str) -> DataFrame:
    """A6 in SQL: a stream of files under a view's name, transformed by a SELECT statement.

    The statement sees the stream's columns and, as ``source``, its file's ``file_path``,
    ``file_name``, ``file_size`` and ``file_modification_time``.
    """
    raw.select("*", F.col("_metadata").alias("source")).createOrReplaceTempView(name)
    return spark.sql(statement)


def projected_stream(
    spark: SparkSession,
    source: str,
    schema: StructType,
    project: Callable[[DataFrame], DataFrame],
    path: str,
    checkpoint: str,
    max_files: int | None = None,
) -> StreamingQuery:
    """A bronze table read as a stream, projected (and filtered) to silver."""
    return append_stream(
        project(stream_table(spark, source, schema, max_files)), path, checkpoint
    )


def replace_batches(
    rows: DataFrame, path: str, checkpoint: str, merge: Callable[[DataFrame], DataFrame]
) -> StreamingQuery:
    """B5 for flows that reduce rows inside a micro-batch: one partition per batch id.

    Running a batch again overwrites its own partition, so a replay changes nothing.  A batch
    is one partition, so its rows are written from where the merge left them.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        tagged = merge(batch).withColumn(BATCH, F.lit(batch_id))
        replace_partitions(tagged, path, BATCH, spread=False)

    return (
        rows.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def statistics_stream(raw: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Stamped statistics payloads to typed rows.

    The pivot works inside each payload, so the stream keeps no state; payloads of the
    same fixture in one micro-batch are reduced by maximum.
    """
    return replace_batches(
        silver.stats_from_payloads(raw), path, checkpoint, silver.merge_stats
    )


def history_stream(
    changes: DataFrame,
    root: str,
    checkpoint: str,
    keys: Sequence[str],
    sequence_by: str,
    ignore: Sequence[str] | None = None,
    tie_break: Sequence[str] = (),
    delete_when: Column | None = None,
    buckets: int = 64,
    keep: int | None = None,
    name: str = "history",
) -> StreamingQuery:
    """Keep a type 2 history of a change stream below ``root``.

    Each micro-batch is one commit of log and versions (``operators.tails``): it touches the
    tails of its keys only, late rows are exact, a failed batch leaves the history as it was,
    and a batch that runs again changes nothing.  ``read_history`` gives the versions.  With
    ``keep``, older commits than the last so many are removed after each batch.
    """
    layout = changes.schema

    def apply(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        snapshots = Snapshots(spark, root)
        base = snapshots.newest()
        mark = f"stream {spark.sparkContext.getLocalProperty('sql.streaming.queryId')}"
        if int(base.notes.get(mark, -1)) >= batch_id:
            return  # committed before the checkpoint was
        stored = History(
            snapshots, name, layout, keys, sequence_by, ignore, tie_break,
            delete_when=delete_when, buckets=buckets,
        )
        snapshots.commit(base, stored.advanced(base, batch), {mark: batch_id})
        if keep is not None:
            snapshots.expire(keep)

    return (
        changes.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
