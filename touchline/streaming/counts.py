"""Rows that a stream keeps and drops, per micro-batch."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import (
    QueryIdleEvent,
    QueryProgressEvent,
    QueryStartedEvent,
    QueryTerminatedEvent,
    StreamingQueryListener,
)

from touchline.operators.quality import drop_violations

SEEN, DROPPED = "seen", "dropped_"


def observed(df: DataFrame, name: str, **expectations: str) -> DataFrame:
    """Rows that meet every condition; what was seen and dropped goes along as metrics.

    The metrics are counted where the rows pass by: no second pass, no shuffle, no state.  A
    row that breaks several conditions counts for each, and once among the rows not kept.
    """
    kept = F.lit(True)
    for condition in expectations.values():
        kept = kept & F.coalesce(F.expr(condition), F.lit(False))
    counts = [
        F.count_if(~F.coalesce(F.expr(c), F.lit(False))).alias(f"{DROPPED}{n}")
        for n, c in expectations.items()
    ]
    metrics = df.observe(name, F.count(F.lit(1)).alias(SEEN), F.count_if(kept).alias("kept"), *counts)
    return drop_violations(metrics, **expectations)


class DropCounts(StreamingQueryListener):
    """Gathers the metrics of one name from every progress event of all streams.

    Register it with ``spark.streams.addListener`` before the stream starts.
    """

    def __init__(self, name: str) -> None:
        self.name = name
        self._batches: dict[tuple[str, int], dict[str, int]] = {}

    def onQueryStarted(self, event: QueryStartedEvent) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event: QueryProgressEvent) -> None:  # noqa: N802
        metrics = event.progress.observedMetrics.get(self.name)
        if metrics is not None:
            self._batches[str(event.progress.runId), event.progress.batchId] = metrics.asDict()

    def onQueryIdle(self, event: QueryIdleEvent) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event: QueryTerminatedEvent) -> None:  # noqa: N802
        pass

    def batches(self, spark: SparkSession, query: StreamingQuery, patience: float = 60.0) -> DataFrame:
        """(batch_id, rule, seen, kept, dropped) of a stream that has ended.

        Events come a little after the batches; this waits for the last one.
        """
        last = query.lastProgress
        wanted = (str(query.runId), last.batchId) if last is not None else None
        end = time.monotonic() + patience
        while wanted is not None and self.name in last.observedMetrics and wanted not in self._batches:
            if time.monotonic() > end:
                raise TimeoutError(f"no metrics {self.name} of batch {wanted[1]}")
            time.sleep(0.05)
        rows = [
            (batch, metric.removeprefix(DROPPED), metrics[SEEN], metrics["kept"], number)
            for (run, batch), metrics in self._batches.items()
            if run == str(query.runId)
            for metric, number in metrics.items()
            if metric.startswith(DROPPED)
        ]
        layout = "batch_id BIGINT, rule STRING, seen BIGINT, kept BIGINT, dropped BIGINT"
        return spark.createDataFrame(rows, layout)
