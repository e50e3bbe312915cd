"""Start streaming writers and run them to the end of the available input."""

from __future__ import annotations

from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from rill.operators.windows import NULL_TIMES
from rill.streaming.counters import Counters


def run(
    writer: DataStreamWriter, *, name: str | None = None, timeout: float | None = None, counters: Counters | None = None,
) -> StreamingQuery:
    """Start ``writer`` and block until it stops (``availableNow``) or times out.

    Re-raises the query's failure, so a failed micro-batch fails the call.
    ``counters`` are complete when this returns.
    """
    if name:
        writer = writer.queryName(name)
    if counters is not None:
        counters.spark.streams.addListener(counters)
    try:
        query = writer.start()
        if counters is not None:
            counters.attach(query)
        finished = query.awaitTermination(timeout) if timeout else query.awaitTermination()
        if finished is False:
            query.stop()
            raise TimeoutError(f"streaming query {query.name or query.id} did not finish in {timeout}s")
        if query.exception() is not None:
            raise RuntimeError(f"streaming query failed: {query.exception()}")
        if counters is not None:
            counters.settle()
        return query
    finally:
        if counters is not None:
            counters.spark.streams.removeListener(counters)


def dropped_by_watermark(query: StreamingQuery) -> int:
    """Rows (groups, after partial aggregation) a stateful operator dropped as late.

    Over the progress that the query still holds (100 batches); ``Counters`` has totals.
    """
    total = 0
    for progress in query.recentProgress:
        for op in progress.get("stateOperators", []) if isinstance(progress, dict) else progress.stateOperators:
            n = op.get("numRowsDroppedByWatermark", 0) if isinstance(op, dict) else op.numRowsDroppedByWatermark
            total += int(n or 0)
    return total


def null_event_times(query: StreamingQuery) -> int:
    """Rows without an event time in the progress that the query still holds; ``Counters`` has totals."""
    total = 0
    for progress in query.recentProgress:
        seen = progress.get("observedMetrics", {}) if isinstance(progress, dict) else progress.observedMetrics
        row = seen.get(NULL_TIMES)
        if row is not None:
            total += int((row[NULL_TIMES] if isinstance(row, dict) else row[0]) or 0)
    return total
