"""Totals over the whole life of a streaming job.

Spark keeps the progress of the last 100 micro-batches only. ``Counters``
listens to every batch's progress, adds up rows read, rows without an event
time and rows dropped behind the watermark, and saves the totals per batch
beside the checkpoint, so that a job started again counts on. A batch that is
reported twice counts once.
"""

from __future__ import annotations

import threading

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from rill.operators.windows import NULL_TIMES
from rill.streaming.staging import BatchLog

NAMES = ("batches", "input_rows", "null_event_times", "dropped_by_watermark")


def counts_of(progress) -> dict[str, int]:
    """What one micro-batch adds to each total."""
    seen = progress.observedMetrics.get(NULL_TIMES)
    return {
        "batches": 1,
        "input_rows": int(progress.numInputRows or 0),
        "null_event_times": int((seen[0] if seen is not None else 0) or 0),
        "dropped_by_watermark": sum(int(op.numRowsDroppedByWatermark or 0) for op in progress.stateOperators),
    }


class Counters(StreamingQueryListener):
    """Listener for one query; register it before the query starts, then ``attach``.

    Progress that comes before ``attach`` is kept and counted then. Totals
    live under ``folder`` (without one, in memory only).
    """

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark = spark
        self.log = BatchLog(folder, "counters") if folder else None
        saved = self.log.load(spark) if self.log else {"batch": None}
        self.totals = {n: saved.get(n, 0) for n in NAMES}
        self.last = saved["batch"]
        self._run_id: str | None = None
        self._early: list = []
        self._over: set[str] = set()
        self._lock = threading.Lock()
        self._ended = threading.Event()

    def attach(self, query: StreamingQuery) -> None:
        with self._lock:
            self._run_id = str(query.runId)
            for progress in self._early:
                self._add(progress)
            self._early = []
            if self._run_id in self._over:
                self._ended.set()

    def _add(self, progress) -> None:
        if str(progress.runId) != self._run_id or (self.last is not None and progress.batchId <= self.last):
            return
        for name, n in counts_of(progress).items():
            self.totals[name] += n
        if self.log:
            self.log.save(self.spark, {"batch": progress.batchId, **self.totals})
        self.last = progress.batchId

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        with self._lock:
            if self._run_id is None:
                self._early.append(event.progress)
            else:
                self._add(event.progress)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._lock:
            self._over.add(str(event.runId))
            if self._run_id in self._over:
                self._ended.set()

    def settle(self, timeout: float = 30.0) -> dict[str, int]:
        """Wait until the end of the query has been reported, after all its progress; the totals."""
        if not self._ended.wait(timeout):
            raise TimeoutError("the end of the query has not been reported")
        return dict(self.totals)


def saved_totals(spark: SparkSession, folder: str) -> dict[str, int]:
    """The totals saved under a job's checkpoint; zeros if there are none."""
    state = BatchLog(folder, "counters").load(spark)
    return {n: state.get(n, 0) for n in NAMES}
