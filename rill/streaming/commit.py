"""Partitioned table sink with a partition-time commit step.

Each micro-batch is staged and moved under the table's partition paths
exactly once (``rill.streaming.staging``). Because the table tracks
partitions in the catalog, those files are invisible to readers until the
partition is added. After the write, every pending partition whose time
plus the commit delay is behind the watermark is published:

* ``metastore`` policy: ``ALTER TABLE ... ADD IF NOT EXISTS PARTITION``
* ``success-file`` policy: an empty ``_SUCCESS`` marker in its folder

The watermark is the largest event time written so far minus the
watermark delay, in epoch microseconds throughout: a message with an
absurd time moves it as the rule says and stops nothing. Its partition,
like one without a time, has no partition time and stays unpublished; its
rows are on disk. Rows without an event time are counted in the state
(``null_event_times``).

State (batch id, watermark, pending partitions) is one small file per
batch beside the query checkpoint. Re-adding a partition or rewriting its
marker is idempotent. A partition that gets late rows after its commit
receives more files; the session that started the query sees them at
once, other sessions refresh the table.

Only partition names reach the driver: the pending list is bounded by
(watermark lag + delay) / partition grain, plus one name per junk time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rill.functions.time import parse_duration
from rill.operators.partition_commit import partition_time
from rill.plans.catalog import add_partitions, refresh, table_location, table_properties
from rill.streaming import fs
from rill.streaming.staging import BatchLog, StagedBatch, partitions_of

# Table property keys and policy names of the commit step.
PROP_TRIGGER = "sink.partition-commit.trigger"
PROP_DELAY = "sink.partition-commit.delay"
PROP_POLICY = "sink.partition-commit.policy.kind"
PROP_PATTERN = "partition.time-extractor.timestamp-pattern"
TRIGGER_PARTITION_TIME = "partition-time"
POLICY_METASTORE = "metastore"
POLICY_SUCCESS_FILE = "success-file"
SUCCESS_FILE_NAME = "_SUCCESS"

def micros(duration: str) -> int:
    return round(parse_duration(duration).total_seconds() * 1_000_000)


def ready_partitions(
    spark: SparkSession, pending: list[dict[str, str]], pattern: str, watermark: int | None, commit_delay: int,
) -> list[dict[str, str]]:
    """Pending partitions with ``partition_time + delay < watermark``, all in epoch microseconds."""
    if watermark is None or not pending:
        return []
    cols = list(pending[0])
    frame = spark.createDataFrame([tuple(p[c] for c in cols) for p in pending], ", ".join(f"`{c}` STRING" for c in cols))
    times = frame.select(*cols, F.unix_micros(partition_time(pattern).cast("timestamp")).alias("__t")).collect()
    return [{c: r[c] for c in cols} for r in times if r["__t"] is not None and r["__t"] + commit_delay < watermark]


def _path(values: dict[str, str], cols: Sequence[str]) -> str:
    return "/".join(f"{c}={values[c]}" for c in cols)


class PartitionCommitSink:
    """foreachBatch sink: write files, then commit partitions by time.

    ``row_filter`` keeps rows out of the table while they still move the
    watermark; ``aux_cols`` (e.g. an event-time column the table layout
    lacks) are read for bookkeeping and dropped before writing.
    """

    caller: SparkSession | None = None

    def __init__(
        self,
        table: str,
        *,
        partition_cols: Sequence[str],
        pattern: str,
        commit_delay: str,
        watermark_delay: str,
        event_time: Column,
        state_dir: str,
        policies: Sequence[str] = (POLICY_METASTORE, POLICY_SUCCESS_FILE),
        row_filter: Column | None = None,
        aux_cols: Sequence[str] = (),
    ):
        self.table = table
        self.aux_cols = list(aux_cols)
        self.partition_cols = list(partition_cols)
        self.pattern = pattern
        self.commit_delay = micros(commit_delay)
        self.watermark_delay = micros(watermark_delay)
        self.event_time = event_time
        self.policies = [p.strip() for p in policies]
        self.row_filter = row_filter
        self.state_dir = state_dir
        self.log = BatchLog(state_dir, "commit-state")

    @classmethod
    def from_table(
        cls, spark: SparkSession, table: str, *, partition_cols: Sequence[str],
        event_time: Column, watermark_delay: str, state_dir: str,
        row_filter: Column | None = None,
        aux_cols: Sequence[str] = (),
    ) -> "PartitionCommitSink":
        """Read trigger, delay, policies and pattern from the table's properties."""
        props = table_properties(spark, table)
        trigger = props.get(PROP_TRIGGER, TRIGGER_PARTITION_TIME)
        if trigger != TRIGGER_PARTITION_TIME:
            raise ValueError(f"only the {TRIGGER_PARTITION_TIME!r} trigger is supported, got {trigger!r}")
        return cls(
            table,
            partition_cols=partition_cols,
            pattern=props[PROP_PATTERN],
            commit_delay=props.get(PROP_DELAY, "0 s"),
            watermark_delay=watermark_delay,
            event_time=event_time,
            state_dir=state_dir,
            policies=props.get(PROP_POLICY, POLICY_METASTORE).split(","),
            row_filter=row_filter,
            aux_cols=aux_cols,
        )

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        spark = batch_df.sparkSession
        state = self.log.load(spark)
        if BatchLog.done(state, batch_id):
            return
        location = table_location(spark, self.table)
        batch = StagedBatch(spark, self.state_dir, batch_id, location)
        # the watermark sees every row, pending partitions only kept rows
        record = batch.write(
            batch_df, self.partition_cols, keep=self.row_filter, drop=self.aux_cols,
            measures={
                "max": F.max(F.unix_micros(self.event_time.cast("timestamp"))),
                "nulls": F.count_if(self.event_time.isNull()),
            },
        )
        batch.publish(record)

        written = partitions_of(record["files"])
        # a partition without values (NULL event time) has no partition
        # time, so the time rule can never publish it
        pending = {tuple(p[c] for c in self.partition_cols) for p in [*state.get("pending", []), *written]
                   if all(p[c] is not None for c in self.partition_cols)}
        seen = [m for m in (state.get("max_event_micros"), record["measures"]["max"]) if m is not None]
        most = max(seen, default=None)
        pending_list = [dict(zip(self.partition_cols, p)) for p in sorted(pending)]
        watermark = None if most is None else most - self.watermark_delay
        ready = ready_partitions(spark, pending_list, self.pattern, watermark, self.commit_delay)
        self._commit(spark, location, ready)
        if written:
            refresh(self.table, spark, self.caller)

        ready_keys = {tuple(p[c] for c in self.partition_cols) for p in ready}
        self.log.save(spark, {
            "batch": batch_id,
            "max_event_micros": most,
            "null_event_times": state.get("null_event_times", 0) + (record["measures"]["nulls"] or 0),
            "pending": [p for p in pending_list if tuple(p[c] for c in self.partition_cols) not in ready_keys],
            "committed": state.get("committed", 0) + len(ready),
        })
        batch.clean()

    def _commit(self, spark: SparkSession, location: str, ready: list[dict[str, str]]) -> None:
        if not ready:
            return
        if POLICY_METASTORE in self.policies:
            add_partitions(spark, self.table, self.partition_cols, ready)
            refresh(self.table, spark, self.caller)
        if POLICY_SUCCESS_FILE in self.policies:
            fs.touch_all(
                spark, location.rstrip("/"), [f"{_path(p, self.partition_cols)}/{SUCCESS_FILE_NAME}" for p in ready]
            )
