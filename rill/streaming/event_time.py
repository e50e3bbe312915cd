"""Stateful sinks whose event time lives in the batch log.

``EventTimeWindowSink`` aggregates tumbling windows, routes rows that come
behind the watermark to a table of their own, and lets windows and watermark
run on different clocks. ``MonotoneTimeSink`` stamps each row with the largest
event time seen so far. Neither is expressible with ``withWatermark``, which
drops late rows inside the aggregation and ties windows and watermark to one
column.

During micro-batch n the watermark is the largest watermark time of the
batches before n minus the delay. A row is late if its window had closed
under that watermark; after the batch, the windows closed by the new
watermark are emitted, once. No later batch is needed to emit them.

Exactly once: what a batch finds in its rows (partial aggregates, largest
time, counts) is written under the batch id and recorded; the open windows
after the batch are a folder per batch id, an input of the next; results and
late rows go through staged batches. The batch log is saved last, so that a
retry at any step repeats only idempotent work.

Sizes: the open windows hold one row per window and key, and are rewritten
each batch: (delay + window) / window times keys rows, never the rows of the
windows. The driver sees counters, and one maximum per topic partition.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rill.functions.time import parse_duration
from rill.operators.layout import keep_observations
from rill.operators.projection import insert_by_position
from rill.operators.replay import running_max
from rill.plans.catalog import refresh, table_location
from rill.streaming import fs
from rill.streaming.staging import BatchLog, StagedBatch, observed

# Fixed value: the host closes a window at its last millisecond.
HOST_SLACK_MICROS = {"host": 1_000, "spark": 0}


def micros(duration: str) -> int:
    return round(parse_duration(duration).total_seconds() * 1_000_000)


def time_micros(col) -> Column:
    return F.unix_micros((F.col(col) if isinstance(col, str) else col).cast("timestamp"))


def zone_less(us) -> Column:
    return F.timestamp_micros(us).cast("timestamp_ntz")


@dataclass(frozen=True)
class Partial:
    """An aggregate taken in parts: over a batch's rows, then over the parts."""

    first: Callable[[], Column]  # made when a session is there
    merge: Callable[[str], Column]


def counted(col: str | None = None) -> Partial:
    return Partial(lambda: F.count(F.lit(1) if col is None else col), F.sum)


def summed(col: str) -> Partial:
    return Partial(lambda: F.sum(col), F.sum)


def largest(col: str) -> Partial:
    return Partial(lambda: F.max(col), F.max)


def smallest(col: str) -> Partial:
    return Partial(lambda: F.min(col), F.min)


class Landing:
    """Staged, exactly-once append of one batch's rows to an unpartitioned table."""

    def __init__(self, spark: SparkSession, table: str, state_dir: str, batch_id: int, caller: SparkSession | None):
        self.spark, self.table, self.caller = spark, table, caller
        self.batch = StagedBatch(spark, state_dir, batch_id, table_location(spark, table))

    def land(self, rows: DataFrame) -> None:
        record = self.batch.write(insert_by_position(rows, self.spark.table(self.table).schema), [])
        self.batch.publish(record)
        if record["files"]:
            refresh(self.table, self.spark, self.caller)

    def clean(self) -> None:
        self.batch.clean()


class EventTimeWindowSink:
    """foreachBatch: windowed aggregates to ``table``, late rows to ``late_table``.

    ``window_time`` places a row in its window, ``watermark_time`` (the same
    column by default) moves the watermark. Result columns by position: keys,
    aggregates, window start, window end. Late rows by position: ``late_cols``,
    window start, window end, the watermark they met; without a late table they
    are counted only. Rows without a window time belong to no window and are
    counted; rows without a watermark time do not move the watermark.
    """

    caller: SparkSession | None = None

    def __init__(
        self, table: str, state_dir: str, *, window_time: str, size: str, delay: str, keys: Sequence[str],
        aggs: dict[str, Partial], watermark_time: str | None = None, late_table: str | None = None,
        late_cols: Sequence[str] = (), closing_rule: str = "host",
    ):
        if closing_rule not in HOST_SLACK_MICROS:
            raise ValueError("closing_rule must be 'host' or 'spark'")
        self.table, self.late_table, self.late_cols = table, late_table, list(late_cols)
        self.window_time, self.watermark_time = window_time, watermark_time or window_time
        self.width, self.delay, self.slack = micros(size), micros(delay), HOST_SLACK_MICROS[closing_rule]
        self.keys, self.aggs = list(keys), dict(aggs)
        self.state_dir = state_dir.rstrip("/")
        self.log = BatchLog(state_dir, "window-state")

    def _start(self) -> Column:
        t = time_micros(self.window_time)
        return t - F.pmod(t, F.lit(self.width))

    def _closed(self, watermark: int | None) -> Column:
        """Has the window that begins at ``__start`` closed under the watermark?"""
        if watermark is None:
            return F.lit(False)
        return F.col("__start") + F.lit(self.width - self.slack) <= F.lit(watermark)

    def _parts(self, spark: SparkSession, rows: DataFrame, watermark: int | None, batch_id: int) -> tuple[DataFrame, dict]:
        """The batch's partial aggregates, written once, and what was seen of its rows; one pass."""
        path, record = f"{self.state_dir}/parts/{batch_id}", f"{self.state_dir}/parts/{batch_id}.json"
        late = F.coalesce(self._closed(watermark), F.lit(False))
        seen = Observation()
        measured = rows.observe(
            seen, F.max(time_micros(self.watermark_time)).alias("most"),
            F.count_if(F.col("__start").isNull()).alias("nulls"), F.count_if(late).alias("late"),
        )
        on_time = measured.where(F.col("__start").isNotNull() & ~late)
        parts = on_time.groupBy("__start", *self.keys).agg(*[a.first().alias(n) for n, a in self.aggs.items()])
        known = fs.read_text(spark, record)
        if known is None:
            keep_observations(spark)
            parts.write.mode("overwrite").parquet(path)
            known = json.dumps({"most": None, "nulls": 0, "late": 0, **observed(seen)})
            fs.write_text(spark, record, known)
        return self._read(spark, path, parts.schema), json.loads(known)

    @staticmethod
    def _read(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
        return spark.read.schema(schema).parquet(path)

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        spark = batch_df.sparkSession
        state = self.log.load(spark)
        if BatchLog.done(state, batch_id):
            self._sweep(spark, state, batch_id)
            return
        before = state.get("watermark")
        rows = batch_df.withColumn("__start", self._start())
        parts, seen = self._parts(spark, rows, before, batch_id)
        marks = [w for w in (before, None if seen["most"] is None else seen["most"] - self.delay) if w is not None]
        watermark = max(marks, default=None)

        windows = parts
        if state.get("open") is not None:
            windows = parts.unionByName(self._read(spark, f"{self.state_dir}/open/{state['open']}", parts.schema))
        windows = windows.groupBy("__start", *self.keys).agg(*[a.merge(n).alias(n) for n, a in self.aggs.items()])
        closed = self._closed(watermark)
        windows.where(~closed).select(*parts.columns).write.mode("overwrite").parquet(f"{self.state_dir}/open/{batch_id}")
        bounds = (zone_less(F.col("__start")), zone_less(F.col("__start") + F.lit(self.width)))
        results = Landing(spark, self.table, f"{self.state_dir}/results", batch_id, self.caller)
        results.land(windows.where(closed).select(*self.keys, *self.aggs, bounds[0].alias("window_start"), bounds[1].alias("window_end")))
        landings = [results]
        if seen["late"] and self.late_table:
            behind = Landing(spark, self.late_table, f"{self.state_dir}/late", batch_id, self.caller)
            behind.land(rows.where(self._closed(before)).select(
                *self.late_cols, bounds[0].alias("window_start"), bounds[1].alias("window_end"),
                zone_less(F.lit(before)).alias("watermark"),
            ))
            landings.append(behind)

        self.log.save(spark, {
            "batch": batch_id, "open": batch_id, "watermark": watermark,
            "null_event_times": state.get("null_event_times", 0) + seen["nulls"],
            "late_rows": state.get("late_rows", 0) + seen["late"],
        })
        for landing in landings:
            landing.clean()
        self._sweep(spark, {"open": batch_id}, batch_id)

    def _sweep(self, spark: SparkSession, state: dict, batch_id: int) -> None:
        """After the state is saved: the batch's parts and all open windows but the newest."""
        fs.delete(spark, f"{self.state_dir}/parts/{batch_id}")
        fs.delete(spark, f"{self.state_dir}/parts/{batch_id}.json")
        for name in fs.list_names(spark, f"{self.state_dir}/open"):
            if name != str(state["open"]):
                fs.delete(spark, f"{self.state_dir}/open/{name}")


class MonotoneTimeSink:
    """foreachBatch: rows with the running maximum of their event time, appended to ``table``.

    The maximum so far, one per ``partition_cols`` value (e.g. topic
    partition), is carried from batch to batch in the log; within a batch the
    rows are scanned in ``order_cols`` order by ``running_max``. Columns by
    position: ``id_cols``, ``partition_cols``, the time, the monotone time, and
    that minus the delay. Batches must arrive in order, as topic offsets do.
    """

    caller: SparkSession | None = None

    def __init__(
        self, table: str, state_dir: str, *, time_col: str, order_cols: Sequence[str], delay: str,
        id_cols: Sequence[str] = (), partition_cols: Sequence[str] = (),
    ):
        self.table, self.time_col, self.delay = table, time_col, micros(delay)
        self.order_cols, self.id_cols, self.partition_cols = list(order_cols), list(id_cols), list(partition_cols)
        self.state_dir = state_dir.rstrip("/")
        self.log = BatchLog(state_dir, "monotone-state")

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        spark = batch_df.sparkSession
        state = self.log.load(spark)
        keys, scan = self.partition_cols, f"{self.state_dir}/scan/{batch_id}"
        if BatchLog.done(state, batch_id):
            fs.delete(spark, scan)
            return
        needed = batch_df.select(*dict.fromkeys([*self.id_cols, *keys, self.time_col, *self.order_cols]))
        seen = running_max(needed, self.time_col, self.order_cols, out_col="__seen", partition_cols=keys, path=scan)
        held = StructType([*[needed.schema[k] for k in keys]]).add("__carry", "long")
        # one row per topic partition
        texts = [json.dumps(dict(zip([*keys, "__carry"], row))) for row in state.get("most", [])]
        carried = spark.createDataFrame([(t,) for t in texts], "t string").select(F.from_json("t", held).alias("c"))
        carried = carried.select(*[F.col("c")[k].alias(f"__key_{i}") for i, k in enumerate(keys)], F.col("c.__carry").alias("__carry"))
        same = F.lit(True)
        for i, k in enumerate(keys):
            same &= F.col(k).eqNullSafe(F.col(f"__key_{i}"))
        rows = seen.join(F.broadcast(carried), same, "left").withColumn("__most", F.greatest(time_micros("__seen"), F.col("__carry")))

        landing = Landing(spark, self.table, self.state_dir, batch_id, self.caller)
        landing.land(rows.select(
            *self.id_cols, *keys, self.time_col, zone_less(F.col("__most")).alias("monotone_ts"),
            zone_less(F.col("__most") - F.lit(self.delay)).alias("watermark"),
        ))
        most = {tuple(row[:-1]): row[-1] for row in state.get("most", [])}
        ends = rows.groupBy(*keys).agg(F.max("__most").alias("__most")) if keys else rows.agg(F.max("__most").alias("__most"))
        for r in ends.where(F.col("__most").isNotNull()).select(F.to_json(F.struct(*keys, "__most")).alias("t")).collect():
            row = json.loads(r["t"])
            most[tuple(row.get(k) for k in keys)] = row["__most"]
        self.log.save(spark, {"batch": batch_id, "most": [[*k, v] for k, v in sorted(most.items(), key=str)]})
        landing.clean()
        fs.delete(spark, scan)
