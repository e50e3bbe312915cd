"""Stream sinks: topic, console, text/file, table and JDBC.

The file and text sinks are exactly-once through Spark's manifest, the
table sinks through staged batches (``rill.streaming.staging``). The JDBC
and topic sinks are at-least-once: a crash after a batch's write and
before its id is recorded sends that batch again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from rill.operators.projection import insert_by_position
from rill.plans.catalog import add_partitions, refresh, table_location
from rill.streaming import fs
from rill.streaming.staging import BatchLog, StagedBatch, partitions_of


def _trigger(writer: DataStreamWriter, trigger: str | None, available_now: bool) -> DataStreamWriter:
    if available_now:
        return writer.trigger(availableNow=True)
    if trigger:
        return writer.trigger(processingTime=trigger)
    return writer


def to_topic(
    df: DataFrame,
    topic: str,
    bootstrap_servers: str,
    checkpoint: str,
    *,
    trigger: str | None = None,
    available_now: bool = False,
    output_mode: str = "append",
) -> DataStreamWriter:
    """Write the ``value`` column (and ``key`` if present) to a topic."""
    cols = [F.col("value").cast("string").alias("value")]
    if "key" in df.columns:
        cols.insert(0, F.col("key").cast("string").alias("key"))
    writer = (
        df.select(*cols).writeStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .outputMode(output_mode)
    )
    return _trigger(writer, trigger, available_now)


class PrintSink:
    """foreachBatch: print every row of each micro-batch.

    Rows come to the driver one partition at a time.
    """

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        print_rows(batch_df)


def print_rows(df: DataFrame) -> None:
    """One line per row, all rows."""
    for row in df.toLocalIterator():
        print("\t".join("NULL" if v is None else str(v) for v in row))


def to_console(df: DataFrame, *, output_mode: str = "append", trigger: str | None = None,
               available_now: bool = False) -> DataStreamWriter:
    """Print every row of each micro-batch."""
    writer = df.writeStream.foreachBatch(PrintSink()).outputMode(output_mode)
    return _trigger(writer, trigger, available_now)


def to_files(
    df: DataFrame,
    path: str,
    checkpoint: str,
    *,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    trigger: str | None = None,
    available_now: bool = False,
) -> DataStreamWriter:
    """Append to a folder of files (parquet, csv, json, text)."""
    writer = (
        df.writeStream.format(fmt).outputMode("append")
        .option("path", path).option("checkpointLocation", checkpoint)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return _trigger(writer, trigger, available_now)


def to_text(
    df: DataFrame, path: str, checkpoint: str, *,
    trigger: str | None = None, available_now: bool = False,
) -> DataStreamWriter:
    """One line per row; the frame must have exactly one string column."""
    if len(df.columns) != 1:
        raise ValueError(f"text sink takes one string column, got {df.columns}")
    return to_files(df, path, checkpoint, fmt="text", trigger=trigger, available_now=available_now)


def write_files(df: DataFrame, path: str, *, fmt: str = "parquet", mode: str = "append",
                partition_by: Sequence[str] = ()) -> None:
    """Batch file-table sink (parquet, csv, json, text)."""
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


class TableAppendSink:
    """foreachBatch: append each micro-batch to a catalog table, exactly once.

    Columns go in by position (as ``INSERT INTO``), so partitioned tables
    get dynamic partitions from the trailing columns. Rows are rebalanced on
    the partition values first, so each partition gets few files and a hot
    one is split. The session that started the query sees new rows at once;
    other sessions refresh the table.
    """

    caller: SparkSession | None = None

    def __init__(self, table: str, state_dir: str, *, partition_cols: Sequence[str] = ()):
        self.table = table
        self.state_dir = state_dir
        self.partition_cols = list(partition_cols)
        self.log = BatchLog(state_dir)

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        spark = batch_df.sparkSession
        state = self.log.load(spark)
        if BatchLog.done(state, batch_id):
            return
        rows = insert_by_position(batch_df, spark.table(self.table).schema)
        batch = StagedBatch(spark, self.state_dir, batch_id, table_location(spark, self.table))
        record = batch.write(rows, self.partition_cols)
        batch.publish(record)
        if self.partition_cols:
            add_partitions(spark, self.table, self.partition_cols, partitions_of(record["files"]))
        if record["files"]:
            refresh(self.table, spark, self.caller)
        self.log.save(spark, {**state, "batch": batch_id})
        batch.clean()


class JdbcAppendSink:
    """foreachBatch: append each micro-batch to a JDBC table.

    Executors write their partitions in parallel over their own
    connections; ``batchsize`` rows per round trip.
    """

    def __init__(self, url: str, table: str, properties: dict[str, str] | None = None,
                 state_dir: str | None = None, *, batch_size: int = 1000):
        self.url, self.table = url, table
        self.properties = dict(properties or {})
        self.properties.setdefault("batchsize", str(batch_size))
        self.log = BatchLog(state_dir) if state_dir else None

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        spark = batch_df.sparkSession
        state = self.log.load(spark) if self.log else {"batch": None}
        if BatchLog.done(state, batch_id):
            return
        batch_df.write.jdbc(self.url, self.table, mode="append", properties=self.properties)
        if self.log:
            state["batch"] = batch_id
            self.log.save(spark, state)


class CompleteResultSink:
    """foreachBatch for complete output: each micro-batch carries the whole
    (small, aggregated) result. It is written to a folder of its own and
    replaces the one before by the rename that saves the batch log, so a
    reader (``read_complete``) or a crash never meets a missing result. Update
    output carries changed groups only: use ``rill.streaming.upsert``."""

    def __init__(self, path: str, fmt: str = "parquet"):
        self.path, self.fmt = path.rstrip("/"), fmt
        self.log = BatchLog(self.path, "_log")

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        spark = batch_df.sparkSession
        state = self.log.load(spark)
        if BatchLog.done(state, batch_id):
            return
        batch_df.write.mode("overwrite").format(self.fmt).save(f"{self.path}/{batch_id}")
        self.log.save(spark, {"batch": batch_id, "before": state["batch"], "format": self.fmt})
        if state.get("before") is not None:  # the one before stays for readers that have begun
            fs.delete(spark, f"{self.path}/{state['before']}")


def read_complete(spark: SparkSession, path: str) -> DataFrame:
    """The newest whole result of a ``CompleteResultSink``."""
    state = BatchLog(path, "_log").load(spark)
    if state["batch"] is None:
        raise FileNotFoundError(f"no result has been written to {path}")
    return spark.read.format(state["format"]).load(f"{path.rstrip('/')}/{state['batch']}")


def for_each_batch(
    df: DataFrame, sink, checkpoint: str, *, output_mode: str = "append",
    trigger: str | None = None, available_now: bool = False,
) -> DataStreamWriter:
    if isinstance(sink, CompleteResultSink) and output_mode != "complete":
        raise ValueError(f"CompleteResultSink needs output mode 'complete', got {output_mode!r}")
    if hasattr(sink, "caller"):
        sink.caller = df.sparkSession
    writer = (
        df.writeStream.foreachBatch(sink).outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
    )
    return _trigger(writer, trigger, available_now)
