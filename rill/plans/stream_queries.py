"""Registered streaming queries.

Each one runs the job as Structured Streaming over the ``events`` files
with ``trigger(availableNow=True)``, into a sink under the shared folder
(``spark.checkpoint.dir``), and returns the sink read back as a batch
DataFrame. Append mode emits only windows the final watermark closed:
``window_end <= max(event_time) - delay``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from rill import schemas
from rill.operators.windows import count_by_window, window_bounds_to_table_time, with_watermark
from rill.plans import catalog, jobs
from rill.session import conform, rocksdb_session, scratch_path, shared_dir, small_files_session
from rill.sources import replay
from rill.sources.tables import read_table, stream_table
from rill.streaming import fs
from rill.streaming import jobs as sjobs
from rill.streaming.commit import (
    POLICY_METASTORE, POLICY_SUCCESS_FILE, PROP_DELAY, PROP_PATTERN, PROP_POLICY,
    PROP_TRIGGER, TRIGGER_PARTITION_TIME,
)
from rill.streaming.counters import Counters, saved_totals
from rill.streaming.event_time import EventTimeWindowSink, MonotoneTimeSink, counted
from rill.streaming.runner import run
from rill.streaming.sinks import (
    CompleteResultSink, TableAppendSink, for_each_batch, read_complete, to_files, to_text,
)
from rill.streaming.upsert import UpsertSink, read_upserts

# Fixed value: database holding the sink tables of the registered queries.
SINK_DATABASE = "access_logs"
DAY_WINDOW = "1 day"

MINUTE_COMMIT_PROPERTIES = {
    PROP_TRIGGER: TRIGGER_PARTITION_TIME,
    PROP_DELAY: "1 min",
    PROP_POLICY: f"{POLICY_METASTORE},{POLICY_SUCCESS_FILE}",
    PROP_PATTERN: schemas.MINUTE_PARTITION_PATTERN,
}


def _sink_database(spark: SparkSession) -> None:
    """The sink database, located in the shared folder (never the
    process's working directory, where a default warehouse would go)."""
    catalog.create_database(
        spark, SINK_DATABASE, location=f"{shared_dir(spark)}/rill/{SINK_DATABASE}.db"
    )


def _events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    conform(spark)
    return stream_table(spark, sf_dir, "events")


def _run_to_parquet(frame: DataFrame, label: str) -> DataFrame:
    spark = frame.sparkSession
    out = scratch_path(spark, label)
    run(to_files(frame, f"{out}/data", f"{out}/checkpoint", available_now=True))
    return spark.read.parquet(f"{out}/data")


# J2 S2 F4 W2 W10 K2 -- site counts from strict-JSON text access logs
def site_count_20s_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    topic = replay.access_log_text_topic(_events_stream(spark, sf_dir))
    return _run_to_parquet(sjobs.site_count_frame(topic), "site_count_20s_stream")


# J2 K2 C1 C3 -- site counts appended to the access-count table
def site_count_20s_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    topic = replay.access_log_text_topic(_events_stream(spark, sf_dir))
    table, base = _sink_table(spark, "access_count", schemas.ACCESS_COUNT)
    run(sjobs.site_count_job(topic, table, f"{base}/checkpoint", available_now=True))
    return spark.table(table)


# J1 S1 W1 W7 T1 A2 P5 F1 -- url counts from JSON metrics, 5 s windows, 2 s delay
def url_count_5s_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    topic = replay.metric_topic(_events_stream(spark, sf_dir))
    out = _run_to_parquet(sjobs.url_count_frame(topic), "url_count_5s_stream")
    return window_bounds_to_table_time(out, "window_start", "window_end")


# K7 F2 -- url summary lines through the text sink
def text_sink_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    topic = replay.metric_topic(_events_stream(spark, sf_dir))
    frame = sjobs.url_summary_frame(topic, size=DAY_WINDOW)
    out = scratch_path(spark, "text_sink")
    run(to_text(frame, f"{out}/data", f"{out}/checkpoint", available_now=True))
    return spark.read.text(f"{out}/data")


# A6 P4 -- running SUM over a filtered stream (complete output mode)
def product_like_sum_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rill.operators.aggregate import like_sum
    from rill.plans.queries import PRODUCT_PATTERN

    conform(spark)
    part = stream_table(spark, sf_dir, "part").select(
        F.col("p_type").alias("product"),
        F.col("p_retailprice").cast("decimal(18,2)").alias("amount"),
    )
    total = like_sum(part, "product", PRODUCT_PATTERN, "amount", alias="total_amount")
    out = scratch_path(spark, "product_like_sum_stream")
    run(for_each_batch(total, CompleteResultSink(f"{out}/data"), f"{out}/checkpoint",
                       output_mode="complete", available_now=True))
    return read_complete(spark, f"{out}/data").select(F.col("total_amount").cast("double").alias("total_amount"))


def _sink_table(
    spark: SparkSession, label: str, columns_ddl: str, *,
    partition_cols=(), properties=None,
) -> tuple[str, str]:
    """Create a fresh sink table under the shared folder; (name, folder)."""
    base = scratch_path(spark, label)
    _sink_database(spark)
    fs.mkdirs(spark, f"{base}/table")
    name = f"{label}_{base.rsplit('-', 1)[-1]}"
    ddl = catalog.table_ddl(
        name, columns_ddl, database=SINK_DATABASE, partition_cols=partition_cols,
        properties=properties, location=f"{base}/table",
    )
    catalog.create_if_absent(spark, name, ddl, database=SINK_DATABASE)
    return catalog.qualified(SINK_DATABASE, name), base


# J3 K3 S3 C1 C2 C3 C6 -- access-log ETL appended to a partitioned table
def access_log_hive_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    topic = replay.access_log_topic(_events_stream(spark, sf_dir))
    table, base = _sink_table(
        spark, "access_log", schemas.ACCESS_LOG_TABLE, partition_cols=schemas.ACCESS_LOG_PARTITIONS
    )
    sink = TableAppendSink(table, f"{base}/checkpoint", partition_cols=schemas.ACCESS_LOG_PARTITIONS)
    run(for_each_batch(sjobs.access_log_frame(topic), sink, f"{base}/checkpoint", available_now=True))
    return spark.table(table)


# J3 K3 K4 N6 -- the same ETL with partition-time commit: rows become
# visible through the table only once their partition is committed
def access_log_committed(spark: SparkSession, sf_dir: str) -> DataFrame:
    topic = replay.access_log_topic(_events_stream(spark, sf_dir))
    table, base = _sink_table(
        spark, "access_log_commit", schemas.ACCESS_LOG_TABLE,
        partition_cols=schemas.ACCESS_LOG_PARTITIONS, properties=MINUTE_COMMIT_PROPERTIES,
    )
    run(sjobs.access_log_job(topic, table, f"{base}/checkpoint", available_now=True))
    return small_files_session(spark).table(table)


HOUR_COMMIT_PROPERTIES = {
    PROP_TRIGGER: TRIGGER_PARTITION_TIME,
    PROP_DELAY: "1 h",
    PROP_POLICY: f"{POLICY_METASTORE},{POLICY_SUCCESS_FILE}",
    PROP_PATTERN: schemas.HOUR_PARTITION_PATTERN,
}


# K5 S4 W3 -- order messages into the hourly table, committed per hour
def hourly_order_committed(spark: SparkSession, sf_dir: str) -> DataFrame:
    topic = replay.order_topic(_events_stream(spark, sf_dir))
    table, base = _sink_table(
        spark, "hourly_order", schemas.HOURLY_ORDER_TABLE,
        partition_cols=schemas.HOURLY_ORDER_PARTITIONS, properties=HOUR_COMMIT_PROPERTIES,
    )
    run(sjobs.hourly_order_job(topic, table, f"{base}/checkpoint", available_now=True))
    return spark.table(table)


# C2 C6 K2 -- orders of a table in one database streamed into a table of another
ORDERS_DATABASE = "order_logs"
ORDERS_SELECT = "SELECT user_id, order_amount, dt, `hour` FROM source_rows WHERE order_amount > 0"


def order_copy_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    conform(spark)
    base = scratch_path(spark, "order_source")
    catalog.create_database(
        spark, ORDERS_DATABASE, location=f"{shared_dir(spark)}/rill/{ORDERS_DATABASE}.db"
    )
    name = f"orders_{base.rsplit('-', 1)[-1]}"
    ddl = catalog.table_ddl(name, schemas.HOURLY_ORDER_TABLE, database=ORDERS_DATABASE, location=f"{base}/table")
    catalog.create_if_absent(spark, name, ddl, database=ORDERS_DATABASE)
    orders = jobs.hourly_order_rows(replay.order_records(read_table(spark, sf_dir, "events")))
    orders.write.insertInto(catalog.qualified(ORDERS_DATABASE, name))
    table, sink = _sink_table(spark, "order_copy", schemas.HOURLY_ORDER_TABLE)
    run(sjobs.table_to_table_job(
        spark, f"{ORDERS_DATABASE}.{name}", table, ORDERS_SELECT, f"{sink}/checkpoint", available_now=True
    ))
    return spark.table(table)


# S5 W3 A5 -- page views per user and minute of the computed time, as a stream
def pv_per_user_1m_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    topic = replay.user_log_topic(_events_stream(spark, sf_dir))
    return _run_to_parquet(sjobs.page_view_frame(topic), "pv_per_user_1m_stream")


# A delivery holds so many days of the replay; hourly windows, so that counts exceed one.
DELIVERY_DAYS = 8
HOUR_WINDOW = "1 hour"


def _deliver(rows: DataFrame, number: Column, folder: str, start: Callable[[DataFrame], DataStreamWriter]) -> None:
    """Rows land in ``folder`` delivery by delivery; the job runs after each.

    Each run is one micro-batch over the files that are new, so the batches
    are the deliveries whatever the files, and every run but the first
    resumes from the checkpoint.
    """
    spark = rows.sparkSession
    numbered = rows.withColumn("__delivery", number)
    for (n,) in sorted(numbered.select("__delivery").distinct().collect()):
        numbered.where(F.col("__delivery") == n).drop("__delivery").write.mode("append").parquet(folder)
        run(start(spark.readStream.schema(rows.schema).parquet(folder)))


def _disordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    conform(spark)
    return read_table(spark, sf_dir, "events").select(
        "event_id", "event_type", "ts", replay.disordered_arrival().alias("arrival_ts")
    )


LATE_EVENTS = "event_id BIGINT, ts TIMESTAMP_NTZ, window_start TIMESTAMP_NTZ, window_end TIMESTAMP_NTZ, watermark TIMESTAMP_NTZ"


# W6 W1 N2 -- late rows of a running job in a table of their own, the rest counted
def late_rows_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts, base = _sink_table(spark, "on_time_count", schemas.URL_COUNT_TABLE)
    late, _ = _sink_table(spark, "late_event", LATE_EVENTS)
    sink = EventTimeWindowSink(
        counts, f"{base}/checkpoint", window_time="ts", size=HOUR_WINDOW, delay=schemas.URL_COUNT_DELAY, keys=["event_type"],
        aggs={"cnt": counted()}, late_table=late, late_cols=["event_id", "ts"],
    )
    _deliver(
        _disordered(spark, sf_dir), replay.delivery(F.col("arrival_ts"), DELIVERY_DAYS), f"{base}/in",
        lambda stream: for_each_batch(stream, sink, f"{base}/checkpoint", available_now=True),
    )
    return spark.table(late)


# J1 W1 N1 T1 A2 -- windows on the record time, closed by a watermark on the payload time
def url_count_two_clocks_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    conform(spark)
    counts, base = _sink_table(spark, "url_count", schemas.URL_COUNT_TABLE)
    late, _ = _sink_table(spark, "late_metric", schemas.LATE_METRIC_TABLE)
    _deliver(
        read_table(spark, sf_dir, "events"), replay.delivery(F.col("ts"), DELIVERY_DAYS), f"{base}/in",
        lambda stream: sjobs.url_count_table_job(
            replay.metric_topic(stream, record_time=replay.lagging_record_time()), counts, f"{base}/checkpoint",
            late_table=late, window_on="record", watermark_on="payload", size=HOUR_WINDOW, available_now=True,
        ),
    )
    return spark.table(counts)


# W4 -- event time as the running maximum in arrival order, carried from batch to batch
def monotone_event_time_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    table, base = _sink_table(
        spark, "monotone_time", "event_id BIGINT, ts TIMESTAMP_NTZ, monotone_ts TIMESTAMP_NTZ, watermark TIMESTAMP_NTZ"
    )
    sink = MonotoneTimeSink(
        table, f"{base}/checkpoint", time_col="ts", order_cols=["arrival_ts", "event_id"],
        delay=schemas.URL_COUNT_DELAY, id_cols=["event_id"],
    )
    _deliver(
        _disordered(spark, sf_dir), replay.delivery(F.col("arrival_ts"), DELIVERY_DAYS), f"{base}/in",
        lambda stream: for_each_batch(stream, sink, f"{base}/checkpoint", available_now=True),
    )
    return spark.table(table)


# A6 P4 -- SUM per brand over a filtered stream in update mode, newest row per key
def product_sum_by_brand_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rill.plans.queries import PRODUCT_PATTERN

    conform(spark)
    part = read_table(spark, sf_dir, "part").select(
        "p_partkey", "p_brand", F.col("p_type").alias("product"), F.col("p_retailprice").cast("decimal(18,2)").alias("amount")
    )
    out = scratch_path(spark, "product_sum_by_brand")
    sink = UpsertSink(f"{out}/data", ["p_brand"], compact_every=3)

    def start(stream: DataFrame) -> DataStreamWriter:
        sums = stream.where(F.col("product").like(PRODUCT_PATTERN)).groupBy("p_brand").agg(F.sum("amount").alias("total_amount"))
        return for_each_batch(sums, sink, f"{out}/checkpoint", output_mode="update", available_now=True)

    _deliver(part, F.pmod("p_partkey", F.lit(4)), f"{out}/in", start)
    return read_upserts(spark, f"{out}/data").select("p_brand", F.col("total_amount").cast("double").alias("total_amount"))


# W7 W8 -- keyed window state in RocksDB over several runs of the job, restored in each
def url_count_5s_rocksdb_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    conform(spark)
    out = scratch_path(spark, "url_count_rocksdb")
    events = read_table(rocksdb_session(spark), sf_dir, "events")
    _deliver(
        events, replay.delivery(F.col("ts"), 2 * DELIVERY_DAYS), f"{out}/in",
        lambda stream: to_files(sjobs.url_count_frame(replay.metric_topic(stream)), f"{out}/data", f"{out}/checkpoint", available_now=True),
    )
    return window_bounds_to_table_time(spark.read.parquet(f"{out}/data"), "window_start", "window_end")


# N8 W6 -- totals of a job over all its runs: rows read, rows without an event time
def event_time_totals_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    conform(spark)
    out = scratch_path(spark, "event_time_totals")
    events = read_table(spark, sf_dir, "events").select(
        "event_type", "ts", F.when(replay.merchandise_id() % 10 != 0, F.col("ts")).alias("event_time")
    )
    numbered = events.withColumn("__delivery", replay.delivery(F.col("ts"), DELIVERY_DAYS))
    for (n,) in sorted(numbered.select("__delivery").distinct().collect()):
        numbered.where(F.col("__delivery") == n).drop("__delivery").write.mode("append").parquet(f"{out}/in")
        stream = spark.readStream.schema(events.schema).parquet(f"{out}/in")
        counts = count_by_window(with_watermark(stream, "event_time", schemas.URL_COUNT_DELAY), "event_time", HOUR_WINDOW, ["event_type"])
        counters = Counters(spark, f"{out}/checkpoint")
        run(to_files(counts, f"{out}/data", f"{out}/checkpoint", available_now=True), counters=counters)
    totals = saved_totals(spark, f"{out}/checkpoint")
    return spark.createDataFrame(
        [(totals["input_rows"], totals["null_event_times"])], "input_rows BIGINT, null_event_times BIGINT"
    )


STREAM_QUERIES = {
    "late_rows_stream": late_rows_stream,
    "url_count_two_clocks_stream": url_count_two_clocks_stream,
    "monotone_event_time_stream": monotone_event_time_stream,
    "product_sum_by_brand_stream": product_sum_by_brand_stream,
    "url_count_5s_rocksdb_stream": url_count_5s_rocksdb_stream,
    "event_time_totals_stream": event_time_totals_stream,
    "order_copy_stream": order_copy_stream,
    "pv_per_user_1m_stream": pv_per_user_1m_stream,
    "site_count_20s_stream": site_count_20s_stream,
    "site_count_20s_table": site_count_20s_table,
    "url_count_5s_stream": url_count_5s_stream,
    "text_sink_roundtrip": text_sink_roundtrip,
    "product_like_sum_stream": product_like_sum_stream,
    "access_log_hive_stream": access_log_hive_stream,
    "access_log_committed": access_log_committed,
    "hourly_order_committed": hourly_order_committed,
}
