"""The streaming jobs: source -> parse -> job recipe -> sink.

* ``url_summary_job``: metric JSON topic -> 5 s counts per url under a
  2 s watermark -> ``{"f0":url,"f1":count}`` to a topic (or any sink).
* ``url_count_table_job``: the same counts into a table, late rows into
  another, windows and watermark on one clock or two.
* ``monotone_time_job``: event time that never goes back, per topic partition.
* ``site_count_job``: text access-log JSON -> 20 s counts per site under
  a 15 s watermark -> access-count table.
* ``access_log_job``: access-log JSON (lenient) -> filtered, renamed,
  minute-partitioned rows -> partitioned table with partition commit.
* ``tail_job``: ``SELECT *`` of a stream to the console.

Each ``*_frame`` function returns the streaming DataFrame so it can be
pointed at any sink; the recipes themselves live in ``rill.plans.jobs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rill import schemas
from rill.functions.json import parse_messages
from rill.functions.time import epoch_millis_to_seconds, millis_to_timestamp
from rill.operators.projection import select_all
from rill.plans.catalog import print_schema, register_view, use_database
from rill.plans import jobs
from rill.streaming.commit import PartitionCommitSink
from rill.streaming.event_time import EventTimeWindowSink, MonotoneTimeSink, counted
from rill.streaming.sinks import TableAppendSink, for_each_batch, to_console, to_topic


def url_count_frame(
    topic: DataFrame, *, size: str = schemas.URL_COUNT_WINDOW,
    delay: str = schemas.URL_COUNT_DELAY, lenient: bool = False,
    event_time: str = "payload",
) -> DataFrame:
    """Metric topic -> url counts. ``event_time='record'`` windows on the
    topic record time instead of the payload's epoch-ms field."""
    keep: tuple[str, ...] = ()
    if event_time == "record":
        topic = topic.withColumnRenamed("timestamp", "record_time")
        keep = ("record_time",)
    metrics = parse_messages(topic, schemas.METRIC, lenient=lenient, keep=keep)
    return jobs.url_counts(metrics, size=size, delay=delay, event_time=event_time)


def url_summary_frame(topic: DataFrame, **kw) -> DataFrame:
    return jobs.url_summary(url_count_frame(topic, **kw))


def url_summary_job(
    topic: DataFrame, sink_topic: str, bootstrap_servers: str, checkpoint: str,
    *, trigger: str = "5 seconds", available_now: bool = False,
):
    """Topic-to-topic url counts (writer; call ``rill.streaming.runner.run``)."""
    return to_topic(url_summary_frame(topic), sink_topic, bootstrap_servers, checkpoint,
                    trigger=trigger, available_now=available_now)


def url_count_table_job(
    topic: DataFrame, table: str, checkpoint: str, *, late_table: str | None = None,
    window_on: str = "payload", watermark_on: str = "payload",
    size: str = schemas.URL_COUNT_WINDOW, delay: str = schemas.URL_COUNT_DELAY, closing_rule: str = "host",
    lenient: bool = False, trigger: str = "5 seconds", available_now: bool = False,
):
    """Url counts into ``table``, rows behind the watermark into ``late_table``.

    Windows and watermark each follow the ``'payload'`` time (the message's
    epoch-ms field) or the ``'record'`` time (the topic's); the host's job
    windows on the record and lets the payload move the watermark. Late rows
    carry url, payload time, record time, window bounds and watermark.
    """
    clocks = {"payload": "payload_time", "record": "record_time"}
    topic = topic.withColumnRenamed("timestamp", "record_time")
    metrics = parse_messages(topic, schemas.METRIC, lenient=lenient, keep=("record_time",))
    rows = metrics.select("url", millis_to_timestamp("timestamp").alias("payload_time"), F.col("record_time").cast("timestamp_ntz"))
    sink = EventTimeWindowSink(
        table, checkpoint, window_time=clocks[window_on], watermark_time=clocks[watermark_on], size=size, delay=delay,
        keys=["url"], aggs={"cnt": counted()}, late_table=late_table,
        late_cols=["url", "payload_time", "record_time"], closing_rule=closing_rule,
    )
    return for_each_batch(rows, sink, checkpoint, trigger=trigger, available_now=available_now)


def monotone_time_job(
    topic: DataFrame, table: str, checkpoint: str, *, delay: str = schemas.URL_COUNT_DELAY,
    lenient: bool = False, trigger: str = "5 seconds", available_now: bool = False,
):
    """Metric messages stamped with the largest payload time seen so far in their topic partition.

    Columns: offset, partition, payload time, monotone time, watermark.
    """
    metrics = parse_messages(topic, schemas.METRIC, lenient=lenient, keep=("partition", "offset"))
    rows = metrics.select("offset", "partition", millis_to_timestamp("timestamp").alias("payload_time"))
    sink = MonotoneTimeSink(
        table, checkpoint, time_col="payload_time", order_cols=["offset"], delay=delay,
        id_cols=["offset"], partition_cols=["partition"],
    )
    return for_each_batch(rows, sink, checkpoint, trigger=trigger, available_now=available_now)


def site_count_frame(
    topic: DataFrame, *, size: str = schemas.SITE_COUNT_WINDOW,
    delay: str = schemas.ACCESS_LOG_DELAY, lenient: bool = False,
) -> DataFrame:
    records = parse_messages(topic, schemas.ACCESS_LOG_TEXT, lenient=lenient)
    return jobs.site_counts(records, size=size, delay=delay, lenient=lenient)


def site_count_job(
    topic: DataFrame, table: str, checkpoint: str, *,
    trigger: str = "20 seconds", available_now: bool = False,
):
    """Site counts appended to the (unpartitioned) access-count table."""
    sink = TableAppendSink(table, checkpoint)
    return for_each_batch(site_count_frame(topic), sink, checkpoint,
                          trigger=trigger, available_now=available_now)


def access_log_frame(
    topic: DataFrame, *, delay: str = schemas.ACCESS_LOG_DELAY, lenient: bool = True,
    apply_filter: bool = True,
) -> DataFrame:
    records = parse_messages(topic, schemas.ACCESS_LOG, lenient=lenient)
    return jobs.access_log_rows(records, delay=delay, apply_filter=apply_filter)


def access_log_job(
    topic: DataFrame, table: str, checkpoint: str, *,
    partition_cols=tuple(schemas.ACCESS_LOG_PARTITIONS),
    trigger: str = "20 seconds", available_now: bool = False,
):
    """Access-log ETL into ``table`` with the commit step its properties set."""
    # the watermark is declared on the source, so the sink sees every row
    # for event time and writes only the rows the filter keeps
    frame = access_log_frame(topic, apply_filter=False)
    sink = PartitionCommitSink.from_table(
        frame.sparkSession, table,
        partition_cols=partition_cols,
        event_time=epoch_millis_to_seconds("ts"),
        row_filter=jobs.access_log_keep(),
        watermark_delay=schemas.ACCESS_LOG_DELAY,
        state_dir=checkpoint,
    )
    return for_each_batch(frame, sink, checkpoint, trigger=trigger, available_now=available_now)


def hourly_order_job(
    topic: DataFrame, table: str, checkpoint: str, *,
    trigger: str = "20 seconds", available_now: bool = False,
):
    """Order messages into the hourly (dt, hour) table with its commit rule."""
    orders = parse_messages(topic, schemas.ORDER)
    frame = jobs.hourly_order_rows(orders, delay=schemas.ORDER_DELAY, keep_time=True)
    sink = PartitionCommitSink.from_table(
        frame.sparkSession, table,
        partition_cols=schemas.HOURLY_ORDER_PARTITIONS,
        event_time=F.col("log_ts"),
        watermark_delay=schemas.ORDER_DELAY,
        state_dir=checkpoint,
        aux_cols=("log_ts",),
    )
    return for_each_batch(frame, sink, checkpoint, trigger=trigger, available_now=available_now)


def page_view_frame(topic: DataFrame) -> DataFrame:
    """User-log topic -> page views per user and minute of the computed time."""
    records = parse_messages(topic, schemas.USER_LOG)
    return jobs.page_views(records, delay=schemas.USER_LOG_DELAY, computed_time=True)


def table_to_table_job(
    spark: SparkSession, source: str, target: str, select: str, checkpoint: str, *,
    partition_cols=(), trigger: str = "20 seconds", available_now: bool = False,
):
    """Stream one catalog table into another, which may be in another database.

    ``source`` is ``database.table``: the database becomes the current one
    for the time of the read. ``select`` is SQL over the view ``source_rows``;
    its columns go into ``target`` by position.
    """
    database, table = source.split(".")
    before = spark.catalog.currentDatabase()
    use_database(spark, database)
    try:
        register_view(spark.readStream.table(table), "source_rows")
        frame = spark.sql(select)
    finally:
        use_database(spark, before)
    sink = TableAppendSink(target, checkpoint, partition_cols=partition_cols)
    return for_each_batch(frame, sink, checkpoint, trigger=trigger, available_now=available_now)


def tail_job(stream: DataFrame, *, available_now: bool = False):
    """Print the stream's schema, then every row (append mode)."""
    print_schema(stream)
    return to_console(select_all(stream), available_now=available_now)
