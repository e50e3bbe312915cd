"""The job recipes as DataFrame transforms.

Each function takes parsed records (batch or streaming) and returns the
job's output frame. Passing ``delay`` declares the event-time watermark,
which a streaming frame needs for append output and which a batch frame
ignores. Sources and sinks are attached in ``rill.streaming.jobs``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rill import schemas
from rill.functions.json import tuple_json
from rill.functions.time import (
    epoch_millis_to_seconds, from_text, millis_to_timestamp, partition_values,
)
from rill.functions import csv as csvf
from rill.operators.projection import insert_by_position, keep_positive
from rill.operators.windows import (
    count_by_window, count_column_by_window, integer_mean_by_window, with_watermark,
)


def url_counts(
    metrics: DataFrame,
    *,
    size: str = schemas.URL_COUNT_WINDOW,
    delay: str | None = None,
    event_time: str = "payload",
) -> DataFrame:
    """Metric records -> (url, cnt, window_start, window_end).

    ``event_time='payload'`` windows on the message's own epoch-ms field;
    ``'record'`` on the topic record time (column ``record_time``).
    """
    if event_time == "payload":
        et = millis_to_timestamp("timestamp")
    elif event_time == "record":
        et = F.col("record_time").cast("timestamp_ntz")
    else:
        raise ValueError(f"event_time must be 'payload' or 'record', got {event_time!r}")
    df = metrics.select("url", et.alias("event_time"))
    if delay:
        df = with_watermark(df, "event_time", delay)
    return count_by_window(df, "event_time", size, ["url"], count_col="cnt")


def url_summary(counts: DataFrame, *, keep: tuple[str, ...] = ()) -> DataFrame:
    """(url, cnt) -> ``{"f0":url,"f1":cnt}`` text in ``value``."""
    return counts.select(*keep, tuple_json("url", "cnt").alias("value"))


def site_counts(
    records: DataFrame,
    *,
    size: str = schemas.SITE_COUNT_WINDOW,
    delay: str | None = None,
    lenient: bool = False,
) -> DataFrame:
    """Text access-log records -> access-count table rows.

    Count per site per tumbling window of the parsed ``logTime``; columns
    land in the table by position (the site id fills ``url``).
    """
    df = records.select("siteId", from_text("logTime", lenient=lenient).alias("eventTimestamp"))
    if delay:
        df = with_watermark(df, "eventTimestamp", delay)
    counts = count_by_window(
        df, "eventTimestamp", size, ["siteId"],
        count_col="cnt", start_col="wStar", end_col="wEnd",
    )
    return insert_by_position(counts, schemas.ACCESS_COUNT)


def access_log_event_time(records: DataFrame) -> DataFrame:
    """Add ``eventTime``: epoch-ms ``ts`` truncated to the second."""
    return records.withColumn("eventTime", epoch_millis_to_seconds("ts"))


def access_log_keep() -> Column:
    """The access-log row filter, on table-layout column names."""
    return F.col("merchandise_id") > 0


def access_log_rows(
    records: DataFrame, *, delay: str | None = None, apply_filter: bool = True
) -> DataFrame:
    """Access-log records -> partitioned access-log table rows.

    Keeps ``merchandiseId > 0`` (``apply_filter=False`` leaves that to
    the sink, see ``access_log_keep``), renames to snake_case by position
    and derives the date / hour / minute partition strings from event
    time. Map-only: no shuffle.
    """
    df = access_log_event_time(records)
    if delay:
        df = with_watermark(df, "eventTime", delay)
    if apply_filter:
        df = keep_positive(df, "merchandiseId")
    d, h, m = partition_values("eventTime")
    out = df.select(
        "ts", "userId", "eventType", "fromType", "columnType", "siteId",
        "grouponId", "partnerId", "merchandiseId", d, h, m,
    )
    return insert_by_position(out, schemas.ACCESS_LOG_TABLE)


def hourly_order_rows(
    orders: DataFrame, *, delay: str | None = None, keep_time: bool = False
) -> DataFrame:
    """Order records -> hourly order table rows (``dt``, ``hour`` partitions).

    ``keep_time`` carries ``log_ts`` after the table columns (for a sink
    that needs event time but writes only the table layout).
    """
    df = orders
    if delay:
        df = with_watermark(df, "log_ts", delay)
    cols = [
        F.col("user_id"), F.col("order_amount"),
        F.date_format("log_ts", "yyyy-MM-dd"), F.date_format("log_ts", "HH"),
    ]
    layout = schemas.HOURLY_ORDER_TABLE
    if keep_time:
        cols.append(F.col("log_ts").cast("timestamp_ntz"))
        layout += ", log_ts TIMESTAMP_NTZ"
    return insert_by_position(df.select(*cols), layout)


def host_mem(lines: DataFrame, *, lenient: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """CSV metric lines -> (host, mem, event_ms); lines without a comma drop."""
    return csvf.parse_lines(lines, lenient=lenient, keep=keep)


def host_mem_mean(
    parsed: DataFrame,
    *,
    size: str = schemas.HOST_MEM_WINDOW,
    delay: str | None = None,
) -> DataFrame:
    """(host, mem, event_ms) -> integer mean memory per host per window."""
    df = parsed.select("host", "mem", millis_to_timestamp("event_ms").alias("event_time"))
    if delay:
        df = with_watermark(df, "event_time", delay)
    return integer_mean_by_window(df, "event_time", size, ["host"], "mem", mean_col="mem_mean")


def page_views(
    user_log: DataFrame,
    *,
    size: str = schemas.PV_WINDOW,
    delay: str | None = None,
    computed_time: bool = False,
) -> DataFrame:
    """User-log records -> (dt, pv, uv) per user per window.

    ``computed_time`` windows on the time computed from ``itemId`` (epoch
    milliseconds, whole seconds kept) instead of ``ts``.

    ``pv`` counts non-NULL categories; ``uv`` is the user id itself, as
    the declared output defines it (not a distinct count).
    """
    time = epoch_millis_to_seconds("itemId") if computed_time else F.col("ts")
    df = user_log.select("userId", "categoryId", time.alias("event_time"))
    if delay:
        df = with_watermark(df, "event_time", delay)
    agg = count_column_by_window(df, "event_time", size, ["userId"], "categoryId", count_col="pv")
    return insert_by_position(agg.select("window_start", "pv", "userId"), schemas.PV_UV)
