"""Recorded topics derived from the ``events`` table.

The jobs consume topic records whose ``value`` is a JSON or CSV message.
These functions render each ``events`` row either as the parsed record
(the columns a structured source would deliver) or as the message text
of a topic record, so the same parse -> window -> sink code runs on files
(batch or streaming) exactly as it would on a topic. Everything is a
per-row projection: no shuffle.

Stand-ins (fixed choice, documented in the README):
``event_type`` is the url / site / host, ``user_id`` the user,
``props.k`` the merchandise id, the event time in epoch milliseconds the
message time, and ``floor(value)`` the memory figure.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rill.functions.json import record_json
from rill.functions.time import epoch_millis

# Constant parts of the generated messages.
METRIC_NAME = "mem"
FROM_TYPE_PREFIX = "fromType: "
COLUMN_TYPE_PREFIX = "columnType: "
MESSAGE_PREFIX = "message: "
SINGLE_PARTITION = 0

# The disorder rule of a shuffled replay (hours of delay).
DISORDER_MULTIPLIER = 7
DISORDER_MODULUS = 13


def _ms() -> Column:
    return epoch_millis("ts")


def merchandise_id() -> Column:
    return F.get_json_object("props", "$.k").cast("bigint")


# --- parsed records ----------------------------------------------------------

def metric_columns() -> list[Column]:
    """Metric fields per event (``count`` is never set by the producer)."""
    return [
        F.lit(METRIC_NAME).alias("name"),
        _ms().alias("timestamp"),
        F.col("event_type").alias("url"),
        F.lit(None).cast("int").alias("count"),
        F.create_map(F.lit("value"), F.col("value")).alias("fields"),
        F.create_map(F.lit("user_id"), F.col("user_id").cast("string")).alias("tags"),
    ]


def access_log_columns() -> list[Column]:
    """Access-log fields (numeric ids) per event."""
    ms = _ms()
    return [
        ms.alias("ts"),
        F.col("user_id").alias("userId"),
        F.col("event_type").alias("eventType"),
        F.concat(F.lit(FROM_TYPE_PREFIX), ms.cast("string")).alias("fromType"),
        F.concat(F.lit(COLUMN_TYPE_PREFIX), ms.cast("string")).alias("columnType"),
        F.col("user_id").alias("siteId"),
        F.col("event_id").alias("grouponId"),
        F.col("event_id").alias("partnerId"),
        merchandise_id().alias("merchandiseId"),
    ]


def access_log_text_columns() -> list[Column]:
    """Access-log fields, all text, per event."""
    return [
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("logTime"),
        F.concat(F.lit(MESSAGE_PREFIX), _ms().cast("string")).alias("message"),
        F.col("event_type").alias("eventType"),
        F.col("user_id").cast("string").alias("userId"),
        F.col("event_type").alias("siteId"),
    ]


def user_log_columns(*, timed_items: bool = False) -> list[Column]:
    """User-behaviour fields per event (category = merchandise id).

    ``timed_items`` puts the event's epoch milliseconds into ``itemId``, from
    which the stream's computed event time is derived.
    """
    return [
        F.col("user_id").alias("userId"),
        (_ms() if timed_items else F.col("event_id")).alias("itemId"),
        merchandise_id().alias("categoryId"),
        F.col("event_type").alias("behavior"),
        F.col("ts").cast("timestamp_ntz").alias("ts"),
    ]


def order_columns() -> list[Column]:
    """Order fields per event (amount = value, time = event time)."""
    return [
        F.col("user_id").cast("string").alias("user_id"),
        F.col("value").alias("order_amount"),
        F.col("ts").cast("timestamp_ntz").alias("log_ts"),
    ]


def csv_metric_line() -> Column:
    """``"<epoch ms>,<host>,<mem>"`` per event."""
    return F.concat_ws(
        ",", _ms().cast("string"), F.col("event_type"), F.floor("value").cast("bigint").cast("string")
    )


def metric_records(events: DataFrame, *, keep: tuple[str, ...] = ()) -> DataFrame:
    return events.select(*keep, *metric_columns())


def access_log_records(events: DataFrame, *, keep: tuple[str, ...] = ()) -> DataFrame:
    return events.select(*keep, *access_log_columns())


def access_log_text_records(events: DataFrame, *, keep: tuple[str, ...] = ()) -> DataFrame:
    return events.select(*keep, *access_log_text_columns())


def user_log_records(events: DataFrame, *, keep: tuple[str, ...] = ()) -> DataFrame:
    return events.select(*keep, *user_log_columns())


def order_records(events: DataFrame, *, keep: tuple[str, ...] = ()) -> DataFrame:
    return events.select(*keep, *order_columns())


# --- topic records (message text) -----------------------------------------

def topic_record(events: DataFrame, value: Column, *, record_time: Column | None = None) -> DataFrame:
    """Frame a message column as a single-partition topic record."""
    rt = record_time if record_time is not None else F.col("ts")
    return events.select(
        F.lit(None).cast("binary").alias("key"),
        value.alias("value"),
        F.lit(SINGLE_PARTITION).alias("partition"),
        F.col("event_id").alias("offset"),
        rt.cast("timestamp").alias("timestamp"),
    )


def metric_topic(events: DataFrame, *, record_time: Column | None = None) -> DataFrame:
    return topic_record(events, record_json(*metric_columns()), record_time=record_time)


def access_log_topic(events: DataFrame) -> DataFrame:
    return topic_record(events, record_json(*access_log_columns()))


def access_log_text_topic(events: DataFrame) -> DataFrame:
    return topic_record(events, record_json(*access_log_text_columns()))


def user_log_topic(events: DataFrame) -> DataFrame:
    return topic_record(events, record_json(*user_log_columns(timed_items=True)))


def order_topic(events: DataFrame) -> DataFrame:
    return topic_record(events, record_json(*order_columns()))


def csv_metric_topic(events: DataFrame) -> DataFrame:
    return topic_record(events, csv_metric_line())


def _disorder(event_id: str) -> Column:
    hours = (F.col(event_id) * DISORDER_MULTIPLIER) % DISORDER_MODULUS
    return F.make_dt_interval(hours=hours.cast("int"))


def disordered_arrival(ts: str = "ts", event_id: str = "event_id") -> Column:
    """Arrival time of a shuffled replay: event time plus 0..12 hours."""
    return F.col(ts) + _disorder(event_id)


def lagging_record_time(ts: str = "ts", event_id: str = "event_id") -> Column:
    """Record time of brokers whose clocks are 0..12 hours behind the messages'."""
    return F.col(ts) - _disorder(event_id)


def delivery(time: Column, days: int) -> Column:
    """Number of the delivery a row comes with: one for so many days of ``time``."""
    width = days * 86_400_000_000
    us = F.unix_micros(time.cast("timestamp"))
    return F.call_function("div", us - F.pmod(us, F.lit(width)), F.lit(width))
