"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads the given tables (``events``, ``part``, ``pages``) in
full and derives its input with Spark, so its work grows with them.
The comment on each names the inventory ids it covers.
"""

from __future__ import annotations

from collections import Counter

import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rill import schemas
from rill.functions.json import parse_messages
from rill.functions.time import epoch_millis_to_seconds, from_text, millis_to_timestamp
from rill.operators.aggregate import like_rows, like_sum
from rill.operators.partition_commit import partition_readiness
from rill.operators.replay import late_row_audit, monotone_event_time
from rill.operators.windows import apply_by_window
from rill.plans import jobs
from rill.session import conform
from rill.sources import replay
from rill.sources.jdbc import url_dimension
from rill.sources.tables import read_table

# Window sizes beside the job sizes, so counts exceed one
# on the sparse test stream, and the LIKE stand-in on ``part.p_type``.
DAY_WINDOW = "1 day"
AUDIT_WINDOW = "1 hour"
AUDIT_DELAY = "2 seconds"
PRODUCT_PATTERN = "%CONO%"


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    conform(spark)
    return read_table(spark, sf_dir, "events")


# A1 T2 T3 P2 N5 -- flagship: 20 s site counts into the access-count layout
def site_count_20s(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.site_counts(replay.access_log_text_records(_events(spark, sf_dir)))


# A3 T4 -- per-url counts over 2 s windows (the pairwise-reduce count)
def url_count_2s(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.url_counts(replay.metric_records(_events(spark, sf_dir)), size=schemas.HOST_MEM_WINDOW)


# F2 U2 -- per-url daily counts rendered as {"f0":url,"f1":count}
def url_count_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = jobs.url_counts(replay.metric_records(_events(spark, sf_dir)), size=DAY_WINDOW)
    return jobs.url_summary(counts, keep=("window_start",))


# F1 S2 S3 P5 U1 -- JSON metric messages parsed back with the declared schema
def metric_json_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    topic = replay.metric_topic(_events(spark, sf_dir))
    parsed = parse_messages(topic, schemas.METRIC, keep=("offset",))
    return parsed.select(
        "offset", "name", "timestamp", "url", "count",
        F.col("fields")["value"].cast("double").alias("field_value"),
        F.col("tags")["user_id"].alias("user_tag"),
    )


# F4 -- event time parsed from 'yyyy-MM-dd HH:mm:ss' text
def event_time_from_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    recs = replay.access_log_text_records(_events(spark, sf_dir), keep=("event_id",))
    return recs.select("event_id", from_text("logTime").alias("event_time"))


# F5 -- event time from epoch milliseconds, truncated to the second
def event_time_from_epoch(spark: SparkSession, sf_dir: str) -> DataFrame:
    recs = replay.access_log_records(_events(spark, sf_dir), keep=("event_id",))
    return recs.select("event_id", epoch_millis_to_seconds("ts").alias("event_time"))


# J3 P2 P3 F6 -- access-log ETL rows (filter, rename, partition strings)
def access_log_etl(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.access_log_rows(replay.access_log_records(_events(spark, sf_dir)))


# K4 K5 N6 -- which minute partitions the commit policy may publish
def partitions_ready(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the watermark is declared on the source, before the row filter
    records = replay.access_log_records(_events(spark, sf_dir))
    return partition_readiness(
        jobs.access_log_rows(records, apply_filter=False),
        partition_cols=schemas.ACCESS_LOG_PARTITIONS,
        pattern=schemas.MINUTE_PARTITION_PATTERN,
        event_time=epoch_millis_to_seconds("ts"),
        watermark_delay=schemas.ACCESS_LOG_DELAY,
        commit_delay=schemas.MINUTE_COMMIT_DELAY,
        keep=jobs.access_log_keep(),
    )


# K5 S4 W3 -- hourly (dt, hour) partitions of the order table and the 1 h rule
def hourly_partitions_ready(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = replay.order_records(_events(spark, sf_dir))
    return partition_readiness(
        jobs.hourly_order_rows(orders, keep_time=True),
        partition_cols=schemas.HOURLY_ORDER_PARTITIONS,
        pattern=schemas.HOUR_PARTITION_PATTERN,
        event_time=F.col("log_ts"),
        watermark_delay=schemas.ORDER_DELAY,
        commit_delay=schemas.HOUR_COMMIT_DELAY,
    )


# C5 A1 T2 T3 -- the site-count job as SQL text over an unregistered frame
SITE_COUNT_SQL = """
    SELECT siteId AS url, count(*) AS access_count,
           window.start AS start_time, window.end AS end_time
    FROM (
        SELECT siteId, window(to_timestamp_ntz(logTime, 'yyyy-MM-dd HH:mm:ss'), '20 seconds') AS window
        FROM {records}
    )
    GROUP BY window, siteId
"""


def site_count_20s_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = replay.access_log_text_records(_events(spark, sf_dir))
    return spark.sql(SITE_COUNT_SQL, records=records)


# P6 F3 F9 -- CSV metric lines split into host, mem and event millis
def csv_metric_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = replay.csv_metric_topic(_events(spark, sf_dir))
    return jobs.host_mem(lines, keep=("offset",))


# A4 T4 U4 -- integer mean memory per host per 2 s window
def host_mem_mean_2s(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = replay.csv_metric_topic(_events(spark, sf_dir))
    return jobs.host_mem_mean(jobs.host_mem(lines))


# W5 W6 N2 -- which rows of a disordered replay arrive behind the watermark
def late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _events(spark, sf_dir).select(
        "event_id", "ts", replay.disordered_arrival().alias("arrival_ts")
    )
    return late_row_audit(
        events, time_col="ts", order_cols=["arrival_ts", "event_id"],
        window=AUDIT_WINDOW, delay=AUDIT_DELAY, id_cols=["event_id"],
    )


# W4 -- event time as the running maximum in arrival order
def monotone_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _events(spark, sf_dir).select(
        "event_id", "ts", replay.disordered_arrival().alias("arrival_ts")
    )
    return monotone_event_time(
        events, time_col="ts", order_cols=["arrival_ts", "event_id"],
        delay=schemas.URL_COUNT_DELAY, id_cols=["event_id"],
    )


def median_of(column: str):
    """Window function: the lower median, from counts of the distinct values, never the rows."""
    def median(_: dict, pieces) -> list[tuple]:
        counts: Counter = Counter()
        for piece in pieces:
            for entry in pc.value_counts(piece.column(column)).to_pylist():
                if entry["values"] is not None:
                    counts[entry["values"]] += entry["counts"]
        half, seen = (counts.total() + 1) // 2, 0
        for value in sorted(counts):
            seen += counts[value]
            if seen >= half:
                return [(value, counts.total())]
        return []

    return median


# U4 -- a user function over each whole window: median memory per host and day
def host_mem_median_1d(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = replay.csv_metric_topic(_events(spark, sf_dir))
    metrics = jobs.host_mem(lines).select("host", "mem", millis_to_timestamp("event_ms").alias("event_time"))
    return apply_by_window(
        metrics, "event_time", DAY_WINDOW, ["host"], median_of("mem"), "mem_median BIGINT, n BIGINT"
    )


# A5 T4 -- page views per user per minute
def pv_per_user_1m(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.page_views(replay.user_log_records(_events(spark, sf_dir)))


def _part(spark: SparkSession, sf_dir: str) -> DataFrame:
    conform(spark)
    part = read_table(spark, sf_dir, "part")
    # amounts as DECIMAL(18,2): the sum is exact whatever the summation order
    return part.select(
        "p_partkey",
        F.col("p_type").alias("product"),
        F.col("p_retailprice").cast("decimal(18,2)").alias("amount"),
    )


# P4 A6 -- SUM(amount) WHERE product LIKE pattern
def product_like_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    total = like_sum(_part(spark, sf_dir), "product", PRODUCT_PATTERN, "amount", alias="total_amount")
    return total.select(F.col("total_amount").cast("double").alias("total_amount"))


# P4 -- SELECT product, amount WHERE product LIKE pattern
def product_like_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = like_rows(_part(spark, sf_dir), "product", PRODUCT_PATTERN, "p_partkey", "product", "amount")
    return rows.withColumn("amount", F.col("amount").cast("double"))


# K9 P4 -- filtered rows through a file-system table (CSV), read back
def product_like_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rill.session import scratch_path
    from rill.streaming.sinks import write_files

    rows = product_like_rows(spark, sf_dir)
    path = scratch_path(spark, "product_like_files")
    write_files(rows, path, fmt="csv")
    return spark.read.schema(rows.schema).option("header", "true").csv(path)


# S7 J4 -- the tracked-URL dimension (parquet stand-in for the JDBC table)
def tracked_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    conform(spark)
    return url_dimension(read_table(spark, sf_dir, "pages"))


BATCH_QUERIES = {
    "site_count_20s": site_count_20s,
    "url_count_json": url_count_json,
    "url_count_2s": url_count_2s,
    "metric_json_parse": metric_json_parse,
    "event_time_from_string": event_time_from_string,
    "event_time_from_epoch": event_time_from_epoch,
    "access_log_etl": access_log_etl,
    "partitions_ready": partitions_ready,
    "hourly_partitions_ready": hourly_partitions_ready,
    "site_count_20s_sql": site_count_20s_sql,
    "csv_metric_split": csv_metric_split,
    "host_mem_mean_2s": host_mem_mean_2s,
    "host_mem_median_1d": host_mem_median_1d,
    "late_row_audit": late_rows,
    "monotone_event_time": monotone_time,
    "pv_per_user_1m": pv_per_user_1m,
    "product_like_sum": product_like_sum,
    "product_like_rows": product_like_rows,
    "product_like_files": product_like_files,
    "tracked_urls": tracked_urls,
}
