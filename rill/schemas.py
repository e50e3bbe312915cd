"""Declared record schemas (DDL strings).

Fixed values: these field names and types must equal the message and
table layouts the jobs exchange, so they are stated plainly here.
"""

# --- message payloads ------------------------------------------------------

# Metric message (JSON) fields.
METRIC = (
    "name STRING, timestamp BIGINT, url STRING, count INT, "
    "fields MAP<STRING,STRING>, tags MAP<STRING,STRING>"
)

# Access-log message (JSON) fields, camelCase as produced.
ACCESS_LOG = (
    "ts BIGINT, userId BIGINT, eventType STRING, fromType STRING, "
    "columnType STRING, siteId BIGINT, grouponId BIGINT, partnerId BIGINT, "
    "merchandiseId BIGINT"
)

# Access log whose fields all arrive as text.
ACCESS_LOG_TEXT = (
    "logTime STRING, message STRING, eventType STRING, userId STRING, siteId STRING"
)

# Order stream (table declared with a 5 s watermark on log_ts).
ORDER = "user_id STRING, order_amount DOUBLE, log_ts TIMESTAMP_NTZ"

# User behaviour stream.
USER_LOG = "userId BIGINT, itemId BIGINT, categoryId BIGINT, behavior STRING, ts TIMESTAMP_NTZ"

# --- table layouts -----------------------------------------------------------
# Declared TIMESTAMP columns are zone-less wall clock, hence TIMESTAMP_NTZ.

# Windowed access counts table.
ACCESS_COUNT = "url STRING, access_count BIGINT, start_time TIMESTAMP_NTZ, end_time TIMESTAMP_NTZ"
ACCESS_COUNT_COLUMNS = ["url", "access_count", "start_time", "end_time"]

# Access-log table, snake_case, partitioned by minute strings.
ACCESS_LOG_TABLE = (
    "ts BIGINT, user_id BIGINT, event_type STRING, from_type STRING, "
    "column_type STRING, site_id BIGINT, groupon_id BIGINT, partner_id BIGINT, "
    "merchandise_id BIGINT, ts_date STRING, ts_hour STRING, ts_minute STRING"
)
ACCESS_LOG_PARTITIONS = ["ts_date", "ts_hour", "ts_minute"]

# Hourly order table.
HOURLY_ORDER_TABLE = "user_id STRING, order_amount DOUBLE, dt STRING, hour STRING"
HOURLY_ORDER_PARTITIONS = ["dt", "hour"]

# Page-view table (uv carries the user id, as declared upstream).
PV_UV = "dt TIMESTAMP_NTZ, pv BIGINT, uv BIGINT"

# Tables of the event-time sinks: url counts, their late rows, monotone times.
URL_COUNT_TABLE = "url STRING, cnt BIGINT, window_start TIMESTAMP_NTZ, window_end TIMESTAMP_NTZ"
LATE_METRIC_TABLE = (
    "url STRING, payload_time TIMESTAMP_NTZ, record_time TIMESTAMP_NTZ, "
    "window_start TIMESTAMP_NTZ, window_end TIMESTAMP_NTZ, watermark TIMESTAMP_NTZ"
)
MONOTONE_TIME_TABLE = (
    "`offset` BIGINT, `partition` INT, payload_time TIMESTAMP_NTZ, monotone_ts TIMESTAMP_NTZ, watermark TIMESTAMP_NTZ"
)

# Partition-time patterns and commit delays.
MINUTE_PARTITION_PATTERN = "$ts_date $ts_hour:$ts_minute:00"
HOUR_PARTITION_PATTERN = "$dt $hour:00:00"
MINUTE_COMMIT_DELAY = "1 minute"
HOUR_COMMIT_DELAY = "1 hour"

# Watermark delays and window sizes used by the jobs.
URL_COUNT_WINDOW = "5 seconds"
URL_COUNT_DELAY = "2 seconds"
SITE_COUNT_WINDOW = "20 seconds"
ACCESS_LOG_DELAY = "15 seconds"
ORDER_DELAY = "5 seconds"
USER_LOG_DELAY = "1 millisecond"
HOST_MEM_WINDOW = "2 seconds"
PV_WINDOW = "1 minute"

# Timestamp text format used by the jobs.
TIMESTAMP_TEXT_FORMAT = "yyyy-MM-dd HH:mm:ss"
