"""Independent DuckDB SQL for each registered query.

Written directly against the raw tables (not through the Spark code), so
a match checks the Spark plan end to end. Conventions: epoch
milliseconds are ``epoch_us(ts) // 1000`` (floored, as Spark's
``unix_millis``), window starts are epoch-aligned micro-second buckets.
"""

from __future__ import annotations

MS = "(epoch_us(ts) // 1000)"
MERCH = "CAST(json_extract_string(props, '$.k') AS BIGINT)"
SEC_TS = "date_trunc('second', ts)"


def bucket(expr_us: str, width_us: int, *, end: bool = False) -> str:
    """Start (or end) of the epoch-aligned bucket holding ``expr_us``."""
    shift = f" + {width_us}" if end else ""
    return f"make_timestamp(({expr_us} // {width_us}) * {width_us}{shift})"


SEC_20 = 20_000_000
SEC_5 = 5_000_000
SEC_2 = 2_000_000
MINUTE = 60_000_000
HOUR = 3_600_000_000
DAY = 86_400_000_000

ARRIVAL = (
    "SELECT event_id, ts, ts + to_hours(CAST((event_id * 7) % 13 AS INTEGER)) AS arrival_ts "
    "FROM events"
)

ORACLE: dict[str, str] = {
    "site_count_20s": f"""
        SELECT event_type AS url, count(*) AS access_count,
               {bucket(f"epoch_us({SEC_TS})", SEC_20)} AS start_time,
               {bucket(f"epoch_us({SEC_TS})", SEC_20, end=True)} AS end_time
        FROM events GROUP BY 1, 3, 4
    """,
    "url_count_json": f"""
        SELECT {bucket("epoch_us(ts)", DAY)} AS window_start,
               '{{"f0":"' || event_type || '","f1":' || CAST(count(*) AS VARCHAR) || '}}' AS value
        FROM events GROUP BY event_type, 1
    """,
    "metric_json_parse": f"""
        SELECT event_id AS "offset", 'mem' AS name, {MS} AS "timestamp",
               event_type AS url, CAST(NULL AS INTEGER) AS "count",
               value AS field_value, CAST(user_id AS VARCHAR) AS user_tag
        FROM events
    """,
    "event_time_from_string": f"SELECT event_id, {SEC_TS} AS event_time FROM events",
    "event_time_from_epoch": f"SELECT event_id, {SEC_TS} AS event_time FROM events",
    "access_log_etl": f"""
        SELECT {MS} AS ts, user_id AS user_id, event_type AS event_type,
               'fromType: ' || CAST({MS} AS VARCHAR) AS from_type,
               'columnType: ' || CAST({MS} AS VARCHAR) AS column_type,
               user_id AS site_id, event_id AS groupon_id, event_id AS partner_id,
               {MERCH} AS merchandise_id,
               strftime(ts, '%Y-%m-%d') AS ts_date, strftime(ts, '%H') AS ts_hour,
               strftime(ts, '%M') AS ts_minute
        FROM events WHERE {MERCH} > 0
    """,
    "partitions_ready": f"""
        WITH p AS (
            SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS ts_date, strftime(ts, '%H') AS ts_hour,
                   strftime(ts, '%M') AS ts_minute
            FROM events WHERE {MERCH} > 0
        ), t AS (
            SELECT ts_date, ts_hour, ts_minute,
                   strptime(ts_date || ' ' || ts_hour || ':' || ts_minute || ':00',
                            '%Y-%m-%d %H:%M:%S') AS partition_time
            FROM p
        )
        SELECT ts_date, ts_hour, ts_minute, partition_time,
               partition_time + INTERVAL 1 MINUTE
                 < (SELECT max({SEC_TS}) FROM events) - INTERVAL 15 SECOND AS ready
        FROM t
    """,
    "hourly_partitions_ready": """
        WITH p AS (
            SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS dt, strftime(ts, '%H') AS "hour" FROM events
        ), t AS (
            SELECT dt, "hour", strptime(dt || ' ' || "hour" || ':00:00', '%Y-%m-%d %H:%M:%S') AS partition_time
            FROM p
        )
        SELECT dt, "hour", partition_time,
               partition_time + INTERVAL 1 HOUR < (SELECT max(ts) FROM events) - INTERVAL 5 SECOND AS ready
        FROM t
    """,
    "csv_metric_split": f"""
        SELECT event_id AS "offset", event_type AS host, CAST(floor(value) AS BIGINT) AS mem,
               {MS} AS event_ms
        FROM events
    """,
    "host_mem_mean_2s": f"""
        SELECT event_type AS host,
               CAST(sum(CAST(floor(value) AS BIGINT)) // count(*) AS BIGINT) AS mem_mean,
               {bucket(f"{MS} * 1000", SEC_2)} AS window_start,
               {bucket(f"{MS} * 1000", SEC_2, end=True)} AS window_end
        FROM events GROUP BY 1, 3, 4
    """,
    "late_row_audit": f"""
        WITH e AS ({ARRIVAL}),
        w AS (
            SELECT event_id, ts,
                   max(ts) OVER (ORDER BY arrival_ts, event_id
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
                     - INTERVAL 2 SECOND AS watermark
            FROM e
        )
        SELECT event_id, ts,
               {bucket("epoch_us(ts)", HOUR)} AS window_start,
               {bucket("epoch_us(ts)", HOUR, end=True)} AS window_end,
               watermark,
               coalesce({bucket("epoch_us(ts)", HOUR, end=True)} - INTERVAL 1 MILLISECOND
                        <= watermark, false) AS is_late
        FROM w
    """,
    "monotone_event_time": f"""
        WITH e AS ({ARRIVAL}),
        m AS (
            SELECT event_id, ts,
                   max(ts) OVER (ORDER BY arrival_ts, event_id
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS monotone_ts
            FROM e
        )
        SELECT event_id, ts, monotone_ts, monotone_ts - INTERVAL 2 SECOND AS watermark FROM m
    """,
    "pv_per_user_1m": f"""
        SELECT {bucket("epoch_us(ts)", MINUTE)} AS dt, count({MERCH}) AS pv, user_id AS uv
        FROM events GROUP BY 1, 3
    """,
    "product_like_sum": """
        SELECT CAST(sum(CAST(p_retailprice AS DECIMAL(18,2))) AS DOUBLE) AS total_amount
        FROM part WHERE p_type LIKE '%CONO%'
    """,
    "product_like_rows": """
        SELECT p_partkey, p_type AS product,
               CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS DOUBLE) AS amount
        FROM part WHERE p_type LIKE '%CONO%'
    """,
    "tracked_urls": "SELECT url FROM pages",
}

MS_TS = "make_timestamp((epoch_us(ts) // 1000) * 1000)"

ORACLE.update({
    "site_count_20s_stream": f"""
        SELECT * FROM ({ORACLE["site_count_20s"]}) c
        WHERE end_time <= (SELECT max({SEC_TS}) FROM events) - INTERVAL 15 SECOND
    """,
    "url_count_5s_stream": f"""
        WITH m AS (SELECT event_type AS url, {MS_TS} AS et FROM events),
        c AS (
            SELECT url, count(*) AS cnt,
                   {bucket("epoch_us(et)", SEC_5)} AS window_start,
                   {bucket("epoch_us(et)", SEC_5, end=True)} AS window_end
            FROM m GROUP BY 1, 3, 4
        )
        SELECT * FROM c WHERE window_end <= (SELECT max(et) FROM m) - INTERVAL 2 SECOND
    """,
    "text_sink_roundtrip": f"""
        WITH m AS (SELECT event_type, {MS_TS} AS et FROM events),
        c AS (
            SELECT event_type, count(*) AS n, {bucket("epoch_us(et)", DAY, end=True)} AS window_end
            FROM m GROUP BY 1, 3
        )
        SELECT '{{"f0":"' || event_type || '","f1":' || CAST(n AS VARCHAR) || '}}' AS value
        FROM c WHERE window_end <= (SELECT max(et) FROM m) - INTERVAL 2 SECOND
    """,
    "access_log_hive_stream": ORACLE["access_log_etl"],
    "product_like_files": ORACLE["product_like_rows"],
    "url_count_2s": f"""
        SELECT event_type AS url, count(*) AS cnt,
               {bucket(f"{MS} * 1000", SEC_2)} AS window_start,
               {bucket(f"{MS} * 1000", SEC_2, end=True)} AS window_end
        FROM events GROUP BY 1, 3, 4
    """,
    "site_count_20s_sql": ORACLE["site_count_20s"],
    "product_like_sum_stream": ORACLE["product_like_sum"],
    "access_log_committed": f"""
        SELECT * FROM ({ORACLE["access_log_etl"]}) r
        WHERE strptime(ts_date || ' ' || ts_hour || ':' || ts_minute || ':00', '%Y-%m-%d %H:%M:%S')
                + INTERVAL 1 MINUTE
              < (SELECT max({SEC_TS}) FROM events) - INTERVAL 15 SECOND
    """,
})

# the table sink holds exactly what the file sink holds
ORACLE["site_count_20s_table"] = ORACLE["site_count_20s_stream"]

ORACLE["hourly_order_committed"] = """
    SELECT CAST(user_id AS VARCHAR) AS user_id, value AS order_amount,
           strftime(ts, '%Y-%m-%d') AS dt, strftime(ts, '%H') AS "hour"
    FROM events
    WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR
          < (SELECT max(ts) FROM events) - INTERVAL 5 SECOND
"""

ORACLE["order_copy_stream"] = """
    SELECT CAST(user_id AS VARCHAR) AS user_id, value AS order_amount,
           strftime(ts, '%Y-%m-%d') AS dt, strftime(ts, '%H') AS "hour"
    FROM events WHERE value > 0
"""

# the computed time keeps whole seconds; windows closed by max - 1 ms
ORACLE["pv_per_user_1m_stream"] = f"""
    SELECT {bucket(f"epoch_us({SEC_TS})", MINUTE)} AS dt, count({MERCH}) AS pv, user_id AS uv
    FROM events
    GROUP BY 1, 3
    HAVING {bucket(f"epoch_us(max({SEC_TS}))", MINUTE, end=True)}
           <= (SELECT max({SEC_TS}) FROM events) - INTERVAL 1 MILLISECOND
"""

# the lower median of each host and day
ORACLE["host_mem_median_1d"] = f"""
    SELECT event_type AS host, quantile_disc(CAST(floor(value) AS BIGINT), 0.5) AS mem_median, count(*) AS n,
           {bucket(f"{MS} * 1000", DAY)} AS window_start,
           {bucket(f"{MS} * 1000", DAY, end=True)} AS window_end
    FROM events GROUP BY 1, 4, 5
"""


def delivered(rows: str, time: str, moves: str, delay: str = "2 SECOND", days: int = 8) -> str:
    """CTEs: ``rows`` with their delivery ``d`` (by ``time``) and the watermark they met.

    The watermark of a delivery is the largest ``moves`` of the deliveries
    before it, minus the delay.
    """
    return f"""
        e AS (SELECT *, epoch_us({time}) // {days * DAY} AS d FROM ({rows})),
        per AS (SELECT d, max({moves}) AS most FROM e GROUP BY d),
        marks AS (
            SELECT d, max(most) OVER (ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL {delay} AS watermark
            FROM per
        ),
        met AS (SELECT e.*, watermark FROM e JOIN marks USING (d))
    """


ORACLE["late_rows_stream"] = f"""
    WITH {delivered(ARRIVAL, "arrival_ts", "ts")}
    SELECT event_id, ts, {bucket("epoch_us(ts)", HOUR)} AS window_start, {bucket("epoch_us(ts)", HOUR, end=True)} AS window_end, watermark
    FROM met WHERE {bucket("epoch_us(ts)", HOUR, end=True)} - INTERVAL 1 MILLISECOND <= watermark
"""

ORACLE["url_count_two_clocks_stream"] = f"""
    WITH {delivered(
        f"SELECT event_type, ts, {MS_TS} AS payload, ts - to_hours(CAST((event_id * 7) % 13 AS INTEGER)) AS record FROM events",
        "ts", "payload")},
    w AS (
        SELECT event_type AS url, watermark, {bucket("epoch_us(record)", HOUR)} AS window_start,
               {bucket("epoch_us(record)", HOUR, end=True)} AS window_end
        FROM met
    )
    SELECT url, count(*) AS cnt, window_start, window_end FROM w
    WHERE watermark IS NULL OR window_end - INTERVAL 1 MILLISECOND > watermark
    GROUP BY url, window_start, window_end
    HAVING window_end - INTERVAL 1 MILLISECOND <= (SELECT max({MS_TS}) FROM events) - INTERVAL 2 SECOND
"""

ORACLE["monotone_event_time_stream"] = ORACLE["monotone_event_time"]

ORACLE["product_sum_by_brand_stream"] = """
    SELECT p_brand, CAST(sum(CAST(p_retailprice AS DECIMAL(18,2))) AS DOUBLE) AS total_amount
    FROM part WHERE p_type LIKE '%CONO%' GROUP BY p_brand
"""

ORACLE["url_count_5s_rocksdb_stream"] = ORACLE["url_count_5s_stream"]

ORACLE["event_time_totals_stream"] = f"""
    SELECT count(*) AS input_rows, count(*) FILTER (WHERE {MERCH} % 10 = 0) AS null_event_times FROM events
"""
