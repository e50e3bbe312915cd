"""Catalog helpers, table sinks, the partition-commit sink and restarts."""

import datetime as dt
import os

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from rill import schemas
from rill.plans import catalog
from rill.plans.stream_queries import MINUTE_COMMIT_PROPERTIES
from rill.streaming import jobs as sjobs
from rill.streaming.runner import dropped_by_watermark, run
from rill.streaming.sinks import TableAppendSink, for_each_batch, to_files, to_topic
from rill.sources import replay


def test_create_if_absent(spark, tmp_dir):
    catalog.create_database(spark, "rill_t")
    ddl = catalog.table_ddl("t_once", "a BIGINT", database="rill_t", location=f"{tmp_dir}/t")
    assert catalog.create_if_absent(spark, "t_once", ddl, database="rill_t") is True
    assert catalog.create_if_absent(spark, "t_once", ddl, database="rill_t") is False
    catalog.drop_if_exists(spark, "t_once", database="rill_t")
    assert catalog.table_exists(spark, "t_once", "rill_t") is False


EVENT_SCHEMA = pa.schema([
    ("event_id", pa.int64()), ("ts", pa.timestamp("us")), ("user_id", pa.int64()),
    ("event_type", pa.string()), ("value", pa.float64()), ("props", pa.string()),
])


def _write_batch(folder, name, rows):
    os.makedirs(folder, exist_ok=True)
    cols = list(zip(*rows))
    pq.write_table(pa.table([pa.array(c, t.type) for c, t in zip(cols, EVENT_SCHEMA)], schema=EVENT_SCHEMA),
                   f"{folder}/{name}.parquet")


def _event(i, ts, k=1, kind="view"):
    return (i, ts, 1, kind, 1.0, '{"k": %d}' % k)


def _stream(spark, folder):
    schema = spark.read.parquet(folder).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", "1").parquet(folder)


def test_late_rows_across_batches(spark, tmp_dir):
    """Within one run, batch n is filtered by the watermark of batch n-1: a
    row behind the watermark in the batch right after it moved still counts;
    a row behind it one batch later is dropped and counted as dropped."""
    src = f"{tmp_dir}/in"
    t = lambda s: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)
    _write_batch(src, "b0", [_event(0, t(0)), _event(1, t(45))])
    _write_batch(src, "b1", [_event(2, t(5))])   # behind the 45 s watermark, next batch
    out, ck = f"{tmp_dir}/out", f"{tmp_dir}/ck"
    frame = sjobs.url_count_frame(replay.metric_topic(_stream(spark, src)), size="20 seconds", delay="0 seconds")
    run(to_files(frame, out, ck, available_now=True))
    first = {(r["window_start"].second, r["cnt"]) for r in spark.read.parquet(out).collect()}
    assert first == {(0, 2)}  # rows 0 and 2; [40,60) still open
    _write_batch(src, "b2", [_event(3, t(70))])
    _write_batch(src, "b3", [_event(4, t(6))])   # two batches behind: dropped
    q = run(to_files(frame, out, ck, available_now=True))
    rows = {(r["window_start"].second, r["cnt"]) for r in spark.read.parquet(out).collect()}
    assert rows == {(0, 2), (40, 1)}
    assert dropped_by_watermark(q) >= 1


def test_restart_has_no_duplicates(spark, tmp_dir):
    src = f"{tmp_dir}/in"
    t = lambda s: dt.datetime(2024, 1, 1) + dt.timedelta(minutes=s)
    _write_batch(src, "b0", [_event(i, t(i)) for i in range(5)])
    catalog.create_database(spark, "rill_t")
    loc = f"{tmp_dir}/table"
    name = "restart_log"
    catalog.drop_if_exists(spark, name, database="rill_t")
    spark.sql(catalog.table_ddl(name, schemas.ACCESS_LOG_TABLE, database="rill_t",
                                partition_cols=schemas.ACCESS_LOG_PARTITIONS, location=loc))
    table = catalog.qualified("rill_t", name)
    frame = sjobs.access_log_frame(replay.access_log_topic(_stream(spark, src)))
    ck = f"{tmp_dir}/ck"
    run(for_each_batch(frame, TableAppendSink(table, ck, partition_cols=schemas.ACCESS_LOG_PARTITIONS), ck,
                       available_now=True))
    assert spark.table(table).count() == 5
    # restart with nothing new: no rows re-added
    run(for_each_batch(frame, TableAppendSink(table, ck, partition_cols=schemas.ACCESS_LOG_PARTITIONS), ck,
                       available_now=True))
    assert spark.table(table).count() == 5
    # a replayed batch id is skipped by the sink itself
    sink = TableAppendSink(table, ck, partition_cols=schemas.ACCESS_LOG_PARTITIONS)
    sink(spark.table(table), 0)
    assert spark.table(table).count() == 5
    _write_batch(src, "b1", [_event(i, t(i)) for i in range(5, 8)])
    run(for_each_batch(frame, TableAppendSink(table, ck, partition_cols=schemas.ACCESS_LOG_PARTITIONS), ck,
                       available_now=True))
    assert spark.table(table).count() == 8


def test_partition_commit_sink(spark, tmp_dir):
    src = f"{tmp_dir}/in"
    t = lambda s: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)
    # minutes 00, 01, 02 plus one row with merchandise id 0 (filtered) that
    # still moves event time to 00:02:16 -> 15 s delay -> watermark 00:02:01
    # (event time is whole seconds, so 00:02:00.001 itself cannot occur)
    _write_batch(src, "b0", [_event(0, t(5)), _event(1, t(65)), _event(2, t(125)), _event(3, t(136), k=0)])
    catalog.create_database(spark, "rill_t")
    name = "commit_log"
    catalog.drop_if_exists(spark, name, database="rill_t")
    loc = f"{tmp_dir}/table"
    spark.sql(catalog.table_ddl(name, schemas.ACCESS_LOG_TABLE, database="rill_t",
                                partition_cols=schemas.ACCESS_LOG_PARTITIONS, location=loc,
                                properties=MINUTE_COMMIT_PROPERTIES))
    table = catalog.qualified("rill_t", name)
    ck = f"{tmp_dir}/ck"
    run(sjobs.access_log_job(replay.access_log_topic(_stream(spark, src)), table, ck, available_now=True))
    visible = sorted(r["ts_minute"] for r in spark.table(table).collect())
    assert visible == ["00", "01"]
    assert os.path.exists(f"{loc}/ts_date=2024-01-01/ts_hour=00/ts_minute=00/_SUCCESS")
    assert not os.path.exists(f"{loc}/ts_date=2024-01-01/ts_hour=00/ts_minute=02/_SUCCESS")
    # the 00:02 files are written but not yet published
    assert spark.read.parquet(loc).count() == 3
    # a later batch moves the watermark and publishes 00:02
    _write_batch(src, "b1", [_event(4, t(400))])
    run(sjobs.access_log_job(replay.access_log_topic(_stream(spark, src)), table, ck, available_now=True))
    assert sorted(r["ts_minute"] for r in spark.table(table).collect()) == ["00", "01", "02"]


def test_console_and_topic_writers(spark, tmp_dir, capsys):
    src = f"{tmp_dir}/in"
    _write_batch(src, "b0", [_event(0, dt.datetime(2024, 1, 1))])
    stream = _stream(spark, src)
    run(sjobs.tail_job(stream, available_now=True))
    writer = to_topic(replay.metric_topic(stream), "summary_url", "broker:9092", f"{tmp_dir}/ck")
    # the topic sink cannot be started here (no connector on the classpath)
    assert writer is not None


def test_record_time_clock(spark, tmp_dir):
    """Windows on the topic record time instead of the payload time."""
    src = f"{tmp_dir}/in"
    t = lambda s: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)
    _write_batch(src, "b0", [_event(0, t(1)), _event(1, t(2)), _event(2, t(30))])
    # record time = event time + 10 s, payload time = event time
    topic = replay.topic_record(
        _stream(spark, src), replay.record_json(*replay.metric_columns()),
        record_time=F.col("ts") + F.expr("INTERVAL 10 SECONDS"),
    )
    out, ck = f"{tmp_dir}/out", f"{tmp_dir}/ck"
    frame = sjobs.url_count_frame(topic, size="20 seconds", delay="0 seconds", event_time="record")
    run(to_files(frame, out, ck, available_now=True))
    got = {(r["window_start"].second, r["cnt"]) for r in spark.read.parquet(out).collect()}
    assert got == {(0, 2)}  # records at 11 s and 12 s; the 40 s one is still open


def test_commit_sink_null_event_time(spark, tmp_dir):
    """A message without a time lands in no publishable partition; the job
    goes on and still commits the partitions the watermark passed."""
    src = f"{tmp_dir}/in"
    t = lambda s: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)
    _write_batch(src, "b0", [_event(0, t(5)), _event(1, None), _event(2, t(200))])
    catalog.create_database(spark, "rill_t")
    name = "commit_null"
    catalog.drop_if_exists(spark, name, database="rill_t")
    spark.sql(catalog.table_ddl(name, schemas.ACCESS_LOG_TABLE, database="rill_t",
                                partition_cols=schemas.ACCESS_LOG_PARTITIONS, location=f"{tmp_dir}/table",
                                properties=MINUTE_COMMIT_PROPERTIES))
    table = catalog.qualified("rill_t", name)
    run(sjobs.access_log_job(replay.access_log_topic(_stream(spark, src)), table, f"{tmp_dir}/ck",
                             available_now=True))
    assert [r["ts_minute"] for r in spark.table(table).collect()] == ["00"]


def test_commit_sink_over_batches_matches_rule(spark, tmp_dir):
    """Random times in four files (one micro-batch each): the published
    minutes are exactly those with minute + 1 min < max time - 15 s."""
    import random

    rnd = random.Random(5)
    src = f"{tmp_dir}/in"
    t = lambda s: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)
    times = []
    for b in range(4):
        batch = [rnd.randint(0, 1800) for _ in range(40)]
        times += batch
        _write_batch(src, f"b{b}", [_event(b * 100 + i, t(s)) for i, s in enumerate(batch)])
    catalog.create_database(spark, "rill_t")
    name = "commit_random"
    catalog.drop_if_exists(spark, name, database="rill_t")
    spark.sql(catalog.table_ddl(name, schemas.ACCESS_LOG_TABLE, database="rill_t",
                                partition_cols=schemas.ACCESS_LOG_PARTITIONS, location=f"{tmp_dir}/table",
                                properties=MINUTE_COMMIT_PROPERTIES))
    table = catalog.qualified("rill_t", name)
    run(sjobs.access_log_job(replay.access_log_topic(_stream(spark, src)), table, f"{tmp_dir}/ck",
                             available_now=True))
    watermark = t(max(times)) - dt.timedelta(seconds=15)
    minutes = {s // 60 for s in times}
    want = {m for m in minutes if t(m * 60) + dt.timedelta(minutes=1) < watermark}
    got = {int(r["ts_hour"]) * 60 + int(r["ts_minute"]) for r in spark.table(table).select("ts_hour", "ts_minute").distinct().collect()}
    assert got == want
    rows_want = sum(1 for s in times if s // 60 in want)
    assert spark.table(table).count() == rows_want
