"""Run a job: ``python -m rill <job> [options]``.

Streaming jobs: ``url-summary`` (metric topic -> url counts -> topic or
folder), ``url-counts`` (the same into a table, late rows into another,
windows and watermark on one clock or two), ``monotone-time`` (metrics
stamped with the largest time seen), ``site-counts`` (text access logs -> access-count table),
``access-log`` (access logs -> minute-partitioned table with partition
commit), ``hourly-order`` (orders -> hour-partitioned table with partition
commit) and ``tail`` (print a message stream). Batch job:
``tracked-urls`` (the URL dimension from a JDBC table or a parquet
folder). Sources are a Kafka topic (``--bootstrap`` + ``--topic``) or a
folder of recorded messages (``--path`` + ``--format``). The default
checkpoint is fixed by the job and its sink, under ``spark.checkpoint.dir``
(``--shared-dir``), so a job started again goes on where it stopped. When a
job ends it prints its totals over all its runs: batches, rows read, rows
without an event time, rows dropped behind the watermark.
"""

from __future__ import annotations

import argparse
import os
import sys

from rill import schemas
from rill.plans import catalog
from rill.session import build_session, job_checkpoint
from rill.sources.jdbc import URL_SLA_TABLE, read_url_dimension, url_dimension
from rill.sources.messages import EARLIEST, LATEST, kafka_options, read_messages
from rill.streaming import jobs as sjobs
from rill.streaming.commit import (
    POLICY_METASTORE, POLICY_SUCCESS_FILE, PROP_DELAY, PROP_PATTERN, PROP_POLICY,
    PROP_TRIGGER, TRIGGER_PARTITION_TIME,
)
from rill.streaming.counters import Counters
from rill.streaming.runner import run
from rill.streaming.sinks import print_rows, to_files

# Trigger intervals and start positions of the jobs.
JOB_DEFAULTS = {
    "url-summary": {"trigger": "5 seconds", "start": EARLIEST},
    "url-counts": {"trigger": "5 seconds", "start": EARLIEST},
    "monotone-time": {"trigger": "5 seconds", "start": EARLIEST},
    "site-counts": {"trigger": "20 seconds", "start": LATEST},
    "access-log": {"trigger": "20 seconds", "start": LATEST},
    "hourly-order": {"trigger": "20 seconds", "start": LATEST},
    "tail": {"trigger": None, "start": LATEST},
    "tracked-urls": {"trigger": None, "start": LATEST},
}


# What a micro-batch takes at most by default.
MAX_FILES, MAX_RECORDS = 1_000, 10_000_000


def _args(argv=None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="python -m rill", description=__doc__.splitlines()[0])
    p.add_argument("job", choices=sorted(JOB_DEFAULTS))
    p.add_argument("--bootstrap", help="Kafka bootstrap servers (topic source/sink)")
    p.add_argument("--topic", help="source topic")
    p.add_argument("--group-id")
    p.add_argument("--path", help="folder of recorded messages (instead of a topic)")
    p.add_argument("--format", default="text", help="format of recorded messages")
    p.add_argument("--sink-topic", help="url-summary: output topic")
    p.add_argument("--sink-path", help="url-summary: output folder (instead of a topic)")
    p.add_argument("--window-on", choices=("payload", "record"), default="record", help="url-counts: clock of the windows")
    p.add_argument("--watermark-on", choices=("payload", "record"), default="payload", help="url-counts: clock of the watermark")
    p.add_argument("--late-table", help="url-counts: table of rows behind the watermark (else they are counted only)")
    p.add_argument("--database", default="access_logs")
    p.add_argument("--table")
    p.add_argument("--checkpoint")
    p.add_argument("--trigger", help="processing-time trigger, e.g. '20 seconds'")
    p.add_argument("--available-now", action="store_true", help="process what is there, then stop")
    p.add_argument("--hive", action="store_true", help="use the Hive metastore catalog")
    p.add_argument("--jdbc-url", help="tracked-urls: JDBC URL of the URL table")
    p.add_argument("--jdbc-table", default=URL_SLA_TABLE)
    p.add_argument("--jdbc-user-env", default="JDBC_USER", help="env var holding the user")
    p.add_argument("--jdbc-password-env", default="JDBC_PASSWORD", help="env var holding the password")
    p.add_argument("--with-sla", action="store_true")
    p.add_argument("--jdbc-partition-column", help="numeric column to split the JDBC read on")
    p.add_argument("--jdbc-lower", type=int)
    p.add_argument("--jdbc-upper", type=int)
    p.add_argument("--jdbc-partitions", type=int)
    p.add_argument("--max-per-trigger", type=int, help="files (or topic records) per micro-batch, so that a backlog is many "
                   f"batches; 0: no limit; default {MAX_FILES} files or {MAX_RECORDS} records")
    p.add_argument("--rocksdb", action="store_true", help="keep streaming state in RocksDB, off the executor heap")
    p.add_argument("--shared-dir", help="sets spark.checkpoint.dir")
    p.add_argument("--master")
    return p.parse_args(argv)


def _source(spark, a, start: str):
    most = (MAX_FILES if a.path else MAX_RECORDS) if a.max_per_trigger is None else a.max_per_trigger
    if a.path:
        limit = {"maxFilesPerTrigger": str(most)} if most else {}
        return read_messages(spark, a.format, stream=True, path=a.path, **limit)
    if not (a.bootstrap and a.topic):
        raise SystemExit("give --path, or --bootstrap and --topic")
    return read_messages(spark, "kafka", stream=True, **kafka_options(
        a.bootstrap, a.topic, group_id=a.group_id, starting_offsets=start,
        max_offsets_per_trigger=most or None))


def _table(spark, a, name: str, ddl: str, **kw) -> str:
    catalog.create_database(spark, a.database)
    catalog.create_if_absent(
        spark, name, catalog.table_ddl(name, ddl, database=a.database, **kw), database=a.database
    )
    return catalog.qualified(a.database, name)


def tracked_urls(spark, a) -> None:
    """Batch: read the URL dimension, write it to --sink-path or print all of it."""
    if a.jdbc_url:
        props = {k: os.environ[v] for k, v in (("user", a.jdbc_user_env), ("password", a.jdbc_password_env))
                 if v in os.environ}
        urls = read_url_dimension(spark, a.jdbc_url, props, table=a.jdbc_table, with_sla=a.with_sla,
                                  partition_column=a.jdbc_partition_column, lower_bound=a.jdbc_lower,
                                  upper_bound=a.jdbc_upper, num_partitions=a.jdbc_partitions)
    elif a.path:
        urls = url_dimension(spark.read.format(a.format).load(a.path), with_sla=a.with_sla)
    else:
        raise SystemExit("tracked-urls needs --jdbc-url or --path")
    if a.sink_path:
        urls.write.mode("overwrite").parquet(a.sink_path)
    else:
        print_rows(urls)


def main(argv=None) -> None:
    a = _args(argv)
    conf = {"spark.sql.catalogImplementation": "hive"} if a.hive else {}
    if a.shared_dir:
        conf["spark.checkpoint.dir"] = a.shared_dir
    spark = build_session(a.master, app_name=f"rill-{a.job}", conf=conf, rocksdb_state=a.rocksdb)
    if a.job == "tracked-urls":
        tracked_urls(spark, a)
        return
    defaults = JOB_DEFAULTS[a.job]
    trigger = a.trigger or defaults["trigger"]
    places: list[str] = []

    def checkpoint(sink: str) -> str:
        places.append(a.checkpoint or job_checkpoint(spark, a.job, sink))
        return places[-1]

    topic = _source(spark, a, defaults["start"])
    opts = {"trigger": trigger, "available_now": a.available_now}

    if a.job == "url-summary":
        if a.sink_path:
            writer = to_files(sjobs.url_summary_frame(topic), a.sink_path, checkpoint(a.sink_path),
                              fmt="text", **opts)
        elif a.sink_topic and a.bootstrap:
            writer = sjobs.url_summary_job(topic, a.sink_topic, a.bootstrap,
                                           checkpoint(f"{a.bootstrap}/{a.sink_topic}"), **opts)
        else:
            raise SystemExit("url-summary needs --sink-path, or --sink-topic with --bootstrap")
    elif a.job == "url-counts":
        table = _table(spark, a, a.table or "url_count", schemas.URL_COUNT_TABLE)
        late = _table(spark, a, a.late_table, schemas.LATE_METRIC_TABLE) if a.late_table else None
        writer = sjobs.url_count_table_job(
            topic, table, checkpoint(table), late_table=late, window_on=a.window_on, watermark_on=a.watermark_on, **opts
        )
    elif a.job == "monotone-time":
        table = _table(spark, a, a.table or "monotone_time", schemas.MONOTONE_TIME_TABLE)
        writer = sjobs.monotone_time_job(topic, table, checkpoint(table), **opts)
    elif a.job == "site-counts":
        table = _table(spark, a, a.table or "access_count", schemas.ACCESS_COUNT)
        writer = sjobs.site_count_job(topic, table, checkpoint(table), **opts)
    elif a.job == "access-log":
        table = _table(
            spark, a, a.table or "access_log", schemas.ACCESS_LOG_TABLE,
            partition_cols=schemas.ACCESS_LOG_PARTITIONS,
            properties={
                PROP_TRIGGER: TRIGGER_PARTITION_TIME,
                PROP_DELAY: "1 min",
                PROP_POLICY: f"{POLICY_METASTORE},{POLICY_SUCCESS_FILE}",
                PROP_PATTERN: schemas.MINUTE_PARTITION_PATTERN,
            },
        )
        writer = sjobs.access_log_job(topic, table, checkpoint(table), **opts)
    elif a.job == "hourly-order":
        table = _table(
            spark, a, a.table or "hourly_order", schemas.HOURLY_ORDER_TABLE,
            partition_cols=schemas.HOURLY_ORDER_PARTITIONS,
            properties={
                PROP_TRIGGER: TRIGGER_PARTITION_TIME,
                PROP_DELAY: "1 h",
                PROP_POLICY: f"{POLICY_METASTORE},{POLICY_SUCCESS_FILE}",
                PROP_PATTERN: schemas.HOUR_PARTITION_PATTERN,
            },
        )
        writer = sjobs.hourly_order_job(topic, table, checkpoint(table), **opts)
    else:
        writer = sjobs.tail_job(topic, available_now=a.available_now)
    counters = Counters(spark, places[0] if places else None)
    try:
        run(writer, name=f"rill-{a.job}", counters=counters)
    finally:
        print("totals: " + ", ".join(f"{n} {v}" for n, v in counters.totals.items()), file=sys.stderr)


if __name__ == "__main__":
    main()
