"""Tables with very many small partitions: cost per file, whole results."""

import datetime as dt
import glob
import os

import pyarrow as pa
import pyarrow.parquet as pq

from rill.plans.stream_queries import access_log_committed
from rill.session import shared_dir, small_files_session
from rill.streaming import fs

MINUTES = 300
COLUMNS = {
    "event_id": pa.int64(), "ts": pa.timestamp("us"), "user_id": pa.int64(),
    "event_type": pa.string(), "value": pa.float64(), "props": pa.string(),
}


def _events(folder):
    """Two rows a minute, one of them below the filter in every third minute."""
    start = dt.datetime(2024, 1, 1)
    rows = [
        (2 * m + i, start + dt.timedelta(minutes=m, seconds=20 * i), m % 7, "view", 1.0, '{"k": %d}' % (m % 3 if i else 1))
        for m in range(MINUTES) for i in range(2)
    ]
    table = pa.table({n: pa.array(c, t) for (n, t), c in zip(COLUMNS.items(), zip(*rows))})
    pq.write_table(table, f"{folder}/events.parquet")
    return rows


def test_committed_minutes_cost_one_local_file_each(spark, tmp_dir):
    rows = _events(tmp_dir)
    known = set(glob.glob(f"{_local(shared_dir(spark))}/rill/access_log_commit-*"))
    out = access_log_committed(spark, tmp_dir)
    base, = set(glob.glob(f"{_local(shared_dir(spark))}/rill/access_log_commit-*")) - known

    # the watermark stands 15 s before the last row: minutes before the last but one are published
    ready = {r[1].replace(second=0) for r in rows if r[1].replace(second=0) + dt.timedelta(minutes=1) < rows[-1][1] - dt.timedelta(seconds=15)}
    want = sorted(r[0] for r in rows if r[5] != '{"k": 0}' and r[1].replace(second=0) in ready)
    assert sorted(r["groupon_id"] for r in out.select("groupon_id").collect()) == want

    files = [os.path.join(d, f) for d, _, names in os.walk(f"{base}/table") for f in names]
    assert sum(os.path.basename(f).startswith("part-") for f in files) == MINUTES
    marked = [f for f in files if os.path.basename(f) == "_SUCCESS"]
    assert len(marked) == len(ready) and all(os.path.getsize(f) == 0 for f in marked)
    # nothing beside them: each further local file would cost a process
    assert len(files) == MINUTES + len(ready)
    # small files are read together, not a handful a task
    assert out.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism


def _local(path):
    return path.removeprefix("file:").replace("//", "/")


def test_markers_and_listing(spark, tmp_dir):
    folder = f"file:{tmp_dir}/a [b] %20"
    fs.touch_all(spark, folder, ["x=1/y=2/part-0", "x=1/part-1", "x=%3A/y=2/part-2", "x=1/y=2/_SUCCESS"])
    assert fs.list_files(spark, folder, 2) == ["x=%3A/y=2/part-2", "x=1/y=2/part-0"]
    assert fs.list_files(spark, folder, 1) == ["x=1/part-1"]
    assert fs.list_files(spark, f"{folder}/none", 1) == []
    assert fs.exists(spark, f"{folder}/x=1/y=2/_SUCCESS")


def test_small_files_session_keeps_settings(spark):
    before = spark.conf.getAll
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        beside = small_files_session(spark)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before.get("spark.sql.shuffle.partitions", "4"))
    assert beside.conf.get("spark.sql.shuffle.partitions") == "3"
    assert beside.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.conf.getAll == before
