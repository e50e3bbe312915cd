"""Late rows, two clocks, monotone time, upserts and counters: against plain models, and crashes at every step."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from rill import schemas
from rill.operators.windows import with_watermark
from rill.plans import catalog
from rill.sources import replay
from rill.streaming import event_time as et
from rill.streaming import fs
from rill.streaming import jobs as sjobs
from rill.streaming.counters import Counters, saved_totals
from rill.streaming.event_time import EventTimeWindowSink, MonotoneTimeSink, counted, largest, smallest, summed
from rill.streaming.runner import null_event_times, run
from rill.streaming.sinks import CompleteResultSink, for_each_batch, read_complete, to_files
from rill.streaming.staging import BatchLog, StagedBatch
from rill.streaming.upsert import UpsertSink, read_upserts
from test_catalog_sinks import _event, _stream, _write_batch
from test_exactly_once import _crash_once

BASE = dt.datetime(2024, 1, 1)
ROW = "id BIGINT, k STRING, ts TIMESTAMP_NTZ, rec TIMESTAMP_NTZ, v INT"
COUNTS = "k STRING, n BIGINT, total BIGINT, most INT, least INT, window_start TIMESTAMP_NTZ, window_end TIMESTAMP_NTZ"
LATE = "id BIGINT, window_start TIMESTAMP_NTZ, window_end TIMESTAMP_NTZ, watermark TIMESTAMP_NTZ"
AGGS = {"n": counted(), "total": summed("v"), "most": largest("v"), "least": smallest("v")}


def at(seconds):
    return BASE + dt.timedelta(seconds=seconds)


def batches(n=4, size=40, seed=1):
    """Micro-batches whose times jump back and forth; NULL times and keys among them."""
    rnd, out, i = random.Random(seed), [], 0
    for b in range(n):
        rows = []
        for _ in range(size):
            s = rnd.randint(0, 100) + 40 * b
            ts = None if rnd.random() < 0.05 else at(s + rnd.choice([0, 0.0005, 0.999]))
            rec = None if rnd.random() < 0.05 else at(max(0, s - rnd.randint(0, 50)))
            rows.append((i, rnd.choice(["a", "b", None]), ts, rec, rnd.choice([None, 1, 2, 3])))
            i += 1
        out.append(rows)
    return out


def model(groups, *, window, mark, width=20, delay=2, slack=0.001):
    """(results, late rows, final watermark, nulls) by plain loops."""
    watermark, results, late, windows, nulls = None, [], [], {}, 0
    for rows in groups:
        for r in rows:
            t = r[window]
            if t is None:
                nulls += 1
                continue
            start = BASE + dt.timedelta(seconds=(t - BASE).total_seconds() // width * width)
            end = start + dt.timedelta(seconds=width)
            if watermark is not None and end - dt.timedelta(seconds=slack) <= watermark:
                late.append((r[0], start, end, watermark))
            else:
                windows.setdefault((r[1], start, end), []).append(r[4])
        seen = [r[mark] - dt.timedelta(seconds=delay) for r in rows if r[mark] is not None]
        watermark = max([*seen, *([watermark] if watermark else [])], default=None)
        for key in [k for k in windows if watermark and k[2] - dt.timedelta(seconds=slack) <= watermark]:
            values = windows.pop(key)
            known = [v for v in values if v is not None]
            results.append((key[0], len(values), sum(known) if known else None, max(known, default=None), min(known, default=None), *key[1:]))
    return sorted(results, key=str), sorted(late), watermark, nulls


def write_in_order(folder, batches_):
    """One file a batch; the stream takes files by their times."""
    for n, rows in enumerate(batches_):
        _write_batch(folder, f"b{n}", rows)
        os.utime(f"{folder}/b{n}.parquet", (1_700_000_000 + n, 1_700_000_000 + n))


def new_table(spark, folder, name, ddl):
    catalog.create_database(spark, "rill_t")
    catalog.drop_if_exists(spark, name, database="rill_t")
    spark.sql(catalog.table_ddl(name, ddl, database="rill_t", location=f"{folder}/{name}"))
    return catalog.qualified("rill_t", name)


def feed(spark, sink, groups, ddl):
    """Every batch, again and again until it goes through, and once more when done."""
    for number, rows in enumerate(groups):
        df = spark.createDataFrame(rows, ddl)
        for _ in range(3):
            try:
                sink(df, number)
            except RuntimeError:
                sink(df, number)
    sink(spark.createDataFrame(groups[0], ddl), 0)  # an old batch changes nothing


def window_sink(spark, tmp_dir, **settings):
    counts, late = new_table(spark, tmp_dir, "counts", COUNTS), new_table(spark, tmp_dir, "late", LATE)
    return EventTimeWindowSink(
        counts, f"{tmp_dir}/state", size="20 seconds", delay="2 seconds", keys=["k"], aggs=AGGS,
        late_table=late, late_cols=["id"], **settings,
    ), counts, late


def rows_of(spark, table):
    return sorted(map(tuple, spark.table(table).collect()), key=str)


@pytest.mark.parametrize("window,mark,rule", [("ts", "ts", "host"), ("rec", "ts", "host"), ("ts", "rec", "spark")])
def test_windows_and_late_rows_match_a_plain_model(spark, tmp_dir, window, mark, rule):
    groups = batches(seed=len(rule))
    sink, counts, late = window_sink(spark, tmp_dir, window_time=window, watermark_time=mark, closing_rule=rule)
    feed(spark, sink, groups, ROW)
    place = {"ts": 2, "rec": 3}
    want, want_late, watermark, nulls = model(groups, window=place[window], mark=place[mark], slack=0.001 if rule == "host" else 0)
    assert want and want_late
    assert rows_of(spark, counts) == want
    assert rows_of(spark, late) == sorted(want_late, key=str)
    state = sink.log.load(spark)
    assert state["late_rows"] == len(want_late) and state["null_event_times"] == nulls
    assert BASE + dt.timedelta(microseconds=state["watermark"] - int(BASE.replace(tzinfo=dt.timezone.utc).timestamp()) * 10**6) == watermark
    left = fs.list_names(spark, f"{tmp_dir}/state/open")
    assert left == ["3"] and not fs.list_names(spark, f"{tmp_dir}/state/parts")


CRASHES = [
    ((StagedBatch, "write"), True), ((StagedBatch, "publish"), False), ((StagedBatch, "publish"), True),
    ((BatchLog, "save"), False), ((BatchLog, "save"), True), ((StagedBatch, "clean"), False), ((EventTimeWindowSink, "_parts"), True),
]


@pytest.mark.parametrize("where,after", CRASHES)
def test_window_sink_lands_everything_once(spark, tmp_dir, monkeypatch, where, after):
    groups = batches(3, 25, seed=5)
    sink, counts, late = window_sink(spark, tmp_dir, window_time="ts")
    for number, rows in enumerate(groups):
        df = spark.createDataFrame(rows, ROW)
        with monkeypatch.context() as m:
            _crash_once(m, where, after=after)
            with pytest.raises(RuntimeError, match="crash"):
                sink(df, number)
                raise RuntimeError("crash")  # batches without late rows pass a step of theirs only once
        sink(df, number)
    want, want_late, *_ = model(groups, window=2, mark=2)
    assert want_late and rows_of(spark, counts) == want and rows_of(spark, late) == sorted(want_late, key=str)


def test_window_sink_odd_batches(spark, tmp_dir):
    """Empty batches, only NULL times, and no late table: rows are counted."""
    counts = new_table(spark, tmp_dir, "counts", COUNTS)
    sink = EventTimeWindowSink(
        counts, f"{tmp_dir}/state", window_time="ts", size="20 seconds", delay="0 seconds", keys=["k"], aggs=AGGS
    )
    groups = [[], [(0, "a", None, None, 1)], [(1, "a", at(100), None, 1)], [], [(2, "a", at(5), None, 1), (3, "a", at(200), None, 4)]]
    feed(spark, sink, groups, ROW)
    assert rows_of(spark, counts) == [("a", 1, 1, 1, 1, at(100), at(120))]
    state = sink.log.load(spark)
    assert (state["late_rows"], state["null_event_times"]) == (1, 1)
    with pytest.raises(ValueError, match="closing_rule"):
        EventTimeWindowSink(counts, tmp_dir, window_time="ts", size="1 s", delay="0 s", keys=[], aggs=AGGS, closing_rule="x")


@pytest.mark.parametrize("keys", [[], ["k"]])
@pytest.mark.parametrize("where,after", [(None, False), ((StagedBatch, "publish"), False), ((BatchLog, "save"), False), ((BatchLog, "save"), True)])
def test_monotone_time_is_carried_over_batches_and_crashes(spark, tmp_dir, monkeypatch, where, after, keys):
    groups = batches(3, 20, seed=9)
    table = new_table(spark, tmp_dir, "mono", f"id BIGINT, {'k STRING, ' if keys else ''}ts TIMESTAMP_NTZ, m TIMESTAMP_NTZ, w TIMESTAMP_NTZ")
    make = lambda: MonotoneTimeSink(table, f"{tmp_dir}/s", time_col="ts", order_cols=["id"], delay="2 seconds", id_cols=["id"], partition_cols=keys)
    for number, rows in enumerate(groups):
        df = spark.createDataFrame(rows, ROW)
        if where and number == 1:
            with monkeypatch.context() as m:
                _crash_once(m, where, after=after)
                with pytest.raises(RuntimeError, match="crash"):
                    make()(df, number)
        make()(df, number)  # a sink of its own for each batch, as after a restart
    most, want = {}, []
    for i, k, ts, _, _ in sum(groups, []):
        key = k if keys else 0
        if ts is not None:
            most[key] = max(ts, most.get(key, ts))
        m = most.get(key)
        want.append((i, *([k] if keys else []), ts, m, m - dt.timedelta(seconds=2) if m else None))
    assert rows_of(spark, table) == sorted(want, key=str)
    assert fs.list_names(spark, f"{tmp_dir}/s/scan") == []


def test_jobs_of_the_metric_topic(spark, tmp_dir):
    """The two table jobs from topic records to tables, one file a micro-batch."""
    src = f"{tmp_dir}/in"
    write_in_order(src, [[_event(10 * n + j, at(t)) for j, t in enumerate(times)] for n, times in enumerate([(1, 9, 3), (40, 2), (41, 90)])])
    stream = lambda: replay.metric_topic(_stream(spark, src))
    counts, late = new_table(spark, tmp_dir, "counts", schemas.URL_COUNT_TABLE), new_table(spark, tmp_dir, "late", schemas.LATE_METRIC_TABLE)
    run(sjobs.url_count_table_job(stream(), counts, f"{tmp_dir}/ck", late_table=late, available_now=True))
    assert [(r["cnt"], r["window_start"]) for r in spark.table(counts).orderBy("window_start").collect()] == [
        (2, at(0)), (1, at(5)), (2, at(40))]
    assert [(r["payload_time"], r["watermark"]) for r in spark.table(late).collect()] == [(at(2), at(7))]
    mono = new_table(spark, tmp_dir, "mono", schemas.MONOTONE_TIME_TABLE)
    run(sjobs.monotone_time_job(stream(), mono, f"{tmp_dir}/ck2", available_now=True))
    assert [r["monotone_ts"] for r in spark.table(mono).orderBy("offset").collect()] == list(map(at, (1, 9, 9, 40, 40, 41, 90)))


# --- upserts ---------------------------------------------------------------

CHANGES = [[("a", 1), ("b", 2)], [("b", 5), (None, 7)], [], [("a", None), ("c", 1)], [("b", 6)]]
UPSERT_CRASHES = [((BatchLog, "save"), False), ((BatchLog, "save"), True), ((fs, "delete"), False), ((fs, "delete"), True)]


@pytest.mark.parametrize("every", [1, 3])
@pytest.mark.parametrize("where,after", [(None, False), *UPSERT_CRASHES])
def test_upserts_keep_the_newest_row_of_each_key(spark, tmp_dir, monkeypatch, every, where, after):
    sink = UpsertSink(f"{tmp_dir}/u", ["k"], compact_every=every)
    newest = {}
    for number, rows in enumerate(CHANGES):
        df = spark.createDataFrame(rows, "k STRING, total INT")
        if where:
            with monkeypatch.context() as m:
                _crash_module_once(m, where, after=after)
                try:
                    sink(df, number)
                except RuntimeError:
                    pass
        sink(df, number)
        newest.update(rows)
        assert sorted(map(tuple, read_upserts(spark, f"{tmp_dir}/u").collect()), key=str) == sorted(newest.items(), key=str)
    assert len(fs.list_names(spark, f"{tmp_dir}/u/changes")) <= 2 * every


def _crash_module_once(monkeypatch, where, *, after):
    owner, name = where
    if isinstance(owner, type):
        _crash_once(monkeypatch, where, after=after)
        return
    real, left = getattr(owner, name), [1]

    def wrapped(*a, **k):
        if left[0] and not after:
            left[0] = 0
            raise RuntimeError("crash")
        out = real(*a, **k)
        if left[0]:
            left[0] = 0
            raise RuntimeError("crash")
        return out

    monkeypatch.setattr(owner, name, wrapped)


def test_a_reader_survives_a_compaction(spark, tmp_dir):
    sink = UpsertSink(f"{tmp_dir}/u", ["k"], compact_every=2)
    put = lambda n, rows: sink(spark.createDataFrame(rows, "k STRING, total INT"), n)
    put(0, [("a", 1)])
    before = read_upserts(spark, f"{tmp_dir}/u")
    put(1, [("a", 2)])  # compacts; what the reader needs is still there
    assert list(map(tuple, before.collect())) == [("a", 1)]
    assert list(map(tuple, read_upserts(spark, f"{tmp_dir}/u").collect())) == [("a", 2)]


def test_global_sum_in_update_mode(spark, tmp_dir):
    src = f"{tmp_dir}/in"
    for n in range(3):
        _write_batch(src, f"b{n}", [_event(10 * n + j, at(j), k=j) for j in range(4)])
    sums = _stream(spark, src).agg(F.sum("event_id").alias("total"))
    run(for_each_batch(sums, UpsertSink(f"{tmp_dir}/u"), f"{tmp_dir}/ck", output_mode="update", available_now=True))
    assert [r["total"] for r in read_upserts(spark, f"{tmp_dir}/u").collect()] == [sum(10 * n + j for n in range(3) for j in range(4))]
    with pytest.raises(FileNotFoundError):
        read_upserts(spark, f"{tmp_dir}/none")


def test_complete_result_is_replaced_whole(spark, tmp_dir, monkeypatch):
    sink = CompleteResultSink(f"{tmp_dir}/c")
    one = lambda v: spark.createDataFrame([(v,)], "v INT")
    with pytest.raises(FileNotFoundError):
        read_complete(spark, f"{tmp_dir}/c")
    for n in range(5):
        _crash_once(monkeypatch, (BatchLog, "save"), after=False)
        with pytest.raises(RuntimeError, match="crash"):
            sink(one(n), n)
        if n:
            assert [r["v"] for r in read_complete(spark, f"{tmp_dir}/c").collect()] == [n - 1]
        sink(one(n), n)
        assert [r["v"] for r in read_complete(spark, f"{tmp_dir}/c").collect()] == [n]
        monkeypatch.undo()


# --- counters --------------------------------------------------------------


def test_totals_are_exact_after_150_batches_and_a_restart(spark, tmp_dir):
    src, ck = f"{tmp_dir}/in", f"{tmp_dir}/ck"
    for n in range(150):
        _write_batch(src, f"b{n:03}", [_event(2 * n, at(60 * n)), _event(2 * n + 1, None if n % 3 else at(60 * n))])

    def start():
        counters = Counters(spark, ck)
        frame = with_watermark(_stream(spark, src), "ts", "0 seconds").select("event_id")
        return run(to_files(frame, f"{tmp_dir}/out", ck, available_now=True), counters=counters), counters

    query, counters = start()
    assert counters.totals["input_rows"] == 300 and counters.totals["null_event_times"] == 100
    assert null_event_times(query) < 100  # what Spark itself still holds
    for n in range(150, 160):
        _write_batch(src, f"b{n:03}", [_event(2 * n, None)])
    _, again = start()
    want = {"batches": 160, "input_rows": 310, "null_event_times": 110, "dropped_by_watermark": 0}
    assert again.totals == want == saved_totals(spark, ck)


def test_dropped_rows_are_counted(spark, tmp_dir):
    src = f"{tmp_dir}/in"
    write_in_order(src, [[_event(0, at(0)), _event(1, at(45))], [_event(3, at(70))], [_event(4, at(6))]])
    counters = Counters(spark)
    frame = sjobs.url_count_frame(replay.metric_topic(_stream(spark, src)), size="20 seconds", delay="0 seconds")
    run(to_files(frame, f"{tmp_dir}/out", f"{tmp_dir}/ck", available_now=True), counters=counters)
    assert counters.totals["dropped_by_watermark"] == 1


def test_rocksdb_session_keeps_state_there(spark, tmp_dir):
    from rill.session import ROCKSDB_PROVIDER, rocksdb_session

    src = f"{tmp_dir}/in"
    _write_batch(src, "b0", [_event(0, at(0))])
    session = rocksdb_session(spark)
    frame = sjobs.url_count_frame(replay.metric_topic(_stream(session, src)))
    query = run(to_files(frame, f"{tmp_dir}/out", f"{tmp_dir}/ck", available_now=True))
    assert any(k.startswith("rocksdb") for p in query.recentProgress for op in p.stateOperators for k in op.customMetrics)
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") != ROCKSDB_PROVIDER
