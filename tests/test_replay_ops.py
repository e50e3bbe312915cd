"""Running-maximum scan, late-row audit and partition readiness vs brute force."""

import datetime as dt
import random

import pandas as pd
import pytest

from rill.operators.partition_commit import is_ready, partition_readiness, partition_time
from rill.operators.replay import late_row_audit, monotone_event_time, running_max
from rill.streaming.commit import micros, ready_partitions

BASE = dt.datetime(2024, 1, 1)


def _rows(n, seed, hot_fraction=0.0):
    """Rows in arrival order; a hot share of them carry one identical arrival time."""
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        ts = BASE + dt.timedelta(seconds=rnd.randint(0, 3600))
        arrival = BASE + dt.timedelta(seconds=7200) if rnd.random() < hot_fraction else ts + dt.timedelta(
            seconds=rnd.randint(0, 900))
        out.append((i, ts, arrival, rnd.randint(0, 2)))
    return out


def _frame(spark, rows):
    return spark.createDataFrame(rows, "id BIGINT, ts TIMESTAMP_NTZ, arrival TIMESTAMP_NTZ, p INT")


@pytest.mark.parametrize("seed,hot,blocks,parts", [(1, 0.0, 4, ()), (2, 0.4, 7, ()), (3, 0.34, 5, ("p",)), (4, 0.0, 1, ("p",))])
@pytest.mark.parametrize("inclusive", [True, False])
def test_running_max_matches_brute_force(spark, seed, hot, blocks, parts, inclusive):
    rows = _rows(400, seed, hot)
    got = running_max(
        _frame(spark, rows), "ts", ["arrival", "id"], out_col="m",
        partition_cols=parts, inclusive=inclusive, blocks=blocks,
    ).toPandas().set_index("id")["m"]
    pdf = pd.DataFrame(rows, columns=["id", "ts", "arrival", "p"]).sort_values(["arrival", "id"])
    grp = pdf.groupby(list(parts)) if parts else pdf.groupby(lambda _: 0)
    want = grp["ts"].cummax() if inclusive else grp["ts"].transform(lambda s: s.cummax().shift(1))
    for i in pdf["id"]:
        w, g = want.loc[pdf.index[pdf["id"] == i][0]], got.loc[i]
        assert (pd.isna(w) and pd.isna(g)) or pd.Timestamp(w) == pd.Timestamp(g), i


def test_late_row_audit_host_rule(spark):
    t = lambda s: BASE + dt.timedelta(seconds=s)
    # arrival order = id; window 20 s; delay 2 s
    rows = [(0, t(5), t(5), 0), (1, t(30), t(30), 0), (2, t(10), t(31), 0), (3, t(21), t(32), 0)]
    out = {r["id"]: r for r in late_row_audit(
        _frame(spark, rows), time_col="ts", order_cols=["arrival", "id"], window="20 seconds",
        delay="2 seconds", id_cols=["id"],
    ).collect()}
    assert out[0]["is_late"] is False and out[0]["watermark"] is None
    assert out[1]["is_late"] is False
    # watermark 28 s: window [0,20) closed (19.999 <= 28) -> late
    assert out[2]["watermark"] == t(28) and out[2]["is_late"] is True
    assert out[3]["is_late"] is False


def test_monotone_event_time(spark):
    t = lambda s: BASE + dt.timedelta(seconds=s)
    rows = [(0, t(5), t(1), 0), (1, t(3), t(2), 0), (2, t(9), t(3), 0)]
    out = {r["id"]: r["monotone_ts"] for r in monotone_event_time(
        _frame(spark, rows), time_col="ts", order_cols=["arrival", "id"], delay="2 seconds", id_cols=["id"],
    ).collect()}
    assert out == {0: t(5), 1: t(5), 2: t(9)}


def test_partition_commit_rule(spark):
    parts = [("2024-01-01", "00", m) for m in ("00", "01", "02")]
    wm = dt.datetime(2024, 1, 1, 0, 2, 0, 1000)
    wm_micros = int(wm.replace(tzinfo=dt.timezone.utc).timestamp()) * 1_000_000 + wm.microsecond
    py = ready_partitions(
        spark, [dict(zip(("ts_date", "ts_hour", "ts_minute"), p)) for p in [*parts, ("+55969-01-01", "00", "00")]],
        "$ts_date $ts_hour:$ts_minute:00", wm_micros, micros("1 min"),
    )
    assert [p["ts_minute"] for p in py] == ["00", "01"]
    from pyspark.sql import functions as F

    df = spark.createDataFrame(parts, "ts_date STRING, ts_hour STRING, ts_minute STRING")
    flags = df.select(
        "ts_minute",
        is_ready(partition_time("$ts_date $ts_hour:$ts_minute:00"), F.lit(wm).cast("timestamp_ntz"), "1 minute"),
    ).orderBy("ts_minute").collect()
    assert [r[1] for r in flags] == [True, True, False]


def test_partition_readiness_frame(spark):
    rows = spark.createDataFrame(
        [("2024-01-01", "00", "00", BASE), ("2024-01-01", "00", "05", BASE + dt.timedelta(minutes=5))],
        "ts_date STRING, ts_hour STRING, ts_minute STRING, et TIMESTAMP_NTZ",
    )
    from pyspark.sql import functions as F

    out = {r["ts_minute"]: r["ready"] for r in partition_readiness(
        rows, partition_cols=["ts_date", "ts_hour", "ts_minute"], pattern="$ts_date $ts_hour:$ts_minute:00",
        event_time=F.col("et"), watermark_delay="15 seconds", commit_delay="1 minute",
    ).collect()}
    assert out == {"00": True, "05": False}


def test_closing_rules_differ_on_the_last_millisecond(spark):
    """Watermark 19.9995 s: the host closes [0,20) (19.999 <= wm), Spark
    does not yet (20 <= wm is false)."""
    t = lambda s: BASE + dt.timedelta(seconds=s)
    rows = [(0, t(21.9995), t(1), 0), (1, t(5), t(2), 0)]  # second row arrives after wm = 19.9995
    df = _frame(spark, rows)
    kw = dict(time_col="ts", order_cols=["arrival", "id"], window="20 seconds", delay="2 seconds", id_cols=["id"])
    host = {r["id"]: r["is_late"] for r in late_row_audit(df, **kw).collect()}
    sprk = {r["id"]: r["is_late"] for r in late_row_audit(df, closing_rule="spark", **kw).collect()}
    assert host[1] is True and sprk[1] is False


@pytest.mark.parametrize("kind", ["DOUBLE", "STRING", "DATE"])
def test_running_max_of_any_type_with_nulls_and_small_batches(spark, kind):
    """NULL values, NULL keys and order values, not-a-number, a few rows per Arrow batch."""
    rnd = random.Random(kind)
    rows = [
        (i, rnd.choice([None, "a", "b"]), None if rnd.random() < 0.1 else rnd.randint(0, 50), None if rnd.random() < 0.3 else rnd.randint(1, 28))
        for i in range(300)
    ]
    text = {"DATE": "concat('2024-01-', lpad(v, 2, '0'))"}.get(kind, "v")
    nan = "IF(v = 28, CAST('NaN' AS DOUBLE), CAST(v AS DOUBLE))"
    df = spark.createDataFrame(rows, "id INT, k STRING, o INT, v INT").selectExpr(
        "id", "k", "o", f"{nan if kind == 'DOUBLE' else f'CAST({text} AS {kind})'} AS v"
    )
    df.createOrReplaceTempView("running_rows")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        for inclusive, frame in ((True, "CURRENT ROW"), (False, "1 PRECEDING")):
            for keys in ((), ("k",)):
                part = "PARTITION BY k" if keys else ""
                want = spark.sql(
                    f"SELECT id, CAST(max(v) OVER ({part} ORDER BY o, id ROWS BETWEEN UNBOUNDED PRECEDING AND {frame}) AS STRING) AS m FROM running_rows"
                )
                got = running_max(df, "v", ["o", "id"], out_col="m", partition_cols=keys, inclusive=inclusive, blocks=4)
                assert sorted(map(str, got.selectExpr("id", "CAST(m AS STRING) AS m").collect())) == sorted(map(str, want.collect()))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_running_max_of_an_empty_frame(spark):
    df = _frame(spark, [])
    assert running_max(df, "ts", ["arrival", "id"], out_col="m").collect() == []
