"""Tumbling windows, filters, positional insert, time functions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from rill import schemas
from rill.functions.time import epoch_millis_to_seconds, from_text, partition_values
from rill.operators.projection import insert_by_position, keep_positive
from rill.operators.windows import count_by_window, integer_mean_by_window


def test_window_edges(spark):
    df = spark.sql(
        "SELECT * FROM VALUES "
        "('a', TIMESTAMP_NTZ'2024-01-01 00:00:00'), "
        "('a', TIMESTAMP_NTZ'2024-01-01 00:00:19.999'), "
        "('a', TIMESTAMP_NTZ'2024-01-01 00:00:20'), "
        "('a', CAST(NULL AS TIMESTAMP_NTZ)) AS t(k, ts)"
    )
    out = count_by_window(df, "ts", "20 seconds", ["k"]).orderBy("window_start").collect()
    assert [(r["window_start"].second, r["window_end"].second, r["cnt"]) for r in out] == [
        (0, 20, 2), (20, 40, 1)
    ]  # the NULL-time row belongs to no window


def test_integer_mean_truncates(spark):
    df = spark.sql(
        "SELECT * FROM VALUES ('h', 3L, TIMESTAMP_NTZ'2024-01-01 00:00:00'), "
        "('h', 4L, TIMESTAMP_NTZ'2024-01-01 00:00:01') AS t(host, mem, ts)"
    )
    row = integer_mean_by_window(df, "ts", "2 seconds", ["host"], "mem", mean_col="m").collect()[0]
    assert row["m"] == 3


def test_filter_positive(spark):
    df = spark.createDataFrame([(5,), (0,), (-1,), (None,)], "merchandiseId BIGINT")
    assert [r[0] for r in keep_positive(df, "merchandiseId").collect()] == [5]


def test_insert_by_position(spark):
    df = spark.createDataFrame([("s", 2, dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 0, 0, 20))],
                               "siteId STRING, cnt INT, wStar TIMESTAMP_NTZ, wEnd TIMESTAMP_NTZ")
    out = insert_by_position(df, schemas.ACCESS_COUNT)
    assert out.columns == schemas.ACCESS_COUNT_COLUMNS
    assert dict(out.dtypes)["access_count"] == "bigint"


def test_time_functions(spark):
    df = spark.createDataFrame([("2024-01-02 03:04:05", 1704164645999)], "t STRING, ms BIGINT")
    row = df.select(
        from_text("t").alias("a"), epoch_millis_to_seconds("ms").alias("b"),
        *[c.alias(n) for c, n in zip(partition_values(from_text("t")), "dhm")],
    ).collect()[0]
    assert row["a"] == dt.datetime(2024, 1, 2, 3, 4, 5)
    assert row["b"] == dt.datetime(2024, 1, 2, 3, 4, 5)
    assert (row["d"], row["h"], row["m"]) == ("2024-01-02", "03", "04")


def test_strict_text_time_rejects(spark):
    import pytest
    from pyspark.errors import PySparkException

    df = spark.createDataFrame([("yesterday",)], "t STRING")
    with pytest.raises(PySparkException):
        df.select(from_text("t")).collect()
    assert df.select(from_text("t", lenient=True)).collect()[0][0] is None


def test_a_hot_window_comes_in_bounded_pieces(spark):
    from rill.operators.windows import apply_by_window

    def _spans(key, pieces):
        """What a function can see of a window: rows, pieces, the largest piece."""
        sizes = [p.num_rows for p in pieces]
        yield sum(sizes), len(sizes), max(sizes)

    rows = spark.range(50_000).select(
        F.when(F.col("id") < 49_000, F.lit(5)).otherwise(F.col("id")).cast("long").alias("s"), (F.col("id") % 3).alias("k"), "id"
    ).select(F.timestamp_seconds("s").cast("timestamp_ntz").alias("t"), "k", "id")
    got = {(r["k"], r["window_start"]): r for r in apply_by_window(
        rows, "t", "20 seconds", ["k"], _spans, "n BIGINT, pieces INT, most INT").collect()}
    hot = got[(0, dt.datetime(1970, 1, 1))]
    limit = int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))
    assert hot["n"] == 16_334 and hot["pieces"] > 1 and hot["most"] <= limit
    assert sum(r["n"] for r in apply_by_window(rows, "t", "20 seconds", ["k"], _spans, "n BIGINT, pieces INT, most INT").collect()) == 50_000


def test_functions_over_windows_match_plain_loops(spark):
    """Order inside a window, NULL times and keys, functions that read nothing, one row, or give many."""
    import datetime as dt
    import random

    from rill.operators.windows import apply_by_window

    rnd, base = random.Random(6), dt.datetime(1969, 12, 31, 23, 59)
    rows = [(i, rnd.choice(["a", None]), None if rnd.random() < 0.1 else base + dt.timedelta(seconds=rnd.randint(0, 120)), rnd.randint(0, 9)) for i in range(300)]
    df = spark.createDataFrame(rows, "id INT, k STRING, t TIMESTAMP_NTZ, v INT").repartition(5)
    windows = {}
    for i, k, t, v in rows:
        if t is not None:
            start = dt.datetime(1970, 1, 1) + dt.timedelta(seconds=(t - dt.datetime(1970, 1, 1)).total_seconds() // 20 * 20)
            windows.setdefault((k, start), []).append((v, i))

    def ordered(key, pieces):
        for piece in pieces:
            yield from zip(piece.column("v").to_pylist(), piece.column("id").to_pylist())

    got = apply_by_window(df, "t", "20 seconds", ["k"], ordered, "v INT, id INT", order_by=["v", "id"]).collect()
    assert sorted(((r["k"], r["window_start"], r["v"], r["id"]) for r in got), key=str) == sorted(
        ((k, s, v, i) for (k, s), vs in windows.items() for v, i in sorted(vs)), key=str)
    assert all(r["window_end"] - r["window_start"] == dt.timedelta(seconds=20) for r in got)
    first = apply_by_window(df, "t", "20 seconds", ["k"], lambda key, pieces: [next(ordered(key, pieces))], "v INT, id INT", order_by=["v", "id"])
    assert {(r["k"], r["window_start"]): (r["v"], r["id"]) for r in first.collect()} == {w: min(vs) for w, vs in windows.items()}
    bounds = apply_by_window(df, "t", "20 seconds", ["k"], lambda key, _: [(key["k"], key["window_end"] - key["window_start"])], "kk STRING, width BIGINT")
    assert {(r["kk"], r["width"]) for r in bounds.collect()} == {("a", 20_000_000), (None, 20_000_000)} and bounds.count() == len(windows)
    assert apply_by_window(df.limit(0), "t", "20 seconds", ["k"], ordered, "v INT, id INT").collect() == []
    with pytest.raises(ValueError, match="batch frames"):
        apply_by_window(spark.readStream.format("rate").load(), "timestamp", "1 s", [], ordered, "v INT")
