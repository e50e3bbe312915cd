"""Batch tumbling windows (bucket arithmetic) against Python flooring and
against Spark's own window() on generated times, including pre-1970."""

import datetime as dt
import random
from collections import Counter

from pyspark.sql import functions as F

from rill.operators.windows import count_by_window

EPOCH = dt.datetime(1970, 1, 1)


def test_buckets_match_model_and_window(spark):
    rnd = random.Random(3)
    rows = []
    for i in range(3000):
        us = rnd.randint(-10**14, 2 * 10**15)
        ts = None if rnd.random() < 0.02 else EPOCH + dt.timedelta(microseconds=us)
        rows.append((rnd.choice("abc"), ts))
    df = spark.createDataFrame(rows, "k STRING, ts TIMESTAMP_NTZ")
    for size, width in (("20 seconds", 20_000_000), ("1 hour", 3_600_000_000), ("1 day", 86_400_000_000)):
        got = Counter({(r["k"], r["window_start"], r["window_end"]): r["cnt"]
                       for r in count_by_window(df, "ts", size, ["k"]).collect()})
        want = Counter()
        for k, ts in rows:
            if ts is None:
                continue
            us = (ts - EPOCH) // dt.timedelta(microseconds=1)
            start = EPOCH + dt.timedelta(microseconds=(us // width) * width)
            want[(k, start, start + dt.timedelta(microseconds=width))] += 1
        assert got == want, size
        spark_window = Counter({(r["k"], r["w"].start, r["w"].end): r["n"] for r in
                                df.groupBy("k", F.window("ts", size).alias("w")).agg(F.count("*").alias("n")).collect()})
        assert got == spark_window, size
