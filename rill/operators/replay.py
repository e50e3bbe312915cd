"""Replay operators over a recorded stream: running maxima in arrival order.

A periodic or punctuated watermark is a running maximum of event time in
arrival order. A plain ``max() OVER (ORDER BY arrival)`` would sort the
whole stream in one task, so the scan is split into blocks:

1. A range exchange on the whole order key deals the rows into blocks in
   order. The key ends in a unique id, so rows of one instant are split
   too; adaptive execution merges small blocks. Within a block, rows are
   sorted and the running maximum is taken batch by batch (Arrow, numpy),
   which needs no second exchange. The result is written once, with the
   block number, in the shared folder.
2. One maximum per block from the written rows, and the maximum over all
   earlier blocks via a window over those few rows. Broadcasting it is
   bounded by the number of blocks.
3. The written rows are combined with the carry.

Range bounds come from Spark's sample and may differ from run to run;
they set balance only. Since rows and maxima both come from the one
written table, they always agree, and a lost executor re-reads it. The
plan does not grow with the number of blocks.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rill.functions.runs import runs_of
from rill.functions.time import interval
from rill.session import let_workers_import, scratch_path

# Fixed value: the host's closing rule compares the window's last
# millisecond (end - 1 ms) with the watermark.
HOST_WINDOW_MAX_OFFSET = "INTERVAL 1 MILLISECOND"


def _running(values: pa.Array, before):
    """Running maxima of one run of rows, NULLs skipped; ``before`` is the maximum so far."""
    kind = values.type
    if pa.types.is_timestamp(kind):
        out, last = _running(values.cast(pa.int64()), before)
        return out.cast(kind), last
    if pa.types.is_integer(kind) or pa.types.is_floating(kind):
        known = values.is_valid().to_numpy(zero_copy_only=False)
        floor = np.iinfo(np.int64).min if pa.types.is_integer(kind) else -np.inf
        raw = values.fill_null(0).to_numpy(zero_copy_only=False)
        raw = np.where(known, raw, floor).astype(np.int64 if pa.types.is_integer(kind) else np.float64)
        if before is not None:
            raw[0] = np.maximum(raw[0], before)  # not-a-number is the largest
        seen = np.logical_or.accumulate(known) | (before is not None)
        most = np.maximum.accumulate(raw)
        out = pa.array(most, mask=~seen).cast(kind)
        return out, (most[-1].item() if seen[-1] else None)
    largest = lambda a, b: b if a is None else a if b is None else max(a, b)
    most = list(accumulate([before, *values.to_pylist()], largest))[1:]
    return pa.array(most, type=kind), most[-1]


def _scan_sorted(value_col: str, keys: Sequence[str], inclusive: bool):
    """mapInArrow function: appends the running maximum of the partition's sorted rows."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_key, most = None, None
        for batch in batches:
            parts = []
            for key, rows in runs_of(batch, keys):
                before = most if key == held_key else None
                held_key = key
                run, most = _running(rows.column(value_col), before)
                if not inclusive:
                    time = pa.types.is_timestamp(run.type)
                    first = pa.array([before], type=pa.int64() if time else run.type).cast(run.type)
                    run = pa.concat_arrays([first, run.slice(0, len(run) - 1)])
                parts.append(run)
            if not parts:
                continue
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.concat_arrays(parts)], names=[*batch.schema.names, "__local"])

    return scan


def running_max(
    df: DataFrame,
    value_col: str,
    order_cols: Sequence[str],
    *,
    out_col: str = "running_max",
    partition_cols: Sequence[str] = (),
    inclusive: bool = True,
    blocks: int | None = None,
    path: str | None = None,
) -> DataFrame:
    """Add ``out_col`` = max(value_col) over rows up to this one in order.

    ``inclusive=False`` excludes the row itself (the value seen *before*
    it arrived; NULL for the first row). ``partition_cols`` restarts the
    scan per partition (e.g. per topic partition); keep it low-cardinality.
    The rows are written once while the frame is built: select the columns
    that are needed first. ``blocks`` fixes their number; by default the
    shuffle partitions, merged by size. ``path`` is where the rows go (a fresh
    folder of the shared one by default); what is there is replaced.
    """
    spark = df.sparkSession
    let_workers_import(spark)
    keys = list(partition_cols)
    order = [*keys, *order_cols]
    dealt = df.repartitionByRange(blocks, *order) if blocks else df.repartitionByRange(*order)
    sorted_rows = dealt.sortWithinPartitions(*order).withColumn("__blk", F.spark_partition_id())
    kinds = T.StructType([*sorted_rows.schema.fields, T.StructField("__local", df.schema[value_col].dataType)])
    path = path or scratch_path(spark, "running_max")
    sorted_rows.mapInArrow(_scan_sorted(value_col, keys, inclusive), kinds).write.mode("overwrite").parquet(path)
    written = spark.read.schema(kinds).parquet(path)

    block_max = written.groupBy(*keys, "__blk").agg(F.max(value_col).alias("__bmax"))
    earlier = Window.partitionBy(*keys).orderBy("__blk").rowsBetween(Window.unboundedPreceding, -1)
    carry = block_max.select(
        *[F.col(k).alias(f"__key_{i}") for i, k in enumerate(keys)], F.col("__blk").alias("__carry_blk"),
        F.max("__bmax").over(earlier).alias("__carry"),
    )
    if not keys:
        carry = F.broadcast(carry)  # one row per block
    same = F.col("__blk") == F.col("__carry_blk")
    for i, k in enumerate(keys):
        same &= F.col(k).eqNullSafe(F.col(f"__key_{i}"))
    out = written.join(carry, same, "left").withColumn(out_col, F.greatest("__local", "__carry"))
    return out.select(*[c for c in df.columns if c != out_col], out_col)


def late_row_audit(
    df: DataFrame,
    *,
    time_col: str,
    order_cols: Sequence[str],
    window: str,
    delay: str,
    id_cols: Sequence[str] = (),
    partition_cols: Sequence[str] = (),
    closing_rule: str = "host",
    blocks: int | None = None,
) -> DataFrame:
    """Flag rows that arrive after their tumbling window closed.

    The watermark a row meets is the running maximum event time of the
    rows that arrived before it, minus ``delay`` (a bounded-delay
    watermark; ``delay='0 seconds'`` is the punctuated one). Closing
    rules: ``'host'`` -- late iff ``window_end - 1 ms <= watermark``;
    ``'spark'`` -- late iff ``window_end <= watermark``. Returns every row
    (nothing is dropped) with its window, watermark and flag.
    """
    if closing_rule not in ("host", "spark"):
        raise ValueError("closing_rule must be 'host' or 'spark'")
    needed = df.select(*dict.fromkeys([*id_cols, *partition_cols, time_col, *order_cols]))
    seen = running_max(
        needed, time_col, order_cols, out_col="__seen", partition_cols=partition_cols,
        inclusive=False, blocks=blocks,
    )
    w = F.window(time_col, window)
    out = seen.select(
        *id_cols, *partition_cols, time_col,
        w.start.alias("window_start"),
        w.end.alias("window_end"),
        (F.col("__seen") - interval(delay)).alias("watermark"),
    )
    last = F.col("window_end")
    if closing_rule == "host":
        last = last - F.expr(HOST_WINDOW_MAX_OFFSET)
    return out.withColumn("is_late", F.coalesce(last <= F.col("watermark"), F.lit(False)))


def monotone_event_time(
    df: DataFrame,
    *,
    time_col: str,
    order_cols: Sequence[str],
    delay: str,
    id_cols: Sequence[str] = (),
    partition_cols: Sequence[str] = (),
    blocks: int | None = None,
) -> DataFrame:
    """Event time as the running maximum in arrival order, and its watermark.

    An assigner that stamps each row with the largest time seen so far
    never lets time go backwards; the watermark trails it by ``delay``.
    """
    needed = df.select(*dict.fromkeys([*id_cols, *partition_cols, time_col, *order_cols]))
    mono = running_max(
        needed, time_col, order_cols, out_col="monotone_ts", partition_cols=partition_cols,
        inclusive=True, blocks=blocks,
    )
    return mono.select(
        *id_cols, *partition_cols, time_col, "monotone_ts",
        (F.col("monotone_ts") - interval(delay)).alias("watermark"),
    )
