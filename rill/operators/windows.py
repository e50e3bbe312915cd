"""Tumbling event-time window aggregations, one function for batch and stream.

Grouping by (window, key) plans as partial aggregation -> one hash exchange
on (window, key) -> final aggregation. A hot key is collapsed map-side
before the shuffle, and the state and shuffle hold one row per
(window, key), never the buffered window contents. Streaming frames group
by ``window()`` so the watermark can close groups; batch frames group by
the epoch-aligned bucket start directly (see ``aggregate_by_window``). A
function of one's own over whole windows is ``apply_by_window``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from itertools import groupby, islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from rill.functions.runs import runs_of
from rill.functions.time import parse_duration, to_stream_time
from rill.session import let_workers_import


# Name of the observed metric that counts rows without an event time.
NULL_TIMES = "null_event_times"


def observe_null_times(df: DataFrame, time_col: str, observation: str | Observation = NULL_TIMES) -> DataFrame:
    """Count rows whose event time is NULL: they belong to no window.

    A stream reports the count of each micro-batch under ``observation`` in
    its progress (``rill.streaming.runner.null_event_times``); in batch pass
    an ``Observation`` and read its ``null_event_times`` after the action.
    """
    return df.observe(observation, F.count_if(F.col(time_col).isNull()).alias(NULL_TIMES))


def with_watermark(df: DataFrame, time_col: str, delay: str) -> DataFrame:
    """Declare a bounded-delay watermark; casts zone-less times first.

    A stream also counts the rows without a time (``observe_null_times``).
    """
    if df.isStreaming:
        df = observe_null_times(df, time_col)
    if dict(df.dtypes)[time_col] == "timestamp_ntz":
        df = df.withColumn(time_col, to_stream_time(time_col))
    return df.withWatermark(time_col, delay)


def _size_micros(size: str) -> int:
    """'20 seconds' / '1 day' -> microseconds (fixed-length units only)."""
    return int(round(parse_duration(size).total_seconds() * 1_000_000))


def aggregate_by_window(
    df: DataFrame,
    time_col: str,
    size: str,
    keys: Sequence[str],
    aggs: dict[str, Column],
    *,
    start_col: str = "window_start",
    end_col: str = "window_end",
) -> DataFrame:
    """Aggregate per (tumbling window, keys); window bounds as two columns.

    Windows are aligned to the epoch. Rows with a NULL event time belong
    to no window and are not counted; ``observe_null_times`` counts them.

    Streaming frames group by ``window()`` (the key the watermark tracks).
    Batch frames group by the bucket start computed directly,
    ``t - pmod(t, size)``, and drop the NULL-time group after aggregating:
    ``window()`` would add an ``IsNotNull(t)`` filter that the optimizer
    pushes below the projections, evaluating the event-time derivation
    (e.g. text parsing) twice per row.
    """
    if df.isStreaming:
        grouped = df.groupBy(F.window(time_col, size).alias("__w"), *keys)
        out = grouped.agg(*[expr.alias(name) for name, expr in aggs.items()])
        return out.select(
            *keys,
            *aggs.keys(),
            F.col("__w.start").alias(start_col),
            F.col("__w.end").alias(end_col),
        )
    width = _size_micros(size)
    zone_less = dict(df.dtypes)[time_col] == "timestamp_ntz"
    micros = F.unix_micros(F.col(time_col).cast("timestamp"))
    start_us = micros - F.pmod(micros, F.lit(width))
    grouped = df.groupBy(start_us.alias("__start"), *keys)
    out = grouped.agg(
        *[expr.alias(name) for name, expr in aggs.items()],
        F.count(time_col).alias("__timed"),
    ).where(F.col("__timed") > 0)

    def bound(us: Column) -> Column:
        ts = F.timestamp_micros(us)
        return ts.cast("timestamp_ntz") if zone_less else ts

    return out.select(
        *keys,
        *aggs.keys(),
        bound(F.col("__start")).alias(start_col),
        bound(F.col("__start") + F.lit(width)).alias(end_col),
    )


def count_by_window(
    df: DataFrame,
    time_col: str,
    size: str,
    keys: Sequence[str],
    *,
    count_col: str = "cnt",
    start_col: str = "window_start",
    end_col: str = "window_end",
) -> DataFrame:
    """Rows per (tumbling window, keys)."""
    return aggregate_by_window(
        df, time_col, size, keys, {count_col: F.count(F.lit(1))},
        start_col=start_col, end_col=end_col,
    )


def count_column_by_window(
    df: DataFrame,
    time_col: str,
    size: str,
    keys: Sequence[str],
    counted: str,
    *,
    count_col: str,
    start_col: str = "window_start",
    end_col: str = "window_end",
) -> DataFrame:
    """Non-NULL values of ``counted`` per (tumbling window, keys)."""
    return aggregate_by_window(
        df, time_col, size, keys, {count_col: F.count(counted)},
        start_col=start_col, end_col=end_col,
    )


def integer_mean_by_window(
    df: DataFrame,
    time_col: str,
    size: str,
    keys: Sequence[str],
    value: str,
    *,
    mean_col: str = "mean",
    start_col: str = "window_start",
    end_col: str = "window_end",
) -> DataFrame:
    """``sum(value) div count(*)`` per window: integer mean, truncated.

    Sum and count are both algebraic, so the partial/final split keeps
    the shuffle at one row per group per task.
    """
    agg = aggregate_by_window(
        df, time_col, size, keys,
        {"__sum": F.sum(value), "__n": F.count(F.lit(1))},
        start_col=start_col, end_col=end_col,
    )
    mean = F.call_function("div", F.col("__sum"), F.col("__n")).alias(mean_col)
    return agg.select(*keys, mean, start_col, end_col)


#: Rows that a window function has given and that are sent on together.
_OUT_ROWS = 4_096


def apply_by_window(
    df: DataFrame,
    time_col: str,
    size: str,
    keys: Sequence[str],
    function: Callable[[dict, Iterator[pa.RecordBatch]], Iterable[tuple]],
    returns: str,
    *,
    order_by: Sequence[str] = (),
    start_col: str = "window_start",
    end_col: str = "window_end",
) -> DataFrame:
    """A user function over the whole of each (tumbling window, keys); batch only.

    ``function(key, pieces)`` is called once per window and key, with the key
    columns and bounds as a dict and the rows as Arrow batches in
    ``order_by`` order; it gives tuples of the ``returns`` columns (DDL), none
    or many. Result columns: keys, returned columns, window bounds.

    Rows are shuffled once on (window, keys) and sorted; the function gets
    them as they come from the sort, which spills, in pieces of at most
    ``spark.sql.execution.arrow.maxRecordsPerBatch`` rows. A hot window takes
    one task longer, not more memory. Prefer ``aggregate_by_window`` where
    built-in aggregates do: they combine before the shuffle.

    Rows with a NULL event time belong to no window; NULL keys are keys;
    without rows there are no calls.
    """
    if df.isStreaming:
        raise ValueError("apply_by_window takes batch frames; streams take aggregates (aggregate_by_window)")
    let_workers_import(df.sparkSession)
    width, names = _size_micros(size), list(keys)
    zone_less = dict(df.dtypes)[time_col] == "timestamp_ntz"
    t = F.unix_micros(F.col(time_col).cast("timestamp"))
    dealt = df.withColumn("__start", t - F.pmod(t, F.lit(width))).where(F.col("__start").isNotNull())
    dealt = dealt.repartition("__start", *names).sortWithinPartitions("__start", *names, *order_by)
    kinds = T.StructType([df.schema[k] for k in names] + T.StructType.fromDDL(returns).fields + [T.StructField("__start", T.LongType())])
    arrow = to_arrow_schema(kinds)
    bounds = lambda start: {start_col: start, end_col: start + width}

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        runs = (run for batch in batches for run in runs_of(batch, ["__start", *names]))
        for (start, *key), pieces in groupby(runs, key=lambda run: run[0]):
            known = dict(zip(names, key))
            # the next window begins where the pieces end, read or not
            for row in function({**known, **bounds(start)}, (piece.drop_columns(["__start"]) for _, piece in pieces)):
                yield (*key, *row, start)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = rows_of(batches)
        while some := list(islice(rows, _OUT_ROWS)):
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*some), arrow)], schema=arrow)

    def bound(us: Column) -> Column:
        ts = F.timestamp_micros(us)
        return ts.cast("timestamp_ntz") if zone_less else ts

    out = dealt.mapInArrow(run, kinds)
    given = [f.name for f in kinds.fields[:-1]]
    return out.select(*given, bound(F.col("__start")).alias(start_col), bound(F.col("__start") + F.lit(width)).alias(end_col))


def window_bounds_to_table_time(df: DataFrame, *cols: str) -> DataFrame:
    """Stream outputs carry TIMESTAMP bounds; cast back to zone-less."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})
