"""Partition-time commit rule.

A partition may be published once the watermark has passed its partition
time plus the commit delay: ready iff ``partition_time + delay <
watermark``. The partition time comes from a pattern over the partition
values (``$ts_date $ts_hour:$ts_minute:00``).
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rill.functions.time import interval
from rill.schemas import TIMESTAMP_TEXT_FORMAT

_PLACEHOLDER = re.compile(r"\$([A-Za-z_][A-Za-z0-9_]*)")


def pattern_columns(pattern: str) -> list[str]:
    return _PLACEHOLDER.findall(pattern)


def partition_time(pattern: str, values: dict[str, Column] | None = None) -> Column:
    """Timestamp built from a ``$column`` pattern (zone-less).

    ``values`` maps placeholder names to Columns (default: same-named
    columns), so the same rule serves DataFrames and literal values.
    """
    values = values or {}
    parts: list[Column] = []
    pos = 0
    for m in _PLACEHOLDER.finditer(pattern):
        if m.start() > pos:
            parts.append(F.lit(pattern[pos:m.start()]))
        name = m.group(1)
        parts.append(values.get(name, F.col(name)).cast("string"))
        pos = m.end()
    if pos < len(pattern):
        parts.append(F.lit(pattern[pos:]))
    # a year beyond the pattern gives NULL: such a partition is never ready
    return F.try_to_timestamp(F.concat(*parts), F.lit(TIMESTAMP_TEXT_FORMAT)).cast("timestamp_ntz")


def is_ready(ptime: Column, watermark: Column, commit_delay: str) -> Column:
    """``partition_time + delay < watermark``; never ready without a watermark."""
    return F.coalesce(ptime + interval(commit_delay) < watermark, F.lit(False))


def partition_readiness(
    rows: DataFrame,
    *,
    partition_cols: Sequence[str],
    pattern: str,
    event_time: Column,
    watermark_delay: str,
    commit_delay: str,
    keep: Column | None = None,
) -> DataFrame:
    """Distinct partitions of the kept ``rows`` with partition time and flag.

    The watermark is ``max(event_time) - watermark_delay`` over all rows;
    ``keep`` (default: every row) says which rows are written, and so which
    partitions exist. The source is scanned once: one aggregate per
    partition, then the maximum over that small result, whose size is
    bounded by time span / grain.
    """
    kept = F.count_if(F.coalesce(keep, F.lit(False)) if keep is not None else F.lit(True))
    parts = rows.groupBy(*partition_cols).agg(F.max(event_time).alias("__max"), kept.alias("__kept"))
    watermark = F.max("__max").over(Window.partitionBy()) - interval(watermark_delay)
    ptime = partition_time(pattern)
    return (
        parts.withColumn("__watermark", watermark)
        .where(F.col("__kept") > 0)
        .select(
            *partition_cols,
            ptime.alias("partition_time"),
            is_ready(ptime, F.col("__watermark"), commit_delay).alias("ready"),
        )
    )
