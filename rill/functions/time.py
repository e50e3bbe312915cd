"""Event-time derivation and partition-value formatting.

Event times are zone-less (TIMESTAMP_NTZ) in batch form; the streaming
path casts to TIMESTAMP because ``withWatermark`` needs it. All casts
between the two run under the UTC session zone (see ``rill.session``).
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from rill.functions.columns import as_col
from rill.schemas import TIMESTAMP_TEXT_FORMAT

# Partition value formats (date, hour, minute).
DATE_FORMAT = "yyyy-MM-dd"
HOUR_FORMAT = "HH"
MINUTE_FORMAT = "mm"


def from_text(value, fmt: str = TIMESTAMP_TEXT_FORMAT, *, lenient: bool = False) -> Column:
    """Text -> zone-less timestamp. Strict fails on unparseable text."""
    v = as_col(value)
    parsed = F.try_to_timestamp(v, F.lit(fmt)).cast("timestamp_ntz")
    if lenient:
        return parsed
    # the text is parsed once; only a NULL result looks at it again
    bad = F.raise_error(F.concat(F.lit("unparseable event time: "), v)).cast("timestamp_ntz")
    return F.coalesce(parsed, F.when(v.isNotNull(), bad))


def epoch_millis_to_seconds(value) -> Column:
    """Epoch milliseconds -> zone-less timestamp truncated to the second.

    Integral division (toward zero) first, as the declared column does.
    """
    return F.timestamp_seconds(int_div(as_col(value).cast("bigint"), 1000)).cast("timestamp_ntz")


def int_div(col, n: int) -> Column:
    """``col div n``: integral division truncating toward zero."""
    return F.call_function("div", as_col(col), F.lit(n))


def epoch_millis(ts) -> Column:
    """Zone-less or zoned timestamp -> epoch milliseconds (floored)."""
    return F.unix_millis(as_col(ts).cast("timestamp"))


def millis_to_timestamp(ms) -> Column:
    """Epoch milliseconds -> zone-less timestamp with millisecond precision."""
    return F.timestamp_millis(as_col(ms)).cast("timestamp_ntz")


def partition_values(ts) -> tuple[Column, Column, Column]:
    """(date, hour, minute) partition strings of a timestamp."""
    t = as_col(ts)
    return (
        F.date_format(t, DATE_FORMAT),
        F.date_format(t, HOUR_FORMAT),
        F.date_format(t, MINUTE_FORMAT),
    )


def to_stream_time(ts) -> Column:
    """Zone-less -> TIMESTAMP, the type a watermark column must have."""
    return as_col(ts).cast("timestamp")


def to_table_time(ts) -> Column:
    """TIMESTAMP -> zone-less, the type of event times at rest."""
    return as_col(ts).cast("timestamp_ntz")


def processing_time() -> Column:
    """Processing-time column: the micro-batch (or query) start time.

    Constant within a micro-batch; results that use it are not repeatable,
    so it stays out of checked outputs.
    """
    return F.current_timestamp()


# Duration units accepted in delays and window sizes.
_UNITS = {
    "ms": 0.001, "millisecond": 0.001, "milliseconds": 0.001,
    "s": 1, "sec": 1, "second": 1, "seconds": 1,
    "min": 60, "minute": 60, "minutes": 60,
    "h": 3600, "hour": 3600, "hours": 3600,
    "d": 86400, "day": 86400, "days": 86400,
}


def parse_duration(text: str) -> dt.timedelta:
    """'1 min' / '1 h' / '15 seconds' -> timedelta."""
    m = re.fullmatch(r"\s*(\d+(?:\.\d+)?)\s*([A-Za-z]+)\s*", text)
    if not m or m.group(2).lower() not in _UNITS:
        raise ValueError(f"unsupported duration: {text!r}")
    return dt.timedelta(seconds=float(m.group(1)) * _UNITS[m.group(2).lower()])


def interval(text: str) -> Column:
    """'1 min' / '1 h' / '15 seconds' -> a day-time interval literal."""
    return F.expr(f"INTERVAL '{parse_duration(text).total_seconds():.6f}' SECOND")
