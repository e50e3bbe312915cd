"""Comma-separated metric lines: ``"<epoch ms>,<host>,<mem>"``.

Splitting follows the producer's contract: trailing empty items are
dropped, integers are plain signed digit strings (no spaces). In strict
mode a line with too few items or a non-integer number fails the job;
lenient mode yields NULL instead.

The line is split once per row in its own projection and the checks read
the resulting columns, so no regex runs more than once per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rill.functions.columns import as_col

# The separator and what counts as an integer item.
SEPARATOR = ","
INTEGER_TEXT = r"^[+-]?[0-9]+$"


def has_separator(value) -> Column:
    """Non-NULL line containing the separator (the line filter)."""
    v = as_col(value)
    return v.isNotNull() & v.contains(SEPARATOR)


def split_items(value) -> Column:
    """Split on the separator, dropping trailing empty items."""
    return F.split(F.regexp_replace(as_col(value), ",+$", ""), SEPARATOR)


def present(text, *, lenient: bool = False, what: str = "item") -> Column:
    """The item itself; strict mode fails when the line was too short."""
    t = as_col(text)
    if lenient:
        return t
    return F.when(t.isNull(), F.raise_error(F.lit(f"metric line has no {what}"))).otherwise(t)


def parse_long(text, *, lenient: bool = False, what: str = "number") -> Column:
    """Signed digit string -> BIGINT, rejecting spaces and other text.

    ``text`` should be a column reference (it is read several times).
    """
    t = as_col(text)
    ok = t.rlike(INTEGER_TEXT)
    if lenient:
        return F.when(ok, t.try_cast("bigint"))
    bad = F.raise_error(F.concat(F.lit(f"not a valid {what}: "), F.coalesce(t, F.lit("NULL"))))
    return F.when(t.isNull(), F.raise_error(F.lit(f"metric line has no {what}"))).when(
        ok, F.coalesce(t.try_cast("bigint"), bad.cast("bigint"))
    ).otherwise(bad)


def line_event_millis(value, *, lenient: bool = False) -> Column:
    """Item 0 as epoch milliseconds; 0 when the line has no separator.

    Column form for a single use; ``parse_lines`` is the staged form.
    """
    first = F.get(split_items(value), 0)
    return F.when(
        has_separator(value), parse_long(first, lenient=lenient, what="timestamp")
    ).otherwise(F.lit(0).cast("bigint"))


def parse_lines(
    lines: DataFrame, *, value_col: str = "value", lenient: bool = False,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Lines with a separator -> (host, mem, event_ms); others drop.

    Three projections: split once, pick items, validate and convert.
    """
    split = lines.where(has_separator(value_col)).select(
        *keep, split_items(value_col).alias("__items")
    )
    items = split.select(
        *keep,
        F.get("__items", 0).alias("__t0"),
        F.get("__items", 1).alias("__t1"),
        F.get("__items", 2).alias("__t2"),
    )
    return items.select(
        *keep,
        present("__t1", lenient=lenient, what="host").alias("host"),
        parse_long("__t2", lenient=lenient, what="mem").alias("mem"),
        parse_long("__t0", lenient=lenient, what="timestamp").alias("event_ms"),
    )
