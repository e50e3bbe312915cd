"""Global aggregates over a filtered relation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rill.operators.projection import keep_like


def like_sum(df: DataFrame, match_col: str, pattern: str, amount_col: str, *, alias: str) -> DataFrame:
    """``SELECT SUM(amount) FROM t WHERE match LIKE pattern`` (one row).

    Partial sums per task, one row each through the final exchange. On a
    stream this needs ``complete`` or ``update`` output mode.
    """
    return keep_like(df, match_col, pattern).agg(F.sum(amount_col).alias(alias))


def like_rows(df: DataFrame, match_col: str, pattern: str, *cols: str) -> DataFrame:
    """``SELECT cols FROM t WHERE match LIKE pattern``."""
    return keep_like(df, match_col, pattern).select(*cols)
