"""Row placement for partitioned file writes.

Writing a partitioned table wants each partition folder written by few
tasks (few files) while no task gets a hot partition alone. The rebalance
hint asks adaptive execution for exactly that: rows are hashed on the
partition values, small shuffle partitions are merged and large ones are
split by measured size. The plan does not depend on the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

# Small merges still leave this many bytes apart, so that a batch of many
# tiny partition folders is written by all cores and not by one task.
_LEAST_MERGED = "16k"


def rebalanced(df: DataFrame, partition_cols: Sequence[str]) -> DataFrame:
    """``df`` dealt out for a write partitioned by ``partition_cols``."""
    return df.hint("rebalance", *partition_cols) if partition_cols else df.hint("rebalance")


def keep_small_merges_parallel(spark) -> None:
    """For the session of one stream: file creation, not bytes, bounds its small batches."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", _LEAST_MERGED)


# The setting and the rule that replaces a plan by an empty one once a shuffle turns out empty.
_EXCLUDED = "spark.sql.adaptive.optimizer.excludedRules"
_EMPTY_PLANS = "org.apache.spark.sql.execution.adaptive.AQEPropagateEmptyRelation"


def keep_observations(spark) -> None:
    """For the session of one stream: metrics observed below an empty shuffle are still reported.

    A batch whose rows are all filtered out, or all late, has them too.
    """
    known = [r for r in (spark.conf.get(_EXCLUDED, "") or "").split(",") if r]
    if _EMPTY_PLANS not in known:
        spark.conf.set(_EXCLUDED, ",".join([*known, _EMPTY_PLANS]))
