"""Keyed upserts: the changed groups of an update-mode stream.

An update-mode micro-batch carries the groups that changed, with their new
values. Each batch is written to a folder of its own under its batch id, and a
reader takes each key's newest batch. Every ``compact_every`` batches the
newest rows are rewritten as one base folder, so that a read costs the keys
plus the changes of a few batches.

The batch log names the base and the batches on top of it. It is saved after
the folders are complete, by one rename, so a reader sees a batch whole or not
at all, a compaction as no change, and a retried batch overwrites what it had
left. Folders replaced by a compaction stay until the next one, so a reader
that started before it can finish. No row passes through the driver.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rill.streaming import fs
from rill.streaming.staging import BatchLog

# Name of the column that holds a row's micro-batch.
BATCH = "__batch"


class UpsertSink:
    """foreachBatch for update (or complete) output: the newest row of each key.

    ``key_cols`` are the grouping columns; a global aggregate has none and
    keeps one row. NULL keys are keys.
    """

    def __init__(self, path: str, key_cols: Sequence[str] = (), *, compact_every: int = 16):
        if compact_every < 1:
            raise ValueError("compact_every must be at least 1")
        self.path, self.key_cols, self.compact_every = path.rstrip("/"), list(key_cols), compact_every
        self.log = BatchLog(self.path, "_log")

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        spark = batch_df.sparkSession
        state = self.log.load(spark)
        if BatchLog.done(state, batch_id):
            self._sweep(spark, state)
            return
        rows = batch_df.withColumn(BATCH, F.lit(batch_id).cast("long"))
        rows.write.mode("overwrite").parquet(f"{self.path}/changes/{batch_id}")
        new = {
            "batch": batch_id, "keys": self.key_cols, "schema": rows.schema.json(),
            "base": state.get("base"), "changes": [*state.get("changes", []), batch_id], "old": state.get("old", []),
        }
        if len(new["changes"]) >= self.compact_every:
            _newest(spark, self.path, new).write.mode("overwrite").parquet(f"{self.path}/base/{batch_id}")
            new |= {"base": batch_id, "changes": [], "old": _folders(new)}
        self.log.save(spark, new)
        self._sweep(spark, new)

    def _sweep(self, spark: SparkSession, state: dict) -> None:
        """Delete the folders that no reader of this or the last compaction can need."""
        needed = {*_folders(state), *state["old"]}
        for kind in ("changes", "base"):
            for name in fs.list_names(spark, f"{self.path}/{kind}"):
                if f"{kind}/{name}" not in needed:
                    fs.delete(spark, f"{self.path}/{kind}/{name}")


def _folders(state: dict) -> list[str]:
    """The folders that make up the current rows."""
    return [f"changes/{b}" for b in state["changes"]] + ([] if state["base"] is None else [f"base/{state['base']}"])


def _newest(spark: SparkSession, path: str, state: dict) -> DataFrame:
    """Each key's row of its newest batch: partial maxima per task, one shuffle on the keys."""
    schema = StructType.fromJson(json.loads(state["schema"]))
    rows = spark.read.schema(schema).parquet(*[f"{path}/{f}" for f in _folders(state)])
    keys = state["keys"]
    values = [c for c in rows.columns if c not in keys]
    last = F.max_by(F.struct(*values), BATCH).alias("__last")
    newest = rows.groupBy(*keys).agg(last) if keys else rows.agg(last).where(F.col("__last").isNotNull())
    return newest.select(*[F.col(c) if c in keys else F.col("__last")[c].alias(c) for c in rows.columns])


def read_upserts(spark: SparkSession, path: str) -> DataFrame:
    """The current rows of an upsert folder: one per key, as of its last whole batch."""
    state = BatchLog(path, "_log").load(spark)
    if state["batch"] is None:
        raise FileNotFoundError(f"no batch has been written to {path}")
    return _newest(spark, path.rstrip("/"), state).drop(BATCH)
