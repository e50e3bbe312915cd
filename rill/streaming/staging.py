"""Exactly-once appends of micro-batches to file tables.

A batch is written to a staging folder of its own beside the query
checkpoint, the list of its files is recorded, and the files are moved
into the table. Whatever is retried, the batch lands once:

* before the list is recorded, a retry overwrites the staging folder;
* after it, a retry writes nothing and moves the files not yet moved;
* after the batch state is saved, the batch is skipped.

Readers of a partitioned table see a new partition only once it is in the
catalog. Moves are renames of whole partition folders where the table has
none yet, else of single files; the driver handles file names, never rows.
On an object store, where a rename copies, each file costs one copy.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from rill.operators.layout import keep_observations, keep_small_merges_parallel, rebalanced
from rill.streaming import fs

# Fixed value: folder name of a NULL partition value.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
_KEPT_STATES = 3
# On a local file system each file gets no checksum file beside it (Parquet's pages have checksums
# of their own): creating a file costs a process there. Other file systems have no such setting.
_LOCAL_WRITES = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}


class BatchLog:
    """State of a sink after each micro-batch, one file per batch id.

    The highest complete file counts. A crash while saving leaves the one
    before it in place.
    """

    def __init__(self, state_dir: str, name: str = "sink-state"):
        self.path = f"{state_dir.rstrip('/')}/{name}"

    def _ids(self, spark: SparkSession) -> list[int]:
        names = fs.list_names(spark, self.path)
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def load(self, spark: SparkSession) -> dict:
        ids = self._ids(spark)
        return json.loads(fs.read_text(spark, f"{self.path}/{ids[-1]}.json")) if ids else {"batch": None}

    def save(self, spark: SparkSession, state: dict) -> None:
        fs.write_text(spark, f"{self.path}/{state['batch']}.json", json.dumps(state))
        for old in self._ids(spark)[:-_KEPT_STATES]:
            fs.delete(spark, f"{self.path}/{old}.json")

    @staticmethod
    def done(state: dict, batch_id: int) -> bool:
        return state.get("batch") is not None and batch_id <= state["batch"]


def observed(seen: Observation) -> dict:
    """The metrics; none if the frame was known to be empty, as its plan is then optimised away."""
    return dict(seen.get) if seen._jo.getRow().length() else {}


class StagedBatch:
    """One micro-batch on its way into ``location``."""

    def __init__(self, spark: SparkSession, state_dir: str, batch_id: int, location: str):
        self.spark, self.location = spark, location.rstrip("/")
        base = f"{state_dir.rstrip('/')}/staging"
        self.folder, self.record = f"{base}/{batch_id}", f"{base}/{batch_id}.json"

    def write(
        self, df: DataFrame, partition_cols: Sequence[str], *, keep: Column | None = None,
        drop: Sequence[str] = (), measures: dict[str, Column] | None = None,
    ) -> dict:
        """Stage the batch unless its record exists; returns the record.

        ``measures`` are aggregates over all rows, also those that ``keep``
        leaves out; they are taken while the batch is written, in one pass.
        """
        known = fs.read_text(self.spark, self.record)
        if known:
            return json.loads(known)
        keep_small_merges_parallel(df.sparkSession)
        keep_observations(df.sparkSession)
        seen = Observation()
        kept = F.coalesce(keep, F.lit(False)) if keep is not None else F.lit(True)
        measured = df.observe(
            seen, F.count_if(kept).alias("__rows"), *[m.alias(n) for n, m in (measures or {}).items()]
        )
        rows = (measured.where(kept) if keep is not None else measured).drop(*drop)
        writer = rebalanced(rows, partition_cols).write.mode("overwrite").options(**_LOCAL_WRITES)
        (writer.partitionBy(*partition_cols) if partition_cols else writer).parquet(self.folder)
        values = {**dict.fromkeys(measures or {}), **observed(seen)}
        files = fs.list_files(self.spark, self.folder, len(partition_cols)) if values.pop("__rows", 0) else []
        record = {"files": files, "measures": values}
        fs.write_text(self.spark, self.record, json.dumps(record))
        return record

    def publish(self, record: dict) -> None:
        """Move the staged files that are still there.

        From the top: a folder the table has none of moves as a whole, else
        its parts do. What a crashed run has moved is not there any more.
        """
        if record["files"]:
            fs.mkdirs(self.spark, self.location)
        inside: dict[str, set[str]] = {}
        for name in record["files"]:
            steps = name.split("/")
            for n in range(1, len(steps)):
                inside.setdefault("/".join(steps[:n]), set()).add("/".join(steps[:n + 1]))
        level = sorted({name.split("/")[0] for name in record["files"]})
        while level:
            below: list[str] = []

            def move(name: str, below: list[str] = below) -> None:
                source, target = f"{self.folder}/{name}", f"{self.location}/{name}"
                if not fs.exists(self.spark, source):
                    return
                if name in inside and fs.exists(self.spark, target):
                    below.extend(inside[name])
                else:
                    fs.rename(self.spark, source, target)

            fs.in_parallel(move, level)
            level = sorted(below)

    def clean(self) -> None:
        """After the batch state is saved: what is left of the staging."""
        fs.delete(self.spark, self.folder)
        fs.delete(self.spark, self.record)


def partitions_of(files: Sequence[str]) -> list[dict[str, str | None]]:
    """Partition values of staged files, from their folder names."""
    out = []
    for folder in sorted({f.rpartition("/")[0] for f in files}):
        pairs = (step.split("=", 1) for step in folder.split("/") if step)
        out.append({unquote(c): None if v == NULL_PARTITION else unquote(v) for c, v in pairs})
    return out
