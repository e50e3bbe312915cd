"""Parquet tables as batch or streaming DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rill.streaming import fs

# The table names of the test-data layout.
TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Batch read; Catalyst prunes columns and pushes filters into the scan."""
    return spark.read.parquet(table_path(sf_dir, name))


def stream_table(
    spark: SparkSession,
    sf_dir: str,
    name: str,
    *,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Streaming read of a table written as files.

    The file source needs a directory or a glob, so a single-file table is
    addressed by a one-character class glob (``event[s].parquet``). New files
    matching the glob are picked up by later micro-batches.
    """
    path = table_path(sf_dir, name)
    schema = spark.read.parquet(path).schema  # footer read only
    if fs.is_dir(spark, path):
        source = path
    else:
        source = f"{sf_dir.rstrip('/')}/{name[:-1]}[{name[-1]}].parquet"
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(source)
