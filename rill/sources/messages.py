"""Topic sources: Kafka when the connector is on the classpath, files otherwise.

Both return the topic record shape with ``value`` as STRING, so parsing
code does not care where messages came from.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Start positions understood by the topic source.
EARLIEST = "earliest"
LATEST = "latest"


def kafka_options(
    bootstrap_servers: str,
    topic: str,
    *,
    group_id: str | None = None,
    starting_offsets: str = LATEST,
    fail_on_data_loss: bool = True,
    max_offsets_per_trigger: int | None = None,
) -> dict[str, str]:
    """Options for ``format('kafka')`` matching a subscribed consumer."""
    opts = {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if group_id:
        opts["kafka.group.id"] = group_id
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return opts


def as_text_records(df: DataFrame) -> DataFrame:
    """Topic records with ``value`` (and ``key``) decoded to STRING."""
    cols = []
    for name in df.columns:
        if name in ("key", "value"):
            cols.append(F.col(name).cast("string").alias(name))
        else:
            cols.append(F.col(name))
    return df.select(*cols)


def read_messages(
    spark: SparkSession,
    fmt: str = "kafka",
    *,
    stream: bool = True,
    path: str | None = None,
    schema: str | StructType | None = None,
    **options: str,
) -> DataFrame:
    """Open a topic (``fmt='kafka'``) or a folder of recorded messages.

    For file formats the files must carry a ``value`` column (e.g. text,
    or parquet written by ``rill.streaming.sinks``). A stream of files other
    than text takes the layout of the files that are there, if none is given.
    """
    if schema is None and stream and path is not None and fmt != "text":
        schema = spark.read.format(fmt).load(path).schema
    reader = spark.readStream if stream else spark.read
    reader = reader.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    reader = reader.options(**options)
    df = reader.load(path) if path is not None else reader.load()
    if "value" not in df.columns:
        raise ValueError(f"message source {fmt!r} has no 'value' column: {df.columns}")
    return as_text_records(df)
