"""Relational dimension tables over JDBC (the URL/SLA list).

The read is a distributed scan when a numeric partition column is given;
otherwise a single connection reads the table, which is fine for a
dimension table of bounded size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The URL dimension table and its columns.
URL_SLA_TABLE = "tbl_url_sla"
URL_SLA_COLUMNS = ("url", "sla")


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    *,
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
) -> DataFrame:
    props = dict(properties or {})
    if partition_column:
        return spark.read.jdbc(
            url, table, column=partition_column, lowerBound=lower_bound,
            upperBound=upper_bound, numPartitions=num_partitions, properties=props,
        )
    return spark.read.jdbc(url, table, properties=props)


def url_dimension(df: DataFrame, *, with_sla: bool = False) -> DataFrame:
    """The tracked URL list (and optionally the SLA next to it)."""
    return df.select(*URL_SLA_COLUMNS) if with_sla else df.select("url")


def read_url_dimension(
    spark: SparkSession, url: str, properties: dict[str, str] | None = None,
    *, table: str = URL_SLA_TABLE, with_sla: bool = False, **partition: str | int | None,
) -> DataFrame:
    """``partition`` takes the split options of ``read_jdbc``."""
    return url_dimension(read_jdbc(spark, url, table, properties, **partition), with_sla=with_sla)
