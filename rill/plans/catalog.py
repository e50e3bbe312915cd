"""Catalog and DDL: databases, create-if-absent, drops, views, schemas.

Uses whatever catalog the session has: a Hive metastore on a cluster
(``enableHiveSupport`` plus the cluster's hive-site), the in-memory
catalog in tests. Tables are Parquet datasource tables; partitioned ones
track partitions in the catalog, so files written under a partition path
stay invisible to readers until the partition is added (see
``rill.streaming.commit``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession


def create_database(spark: SparkSession, name: str, *, location: str | None = None) -> None:
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{loc}")


def use_database(spark: SparkSession, name: str) -> None:
    """Switch the current database."""
    spark.catalog.setCurrentDatabase(name)


def qualified(database: str | None, table: str) -> str:
    return f"`{database}`.`{table}`" if database else f"`{table}`"


def table_exists(spark: SparkSession, table: str, database: str | None = None) -> bool:
    """Exact-name lookup in ``database`` (default: the current one)."""
    db = database or spark.catalog.currentDatabase()
    return bool(spark.catalog.tableExists(f"`{db}`.`{table}`"))


def create_if_absent(spark: SparkSession, table: str, ddl: str, database: str | None = None) -> bool:
    """Run ``ddl`` only when ``table`` is missing; True if it was created."""
    if table_exists(spark, table, database):
        return False
    spark.sql(ddl)
    return True


def drop_if_exists(spark: SparkSession, table: str, database: str | None = None) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {qualified(database, table)}")


def table_ddl(
    table: str,
    columns_ddl: str,
    *,
    database: str | None = None,
    partition_cols: Sequence[str] = (),
    properties: Mapping[str, str] | None = None,
    location: str | None = None,
    fmt: str = "parquet",
) -> str:
    """``CREATE TABLE`` text for a (partitioned) file table."""
    parts = [f"CREATE TABLE {qualified(database, table)} ({columns_ddl}) USING {fmt}"]
    if partition_cols:
        parts.append("PARTITIONED BY (" + ", ".join(f"`{c}`" for c in partition_cols) + ")")
    if location:
        parts.append(f"LOCATION '{location}'")
    if properties:
        props = ", ".join(f"'{k}' = '{v}'" for k, v in properties.items())
        parts.append(f"TBLPROPERTIES ({props})")
    return "\n".join(parts)


def table_properties(spark: SparkSession, table: str) -> dict[str, str]:
    rows = spark.sql(f"SHOW TBLPROPERTIES {table}").collect()
    return {r["key"]: r["value"] for r in rows}


def table_location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    for r in rows:
        if r["col_name"] == "Location":
            return r["data_type"]
    raise ValueError(f"table {table} has no location")


_ADD_CHUNK = 500


def partition_spec(values: Mapping[str, str | None], cols: Sequence[str]) -> str:
    quoted = ("NULL" if values[c] is None else "'" + values[c].replace("\\", "\\\\").replace("'", "\\'") + "'" for c in cols)
    return ", ".join(f"`{c}` = {v}" for c, v in zip(cols, quoted))


def add_partitions(
    spark: SparkSession, table: str, cols: Sequence[str], partitions: Sequence[Mapping[str, str | None]]
) -> None:
    """``ALTER TABLE .. ADD IF NOT EXISTS PARTITION`` for each, in chunks."""
    for i in range(0, len(partitions), _ADD_CHUNK):
        specs = " ".join(f"PARTITION ({partition_spec(p, cols)})" for p in partitions[i:i + _ADD_CHUNK])
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {specs}")


def refresh(table: str, *sessions: SparkSession | None) -> None:
    """Drop cached file lists of ``table`` in each given session."""
    for spark in sessions:
        if spark is not None:
            spark.sql(f"REFRESH TABLE {table}")


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Expose a (streaming) frame to SQL under ``name``."""
    df.createOrReplaceTempView(name)
    return df


def print_schema(df: DataFrame) -> None:
    df.printSchema()
