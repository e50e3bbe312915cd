"""Projection, positional insert, and row filters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def select_all(df: DataFrame) -> DataFrame:
    """``SELECT *`` from a stream or table."""
    return df.select("*")


def target_schema(ddl: str) -> StructType:
    return StructType.fromDDL(ddl)


def insert_by_position(df: DataFrame, target: str | StructType) -> DataFrame:
    """Match columns to a target layout (DDL or schema) by position, as ``INSERT INTO`` does.

    The i-th input column becomes the i-th target column (name and type),
    whatever its own name was.
    """
    target = target_schema(target) if isinstance(target, str) else target
    if len(df.columns) != len(target.fields):
        raise ValueError(
            f"insert needs {len(target.fields)} columns, got {len(df.columns)}: {df.columns}"
        )
    cols = [
        F.col(f"`{src}`").cast(field.dataType).alias(field.name)
        for src, field in zip(df.columns, target.fields)
    ]
    return df.select(*cols)


def keep_positive(df: DataFrame, column: str) -> DataFrame:
    """``WHERE column > 0``; NULLs do not pass."""
    return df.where(F.col(column) > 0)


def keep_like(df: DataFrame, column: str, pattern: str) -> DataFrame:
    """``WHERE column LIKE pattern``."""
    return df.where(F.col(column).like(pattern))
