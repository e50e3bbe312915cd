"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from rill.session import shared_dir

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

#: Rows turned into Python objects at a time, so that a task's memory is
#: bounded by a slice of an Arrow batch and its largest text.
SLICE_ROWS = 128


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, through Spark's reader only."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def let_workers_import(spark: SparkSession) -> None:
    """Python workers of a local session find this package wherever the driver was started.

    On a cluster the package is installed or sent with ``--py-files``.
    """
    context = spark.sparkContext
    if context.master.startswith("local"):
        known = [p for p in context.environment.get("PYTHONPATH", "").split(os.pathsep) if p]
        if ROOT not in known:
            context.environment["PYTHONPATH"] = os.pathsep.join([*known, ROOT])


def reliable(df: DataFrame) -> DataFrame:
    """Cut lineage with a checkpoint in the cluster's shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def map_rows(
    df: DataFrame,
    make: Callable[[], Callable[..., list[tuple]]],
    schema: T.StructType,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Apply a slice function inside tasks: columns as lists in, rows out.

    ``make()`` runs once per task and returns ``f(*columns) -> rows``. Slices
    of ``slice_rows`` rows keep only a few texts as Python objects at once.
    """
    arrow = to_arrow_schema(schema)
    let_workers_import(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = make()
        for batch in batches:
            for at in range(0, batch.num_rows, slice_rows):
                part = batch.slice(at, slice_rows)
                rows = f(*(column.to_pylist() for column in part.columns))
                if rows:
                    columns = [pa.array(c, type=x.type) for c, x in zip(zip(*rows), arrow)]
                    yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return df.mapInArrow(run, schema)


def schema(text: str) -> T.StructType:
    """A StructType from a DDL string, without a session."""
    out = T.StructType()
    kinds = {
        "long": T.LongType(), "int": T.IntegerType(), "string": T.StringType(),
        "double": T.DoubleType(), "boolean": T.BooleanType(), "binary": T.BinaryType(),
        "longs": T.ArrayType(T.LongType()), "ints": T.ArrayType(T.IntegerType()),
        "doubles": T.ArrayType(T.DoubleType()),
    }
    for item in text.split(","):
        name, kind = item.split()
        out = out.add(name, kinds[kind])
    return out


class _Filling(dict):
    """Hands out an empty buffer for each unknown word and remembers it."""

    def __init__(self):
        self.fresh: dict[str, bytearray] = {}

    def __missing__(self, word: str) -> bytearray:
        place = self[word] = self.fresh[word] = bytearray()
        return place


class WordCache:
    """Word -> bytes, made by ``make(words)`` for the words not seen before.

    One look-up per occurrence: an unknown word yields a buffer that is
    filled once all new words of the slice are made together. The cache
    starts afresh beyond ``limit`` words and keeps none above ``longest``
    letters, so memory stays bounded by the limit and one slice; frequent
    words come back at once.
    """

    def __init__(self, limit: int, make: Callable[[list[str]], dict[str, bytes]], longest: int = 64):
        self.limit, self.make, self.longest = limit, make, longest
        self.known = _Filling()

    def values(self, lists: list[list[str]]) -> list[list[bytes | bytearray]]:
        """The values of all words of ``lists``, in place."""
        known = self.known
        if len(known) > self.limit:
            known.clear()
        get = known.__getitem__
        out = [list(map(get, words)) for words in lists]
        fresh = known.fresh
        if fresh:
            for word, value in self.make(list(fresh)).items():
                fresh[word][:] = value  # what the lists above hold
                known[word] = value
            for word in fresh:
                if len(word) > self.longest:
                    del known[word]
            fresh.clear()
        return out
