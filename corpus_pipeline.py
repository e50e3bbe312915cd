"""A corpus from ``documents``: toxic texts out, near copies to one, secrets
masked, sources mixed to target weights, texts encoded.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
it as Parquet in the shared folder and hands the table read back to the next.
All but the last keep the columns of ``documents`` and any others, whatever
their names. An empty table passes through every stage; null and empty texts
are kept as empty evidence, one row of them as of any group of equal texts, and
encode to no ids; repeated rows and rows without an id are judged by their
texts, ties between copies by id, text hash and row; texts of any length are
read whole.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from rill.llm import bpe, mixing, secrets, simhash, toxicity
from rill.llm.common import table
from rill.session import scratch_path

VOCABULARY = "byte_bpe_50k.json"
MAX_REPEATS = 2.0


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the lexicon, learned from the labels, scores below one half."""
    lexicon = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, lexicon)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each SimHash class: that of the smallest id (nulls last), then of the smallest text hash.

    Rows are told apart by a key of their own, so repeated ids and rows
    without an id are judged by their texts.
    """
    path = scratch_path(spark, "rows")
    docs.select(F.struct(*docs.columns).alias("doc"), F.monotonically_increasing_id().alias("row")).write.parquet(path)
    rows = spark.read.parquet(path)
    classes = simhash.near_duplicates(rows.select(F.col("row").alias("doc_id"), F.col("doc")["text"].alias("text"))).select(
        F.col("doc_id").alias("row"), "component_id"
    )
    field = lambda c: F.col("doc")[c]
    order = F.struct(F.isnull(field("doc_id")), field("doc_id"), F.xxhash64(field("text")), F.col("row").alias("row"))
    firsts = rows.select("row", order.alias("place")).join(classes, "row").groupBy("component_id").agg(
        F.min("place")["row"].alias("row")
    )
    return rows.join(firsts, "row", "left_semi").select(*(field(c).alias(c) for c in docs.columns))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, secrets replaced by a mark and the length brought up to date."""
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row at least once; small sources repeat, at most ``MAX_REPEATS`` passes."""
    target = mixing.Target(max_repeats=MAX_REPEATS)
    docs = mixing.numbered(docs)
    rows = mixing.reliable(mixing.compact(docs, target.seed))
    return mixing.realise(docs, mixing.plan(rows, target), target)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, ids, n_tokens) of every placed document."""
    tokens = bpe.encode(docs, public_tokenizers.path(VOCABULARY))
    return tokens.withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_copies),
    ("secrets", mask_secrets),
    ("mixing", mix_sources),
    ("bpe", encode_texts),
]

#: Lexicon fitting, components and the tokenizer have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    base = scratch_path(spark, "pipeline")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{base}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
