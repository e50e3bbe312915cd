"""The registered queries: each operator over its whole table, and the digest columns of its contract."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from rill.llm import alignment, bpe, clusters, licences, mainpaths, mixing, quality, secrets, segments, simhash, subwords, tokenfiles, toxicity
from rill.llm.common import table
from rill.session import scratch_path

BYTE_BPE = "byte_bpe_50k.json"
WORD_BPE = "word_bpe_49k.json"
PIECES = "piece_bpe_32k.model"


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.judge(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every placed document with its source's weight; repetition at most two."""
    target = mixing.Target(max_repeats=2.0)
    rows = mixing.reliable(mixing.compact(table(spark, sf_dir, "documents"), target.seed))
    sources = mixing.plan(rows, target)
    return mixing.place(rows, sources, target)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    lexicon = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, lexicon)
    return scored.select(
        "doc_id", F.coalesce(toxicity.remainder(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_hits",
    )


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


def op6_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan_licences(table(spark, sf_dir, "documents"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE))


def op8_mainpaths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mainpaths.main_texts(table(spark, sf_dir, "pages"))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", count("assign"), count("access"), count("hex"),
        F.sha2(secrets.joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        secrets.joined(F.col("spans")).alias("spans"),
    )


def op10_tokenfiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written to the shared folder, then read back through each shard's index."""
    folder = scratch_path(spark, "tokens")
    manifest = tokenfiles.write(table(spark, sf_dir, "documents"), folder, public_tokenizers.path(WORD_BPE))
    return tokenfiles.read(manifest, folder, tokenfiles.crc32).withColumnRenamed("value", "ids_crc32")


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.summaries(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE), public_tokenizers.path(PIECES))


def op12_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    centroids = clusters.fit(vectors, k=8, rounds=10, dims=64, scale=1024, seed="3")
    return clusters.with_inertia(clusters.label(vectors, centroids), centroids)


def op13_subwords(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = lambda i: F.crc32(i.cast("string").cast("binary")) % 3 == 1
    model = subwords.fit(docs, table(spark, sf_dir, "labels"), use=~held_out(F.col("doc_id")))
    return subwords.scores(docs, model).select(
        "doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_features",
    )


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_quality": op1_quality,
    "op2_simhash": op2_simhash,
    "op3_mixing": op3_mixing,
    "op4_toxicity": op4_toxicity,
    "op5_topk": op5_topk,
    "op6_licences": op6_licences,
    "op7_bpe": op7_bpe,
    "op8_mainpaths": op8_mainpaths,
    "op9_secrets": op9_secrets,
    "op10_tokenfiles": op10_tokenfiles,
    "op11_alignment": op11_alignment,
    "op12_clusters": op12_clusters,
    "op13_subwords": op13_subwords,
    "pipeline": pipeline,
}


def clusters_sql(k: int = 8, rounds: int = 10, dims: int = 64, scale: int = 1024, seed: str = "3") -> str:
    """Each round as one table of centroids, every vector compared with all of them."""
    parts = [f"""
        v AS MATERIALIZED (
            SELECT vec_id, row_number() OVER () AS row_no, [CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS x
            FROM embeddings
            WHERE len(embedding) = {dims} AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
        ), c0 AS MATERIALIZED (
            SELECT CAST(row_number() OVER (ORDER BY h, x) - 1 AS INTEGER) AS c, x
            FROM (SELECT sha256('{seed}:' || vec_id) AS h, x FROM v WHERE vec_id IS NOT NULL) ORDER BY h, x LIMIT {k}
        )"""]
    for r in range(rounds + 1):
        parts.append(f"""a{r} AS MATERIALIZED (
            SELECT row_no, min({{'d': d, 'c': c}}) AS best FROM (
                SELECT row_no, c, list_sum(list_transform(list_zip(v.x, c{r}.x), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::HUGEINT AS d FROM v, c{r}
            ) GROUP BY row_no
        )""")
        if r < rounds:
            parts.append(f"""c{r + 1} AS MATERIALIZED (
                SELECT c{r}.c, coalesce(m.x, c{r}.x) AS x FROM c{r} LEFT JOIN (
                    SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS x FROM (
                        SELECT c, i, sum(x) AS s, count(*) AS n FROM (
                            SELECT a{r}.best.c AS c, unnest(v.x) AS x, generate_subscripts(v.x, 1) AS i FROM a{r} JOIN v USING (row_no)
                        ) GROUP BY c, i
                    ) GROUP BY c
                ) m ON m.c = c{r}.c
            )""")
    last = rounds
    return f"""WITH {", ".join(parts)}
        SELECT v.vec_id, a{last}.best.c AS cluster, CAST(a{last}.best.d AS BIGINT) AS distance,
            CAST(sum(a{last}.best.d) OVER (PARTITION BY a{last}.best.c) AS BIGINT) AS cluster_inertia,
            CAST(sum(a{last}.best.d) OVER () AS BIGINT) AS inertia,
            sha256(array_to_string(f.x, ',')) AS centroid_sha256
        FROM a{last} JOIN v USING (row_no) JOIN c{last} f ON f.c = a{last}.best.c
    """


#: SQL of the queries that it can express; the others are tested against brute force.
ORACLE: dict[str, str] = {
    "op5_topk": """
        WITH v AS (
            SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS HUGEINT) FOR x IN embedding] AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
        ), pairs AS (
            SELECT q.vec_id AS query_id, c.vec_id AS vec_id, 
                CAST(coalesce(list_sum([p[1] * p[2] FOR p IN list_zip(q.v, c.v)]), 0) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
        ), ranked AS (
            SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM pairs
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
    """,
    "op12_clusters": clusters_sql(),
}
