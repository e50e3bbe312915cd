"""Partitioned-write placement: the plan ignores the data, hot partitions are split."""

from pyspark.sql import functions as F

from rill.operators.layout import rebalanced


def _files(spark, df, folder, tasks, advisory):
    """Rows per (partition, file) of a partitioned write: a task writes one file to each of its partitions."""
    keys = {
        "spark.sql.shuffle.partitions": str(tasks), "spark.sql.adaptive.advisoryPartitionSizeInBytes": advisory,
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        rebalanced(df, ["p"]).write.partitionBy("p").parquet(folder)
        return spark.read.schema("v STRING, p STRING").parquet(folder).groupBy("p", F.input_file_name().alias("f")).count().collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_hot_partition_is_split_over_tasks(spark, tmp_dir):
    df = spark.range(200_000).select(
        F.when(F.col("id") % 10 > 0, F.lit("hot")).otherwise(F.concat(F.lit("p"), F.col("id") % 600)).alias("p"),
        F.sha2(F.col("id").cast("string"), 256).alias("v"),
    )
    rows = _files(spark, df, f"{tmp_dir}/t", 8, "1m")
    hot = [r["count"] for r in rows if r["p"] == "hot"]
    assert len(hot) >= 4 and sum(hot) == 180_000 and max(hot) < 90_000
    assert sum(r["count"] for r in rows) == 200_000


def test_many_equal_partitions_need_no_branch_per_key(spark, tmp_dir):
    df = spark.range(144_000).select((F.col("id") % 1440).cast("string").alias("p"), F.col("id").cast("string").alias("v"))
    plan = rebalanced(df, ["p"])._jdf.queryExecution().optimizedPlan().toString()
    assert "CASE" not in plan and len(plan) < 600
    rows = _files(spark, df.where("p < 200"), f"{tmp_dir}/t", 2000, "64k")
    assert len({r["p"] for r in rows}) == 200 and len(rows) < 2 * 200 and sum(r["count"] for r in rows) == 20_000
