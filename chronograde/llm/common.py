"""Table reading, staging and connected components shared by the operators of this package."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronograde.session import shared_folder
from chronograde.sources.store import discard, discard_at_exit, setting, shuffles_end_with_the_write


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stage(spark: SparkSession, df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """Writes a result that several branches read to the shared folder and reads it back.

    A lost executor then costs a re-read, not a recomputation, and columns are pruned on the way back. The folder goes when it
    is released or the driver ends.
    """
    path = f"{shared_folder(spark)}/llm-{re.sub(r'[^A-Za-z0-9_]', '_', name)}-{uuid.uuid4().hex}"
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    with shuffles_end_with_the_write(spark):
        writer.parquet(path)
    discard_at_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def release(*staged: DataFrame) -> None:
    """Deletes the folders of staged results that nothing will read again."""
    for df in staged:
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            discard(df.sparkSession, folder)


@contextmanager
def by_word(spark: SparkSession, df: DataFrame, key: str = "word") -> Iterator[DataFrame]:
    """Rows as a table in buckets of ``key``, dropped in the end: groupings and joins by the key need no further shuffle.

    Neither do joins by the key and further columns, whose other side is dealt by the key alone. A task writes one bucket, so rows
    need no order; hashes and ids are too different for a dictionary.
    """
    name, n = f"llm_{key}_{uuid.uuid4().hex}", int(spark.conf.get("spark.sql.shuffle.partitions"))
    try:
        with shuffles_end_with_the_write(spark), setting(spark, "spark.sql.maxConcurrentOutputFileWriters", "2", "0"):
            df.repartition(n, key).write.format("parquet").option("parquet.enable.dictionary", "false").bucketBy(n, key).saveAsTable(name)
        with setting(spark, "spark.sql.requireAllClusterKeysForCoPartition", "false", "true"):
            yield spark.table(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def components(spark: SparkSession, edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of an undirected graph given as columns ``a``, ``b`` (bigint).

    Alternates large-star and small-star steps until the edge set no longer changes; then every edge points
    from a node to the smallest node of its component. Both steps are a minimum per node (combined before the
    shuffle) and a join with it, so a hub is never gathered in one group. Returns ``node``, ``root`` for every
    node that is not itself a root. Each round is written to the shared folder, which cuts the lineage.
    """
    e = stage(spark, edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
              .where("u <> v").distinct(), "edges")
    seen = None
    for _ in range(max_rounds):
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        large = stage(spark, large, "large_star")
        before = e
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(low.select("u", F.col("m").alias("v"))).distinct())
        e = stage(spark, small, "small_star")
        release(before, large)
        now = tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == seen:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
