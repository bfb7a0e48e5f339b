"""Dimensions and facts bucketed on one key, so that joins and groupings by it need no exchange.

A bucket is read by one task, so a key with very many facts would make a bucket that no machine shortens. Such keys, at most
1024 of the most frequent, have a table of their own that is not bucketed: their few dimension rows are broadcast, and their
facts are reduced on the map side before they shuffle. Beyond the 1024 hottest a key holds under a thousandth of the facts.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronograde.functions.skew import HOT_ROWS, MAX_HOT_KEYS
from chronograde.operators import history
from chronograde.sources.store import discard_at_exit, scratch_folder, stage

BUCKETS = 64


def write_bucketed(df: DataFrame, name: str, key: str, buckets: int, path: str) -> DataFrame:
    """Rows as a table of ``buckets`` buckets of ``key``, one file each, sorted by it."""
    df.repartition(buckets, key).write.format("parquet").option("path", path).bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    return df.sparkSession.table(name)


@dataclass(frozen=True)
class Copartitioned:
    """``facts`` and ``dim`` share their buckets of ``key``; ``hot_facts`` and ``hot_dim`` hold the hot keys."""

    facts: DataFrame
    dim: DataFrame
    hot_facts: DataFrame
    hot_dim: DataFrame
    names: tuple[str, ...]

    def drop(self) -> None:
        for name in self.names:
            self.facts.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")


def copartition(facts: DataFrame, dim: DataFrame, key: str = "entity_key", buckets: int = BUCKETS, hot_rows: int = HOT_ROWS) -> Copartitioned:
    """Both tables by ``key``, of which ``dim`` has one row each. Facts of unknown or null keys join nothing and are left out.

    The tables go to the shared folder and are dropped by :meth:`Copartitioned.drop` or with the driver.
    """
    spark, folder, run = facts.sparkSession, scratch_folder(facts.sparkSession), uuid.uuid4().hex
    discard_at_exit(spark, folder)
    hot = stage(
        facts.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col(key).isNotNull() & (F.col("n") > hot_rows))
        .orderBy(F.col("n").desc(), key).limit(MAX_HOT_KEYS).select(key), "hot_keys")
    names = (f"facts_{run}", f"dim_{run}")
    return Copartitioned(
        write_bucketed(facts.filter(F.col(key).isNotNull()).join(F.broadcast(hot), key, "left_anti"), names[0], key, buckets, f"{folder}/facts"),
        write_bucketed(dim, names[1], key, buckets, f"{folder}/dim"),
        stage(facts.join(F.broadcast(hot), key, "left_semi"), "hot_facts"),
        stage(dim.join(F.broadcast(hot), key, "left_semi"), "hot_dim"),
        names,
    )


def metric_history(tables: Copartitioned) -> DataFrame:
    """:func:`history.metric_history` over co-partitioned tables: only points already reduced per entity version are shuffled."""
    cold = history.version_points(tables.facts, tables.dim.hint("merge"))
    hot = history.version_points(tables.hot_facts, F.broadcast(tables.hot_dim))
    return history.newest_points(cold.unionByName(hot))
