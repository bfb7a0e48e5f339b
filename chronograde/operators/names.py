"""Case-insensitive name patterns (``%x%``, ``a_c%``) through a table of trigram postings.

Every distinct name lies once under each of its trigrams, and once under the empty gram, which lists all names. A pattern's literal
runs of three and more characters give trigrams that any match must have. The names that have the rarest of them are the
candidates; the pattern itself then decides. A pattern without such a run goes through the empty gram, so every pattern has a whole result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronograde.functions.text import trimmed
from chronograde.sources.store import Store, Write, stage

GRAM = 3
#: Posting lists that are intersected, the shortest ones; more would only read more.
LISTS = 4
#: Names that are pushed into a scan as a list of values; more names are joined.
IN_LIST = 1000


def postings(names: DataFrame, column: str = "natural_key") -> DataFrame:
    """``gram``, ``name``: distinct; grams are taken from the trimmed lower-case name. Null names have none."""
    text = F.lower(trimmed(F.col("name")))
    starts = F.when(F.length(text) >= GRAM, F.sequence(F.lit(1), F.length(text) - (GRAM - 1))).otherwise(F.array().cast("array<int>"))
    grams = F.transform(starts, lambda i: F.substring(text, i, F.lit(GRAM)))
    distinct = names.select(F.col(column).alias("name")).filter("name IS NOT NULL").distinct()
    return distinct.select("name", F.explode(F.array_union(F.array(F.lit("")), grams)).alias("gram")).select("gram", "name")


def pattern_grams(spark: SparkSession, pattern: str) -> list[str]:
    """The trigrams every match of a pattern has; the empty gram if its literal runs are too short."""
    lowered = spark.range(1).select(F.lower(F.lit(pattern))).first()[0]  # as Spark folds it, not as Python does
    runs, run, escaped = [], "", False
    for c in lowered:
        if escaped or c not in "%_\\":
            run, escaped = run + c, False
        elif c == "\\":
            escaped = True
        else:
            runs, run = [*runs, run], ""
    return sorted({r[i:i + GRAM] for r in [*runs, run] for i in range(len(r) - GRAM + 1)}) or [""]


def index_writes(store: Store, new_names: DataFrame, column: str = "natural_key") -> dict[str, Write]:
    """Writes that add names to the index. Names that are in it already must not come again."""
    rows = postings(new_names, column)
    counts = rows.groupBy("gram").agg(F.count(F.lit(1)).alias("names"))
    return {"name_grams": Write(rows.withColumn("key_bucket", store.bucket("gram")), "keyed"),
            "gram_counts": Write(counts.withColumn("key_bucket", store.bucket("gram")), "keyed")}


def candidates(store: Store, grams: list[str]) -> DataFrame:
    """``name``: the stored names that have the rarest of the grams. Reads only these grams' buckets."""
    asked = store.spark.createDataFrame([(g,) for g in grams], "gram string")
    sizes = store.read_open("gram_counts", store.touched(asked, "gram")).filter(F.col("gram").isin(grams))
    held = {r["gram"]: r["names"] for r in sizes.groupBy("gram").agg(F.sum("names").alias("names")).collect()}
    if len(held) < len(grams):  # a gram that no name has
        return store.spark.createDataFrame([], "name string")
    rare = sorted(grams, key=lambda g: (held[g], g))[:LISTS]
    buckets = store.touched(asked.filter(F.col("gram").isin(rare)), "gram")
    hits = store.read_open("name_grams", buckets).filter(F.col("gram").isin(rare))
    return hits.groupBy("name").agg(F.count_distinct("gram").alias("n")).filter(F.col("n") == len(rare)).select("name")


def matching(store: Store, pattern: str) -> DataFrame:
    """``name``: stored names that match a case-insensitive pattern after trimming, as the history queries compare them."""
    wanted = pattern.strip()
    return candidates(store, pattern_grams(store.spark, wanted)).filter(F.ilike(trimmed(F.col("name")), F.lit(wanted)))


def versions(store: Store, pattern: str, table: str = "dim_entities") -> DataFrame:
    """All versions of the entities whose natural key matches.

    Open rows are read in the matching names' buckets only; closed rows, which have no buckets, by names pushed into the scan,
    whose Bloom filters skip files. The names are collected only up to ``IN_LIST``; beyond it they are joined.
    """
    names = stage(matching(store, pattern).withColumnRenamed("name", "natural_key"), "names")
    some = [r[0] for r in names.limit(IN_LIST + 1).collect()]
    touched = store.touched(names, "natural_key")
    rows = store.read_open(table, touched).unionByName(store.read(table).filter("NOT is_current"))
    if len(some) <= IN_LIST:
        return rows.filter(F.col("natural_key").isin(some))
    return rows.join(names, "natural_key", "left_semi").select(rows.columns)
