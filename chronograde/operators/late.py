"""Submissions that arrive after later ones were loaded.

A late row that falls inside a version splits it, and versions after it may change hands: a row that repeated the version
before it may now differ from the late row in between. Closed versions alone cannot tell where, so the narrow observations (key,
time, id, hash, attributes) are kept next to them. A patch touches, of the late rows' keys only, the version that holds the first late
row and what follows it. The result equals loading all rows in order, whatever order they came in, and a batch that is patched in
twice changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronograde.functions.skew import HOT_ROWS, salted_join
from chronograde.functions.timeline import Timeline
from chronograde.operators.scd2 import scd2_history

VALIDITY = ["valid_from", "valid_to", "is_current"]


def observe(observations: DataFrame, late: DataFrame, keys: Sequence[str], id_column: str) -> DataFrame:
    """Observations after a batch: rows whose id the key already has are not added again."""
    fresh = late.dropDuplicates([*keys, id_column]).join(observations.select(*keys, id_column), [*keys, id_column], "left_anti")
    return observations.unionByName(fresh.select(*observations.columns))


def patch_versions(
    versions: DataFrame, observations: DataFrame, late: DataFrame, keys: Sequence[str], hash_column: str, at: str, id_column: str,
    rows_per_slice: int = Timeline(["k"], ["o"]).rows_per_slice, hot_rows: int = HOT_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """Versions that stay as they are, and the patched ones that take the place of all others.

    ``versions`` is a :func:`scd2.scd2_history` of ``observations`` by ``keys`` in the order ``at, id_column`` (unique within a
    key); ``late`` has the columns of ``observations``. Rows of ``late`` with a null key or time are left out, as in a load.
    """
    keys, columns = list(keys), list(observations.columns)
    place, order = F.struct(at, id_column), [at, id_column]
    valid = late.filter(" AND ".join(f"{c} IS NOT NULL" for c in [*keys, at])).select(*columns)
    first = valid.groupBy(*keys).agg(F.min(place).alias("_first"))

    # of each touched key, the version that holds the first late row and all later ones are open to change
    with_first = versions.join(first, keys, "left")
    version_place = F.struct(F.col("valid_from").alias(at), F.col(id_column))
    before = F.col("_first").isNotNull() & (version_place < F.col("_first"))
    sizes = versions.join(first, keys, "left_semi").groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    holders = with_first.filter(before).groupBy(*keys).agg(F.max(version_place).alias("_holder"))
    limits = first.join(holders, keys, "left").join(sizes, keys, "left").withColumn("_n", F.coalesce("_n", F.lit(0)))
    marked = salted_join(versions, limits, keys, "_n", [id_column], "left", hot_rows)
    stays = F.col("_first").isNull() | F.coalesce(version_place < F.col("_holder"), F.lit(False))
    kept = marked.filter(stays).select(*versions.columns)
    seeds = marked.filter(F.col("_holder") == version_place).withColumn(at, F.col("valid_from")).select(*columns)

    counts = observations.join(first, keys, "left_semi").groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    later = salted_join(observations, first.join(counts, keys), keys, "_n", [id_column], "inner", hot_rows).filter(place > F.col("_first"))
    rows = observe(later.select(*columns), valid, keys, id_column)
    rows = rows.join(seeds.select(*keys, id_column), [*keys, id_column], "left_anti").select(*columns).unionByName(seeds)
    patched = scd2_history(rows, keys, hash_column, order, at, rows_per_slice)
    return kept, patched.select(*versions.columns)
