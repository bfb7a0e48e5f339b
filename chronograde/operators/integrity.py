"""Constraint checks; each returns the violating keys, so an empty result means the constraint holds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).filter(F.col("row_count") > 1)


def repeated_current(dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys with more than one current row."""
    return repeated_keys(dim.filter("is_current"), keys)


def among(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key is one of the given keys."""
    return df.join(keys.select(key).distinct(), key, "left_semi")


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose parent key does not exist."""
    return child.join(parent.select(key), key, "left_anti")


def cascade_delete(child: DataFrame, deleted: DataFrame, key: str) -> DataFrame:
    """Child rows that stay when the given parents are deleted."""
    return child.join(deleted.select(key).distinct(), key, "left_anti")
