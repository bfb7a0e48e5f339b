"""Join to a one-row-per-key table when a few keys hold most of the left side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_ROWS = 1_000_000
MAX_HOT_KEYS = 1024
SALTS = 64


def salted_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    key_rows: str,
    spread_by: Sequence[str],
    how: str = "left",
    hot_rows: int = HOT_ROWS,
    broadcast: bool = True,
) -> DataFrame:
    """Join ``left`` to ``right`` (unique on ``keys``) with hot keys spread over ``SALTS`` tasks.

    ``right.<key_rows>`` is the number of left rows of the key. At most ``MAX_HOT_KEYS`` keys, the most
    frequent ones above ``hot_rows``, are salted: their right rows are repeated per salt, their left
    rows take a salt from a hash of ``spread_by``. Every other key keeps salt 0, and beyond the 1024
    hottest a key holds under a thousandth of the rows. The hot list has a fixed bound, so it is broadcast.

    ``broadcast=False`` keeps ``right`` itself from being broadcast. The optimizer judges a table that was written and read
    back by its file, which says little where values repeat: a megabyte of it may be a million rows on the driver.
    """
    keys = list(keys)
    hot = (
        right.filter(F.col(key_rows) > hot_rows)
        .select(*keys, key_rows)
        .orderBy(F.col(key_rows).desc(), *keys)
        .limit(MAX_HOT_KEYS)
        .select(*keys, F.lit(True).alias("_hot"))
    )
    salt = F.when(F.col("_hot"), F.pmod(F.xxhash64(*spread_by), F.lit(SALTS))).otherwise(F.lit(0))
    all_salts = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    spread = left.join(F.broadcast(hot), keys, "left").withColumn("_salt", salt.cast("int")).drop("_hot")
    copies = right.join(F.broadcast(hot), keys, "left").withColumn("_salt", F.explode(all_salts)).drop("_hot")
    if not broadcast:
        copies = copies.hint("merge")
    return spread.join(copies, [*keys, "_salt"], how).drop("_salt")
