"""Deep pages by order statistics: rows range-partitioned in page order, with the number of rows of each range.

A page is found from the counts alone, so any offset reads the one or two ranges it falls in instead of sorting all rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROWS_PER_RANGE = 1 << 16
MAX_RANGES = 4096


@dataclass(frozen=True)
class Pages:
    """Ordered rows in ``path``, one folder a range. ``counts`` holds rows by range, at most ``MAX_RANGES`` numbers."""

    spark: SparkSession
    path: str
    order: tuple[str, ...]
    schema: object
    counts: dict[int, int]

    def ranges(self, offset: int, limit: int) -> tuple[list[int], int]:
        """The ranges that hold rows ``offset`` to ``offset + limit``, and the rows before the first of them."""
        wanted, before, skipped = [], 0, None
        for part in sorted(self.counts):
            end = before + self.counts[part]
            if before < offset + limit and end > offset:
                skipped = before if skipped is None else skipped
                wanted.append(part)
            before = end
        return wanted, skipped or 0

    def page(self, offset: int, limit: int) -> DataFrame:
        """Rows of a page in order; none beyond the end."""
        if offset < 0 or limit < 0:
            raise ValueError("offset and limit must not be negative")
        wanted, skipped = self.ranges(offset, limit)
        if not wanted:
            return self.spark.createDataFrame([], self.schema)
        rows = self.spark.read.schema(self.schema).parquet(*[f"{self.path}/page_range={p}" for p in wanted])
        return rows.orderBy(*self.order).offset(offset - skipped).limit(limit)


def build(df: DataFrame, order: Sequence[str], path: str, rows_per_range: int = ROWS_PER_RANGE) -> Pages:
    """Writes rows in ranges of ``order``, whose last column should tell all rows apart.

    A name that many rows share is split by that last column. Beyond ``MAX_RANGES`` ranges each one holds more rows.
    """
    rows = df.count()
    parts = max(1, min(MAX_RANGES, -(-rows // rows_per_range)))
    placed = df.repartitionByRange(parts, *order).withColumn("page_range", F.spark_partition_id())
    placed.sortWithinPartitions("page_range", *order).write.partitionBy("page_range").parquet(path)
    counts: dict[int, int] = {}
    if rows:
        found = df.sparkSession.read.parquet(path).groupBy("page_range").agg(F.count(F.lit(1)).alias("n")).collect()
        counts = {r["page_range"]: r["n"] for r in found}
    return Pages(df.sparkSession, path, tuple(order), df.schema, counts)
