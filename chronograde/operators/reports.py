"""Reports kept up to date: each batch adds mergeable partial counts, reads fold them, and the file history is not read again.

The partial counts of a key that a batch touches are replaced by their sum with the batch's, bucket by bucket, so what is
stored grows with the keys of the report and not with the batches.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronograde.operators import audit
from chronograde.sources.store import Store, Write

_STATS = ["total_pipeline_runs", "total_files_evaluated", "success_count", "failure_count", "skipped_count"]
#: Report: its table, what its counts are kept by (the first is the bucket key), and the counts.
KEPT = {
    "uploads": ("report_uploads", ["run_id", "outcome", "execution_stage", "error_prefix"], ["file_count"]),
    "errors": ("report_errors", ["submission_id", "error_type"], ["error_per_file"]),
    "runs": ("report_runs", ["run_id"], ["total_files", "success_count", "failure_count", "skipped_count"]),
}


def partials(file_log: DataFrame, errors: DataFrame) -> dict[str, DataFrame]:
    """The partial counts of one batch of logged files and their error rows."""
    return {"uploads": audit.upload_report(file_log), "errors": audit.error_report(errors), "runs": audit.run_counts(file_log)}


def folded(rows: DataFrame, keys: Sequence[str], counts: Sequence[str]) -> DataFrame:
    """Sums of partial counts by key; null keys are keys too."""
    return rows.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in counts])


def merge_writes(store: Store, batch: dict[str, DataFrame]) -> dict[str, Write]:
    """Writes that fold a batch's partial counts into the stored ones; only the buckets of the batch's keys are read and replaced."""
    writes = {}
    for name, rows in batch.items():
        table, keys, counts = KEPT[name]
        touched = store.touched(rows, keys[0])
        if touched:
            known = store.read_open(table, touched).select(*keys, *counts)
            total = folded(known.unionByName(rows.select(*keys, *counts)), keys, counts)
            writes[table] = Write(
                total.withColumn("is_current", F.lit(True)).withColumn("key_bucket", store.bucket(keys[0])), "versioned", touched=touched)
    return writes


def kept(store: Store, name: str) -> DataFrame:
    """A kept report: ``uploads`` and ``errors`` have the columns of their recomputed forms, ``runs`` the counters of each run."""
    table, keys, counts = KEPT[name]
    return store.read_open(table).select(*keys, *counts)


def kept_stats(store: Store) -> DataFrame:
    """The upload statistics from the kept counters."""
    return audit.upload_stats(kept(store, "runs")).select(*_STATS)
