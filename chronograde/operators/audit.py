"""Run counters, file log, audit trail, routing and data-quality reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def route(outcome: Column) -> Column:
    """Successes go to the archive; failures and skipped files to the dead-letter folder."""
    return F.when(F.lower(outcome) == "success", "archive").otherwise("dlq")


def write_routed(files: DataFrame, path: str) -> None:
    """Write the files of one or more runs into one folder per route and run; a run written again replaces itself."""
    (
        files.withColumn("route", route(F.col("outcome"))).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy("run_id", "route").parquet(path)
    )


def close_events(events: DataFrame, updates: DataFrame) -> DataFrame:
    """Audit events after updates by id, which set status, record count, error and end.

    ``updates(id, execution_status, processed_records, error_message, completed_at)``: of several for one id the latest counts
    (of equal times the greatest row). Updates of unknown ids change nothing; events without an update stay as they are.
    """
    fields = ["completed_at", "execution_status", "processed_records", "error_message"]
    latest = updates.groupBy("id").agg(F.max(F.struct(*fields)).alias("_u"))
    closed = events.join(latest, "id", "left")
    return closed.select(*[
        F.when(F.col("_u").isNotNull(), F.col(f"_u.{c}")).otherwise(F.col(c)).alias(c) if c in fields else F.col(c) for c in events.columns
    ])


def run_counts(files: DataFrame) -> DataFrame:
    """Counters per run from its file outcomes (partial counts are combined on the map side)."""
    def tally(name: str) -> Column:
        return F.count_if(F.lower("outcome") == name)

    return files.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("total_files"),
        tally("success").alias("success_count"),
        tally("failure").alias("failure_count"),
        tally("skipped").alias("skipped_count"),
    )


def audit_latest(events: DataFrame, key: str, at: str, tie: str, columns: list[str]) -> DataFrame:
    """Latest event of each key."""
    latest = F.max_by(F.struct(at, tie, *columns), F.struct(at, tie))
    return events.groupBy(key).agg(latest.alias("_e")).select(key, "_e.*")


def recent_uploads(file_log: DataFrame, limit: int) -> DataFrame:
    """Newest file records first; a top-k, the file bytes stay unread."""
    return (
        file_log.select("id", "file_name", "processed_at", "outcome", "submission_id", "execution_stage", "error_message")
        .orderBy(F.col("processed_at").desc(), F.col("id").desc())
        .limit(limit)
    )


def upload_impact(file_log: DataFrame, dim_entities: DataFrame, upload_id: int | None = None) -> DataFrame:
    """File record with the entity versions its submission created (at most one per submission)."""
    files = file_log if upload_id is None else file_log.filter(F.col("id") == upload_id)
    files = files.select("id", "file_name", "processed_at", "outcome", "submission_id", "execution_stage", "error_message")
    impact = F.struct("natural_key", "entity_name", "country_of_origin", "is_current", "valid_from", "valid_to")
    created = dim_entities.groupBy("submission_id").agg(
        F.sort_array(F.collect_list(impact)).alias("impacted_snapshots")
    )
    return files.join(created, "submission_id", "left").withColumn(
        "impacted_snapshots", F.coalesce("impacted_snapshots", F.array().cast(created.schema["impacted_snapshots"].dataType))
    )


def upload_stats(runs: DataFrame) -> DataFrame:
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return runs.agg(
        F.count("run_id").alias("total_pipeline_runs"),
        total("total_files").alias("total_files_evaluated"),
        total("success_count").alias("success_count"),
        total("failure_count").alias("failure_count"),
        total("skipped_count").alias("skipped_count"),
    )


def file_content(file_log: DataFrame, contents: DataFrame, upload_id: int | None = None) -> DataFrame:
    """Stored bytes of an upload; no row, null or empty content all count as missing."""
    rows = file_log if upload_id is None else file_log.filter(F.col("id") == upload_id)
    stored = contents.select("run_id", "path", F.col("content").alias("file_content"))
    found = rows.select("id", "file_name", "run_id", "path").join(stored, ["run_id", "path"]).drop("run_id", "path")
    return found.filter(F.length("file_content") > 0)


def upload_report(file_log: DataFrame) -> DataFrame:
    """Files per run, outcome, stage and start of the error text."""
    return file_log.groupBy(
        "run_id", "outcome", "execution_stage", F.substring("error_message", 1, 10).alias("error_prefix")
    ).agg(F.count(F.lit(1)).alias("file_count"))


def error_report(errors: DataFrame) -> DataFrame:
    """Errors per submission and kind, most frequent first."""
    return (
        errors.groupBy("submission_id", F.substring("error_message", 1, 15).alias("error_type"))
        .agg(F.count(F.lit(1)).alias("error_per_file"))
        .orderBy(F.col("error_per_file").desc(), "submission_id", "error_type")
    )
