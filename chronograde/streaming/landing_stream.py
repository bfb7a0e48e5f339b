"""Drain a landing folder as a stream: every available file once, batch by batch, then stop."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from chronograde import fixed_values as fv
from chronograde.operators.rules import RuleSet
from chronograde.plans.warehouse import ingest
from chronograde.sources.landing import discover, discover_stream
from chronograde.sources.store import Store


def ingest_folder(
    spark: SparkSession, folder: str, store: Store, rules: RuleSet, now: datetime, anchor: str = fv.METRICS_ANCHOR,
    routed: str | None = None,
) -> int | None:
    """One run over everything in the folder; no files, no run. ``routed`` names the folder for the files by route."""
    run_id = store.manifest()["marks"].get("run_id", 0) + 1
    return ingest(store, discover(spark, folder), rules, now, run_id, anchor, routed=routed)


def drain(
    spark: SparkSession, folder: str, store: Store, rules: RuleSet, checkpoint: str,
    clock: Callable[[], datetime] = datetime.now, anchor: str = fv.METRICS_ANCHOR, files_per_batch: int = 1000,
    routed: str | None = None,
) -> StreamingQuery:
    """``availableNow`` stream into the store.

    The micro-batch number is committed together with the tables; a batch that Spark replays after a
    failure finds its number there and does nothing, so files are loaded exactly once.
    """
    def load(batch: DataFrame, batch_id: int) -> None:
        marks = store.manifest()["marks"]
        if marks.get("stream_batch", -1) >= batch_id:
            return
        ingest(store, batch, rules, clock(), marks.get("run_id", 0) + 1, anchor, {"stream_batch": batch_id}, routed)

    return (
        discover_stream(spark, folder, files_per_batch)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
