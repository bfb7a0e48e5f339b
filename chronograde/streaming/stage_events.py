"""Starts and finishes of pipeline stages paired by a stateful stream.

Rules, in the order of event time (ties by event id), per key:

* a start followed by a finish within ``timeout`` is a ``completed`` span with both times;
* a start followed by another start within ``timeout`` was given up for a retry (``retried``, no end);
* a start followed by nothing within ``timeout`` is ``timed out`` (no end);
* a finish that no open start precedes has its ``start missing``;
* events with the same id count once; events older than the watermark are dropped, as Spark does for every stateful operator.

Events wait in the state until the watermark has passed them, so their arrival order within ``delay`` has no effect. The state of a
key holds the events of the last ``delay`` and at most one open start. :func:`paired` is the same on a table that is
complete.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator, Sequence
from datetime import timedelta

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from chronograde.functions.timeline import Timeline

_SPAN = "started_at timestamp, completed_at timestamp, records bigint, state string"


def paired(events: DataFrame, keys: Sequence[str], timeout: timedelta, rows_per_slice: int = 1 << 16) -> DataFrame:
    """Spans of a complete table ``events(<keys>, event_id, at, is_start, records)``; a long key is sliced."""
    line = Timeline(list(keys), ["at", "event_id"], rows_per_slice)
    known = events.filter(" AND ".join(f"{c} IS NOT NULL" for c in [*keys, "event_id", "at", "is_start"])).dropDuplicates([*keys, "event_id"])
    placed = line.split(known)
    near = line.following(line.previous(placed, "_before", F.struct("at", "is_start")), "_next", F.struct("at", "is_start", "records"))
    seconds = F.lit(timeout.total_seconds()) * 1_000_000
    within = lambda early, late: F.unix_micros(late.cast("timestamp")) - F.unix_micros(early.cast("timestamp")) <= seconds
    followed = F.coalesce(within(F.col("at"), F.col("_next.at")), F.lit(False))
    answered = F.coalesce(F.col("_before.is_start") & within(F.col("_before.at"), F.col("at")), F.lit(False))
    done = followed & ~F.col("_next.is_start")
    state = F.when(done, "completed").when(followed, "retried").otherwise("timed out")
    starts = near.filter("is_start").select(
        *keys, F.col("at").alias("started_at"), F.when(done, F.col("_next.at")).alias("completed_at"),
        F.when(done, F.col("_next.records")).alias("records"), state.alias("state"))
    orphans = near.filter(~F.col("is_start") & ~answered).select(
        *keys, F.lit(None).cast("timestamp_ntz").alias("started_at") if dict(events.dtypes)["at"] == "timestamp_ntz"
        else F.lit(None).cast("timestamp").alias("started_at"),
        F.col("at").alias("completed_at"), "records", F.lit("start missing").alias("state"))
    return starts.unionByName(orphans)


def spans(events: DataFrame, key: str, timeout: timedelta, delay: str = "1 hour") -> DataFrame:
    """The stream of spans of a stream ``events(<key> bigint, event_id, at timestamp, is_start, records)``, append mode."""
    limit = int(timeout.total_seconds() * 1_000_000)

    def step(group: tuple, batches: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        pending, opened = json.loads(state.get[0]) if state.exists else ([], None)
        for batch in batches:
            if batch.empty:  # a timeout brings no rows
                continue
            at = batch["at"].astype("datetime64[us]").astype("int64")
            for when, event, is_start, n in zip(at, batch["event_id"], batch["is_start"], batch["records"]):
                pending.append([int(when), int(event), bool(is_start), None if pd.isna(n) else int(n)])
        pending.sort(key=lambda e: e[:2])
        mark = state.getCurrentWatermarkMs() * 1000
        out = []
        while pending and pending[0][0] <= mark:
            when, _, is_start, n = pending.pop(0)
            if opened is not None and when - opened > limit:
                out.append((opened, None, None, "timed out"))
                opened = None
            if is_start:
                if opened is not None:
                    out.append((opened, None, None, "retried"))
                opened = when
            else:
                out.append((opened, when, n, "completed" if opened is not None else "start missing"))
                opened = None
        if opened is not None and mark >= opened + limit:
            out.append((opened, None, None, "timed out"))
            opened = None
        wake = [*(e[0] for e in pending[:1]), *([opened + limit] if opened is not None else [])]
        if wake:
            state.update((json.dumps([pending, opened]),))
            state.setTimeoutTimestamp(max(min(wake), mark) // 1000 + 1)
        elif state.exists:
            state.remove()
        if out:
            frame = pd.DataFrame(out, columns=["started_at", "completed_at", "records", "state"])
            for c in ("started_at", "completed_at"):
                frame[c] = pd.to_datetime(frame[c].astype("Int64"), unit="us")
            frame["records"] = frame["records"].astype("Int64")
            frame.insert(0, key, group[0])
            yield frame

    known = events.filter(" AND ".join(f"{c} IS NOT NULL" for c in (key, "event_id", "at", "is_start"))).withWatermark("at", delay)
    once = known.dropDuplicatesWithinWatermark([key, "event_id"])
    return once.groupBy(key).applyInPandasWithState(
        step, f"{key} bigint, {_SPAN}", "held string", "append", GroupStateTimeout.EventTimeTimeout)
