"""Catalogue of what keeps a loaded warehouse up to date: merges, checks and lookups that touch only a batch's keys, late
submissions, stage times, and grids that span tasks. Registers its queries with :mod:`catalog`."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from chronograde import fixed_values as fv
from chronograde.operators import audit, dedupe, integrity, late, scd2, sheets
from chronograde.plans import warehouse
from chronograde.plans.catalog import _CUT, _landed, _rows, _subs_hashed, query
from chronograde.plans.views_sql import with_views
from chronograde.sources import fixtures as fx
from chronograde.sources.store import Store, Write, discard, discard_at_exit, scratch_folder, stage
from chronograde.streaming import stage_events


def _new_store(spark) -> Store:
    return Store(spark, scratch_folder(spark))


# === merges that touch a batch's keys ============================================================


def _merged_store(spark, d) -> Store:
    """A store that got the submissions before a date in one commit and the others in a second one."""
    store, scratch = _new_store(spark), scratch_folder(spark)
    discard_at_exit(spark, scratch)
    rows = stage(_rows(spark, d), "rows", scratch)
    cut = F.lit(_CUT).cast("timestamp_ntz")
    for batch in (rows.filter(F.col("submitted_at") < cut), rows.filter(F.col("submitted_at") >= cut)):
        touched = store.touched(batch.filter("natural_key IS NOT NULL"), "natural_key")
        keep = lambda df, name: stage(df, name, f"{scratch}/batch")
        store.commit(warehouse.merge_touched(store, batch, touched, keep) if touched else {})
        discard(spark, f"{scratch}/batch")  # the commit has written all that derives from it
    discard(spark, scratch)
    discard_at_exit(spark, store.root)
    return store


@query(with_views(["ents"], "SELECT entity_key, natural_key, entity_hash_key, is_current, valid_from, valid_to FROM ents"))
def merge_touched_entities(spark, d):
    """Two batches merged bucket by bucket: the same history as one load."""
    return _merged_store(spark, d).read("dim_entities").select(
        "entity_key", "natural_key", "entity_hash_key", "is_current", "valid_from", "valid_to")


@query(with_views(["facts"], "SELECT * FROM facts"))
def merge_touched_facts(spark, d):
    return _merged_store(spark, d).read("fct_rating_metric", "is_open").drop("fact_metric_key")


@query(with_views(["subs"], f"""
SELECT natural_key, count(*) AS row_count FROM subs WHERE currency <> 'F'
  AND natural_key IN (SELECT natural_key FROM subs WHERE submitted_at >= TIMESTAMP '{_CUT}') GROUP BY natural_key HAVING count(*) > 1"""))
def check_touched_keys(spark, d):
    """The check of :func:`check_unique_current`, limited to the companies of the second batch."""
    raw = fx.subs(spark, d).withColumn("is_current", F.col("currency") != "F")
    batch = raw.filter(F.col("submitted_at") >= F.lit(_CUT).cast("timestamp_ntz"))
    return integrity.repeated_current(integrity.among(raw, batch, "natural_key"), ["natural_key"])


@query(with_views(["filelog"], """
SELECT f.ingest_seq, f.run_id FROM filelog f
WHERE EXISTS (SELECT 1 FROM filelog p WHERE p.verdict = 'success' AND p.content = f.content AND p.run_id IN ('src0', 'src1', 'src2', 'src3'))"""))
def duplicate_of_known_contents(spark, d):
    """The duplicate test against checksums kept by bucket, behind the batch's Bloom filters."""
    store = _new_store(spark)
    landed = stage(_landed(spark, d), "landed")
    earlier = landed.filter(F.col("run_id").isin("src0", "src1", "src2", "src3") & (F.col("verdict") == "success")).groupBy("checksum").agg(
        F.min("ingest_seq").alias("submission_id"))
    store.commit({"known_contents": Write(earlier.withColumn("key_bucket", store.bucket("checksum")), "keyed")})
    discard_at_exit(spark, store.root)
    history = store.read_open("known_contents", store.touched(landed, "checksum"))
    known = dedupe.known_contents(landed, history, store.bucket("checksum"), store.buckets)
    return dedupe.with_known(landed, known, "ingest_seq").select("ingest_seq", "run_id")


# === late submissions ============================================================================


@query(with_views(["ents"], """
SELECT submission_id, natural_key, sector, accounting_principles, currency, entity_hash_key, is_current, valid_from, valid_to FROM ents"""))
def late_submissions(spark, d):
    """Every seventh submission arrives after all others: the same history as one load in order."""
    rows = stage(_subs_hashed(spark, d), "subs")
    first, after = rows.filter("submission_id % 7 <> 0"), rows.filter("submission_id % 7 = 0")
    keys = ["natural_key"]
    versions = stage(scd2.scd2_history(first, keys, "entity_hash_key", ["submitted_at", "submission_id"], "submitted_at"), "versions")
    kept, patched = late.patch_versions(versions, first, after, keys, "entity_hash_key", "submitted_at", "submission_id")
    return kept.unionByName(patched).select(
        "submission_id", "natural_key", "sector", "accounting_principles", "currency", "entity_hash_key", "is_current", "valid_from", "valid_to")


# === audit events ================================================================================

_TIMEOUT = timedelta(days=2)
_SPANS_SQL = """
WITH e AS (SELECT user_id, event_id, ts AS t, event_type = 'signup' AS is_start, CAST(json_extract_string(props, '$.k') AS BIGINT) AS n
           FROM events WHERE event_type IN ('signup', 'purchase')),
w AS (SELECT *, lead(t) OVER o AS next_t, lead(is_start) OVER o AS next_start, lead(n) OVER o AS next_n,
             lag(t) OVER o AS prev_t, lag(is_start) OVER o AS prev_start
      FROM e WINDOW o AS (PARTITION BY user_id ORDER BY t, event_id)),
f AS (SELECT *, coalesce(next_t - t <= INTERVAL 2 DAY, false) AS followed, coalesce(prev_start AND t - prev_t <= INTERVAL 2 DAY, false) AS answered FROM w)
SELECT user_id, t AS started_at, CASE WHEN followed AND NOT next_start THEN next_t END AS completed_at,
       CASE WHEN followed AND NOT next_start THEN next_n END AS records,
       CASE WHEN followed AND NOT next_start THEN 'completed' WHEN followed THEN 'retried' ELSE 'timed out' END AS state
FROM f WHERE is_start
UNION ALL SELECT user_id, NULL, t, n, 'start missing' FROM f WHERE NOT is_start AND NOT answered"""


def _stage_events(events):
    """Sign-ups as starts and purchases as finishes of a user's stage."""
    return events.filter(F.col("event_type").isin("signup", "purchase")).select(
        "user_id", "event_id", F.col("ts").alias("at"), (F.col("event_type") == "signup").alias("is_start"),
        F.get_json_object("props", "$.k").cast("bigint").alias("records"))


@query(_SPANS_SQL)
def audit_stage_spans(spark, d):
    return stage_events.paired(_stage_events(fx.table(spark, d, "events")), ["user_id"], _TIMEOUT)


@query(_SPANS_SQL)
def audit_stage_stream(spark, d):
    """The same by a stateful stream over the table; a last event far ahead, of no user, moves the watermark past all others."""
    folder = scratch_folder(spark)
    events = fx.table(spark, d, "events")
    end = events.agg(F.max("ts").alias("at")).select(
        F.lit(-1).cast("bigint").alias("user_id"), F.lit(-1).cast("bigint").alias("event_id"),
        (F.col("at") + F.expr("INTERVAL 30 DAYS")).alias("at"), F.lit(False).alias("is_start"), F.lit(0).cast("bigint").alias("records"))
    rows = _stage_events(events).unionByName(end).withColumn("at", F.col("at").cast("timestamp"))
    rows.write.parquet(f"{folder}/events")
    discard_at_exit(spark, folder)
    source = spark.readStream.schema(rows.schema).parquet(f"{folder}/events")
    stream = stage_events.spans(source, "user_id", _TIMEOUT)
    (stream.writeStream.format("parquet").option("checkpointLocation", f"{folder}/progress").option("path", f"{folder}/spans")
     .outputMode("append").trigger(availableNow=True).start().awaitTermination())
    kind = dict(events.dtypes)["ts"]
    return spark.read.schema(stream.schema).parquet(f"{folder}/spans").filter("user_id >= 0").select(
        "user_id", F.col("started_at").cast(kind).alias("started_at"), F.col("completed_at").cast(kind).alias("completed_at"), "records", "state")


@query("""
WITH u AS (SELECT user_id, max(ts) AS ts FROM events WHERE event_type = 'error' GROUP BY 1),
l AS (SELECT e.user_id, max(e.event_id) AS event_id, e.ts FROM events e JOIN u ON u.user_id = e.user_id AND u.ts = e.ts AND event_type = 'error' GROUP BY 1, 3)
SELECT e.event_id AS id, coalesce(CASE WHEN l.user_id IS NOT NULL THEN 'error' END, e.event_type) AS execution_status,
       CASE WHEN l.user_id IS NOT NULL THEN l.event_id ELSE 0 END AS processed_records, e.ts AS started_at, l.ts AS completed_at
FROM events e LEFT JOIN l ON l.user_id = e.event_id""")
def audit_close_events(spark, d):
    """Every event is an open audit event; errors update the event whose id is their user, the latest error counts."""
    events = fx.table(spark, d, "events")
    opened = events.select(
        F.col("event_id").alias("id"), F.col("event_type").alias("execution_status"), F.lit(0).cast("bigint").alias("processed_records"),
        F.lit(None).cast("string").alias("error_message"), F.col("ts").alias("started_at"), F.lit(None).cast(dict(events.dtypes)["ts"]).alias("completed_at"))
    updates = events.filter("event_type = 'error'").select(
        F.col("user_id").alias("id"), F.col("event_type").alias("execution_status"), F.col("event_id").alias("processed_records"),
        F.lit(None).cast("string").alias("error_message"), F.col("ts").alias("completed_at"))
    return audit.close_events(opened, updates).drop("error_message")


# === grids that span tasks =======================================================================


def _placed(spark, d, cells=None):
    return sheets.placed_rows(fx.cells(spark, d) if cells is None else cells, fx.FIXTURE_ANCHOR, stage)


@query(with_views(["meta"], "SELECT file_id, row_idx, key, coalesce(array_to_string(vs, '|'), '') AS vals FROM meta"))
def spanning_metadata_rows(spark, d):
    return sheets.metadata_rows(_placed(spark, d)).withColumn("vals", F.array_join("vals", "|"))


@query(with_views(["meta"], """
SELECT file_id, key, coalesce(array_to_string(vs, '|'), '') AS vals FROM (
  SELECT file_id, row_idx, key2 AS key, vs, row_number() OVER (PARTITION BY file_id, key2 ORDER BY row_idx DESC) AS rn
  FROM (SELECT *, CASE WHEN key LIKE 'Industry%' THEN 'Industry' ELSE key END AS key2 FROM meta)) WHERE rn = 1"""))
def spanning_last_wins(spark, d):
    """The three industry labels are renamed to one, so two of the rows must lose."""
    renamed = fx.cells(spark, d).withColumn("value", F.when(
        (F.col("col_idx") == 1) & F.startswith("value", F.lit("Industry")), "Industry").otherwise(F.col("value")))
    return sheets.metadata_last_wins(_placed(spark, d, renamed)).withColumn("vals", F.array_join("vals", "|"))


@query(with_views(["years"], "SELECT file_id, CAST(pos AS INTEGER) AS pos, year_label FROM years"))
def spanning_year_header(spark, d):
    return sheets.year_header(_placed(spark, d))


@query(with_views(["block"], "SELECT file_id, CAST(row_idx AS INTEGER) AS row_idx, metric_name FROM block"))
def spanning_metric_block(spark, d):
    return sheets.metric_block(_placed(spark, d))


@query(with_views(["points"], "SELECT file_id, metric_name, year_label, value, status FROM points"))
def spanning_metric_points(spark, d):
    return sheets.metric_points(_placed(spark, d))


# === all profile attributes ======================================================================

_ALL_PROFILE = ", ".join(
    f"CASE WHEN submission_id % {i + 2} = 0 THEN NULL ELSE concat(accounting_principles, '/{name}/', currency) END AS {name}"
    for i, name in enumerate(fv.PROFILE_FIELDS) if name != "rating_methodologies_applied")


@query(with_views(["subs"], f"""
SELECT submission_id, {_ALL_PROFILE}, concat('["', sector, '","', currency, '"]') AS rating_methodologies_applied FROM subs"""))
def profile_projection_all(spark, d):
    """All fifteen attributes, each absent in some documents; the last is a list and arrives as JSON text."""
    values = {
        label: F.when(F.col("submission_id") % (i + 2) != 0, F.concat("accounting_principles", F.lit(f"/{name}/"), "currency"))
        for i, (name, label) in enumerate(fv.PROFILE_FIELDS.items()) if name != "rating_methodologies_applied"
    }
    values[fv.PROFILE_FIELDS["rating_methodologies_applied"]] = F.array("sector", "currency")
    metadata = F.struct(*[v.alias(label) for label, v in values.items()])
    documents = fx.subs(spark, d).select("submission_id", F.to_json(F.struct(metadata.alias(fv.METADATA_KEY))).alias("parsed_data"))
    parsed = scd2.parse_payload(documents)
    return parsed.select("submission_id", *[c.alias(n) for n, c in scd2.profile_columns().items()])
