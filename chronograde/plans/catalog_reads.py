"""Catalogue of reads that don't go through whole tables: name patterns by trigrams, deep pages by order statistics, reports kept
up to date, and history over co-partitioned tables. Registers its queries with :mod:`catalog`."""

from __future__ import annotations

from pyspark.sql import functions as F

from chronograde.operators import audit, copart, facts, history, names, pages, reports, scd2
from chronograde.plans.catalog import (
    _COMPANY_SQL, _HISTORY_SQL, ORACLES, _annotated, _documents_of, _entities, query, submission_errors_explode,
)
from chronograde.plans.views_sql import with_views
from chronograde.sources import fixtures as fx
from chronograde.sources.store import Store, Write, discard_at_exit, scratch_folder, stage

_BATCHES = 3


def _new_store(spark) -> Store:
    store = Store(spark, scratch_folder(spark))
    discard_at_exit(spark, store.root)
    return store


# === name patterns ===============================================================================


def _indexed(spark, d) -> Store:
    store = _new_store(spark)
    dim = stage(_entities(spark, d), "entities")
    store.commit({"dim_entities": Write(dim.withColumn("key_bucket", store.bucket("natural_key")), "versioned"),
                  **names.index_writes(store, dim)})
    return store


def _pattern_sql(pattern: str) -> str:
    return f"""
SELECT natural_key, entity_name, country_of_origin, is_current, valid_from, valid_to, submission_id, sector, currency
FROM ents WHERE trim(natural_key) ILIKE '{pattern}'"""


@query(with_views(["ents"], _pattern_sql("%ER#0000000_1%")))
def snapshots_by_pattern(spark, d):
    """Snapshots of the companies that a pattern matches: trigrams find the names, the names find their buckets."""
    return history.snapshots(names.versions(_indexed(spark, d), "%ER#0000000_1%"))


@query(with_views(["ents"], _pattern_sql("%7_")))
def snapshots_by_short_pattern(spark, d):
    """A pattern without any trigram."""
    return history.snapshots(names.versions(_indexed(spark, d), "%7_"))


# === deep pages ==================================================================================


@query(with_views(["ents"], f"""
SELECT * EXCLUDE (entity_key, rn, n) FROM (SELECT *, row_number() OVER (ORDER BY entity_name, entity_key) AS rn, count(*) OVER () AS n
  FROM (SELECT c.*, e.entity_key FROM ({_COMPANY_SQL} WHERE e.is_current) c JOIN ents e USING (submission_id)))
WHERE rn > n // 2 AND rn <= n // 2 + 100"""))
def active_companies_deep_page(spark, d):
    """The page in the middle, found from the counts of name ranges."""
    built = pages.build(_entities(spark, d).filter("is_current"), ["entity_name", "entity_key"], scratch_folder(spark), rows_per_range=128)
    discard_at_exit(spark, built.path)
    return history.companies(built.page(sum(built.counts.values()) // 2, 100), _documents_of(spark, d))


# === reports =====================================================================================


def _reported(spark, d) -> Store:
    """A store that got the file log in batches, by file, so that every run falls into several of them."""
    store = _new_store(spark)
    log = fx.file_details(spark, d)
    for b in range(_BATCHES):
        part = log.filter(F.pmod("id", F.lit(_BATCHES)) == b)
        store.commit(reports.merge_writes(store, {"uploads": audit.upload_report(part), "runs": audit.run_counts(part)}))
    return store


@query(ORACLES["dq_upload_report"])
def report_uploads_kept(spark, d):
    """The report folded from each batch's partial counts."""
    return reports.kept(_reported(spark, d), "uploads")


@query(ORACLES["upload_stats"])
def report_stats_kept(spark, d):
    return reports.kept_stats(_reported(spark, d))


@query(ORACLES["dq_file_report"])
def report_errors_kept(spark, d):
    store = _new_store(spark)
    errors = stage(submission_errors_explode(spark, d), "errors")
    for b in range(_BATCHES):
        part = errors.filter(F.pmod(F.xxhash64("error_message"), F.lit(_BATCHES)) == b)
        store.commit(reports.merge_writes(store, {"errors": audit.error_report(part)}))
    return reports.kept(store, "errors")


# === co-partitioned history ======================================================================


@query(with_views(["facts", "ents"], _HISTORY_SQL))
def metric_history_copartitioned(spark, d):
    """Facts and versions in buckets of the entity key; versions with more than 16 facts go the way of hot keys."""
    annotated = _annotated(spark, d)
    points = stage(facts.upsert_facts(facts.fact_rows(annotated)), "facts")
    return copart.metric_history(copart.copartition(points, stage(scd2.entity_history(annotated), "versions"), buckets=16, hot_rows=16))
