"""Query catalogue: every operator over the test tables, with its SQL oracle.

Each entry runs over whole tables. Lookups by id or key are parameters of the read API and stay as such;
the page and top-k entries keep their limit because it is their feature.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronograde import fixed_values as fv
from chronograde.functions import hashing, text
from chronograde.operators import audit, dedupe, facts, grid, history, integrity, rules as checks, scd2, staging
from chronograde.plans import warehouse
from chronograde.plans.views_sql import VIEWS, with_views
from chronograde.sources import fixtures as fx, landing
from chronograde.sources.store import discard, discard_at_exit, scratch_folder, stage

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

TODAY = date(2002, 1, 1)
PIT_DAY = date(1998, 6, 15)
COMPANY = "Customer#000000043"


def query(oracle: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        ORACLES[fn.__name__] = oracle
        return fn

    return register


# === shared inputs ===============================================================================


def _docs(spark: SparkSession, d: str) -> DataFrame:
    return grid.documents(fx.cells(spark, d, by_file=True), fx.FIXTURE_ANCHOR)


def _checked(spark: SparkSession, d: str, **changes) -> DataFrame:
    """Extracted documents with metadata and zipped industries."""
    docs = grid.with_metadata(_docs(spark, d)).filter(F.col("anchor_row").isNotNull())
    return checks.validate(docs, replace(fx.FIXTURE_RULES, **changes))


def _subs_hashed(spark: SparkSession, d: str) -> DataFrame:
    return fx.subs(spark, d).withColumn("entity_hash_key", scd2.entity_hash())


def _entities(spark: SparkSession, d: str) -> DataFrame:
    """Entity dimension of the submissions view."""
    order = ["submitted_at", "submission_id"]
    versions = scd2.scd2_history(_subs_hashed(spark, d), ["natural_key"], "entity_hash_key", order, "submitted_at")
    return versions.withColumn("entity_key", F.col("submission_id")).withColumn("entity_name", F.col("natural_key"))


def _rows(spark: SparkSession, d: str) -> DataFrame:
    return scd2.warehouse_rows(fx.payloads(spark, d))


def _annotated(spark: SparkSession, d: str) -> DataFrame:
    """Submissions with version keys. Parsed rows and the annotated timeline are written once each, as an
    ingest does, instead of being recomputed by every branch of the plan. The timeline holds all of the rows, so they go."""
    scratch = scratch_folder(spark)
    discard_at_exit(spark, scratch)
    annotated = stage(scd2.annotate_versions(scd2.batch_rows(stage(_rows(spark, d), "rows", scratch))), "annotated")
    discard(spark, scratch)
    return annotated


def _documents_of(spark: SparkSession, d: str) -> DataFrame:
    return fx.subs(spark, d).select("submission_id", F.to_json(F.struct(
        F.struct(F.col("natural_key").alias("Rated entity"), F.col("sector").alias("CorporateSector")).alias("metadata")
    )).alias("parsed_data"))


def _doc_sql(alias: str) -> str:
    return f"""concat('{{"Rated entity":"', {alias}natural_key, '","CorporateSector":"', {alias}sector, '"}}')"""


# === sources and sinks ===========================================================================


@query("SELECT doc_id, sha256(text) AS checksum, strlen(text) AS file_size FROM documents")
def fingerprint_sha256(spark, d):
    return fx.table(spark, d, "documents").select(
        "doc_id", F.sha2("text", 256).alias("checksum"), F.octet_length("text").cast("bigint").alias("file_size")
    )


@query("SELECT page_id AS id, url AS file_name, md5(html) AS content_md5 FROM pages WHERE html IS NOT NULL AND length(html) > 0")
def file_content_lookup(spark, d):
    pages = fx.table(spark, d, "pages")
    log = pages.select(F.col("page_id").alias("id"), F.col("url").alias("file_name"), F.lit(1).alias("run_id"), F.col("page_id").alias("path"))
    contents = pages.select(F.lit(1).alias("run_id"), F.col("page_id").alias("path"), F.encode("html", "UTF-8").alias("content"))
    return audit.file_content(log, contents).select("id", "file_name", F.md5("file_content").alias("content_md5"))


@query("SELECT o_orderkey AS file_id FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)")
def unreadable_files(spark, d):
    """Orders as files, their line items as cells: files without a cell."""
    files = fx.table(spark, d, "orders").select(F.col("o_orderkey").alias("file_id"))
    return landing.unreadable(files, fx.table(spark, d, "lineitem").select(F.col("l_orderkey").alias("file_id")))


@query("""
SELECT doc_id AS submission_id, concat('doc_', CAST(doc_id AS VARCHAR), '.xlsm') AS filename, 'SUCCESS' AS final_status,
       'BEFORE EXTRACT' AS current_status, CAST(0 AS DECIMAL(18,3)) AS execution_duration_seconds,
       concat('{"file_size_bytes":', CAST(strlen(text) AS VARCHAR), ',"file_sha256_checksum":"', sha256(text),
              '","last_modified":"2024-01-01 00:00:00","absolute_path":"', source, '"}') AS file_metadata
FROM documents""")
def stage_submissions(spark, d):
    files = fx.table(spark, d, "documents").select(
        F.col("doc_id").alias("submission_id"), F.concat(F.lit("doc_"), F.col("doc_id").cast("string"), F.lit(".xlsm")).alias("filename"),
        F.octet_length("text").alias("file_size"), F.sha2("text", 256).alias("checksum"),
        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("modified_at"), F.col("source").alias("path"),
        F.col("source").alias("run_id"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("submitted_at"),
    )
    return staging.stage_submissions(files, "SUCCESS", "BEFORE EXTRACT").drop("run_id", "submitted_at")


_YEARS_TEXT = "SELECT file_id, to_json(list(year_label ORDER BY pos)) AS body FROM years GROUP BY file_id"
_POINTS_TEXT = """
SELECT file_id, metric_name, concat(to_json(metric_name), ':{', string_agg(concat(to_json(year_label), ':', coalesce(CAST(to_json(value) AS VARCHAR), 'null')), ',' ORDER BY pos),
       ',"status":', to_json(min(status)), '}') AS body
FROM points GROUP BY file_id, metric_name"""


@query(with_views(
    ["meta", "block"],
    """
SELECT m.file_id AS submission_id, concat('{"metadata":{', m.body, ',"Industry risk":[', coalesce(i.body, ''),
       ']},"scopeCreditMetrics":{"years":', y.body, ',"metrics":{', coalesce(x.body, ''), '}}}') AS parsed_data
FROM m_text m JOIN y_text y ON y.file_id = m.file_id LEFT JOIN i_text i ON i.file_id = m.file_id
LEFT JOIN (SELECT p.file_id, string_agg(body, ',' ORDER BY row_idx) AS body FROM p_text p
           JOIN block b ON b.file_id = p.file_id AND b.metric_name = p.metric_name GROUP BY p.file_id) x ON x.file_id = m.file_id""",
    zipped=VIEWS["zipped"], points=VIEWS["points"],
    m_text="""
SELECT file_id, string_agg(concat(to_json(key), ':', CASE len(vs) WHEN 0 THEN 'null' WHEN 1 THEN to_json(vs[1]) ELSE to_json(vs) END), ',' ORDER BY key) AS body
FROM meta WHERE key NOT IN ('Industry risk', 'Industry risk score', 'Industry weight') GROUP BY file_id""",
    i_text="""
SELECT file_id, string_agg(concat('{"sector":', to_json(sector), ',"Industry weight":', to_json(weight), ',"Industry risk score":', to_json(score), '}'), ',' ORDER BY pos) AS body
FROM zipped GROUP BY file_id""",
    y_text=_YEARS_TEXT,
    p_text=_POINTS_TEXT,
))
def submission_payload_json(spark, d):
    docs = warehouse.extract(fx.cells(spark, d, by_file=True), fx.FIXTURE_ANCHOR).filter(F.col("error").isNull())
    return staging.payload_json(checks.validate(docs, fx.FIXTURE_RULES)).select(F.col("file_id").alias("submission_id"), "parsed_data")


@query("""
SELECT event_id AS submission_id, CASE WHEN event_type = 'error' THEN 'FAILURE' ELSE 'SUCCESS' END AS final_status,
       CASE WHEN event_type = 'error' THEN 'TRANSFORM FAILURE' ELSE 'SUBMISSION SUCCESS' END AS current_status,
       CAST((epoch_us(ts) - epoch_us(date_trunc('minute', ts))) / CAST(1000000 AS DECIMAL(20,0)) AS DECIMAL(18,3)) AS execution_duration_seconds
FROM events""")
def submission_status_duration(spark, d):
    subs = fx.table(spark, d, "events").select(
        F.col("event_id").alias("submission_id"), F.col("event_type"), F.col("ts"),
        F.date_trunc("minute", "ts").cast("timestamp_ntz").alias("submitted_at"),
    )
    closed = staging.close_submissions(subs, F.col("event_type") == "error", F.col("ts"), F.lit("TRANSFORM FAILURE"))
    return closed.select("submission_id", "final_status", "current_status", "execution_duration_seconds")


@query(with_views(["missing", "outside"], "SELECT file_id AS submission_id, error AS error_message FROM (SELECT * FROM missing UNION ALL SELECT * FROM outside)"))
def submission_errors_explode(spark, d):
    checked = _checked(spark, d).select(
        F.col("file_id").alias("submission_id"), F.lit("grid.xlsm").alias("filename"), "errors"
    )
    return staging.explode_errors(checked).select("submission_id", "error_message")


@query(with_views(["files"], """
SELECT run_id, count(*) AS total_files, count(*) FILTER (outcome = 'SUCCESS') AS success_count,
       count(*) FILTER (outcome = 'FAILURE') AS failure_count, count(*) FILTER (outcome = 'SKIPPED') AS skipped_count
FROM files GROUP BY run_id"""))
def run_outcome_counts(spark, d):
    return audit.run_counts(fx.file_details(spark, d))


@query("""
SELECT user_id, event_id, ts, event_type FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""")
def audit_latest_state(spark, d):
    return audit.audit_latest(fx.table(spark, d, "events"), "user_id", "ts", "event_id", ["event_type"])


@query(with_views(["files"], "SELECT id, outcome, CASE WHEN outcome = 'SUCCESS' THEN 'archive' ELSE 'dlq' END AS route FROM files"))
def route_outcome(spark, d):
    return fx.file_details(spark, d).select("id", "outcome", audit.route(F.col("outcome")).alias("route"))


# === grid extraction =============================================================================


@query(with_views(["cl"], "SELECT file_id, row_idx, col_idx, v AS cleaned FROM cl"))
def clean_cell(spark, d):
    return grid.clean_cells(fx.cells(spark, d)).select("file_id", "row_idx", "col_idx", "cleaned")


@query("""
SELECT l_orderkey, l_linenumber, l_extendedprice, l_discount,
       regexp_replace(CAST(CAST(round(l_extendedprice, 2) AS DECIMAL(38,2)) AS VARCHAR), '\\.?0+$', '') AS price_text,
       regexp_replace(CAST(CAST(round(l_discount, 2) AS DECIMAL(38,2)) AS VARCHAR), '\\.?0+$', '') AS discount_text
FROM lineitem""")
def clean_number(spark, d):
    return fx.table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice", "l_discount",
        text.clean_number(F.col("l_extendedprice")).alias("price_text"),
        text.clean_number(F.col("l_discount")).alias("discount_text"),
    )


@query(with_views(["anchor"], "SELECT file_id, a AS anchor_row FROM anchor"))
def anchor_row(spark, d):
    return grid.anchor_rows(fx.cells(spark, d), fx.FIXTURE_ANCHOR)


@query(with_views(["anchor"], """
SELECT DISTINCT cells.file_id, 'Anchor ''[METRICS]'' not found in sheet' AS error
FROM cells LEFT JOIN anchor ON anchor.file_id = cells.file_id WHERE anchor.file_id IS NULL"""))
def missing_anchor(spark, d):
    files = fx.subs(spark, d).select(F.col("submission_id").alias("file_id"))
    return grid.files_without_anchor(files, fx.cells(spark, d), fx.FIXTURE_ANCHOR)


@query(with_views(["anchor"], """
SELECT submission_id AS file_id, CASE WHEN a.file_id IS NULL THEN 'Anchor ''[METRICS]'' not found in sheet' ELSE 'Years Not Avaialable' END AS error
FROM subs LEFT JOIN anchor a ON a.file_id = submission_id WHERE a.file_id IS NULL OR submission_id % 5 = 0"""))
def missing_years(spark, d):
    """Grids whose year cells are blanked in every fifth file."""
    cells = fx.cells(spark, d, by_file=True)
    blanked = cells.withColumn("value", F.when(
        (F.col("row_idx") == 8) & (F.col("col_idx") >= 2) & (F.col("file_id") % 5 == 0), F.lit(" n/a ")
    ).otherwise(F.col("value")))
    return grid.documents(blanked, fx.FIXTURE_ANCHOR).filter(F.col("error").isNotNull()).select("file_id", "error")


@query(with_views(["meta"], "SELECT file_id, row_idx, key, coalesce(array_to_string(vs, '|'), '') AS vals FROM meta"))
def metadata_rows(spark, d):
    return grid.metadata_rows(_docs(spark, d)).withColumn("vals", F.array_join("vals", "|"))


@query(with_views(["meta"], """
SELECT file_id, row_idx, key, CASE len(vs) WHEN 0 THEN 'null' WHEN 1 THEN 'scalar' ELSE 'list' END AS shape,
       CASE WHEN len(vs) = 1 THEN vs[1] END AS scalar_value, CAST(len(vs) AS INTEGER) AS n_values FROM meta"""))
def metadata_shape(spark, d):
    return grid.metadata_shape(_docs(spark, d))


@query(with_views(["meta"], """
SELECT file_id, key, coalesce(array_to_string(vs, '|'), '') AS vals FROM (
  SELECT file_id, row_idx, key2 AS key, vs, row_number() OVER (PARTITION BY file_id, key2 ORDER BY row_idx DESC) AS rn
  FROM (SELECT *, CASE WHEN key LIKE 'Industry%' THEN 'Industry' ELSE key END AS key2 FROM meta)) WHERE rn = 1"""))
def metadata_last_wins(spark, d):
    """The three industry labels are renamed to one, so two of the rows must lose."""
    cells = fx.cells(spark, d, by_file=True)
    renamed = cells.withColumn("value", F.when(
        (F.col("col_idx") == 1) & F.startswith("value", F.lit("Industry")), "Industry"
    ).otherwise(F.col("value")))
    return grid.metadata_last_wins(grid.documents(renamed, fx.FIXTURE_ANCHOR)).withColumn("vals", F.array_join("vals", "|"))


@query(with_views(["meta"], """
SELECT file_id, key, 'MASTER' AS source_sheet, CAST(row_idx + 1 AS INTEGER) AS excel_row,
       coalesce(array_to_string(range(3, len(vs) + 3), ','), '') AS excel_columns FROM meta"""))
def cell_lineage(spark, d):
    docs = grid.with_lineage(_docs(spark, d))
    return docs.select("file_id", F.explode_outer("lineage").alias("key", "l")).filter("key IS NOT NULL").select(
        "file_id", "key", "l.source_sheet", "l.excel_row",
        F.array_join(F.col("l.excel_columns").cast("array<string>"), ",").alias("excel_columns"),
    )


@query(with_views(["years"], "SELECT file_id, CAST(pos AS INTEGER) AS pos, year_label FROM years"))
def year_header(spark, d):
    return grid.year_header(_docs(spark, d))


@query(with_views(["block"], "SELECT file_id, CAST(row_idx AS INTEGER) AS row_idx, metric_name FROM block"))
def metric_block(spark, d):
    return grid.metric_block(_docs(spark, d))


@query(with_views(["points"], "SELECT file_id, metric_name, year_label, value FROM points"))
def metric_unpivot(spark, d):
    return grid.metric_points(_docs(spark, d)).drop("status")


@query(with_views(["points"], "SELECT DISTINCT file_id, metric_name, status FROM points"))
def metric_status(spark, d):
    return grid.metric_status(_docs(spark, d))


@query(with_views(
    ["meta", "block"],
    """
SELECT m.file_id, m.body AS metadata_json,
       concat('{"metadata":', m.body, ',"scopeCreditMetrics":{"years":', y.body, ',"metrics":{', coalesce(x.body, ''), '}}}') AS payload_json
FROM m_text m JOIN y_text y ON y.file_id = m.file_id
LEFT JOIN (SELECT p.file_id, string_agg(body, ',' ORDER BY row_idx) AS body FROM p_text p
           JOIN block b ON b.file_id = p.file_id AND b.metric_name = p.metric_name GROUP BY p.file_id) x ON x.file_id = m.file_id""",
    points=VIEWS["points"],
    m_text="""
SELECT file_id, concat('{', string_agg(concat(to_json(key), ':', CASE len(vs) WHEN 0 THEN 'null' WHEN 1 THEN to_json(vs[1]) ELSE to_json(vs) END), ',' ORDER BY key), '}') AS body
FROM meta GROUP BY file_id""",
    y_text=_YEARS_TEXT,
    p_text=_POINTS_TEXT,
))
def assemble_payload(spark, d):
    """The whole extracted document: the metadata, and with it the years and the metric matrix."""
    docs = grid.with_metrics(grid.with_metadata(_docs(spark, d)).filter(F.col("error").isNull()))
    return docs.select(
        "file_id", grid.metadata_json(F.col("metadata")).alias("metadata_json"),
        grid.document_json(F.col("metadata"), F.col("years"), F.col("metrics")).alias("payload_json"),
    )


# === validation ==================================================================================


def _exploded(docs: DataFrame, errors) -> DataFrame:
    return docs.select("file_id", F.explode_outer(errors).alias("error")).filter(F.col("error").isNotNull())


@query(with_views(["missing"], "SELECT file_id, error FROM missing"))
def rule_required(spark, d):
    parts = [checks.required_errors(r) for r in fx.FIXTURE_RULES.rules]
    return _exploded(_checked(spark, d), F.concat(*parts))


@query(with_views(["outside"], "SELECT file_id, error FROM outside"))
def rule_allowed_values(spark, d):
    parts = [checks.domain_errors(r) for r in fx.FIXTURE_RULES.rules]
    return _exploded(_checked(spark, d), F.concat(*parts))


@query(with_views(["vec"], """
SELECT file_id, CAST(greatest(len(s), len(w), len(c)) AS INTEGER) AS width, CAST(len(w) AS INTEGER) AS given,
       array_to_string(list_concat(w, list_transform(range(0, greatest(len(s), len(w), len(c)) - len(w)), lambda x: '0')), '|') AS weights
FROM vec"""))
def pad_vectors(spark, d):
    width = checks.vector_width()
    return _checked(spark, d).select(
        "file_id", width.alias("width"), F.size(checks.values_of(fv.WEIGHT_FIELD)).alias("given"),
        F.array_join(checks.padded(fv.WEIGHT_FIELD, fx.FIXTURE_RULES, width), "|").alias("weights"),
    )


@query(with_views(["zipped"], "SELECT file_id, CAST(pos - 1 AS INTEGER) AS pos, sector, weight, score FROM zipped"))
def zip_industries(spark, d):
    zipped = _checked(spark, d).select("file_id", F.posexplode_outer("industries").alias("pos", "i"))
    return zipped.filter(F.col("pos").isNotNull()).select("file_id", "pos", "i.sector", "i.weight", "i.score")


@query("""
SELECT l_orderkey, l_linenumber, w AS weight, CASE WHEN n <= 1 THEN concat(CAST(CAST(round_even(n * 100, 0) AS BIGINT) AS VARCHAR), '%')
       WHEN n > 1 THEN concat(CAST(CAST(trunc(n) AS BIGINT) AS VARCHAR), '%') ELSE w END AS label
FROM (SELECT l_orderkey, l_linenumber, w, TRY_CAST(w AS DOUBLE) AS n FROM (
  SELECT l_orderkey, l_linenumber, CAST(l_discount AS VARCHAR) AS w FROM lineitem
  UNION ALL SELECT l_orderkey, l_linenumber, CAST(l_quantity AS VARCHAR) FROM lineitem
  UNION ALL SELECT l_orderkey, l_linenumber, l_linestatus FROM lineitem))""")
def format_weight(spark, d):
    items = fx.table(spark, d, "lineitem")
    weights = items.select("l_orderkey", "l_linenumber", F.explode(F.array(
        F.col("l_discount").cast("string"), F.col("l_quantity").cast("string"), F.col("l_linestatus")
    )).alias("weight"))
    return weights.withColumn("label", text.format_weight(F.col("weight")))


@query(with_views(["allocation"], """
SELECT file_id, concat('Mathematical allocation error: Combined weights sum to ', CAST(total AS VARCHAR), '% instead of 100%.') AS error
FROM allocation WHERE unreadable = 0 AND round(total, 2) <> 100
UNION ALL SELECT file_id, 'Mathematical allocation error: Combined weights sum to 0.0% instead of 100%.' FROM vec WHERE len(s) + len(w) + len(c) = 0"""))
def allocation_check(spark, d):
    return _exploded(_checked(spark, d), checks.allocation_errors(F.col("industries"), 100.0))


_BROKEN_CELLS = VIEWS["cl"].replace(
    "FROM cells", "FROM (SELECT file_id, row_idx, col_idx, CASE WHEN row_idx = 6 AND col_idx >= 2 AND value LIKE '%5' "
    "THEN concat(value, ' pct') ELSE value END AS value FROM cells)"
)


@query(with_views(["zipped"], "SELECT file_id, 'Failed parsing allocation percentage.' AS error FROM zipped "
                  "WHERE TRY_CAST(trim(replace(weight, '%', '')) AS DOUBLE) IS NULL", cl=_BROKEN_CELLS))
def allocation_parse_error(spark, d):
    """Weights ending in 5 are made unreadable."""
    cells = fx.cells(spark, d, by_file=True)
    broken = cells.withColumn("value", F.when(
        (F.col("row_idx") == 6) & (F.col("col_idx") >= 2) & F.endswith("value", F.lit("5")), F.concat("value", F.lit(" pct"))
    ).otherwise(F.col("value")))
    docs = grid.with_metadata(grid.documents(broken, fx.FIXTURE_ANCHOR)).filter(F.col("anchor_row").isNotNull())
    checked = checks.validate(docs, fx.FIXTURE_RULES)
    errors = checks.allocation_errors(F.col("industries"), 100.0)
    return _exploded(checked, F.filter(errors, lambda e: e == fv.MSG_PARSE))


_VERDICT = """
SELECT anchor.file_id, concat_ws('; ', b.errors, CASE WHEN coalesce(total, 0) <> 100
         THEN concat('Mathematical allocation error: Combined weights sum to ', CAST(coalesce(total, CAST(0 AS DOUBLE)) AS VARCHAR), '% instead of 100%.') END) AS error_message,
       coalesce(b.n, 0) + CASE WHEN coalesce(total, 0) <> 100 THEN 1 ELSE 0 END AS error_count
FROM anchor LEFT JOIN boundary b ON b.file_id = anchor.file_id LEFT JOIN allocation l ON l.file_id = anchor.file_id"""


@query(with_views(["anchor", "boundary", "allocation"], f"SELECT file_id, error_count = 0 AS is_valid, CAST(error_count AS INTEGER) AS error_count FROM ({_VERDICT})"))
def validation_verdict(spark, d):
    return _checked(spark, d, allocation_total=100.0).select("file_id", "is_valid", F.size("errors").alias("error_count"))


@query(with_views(["anchor", "boundary", "allocation"], f"SELECT file_id, error_message FROM ({_VERDICT})"))
def error_message_join(spark, d):
    return _checked(spark, d, allocation_total=100.0).select("file_id", checks.error_text(F.col("errors")).alias("error_message"))


@query(with_views(["vec"], """
SELECT file_id, concat('Range violation on ''Industry weight'': Element ''', x, ''' is not in [0, 40].') AS error
FROM (SELECT file_id, unnest(w) AS x FROM vec) WHERE TRY_CAST(x AS DOUBLE) IS NULL OR NOT TRY_CAST(x AS DOUBLE) BETWEEN 0 AND 40"""))
def rule_range(spark, d):
    rule = next(r for r in fx.FIXTURE_RULES.rules if r.value_range)
    return _exploded(_checked(spark, d), checks.range_errors(rule))


@query(with_views(["vec"], """
SELECT file_id, concat('Unequal lengths: ''Industry risk''=', CAST(len(s) AS VARCHAR), ', ''Industry risk score''=', CAST(len(c) AS VARCHAR),
       ', ''Industry weight''=', CAST(len(w) AS VARCHAR)) AS error
FROM vec WHERE greatest(len(s), len(w), len(c)) <> least(len(s), len(w), len(c))"""))
def rule_equal_lengths(spark, d):
    return _exploded(_checked(spark, d), checks.length_errors(fx.FIXTURE_RULES))


@query(with_views(["anchor", "block"], """
SELECT anchor.file_id, concat('Metric table has ', CAST(count(metric_name) AS VARCHAR), ' rows instead of 3') AS error
FROM anchor LEFT JOIN block ON block.file_id = anchor.file_id GROUP BY anchor.file_id HAVING count(metric_name) <> 3"""))
def rule_expected_rows(spark, d):
    return _exploded(_checked(spark, d), checks.row_count_errors(fx.FIXTURE_RULES))


@query(with_views(["kv"], """
SELECT file_id, concat('Type violation on ''', field, ''': single value expected') AS error
FROM kv WHERE field <> 'Industry risk' AND len(vs) > 1"""))
def rule_type(spark, d):
    parts = [checks.kind_errors(r) for r in fx.FIXTURE_RULES.rules]
    return _exploded(_checked(spark, d), F.concat(*parts))


# === stage machine and dedupe ====================================================================


def _landed(spark: SparkSession, d: str) -> DataFrame:
    return fx.filelog(spark, d).withColumn("checksum", F.sha2("content", 256)).drop("content")


@query(with_views(["filelog"], """
SELECT f.ingest_seq, f.run_id FROM filelog f
WHERE EXISTS (SELECT 1 FROM filelog p WHERE p.verdict = 'success' AND p.content = f.content AND p.run_id IN ('src0', 'src1', 'src2', 'src3'))"""))
def duplicate_of_success(spark, d):
    """The first four sources count as loaded earlier."""
    landed = _landed(spark, d)
    earlier = landed.filter(F.col("run_id").isin("src0", "src1", "src2", "src3")).select(
        "checksum", F.upper("verdict").alias("final_status")
    )
    return dedupe.duplicates_of_success(landed, earlier).select("ingest_seq", "run_id")


@query(with_views(["filelog"], """
SELECT ingest_seq, CASE WHEN rn > 1 AND verdict = 'success' THEN 'skipped' ELSE verdict END AS outcome,
       CASE WHEN rn > 1 AND verdict = 'success' THEN '1.Initial' ELSE stage END AS execution_stage
FROM (SELECT *, row_number() OVER (PARTITION BY content ORDER BY ingest_seq) AS rn FROM filelog)"""))
def in_batch_dedupe(spark, d):
    landed = _landed(spark, d)
    verdicts = landed.groupBy("checksum").agg(F.min("verdict").alias("verdict"), F.min("stage").alias("stage"))
    files = landed.select("ingest_seq", "checksum")
    return dedupe.in_batch_outcomes(files, verdicts).select("ingest_seq", "outcome", "execution_stage")


_OUTCOME = """
SELECT s.submission_id, CASE WHEN anchor.file_id IS NULL OR b.file_id IS NOT NULL OR k.file_id IS NULL THEN 'failure' ELSE 'success' END AS outcome,
       CASE WHEN anchor.file_id IS NULL THEN '2.Extraction' WHEN b.file_id IS NOT NULL THEN '3.Validation' ELSE '5.Transform' END AS execution_stage,
       CASE WHEN anchor.file_id IS NULL THEN 'Anchor ''[METRICS]'' not found in sheet' WHEN b.file_id IS NOT NULL THEN b.errors
            WHEN k.file_id IS NULL THEN 'Warehouse transformer script invocation failure' END AS error_message
FROM subs s LEFT JOIN anchor ON anchor.file_id = s.submission_id LEFT JOIN boundary b ON b.file_id = s.submission_id
LEFT JOIN (SELECT DISTINCT file_id FROM block) k ON k.file_id = s.submission_id"""


def _processed(spark: SparkSession, d: str) -> DataFrame:
    files = fx.table(spark, d, "orders").join(
        fx.table(spark, d, "customer").select("c_custkey"), F.col("o_custkey") == F.col("c_custkey"), "left_semi"
    ).select(F.col("o_orderkey").alias("file_id"), F.col("o_orderdate").alias("submitted_at"))
    return warehouse.process(files, fx.cells(spark, d, by_file=True), fx.FIXTURE_RULES, fx.FIXTURE_ANCHOR)


@query(with_views(["subs", "anchor", "boundary", "block"], _OUTCOME))
def file_outcome(spark, d):
    return _processed(spark, d).select("submission_id", "outcome", "execution_stage", "error_message")


# === warehouse load ==============================================================================


@query(with_views(["subs"], "SELECT submission_id, natural_key FROM subs"))
def natural_key(spark, d):
    parsed = scd2.parse_payload(fx.payloads(spark, d))
    return parsed.select("submission_id", scd2.entity_columns()["natural_key"].alias("natural_key"))


@query(with_views(["subs"], "SELECT submission_id, natural_key, country_of_origin, sector, accounting_principles, currency, year_end FROM subs"))
def entity_projection(spark, d):
    parsed = scd2.parse_payload(fx.payloads(spark, d))
    return parsed.select("submission_id", *[c.alias(n) for n, c in scd2.entity_columns().items()])


@query(with_views(["wrows"], "SELECT submission_id, eh AS entity_hash_key FROM wrows"))
def entity_hash(spark, d):
    return _subs_hashed(spark, d).select("submission_id", "entity_hash_key")


@query(with_views(["flags"], "SELECT submission_id, natural_key, ec AS is_new_version FROM flags"))
def scd2_change_detect(spark, d):
    line = scd2.Timeline(["natural_key"], ["submitted_at", "submission_id"])
    compared = line.previous(line.split(_subs_hashed(spark, d)), "before", F.col("entity_hash_key"))
    return compared.select(
        "submission_id", "natural_key", (~F.col("entity_hash_key").eqNullSafe(F.col("before"))).alias("is_new_version")
    )


@query(with_views(["ents"], """
SELECT submission_id, natural_key, sector, accounting_principles, currency, entity_hash_key, is_current, valid_from, valid_to FROM ents"""))
def scd2_entity_history(spark, d):
    return _entities(spark, d).select(
        "submission_id", "natural_key", "sector", "accounting_principles", "currency", "entity_hash_key",
        "is_current", "valid_from", "valid_to",
    )


_CUT = "1998-07-01 00:00:00"


@query(with_views(["ents"], "SELECT entity_key, natural_key, entity_hash_key, is_current, valid_from, valid_to FROM ents"))
def scd2_merge_entities(spark, d):
    """Load the submissions before a date, then merge the rest: the same history as one load."""
    rows = stage(_rows(spark, d), "rows")
    early = rows.filter(F.col("submitted_at") < F.lit(_CUT).cast("timestamp_ntz"))
    first = stage(scd2.annotate_versions(scd2.batch_rows(early)), "annotated")
    old_entities = stage(scd2.entity_history(first), "entities")
    old_profiles = stage(scd2.profile_history(first), "profiles")
    old_industries = stage(scd2.industry_history(first), "industries")
    merged = scd2.merge_dimensions(
        rows.filter(F.col("submitted_at") >= F.lit(_CUT).cast("timestamp_ntz")), old_entities, old_profiles, old_industries,
        settle=lambda df: stage(df, "merged"),
    )
    closed = old_entities.filter(~F.col("is_current"))
    return closed.unionByName(merged["dim_entities"]).select(
        "entity_key", "natural_key", "entity_hash_key", "is_current", "valid_from", "valid_to"
    )


@query(with_views(["ents"], f"SELECT entity_key FROM ents WHERE is_current AND natural_key = '{COMPANY}'"))
def current_version_lookup(spark, d):
    return scd2.current_keys(_entities(spark, d), "entity_key", "natural_key", COMPANY)


@query(with_views(["wrows"], "SELECT submission_id, business_risk_profile, liquidity_notches FROM wrows"))
def profile_projection(spark, d):
    parsed = scd2.parse_payload(fx.payloads(spark, d))
    columns = scd2.profile_columns()
    return parsed.select("submission_id", *[columns[n].alias(n) for n in ("business_risk_profile", "liquidity_notches")])


@query(with_views(["inds"], """
SELECT submission_id, sector, concat(CAST(weight AS VARCHAR), '%') AS weight_label, score FROM inds WHERE submission_id % 3 <> 0"""))
def unnest_industries(spark, d):
    parsed = scd2.parse_payload(fx.payloads(spark, d))
    vector = F.col("payload.metadata")[fv.INDUSTRY_FIELD]
    return parsed.select("submission_id", F.explode_outer(vector).alias("i")).filter(F.col("i").isNotNull()).select(
        "submission_id", "i.sector", F.col("i")[fv.WEIGHT_FIELD].alias("weight_label"), F.col("i")[fv.SCORE_FIELD].alias("score")
    )


@query("""
SELECT l_orderkey, l_linenumber, label, TRY_CAST(regexp_replace(coalesce(label, '0'), '[^0-9.]', '', 'g') AS DOUBLE) AS weight
FROM (SELECT l_orderkey, l_linenumber, concat(' ', CAST(l_quantity AS VARCHAR), ' %') AS label FROM lineitem
      UNION ALL SELECT l_orderkey, l_linenumber, CASE WHEN l_linestatus = 'O' THEN concat('abt. ', CAST(l_discount AS VARCHAR)) END FROM lineitem)""")
def parse_weight(spark, d):
    items = fx.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.explode(F.array(
        F.concat(F.lit(" "), F.col("l_quantity").cast("string"), F.lit(" %")),
        F.when(F.col("l_linestatus") == "O", F.concat(F.lit("abt. "), F.col("l_discount").cast("string"))),
    )).alias("label"))
    return items.withColumn("weight", text.parse_weight(F.col("label")))


@query(with_views(["aggs"], "SELECT submission_id, agg_hash AS industry_aggregate_hash_key FROM aggs"))
def industry_aggregate_hash(spark, d):
    return _rows(spark, d).filter(F.size("industries") > 0).select("submission_id", "industry_aggregate_hash_key")


@query(with_views(["wrows"], "SELECT submission_id, natural_key, agg_hash AS industry_aggregate_hash_key FROM wrows"))
def profile_left_join_agg(spark, d):
    return _rows(spark, d).select("submission_id", "natural_key", "industry_aggregate_hash_key")


@query(with_views(["wrows"], "SELECT submission_id, ph AS profile_hash_key FROM wrows"))
def profile_hash(spark, d):
    return _rows(spark, d).select("submission_id", "profile_hash_key")


@query(with_views(["profs"], """
SELECT profile_key, entity_key, entity_hash_key, profile_hash_key, industry_aggregate_hash_key, business_risk_profile,
       is_current, valid_from, valid_to FROM profs"""))
def scd2_profile_history(spark, d):
    return scd2.profile_history(_annotated(spark, d)).select(
        "profile_key", "entity_key", "entity_hash_key", "profile_hash_key", "industry_aggregate_hash_key",
        "business_risk_profile", "is_current", "valid_from", "valid_to",
    )


@query(with_views(["indrows"], "SELECT * FROM indrows"))
def scd2_industry_history(spark, d):
    return scd2.industry_history(_annotated(spark, d)).drop("industry_profile_key", "submission_id")


@query(with_views(["inds"], """
SELECT submission_id, pos, md5(concat_ws('|', sector, CAST(weight AS VARCHAR), score)) AS industry_hash_key FROM inds"""))
def industry_hash(spark, d):
    return fx.inds(spark, d).select(
        "submission_id", "pos",
        hashing.industry_hash(F.col("sector"), F.col("weight").cast("double"), F.col("score")).alias("industry_hash_key"),
    )


@query(with_views(["profs", "inds"], """
SELECT p.profile_key, i.pos, p.profile_hash_key FROM profs p JOIN inds i ON i.submission_id = p.profile_key"""))
def industry_parent_hash(spark, d):
    profiles = scd2.profile_history(_annotated(spark, d)).select("profile_key", "profile_hash_key")
    industries = fx.inds(spark, d).select(F.col("submission_id").alias("profile_key"), "pos")
    return industries.join(profiles, "profile_key")


@query(with_views(["inds", "subs"], """
SELECT sector, weight, score, submission_id, pos FROM (
  SELECT *, row_number() OVER (PARTITION BY sector, weight, score ORDER BY submission_id, pos) AS rn FROM inds i
  WHERE NOT EXISTS (SELECT 1 FROM inds t JOIN subs ON subs.submission_id = t.submission_id
                    WHERE submitted_at < TIMESTAMP '1995-02-01' AND t.sector = i.sector AND t.weight = i.weight AND t.score = i.score))
WHERE rn = 1"""))
def insert_if_absent(spark, d):
    """Industries of the first month are stored, all are incoming."""
    rows = fx.inds(spark, d)
    month = fx.subs(spark, d).filter(F.col("submitted_at") < F.lit("1995-02-01 00:00:00").cast("timestamp_ntz"))
    target = rows.join(month.select("submission_id"), "submission_id", "left_semi")
    return scd2.insert_if_absent(target, rows, ["sector", "weight", "score"], ["submission_id", "pos"])


@query(with_views(["subs", "ents", "profs"], """
SELECT s.submission_id, e.entity_key, p.profile_key, p.industry_aggregate_hash_key
FROM subs s JOIN ents e ON e.natural_key = s.natural_key AND e.is_current
JOIN profs p ON p.entity_key = e.entity_key AND p.is_current WHERE p.industry_aggregate_hash_key IS NOT NULL"""))
def fact_stage_dims(spark, d):
    annotated = _annotated(spark, d)
    return facts.stage_dimensions(
        fx.subs(spark, d), scd2.entity_history(annotated), scd2.profile_history(annotated), scd2.industry_history(annotated)
    )


@query(with_views(["metrics"], """
SELECT m.submission_id, m.metric_name, concat(CAST(calendar_year AS VARCHAR), CASE WHEN is_forecast THEN 'E' ELSE '' END) AS year_label,
       CAST(metric_value AS VARCHAR) AS raw_value, st.processing_status
FROM metrics m JOIN (SELECT submission_id, metric_name, max(processing_status) AS processing_status FROM metrics GROUP BY 1, 2) st
  ON st.submission_id = m.submission_id AND st.metric_name = m.metric_name"""))
def fact_unpivot(spark, d):
    return facts.unpivot_metrics(_rows(spark, d), ["submission_id"]).select(
        "submission_id", "metric_name", "year_label", "raw_value", "processing_status"
    )


@query("""
SELECT l_orderkey, l_linenumber, label, TRY_CAST(regexp_replace(label, '[^0-9]', '', 'g') AS INTEGER) AS calendar_year, label LIKE '%E' AS is_forecast
FROM (SELECT l_orderkey, l_linenumber, CASE l_returnflag WHEN 'A' THEN concat('FY ', CAST(year(l_shipdate) AS VARCHAR))
        WHEN 'N' THEN concat(CAST(year(l_shipdate) AS VARCHAR), 'E') ELSE 'trend' END AS label FROM lineitem)""")
def year_parse_forecast(spark, d):
    year = F.year("l_shipdate").cast("string")
    label = F.when(F.col("l_returnflag") == "A", F.concat(F.lit("FY "), year)).when(
        F.col("l_returnflag") == "N", F.concat(year, F.lit("E"))).otherwise("trend")
    labels = fx.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", label.alias("label"))
    return labels.withColumn("calendar_year", text.calendar_year(F.col("label"))).withColumn(
        "is_forecast", text.is_forecast(F.col("label"))
    )


_NUMBER_SQL = """
SELECT l_orderkey, l_linenumber, raw, CASE WHEN regexp_matches(raw, '^-?[0-9]+(\\.[0-9]+)?$') THEN {0} END AS {1}
FROM (SELECT l_orderkey, l_linenumber, CASE l_returnflag WHEN 'A' THEN CAST(CAST(l_extendedprice AS DECIMAL(18,4)) AS VARCHAR)
        WHEN 'N' THEN concat('-', CAST(CAST(l_quantity AS BIGINT) AS VARCHAR)) ELSE 'Locked' END AS raw FROM lineitem)"""


def _raw_values(spark: SparkSession, d: str) -> DataFrame:
    flag = F.col("l_returnflag")
    raw = (
        F.when(flag == "A", F.col("l_extendedprice").cast("decimal(18,4)").cast("string"))
        .when(flag == "N", F.concat(F.lit("-"), F.col("l_quantity").cast("bigint").cast("string")))
        .otherwise("Locked")
    )
    return fx.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", raw.alias("raw"))


@query(_NUMBER_SQL.format("CAST(raw AS DECIMAL(18,4))", "metric_value"))
def safe_numeric(spark, d):
    return _raw_values(spark, d).withColumn("metric_value", text.safe_numeric(F.col("raw")))


@query(_NUMBER_SQL.format("format('{:,.2f}', CAST(raw AS DOUBLE))", "metric_value_formatted"))
def format_metric(spark, d):
    return _raw_values(spark, d).withColumn("metric_value_formatted", text.format_metric(F.col("raw")))


@query(with_views(["facts"], "SELECT * FROM facts"))
def fact_upsert_latest(spark, d):
    return facts.upsert_facts(facts.fact_rows(_annotated(spark, d))).drop("fact_metric_key")


@query(with_views(["subs", "metrics"], """
SELECT s.submission_id, CASE WHEN s.submission_id % 3 = 0 OR i.submission_id IS NULL THEN 0 ELSE coalesce(n, 0) END AS fact_count,
       CASE WHEN s.submission_id % 3 = 0 OR i.submission_id IS NULL THEN 0 ELSE coalesce(n, 0) END > 0 AS load_ok
FROM subs s LEFT JOIN (SELECT submission_id, count(*) AS n FROM metrics GROUP BY submission_id) m ON m.submission_id = s.submission_id
LEFT JOIN (SELECT DISTINCT l_orderkey AS submission_id FROM lineitem JOIN part ON l_partkey = p_partkey) i ON i.submission_id = s.submission_id"""))
def load_success_flag(spark, d):
    return facts.load_success(_rows(spark, d))


@query(with_views(["subs"], "SELECT natural_key, count(*) AS row_count FROM subs WHERE currency <> 'F' GROUP BY natural_key HAVING count(*) > 1"))
def check_unique_current(spark, d):
    """Raw submissions as a dimension whose rows are current while their order is open: it violates the check."""
    raw = fx.subs(spark, d).withColumn("is_current", F.col("currency") != "F")
    return integrity.repeated_current(raw, ["natural_key"])


@query("SELECT DISTINCT l_orderkey AS submission_id FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-07-01' AND NOT EXISTS "
       "(SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderdate < TIMESTAMP '1998-07-01')")
def check_orphans(spark, d):
    """Line items shipped before a date whose order is not among the orders before that date."""
    cut = F.lit(_CUT).cast("timestamp_ntz")
    child = fx.table(spark, d, "lineitem").filter(F.col("l_shipdate") < cut).select(F.col("l_orderkey").alias("submission_id")).distinct()
    parent = fx.table(spark, d, "orders").filter(F.col("o_orderdate") < cut).select(F.col("o_orderkey").alias("submission_id"))
    return integrity.orphans(child, parent, "submission_id")


@query("SELECT l_orderkey, l_returnflag, year(l_shipdate) AS calendar_year, count(*) AS row_count FROM lineitem GROUP BY 1, 2, 3 HAVING count(*) > 1")
def check_unique_fact(spark, d):
    """Before the upsert, a fact key may repeat: these are the keys that do."""
    items = fx.table(spark, d, "lineitem").withColumn("calendar_year", F.year("l_shipdate").cast("bigint"))
    return integrity.repeated_keys(items, ["l_orderkey", "l_returnflag", "calendar_year"])


@query(with_views(
    ["subs", "anchor", "boundary", "block", "points", "zipped"],
    """
SELECT entity_key, profile_key, metric_name, calendar_year, submission_id, year_label, metric_value, metric_value_formatted, processing_status
FROM (
  SELECT k.entity_key, k.profile_key, p.metric_name, CAST(regexp_replace(p.year_label, 'E', '') AS INTEGER) AS calendar_year,
         k.submission_id, p.year_label, CAST(p.value AS DECIMAL(18,4)) AS metric_value,
         format('{:,.2f}', CAST(p.value AS DOUBLE)) AS metric_value_formatted, p.status AS processing_status,
         row_number() OVER (PARTITION BY k.entity_key, k.profile_key, p.metric_name, p.year_label
                            ORDER BY k.submitted_at DESC, k.submission_id DESC) AS rn
  FROM c_keys k JOIN points p ON p.file_id = k.submission_id)
WHERE rn = 1""",
    c_ok=f"SELECT submission_id FROM ({_OUTCOME}) WHERE outcome = 'success'",
    c_agg="""
SELECT file_id, md5(string_agg(concat(sector, '|', regexp_replace(weight, '%', ''), '|', score), ',' ORDER BY pos)) AS agg_hash
FROM zipped GROUP BY file_id""",
    c_rows="""
SELECT s.submission_id, s.natural_key, s.submitted_at,
       md5(concat_ws('|', s.natural_key, s.country_of_origin, s.sector, s.accounting_principles, s.currency)) AS eh,
       md5(concat_ws('|', agg_hash)) AS ph
FROM subs s JOIN c_ok ON c_ok.submission_id = s.submission_id JOIN c_agg ON c_agg.file_id = s.submission_id""",
    c_flags="""
SELECT *, prev_eh IS NULL OR eh <> prev_eh AS ec, prev_eh IS NULL OR eh <> prev_eh OR ph <> prev_ph AS pc
FROM (SELECT *, lag(eh) OVER w AS prev_eh, lag(ph) OVER w AS prev_ph FROM c_rows
      WINDOW w AS (PARTITION BY natural_key ORDER BY submitted_at, submission_id))""",
    c_keys="""
SELECT *, last_value(CASE WHEN ec THEN submission_id END IGNORE NULLS) OVER w AS entity_key,
       last_value(CASE WHEN pc THEN submission_id END IGNORE NULLS) OVER w AS profile_key
FROM c_flags WINDOW w AS (PARTITION BY natural_key ORDER BY submitted_at, submission_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
))
def full_chain_facts(spark, d):
    """Cells to facts: extraction, validation, history and upsert over all files in one batch."""
    processed = stage(_processed(spark, d), "processed")
    loaded = warehouse.cascade(processed.filter(F.col("outcome") == "success"))["fct_rating_metric"]
    return loaded.select(
        "entity_key", "profile_key", "metric_name", "calendar_year", "submission_id", "year_label",
        "metric_value", "metric_value_formatted", "processing_status",
    )


# === read queries ================================================================================

_COMPANY_SQL = f"""
SELECT e.natural_key, e.entity_name, e.country_of_origin, e.is_current, e.valid_from, e.valid_to, e.submission_id,
       {_doc_sql('s.')} AS metadata
FROM ents e LEFT JOIN subs s ON s.submission_id = e.submission_id"""


@query(with_views(["ents"], f"{_COMPANY_SQL} WHERE e.is_current ORDER BY e.entity_name LIMIT 100 OFFSET 50"))
def active_companies_page(spark, d):
    return history.active_companies(_entities(spark, d), _documents_of(spark, d), limit=100, offset=50)


@query(with_views(["ents"], f"{_COMPANY_SQL} WHERE e.is_current AND e.entity_key = (SELECT max(entity_key) FROM ents WHERE is_current AND natural_key = '{COMPANY}')"))
def company_by_id(spark, d):
    dim = _entities(spark, d)
    key = scd2.current_keys(dim, "entity_key", "natural_key", COMPANY).first()[0]
    return history.company(dim, _documents_of(spark, d), str(key))


@query(with_views(["ents"], f"{_COMPANY_SQL} WHERE e.is_current AND e.natural_key = '{COMPANY}'"))
def company_by_natural_key(spark, d):
    return history.company(_entities(spark, d), _documents_of(spark, d), COMPANY)


@query(with_views(["ents"], f"SELECT submission_id, valid_from, valid_to, is_current FROM ents WHERE natural_key = '{COMPANY}'"))
def entity_versions(spark, d):
    return history.entity_versions(_entities(spark, d), COMPANY)


@query(with_views(["ents"], f"{_COMPANY_SQL} WHERE CAST(e.valid_from AS DATE) <= DATE '{PIT_DAY}' AND (CAST(e.valid_to AS DATE) >= DATE '{PIT_DAY}' OR e.valid_to IS NULL)"))
def pit_compare(spark, d):
    return history.pit_compare(_entities(spark, d), _documents_of(spark, d), PIT_DAY)


_KEYS = ["  Customer#000000043 ", "Customer#000000007", "", "Customer#000000110"]


@query(with_views(["ents"], f"{_COMPANY_SQL} WHERE trim(e.natural_key) IN ('Customer#000000043', 'Customer#000000007', 'Customer#000000110') AND CAST(e.valid_from AS DATE) <= DATE '{PIT_DAY}' AND (CAST(e.valid_to AS DATE) >= DATE '{PIT_DAY}' OR e.valid_to IS NULL)"))
def pit_compare_keys(spark, d):
    return history.pit_compare(_entities(spark, d), _documents_of(spark, d), PIT_DAY, _KEYS)


@query(with_views(["ents"], f"""
SELECT natural_key, entity_key, valid_from, valid_to FROM ents
WHERE valid_from <= TIMESTAMP '{PIT_DAY} 12:00:00' AND (valid_to > TIMESTAMP '{PIT_DAY} 12:00:00' OR valid_to IS NULL)"""))
def pit_compare_latest(spark, d):
    at = F.lit(f"{PIT_DAY} 12:00:00").cast("timestamp_ntz")
    return history.pit_latest(_entities(spark, d), at).select("natural_key", "entity_key", "valid_from", "valid_to")


@query(with_views(["subs", "ents"], """
SELECT p.submission_id AS point_id, p.natural_key, p.submitted_at - INTERVAL 45 DAY AS as_of, e.entity_key
FROM subs p LEFT JOIN ents e ON e.natural_key = p.natural_key AND e.valid_from <= p.submitted_at - INTERVAL 45 DAY
 AND (e.valid_to > p.submitted_at - INTERVAL 45 DAY OR e.valid_to IS NULL)"""))
def pit_join(spark, d):
    """Entity version valid 45 days before each submission."""
    points = fx.subs(spark, d).select(
        "natural_key", (F.col("submitted_at") - F.expr("INTERVAL '45' DAY")).alias("as_of"), F.col("submission_id").alias("point_id")
    )
    return history.pit_join(points, _entities(spark, d))


_HISTORY_SQL = """
SELECT natural_key, metric_name, calendar_year, year_label, metric_value, metric_value_formatted, is_forecast, processing_status
FROM (SELECT e.natural_key, f.*, row_number() OVER (PARTITION BY e.natural_key, metric_name, calendar_year
             ORDER BY e.valid_from DESC, e.entity_key DESC, f.updated_at DESC, f.submission_id DESC) AS rn
      FROM facts f JOIN ents e ON e.entity_key = f.entity_key) WHERE rn = 1"""


def _history(spark: SparkSession, d: str, *args) -> DataFrame:
    annotated = _annotated(spark, d)
    loaded = stage(facts.upsert_facts(facts.fact_rows(annotated)), "facts")  # its shuffle ends before those of the history begin
    return history.metric_history(loaded, scd2.entity_history(annotated), *args)


@query(with_views(["facts", "ents"], _HISTORY_SQL))
def metric_history(spark, d):
    return _history(spark, d)


@query(with_views(["facts", "ents"], f"SELECT * FROM ({_HISTORY_SQL}) WHERE trim(natural_key) ILIKE 'customer#00000004%' AND metric_name IN ('A', 'R')"))
def metric_history_filtered(spark, d):
    return _history(spark, d, " customer#00000004% ", ["A", "R"])


@query(with_views(["facts", "ents"], f"""
SELECT natural_key, metric_name, string_agg(concat(CAST(calendar_year AS VARCHAR), '=', CAST(metric_value AS VARCHAR)), ';' ORDER BY calendar_year) AS history
FROM ({_HISTORY_SQL}) GROUP BY natural_key, metric_name"""))
def metric_history_nested(spark, d):
    nested = history.nested_history(stage(_history(spark, d), "history"))
    return nested.withColumn("history", F.array_join(F.transform("history", lambda p: F.concat(
        p["calendar_year"].cast("string"), F.lit("="), p["metric_value"].cast("string"))), ";"))


@query(with_views(["ents"], """
SELECT natural_key, entity_name, country_of_origin, is_current, valid_from, valid_to, submission_id, sector, currency
FROM ents WHERE trim(natural_key) ILIKE 'customer#%' AND CAST(valid_from AS DATE) >= DATE '1996-01-01'
  AND (CAST(valid_to AS DATE) <= DATE '1999-12-31' OR valid_to IS NULL) AND country_of_origin ILIKE 'nation_1_'
  AND sector ILIKE '%mach%' AND currency ILIKE 'p'"""))
def snapshots_filtered(spark, d):
    return history.snapshots(
        _entities(spark, d), company_id=" customer#% ", from_date=date(1996, 1, 1), to_date=date(1999, 12, 31),
        sector="mach", country="nation_1_", currency="p",
    )


@query(with_views(["ents"], """
SELECT natural_key, entity_name, country_of_origin, is_current, valid_from, valid_to, submission_id, sector, currency FROM ents"""))
def snapshots_all(spark, d):
    return history.snapshots(_entities(spark, d))


def _snapshot_sql(as_of: str) -> str:
    return f"""
SELECT e.entity_key AS snapshot_id, e.natural_key AS company_id, {as_of} AS as_of_date,
       concat('{{"metadata":', {_doc_sql('s.')}, '}}') AS data
FROM ents e LEFT JOIN subs s ON s.submission_id = e.submission_id"""


@query(with_views(["ents"], _snapshot_sql("CAST(e.valid_from AS DATE)") + """
WHERE e.sector = 'BUILDING' AND e.currency = 'F' AND e.country_of_origin = 'NATION_7'
  AND e.valid_from >= TIMESTAMP '1996-01-01' AND e.valid_from <= TIMESTAMP '2000-12-31'"""))
def snapshots_exact(spark, d):
    return history.snapshots_exact(
        _entities(spark, d), _documents_of(spark, d), TODAY, from_date=date(1996, 1, 1), to_date=date(2000, 12, 31),
        sector="BUILDING", currency="F", country="NATION_7",
    )


@query(with_views(["ents"], _snapshot_sql("CAST(e.valid_from AS DATE)") + " WHERE e.entity_key = (SELECT min(entity_key) FROM ents)"))
def snapshot_by_id(spark, d):
    dim = _entities(spark, d)
    return history.snapshot(dim, _documents_of(spark, d), dim.agg(F.min("entity_key")).first()[0], TODAY)


@query(with_views(["ents"], _snapshot_sql(f"DATE '{TODAY}'") + " WHERE e.is_current"))
def latest_snapshots(spark, d):
    return history.latest_snapshots(_entities(spark, d), _documents_of(spark, d), TODAY)


@query(with_views(["files"], """
SELECT id, file_name, processed_at, outcome, submission_id, execution_stage, error_message
FROM files ORDER BY processed_at DESC, id DESC LIMIT 100"""))
def recent_uploads(spark, d):
    return audit.recent_uploads(fx.file_details(spark, d), 100)


@query(with_views(["files", "ents"], """
SELECT f.id, f.outcome, f.submission_id, count(e.entity_key) AS n_snapshots, coalesce(min(e.natural_key), '') AS natural_key
FROM files f LEFT JOIN ents e ON e.submission_id = f.submission_id GROUP BY f.id, f.outcome, f.submission_id"""))
def upload_impact(spark, d):
    impact = audit.upload_impact(fx.file_details(spark, d), _entities(spark, d))
    return impact.select(
        "id", "outcome", "submission_id", F.size("impacted_snapshots").cast("bigint").alias("n_snapshots"),
        F.coalesce(F.get("impacted_snapshots", 0)["natural_key"], F.lit("")).alias("natural_key"),
    )


@query(with_views(["files"], """
SELECT count(DISTINCT run_id) AS total_pipeline_runs, count(*) AS total_files_evaluated,
       count(*) FILTER (outcome = 'SUCCESS') AS success_count, count(*) FILTER (outcome = 'FAILURE') AS failure_count,
       count(*) FILTER (outcome = 'SKIPPED') AS skipped_count FROM files"""))
def upload_stats(spark, d):
    return audit.upload_stats(audit.run_counts(fx.file_details(spark, d)))


@query(with_views(["subs"], f"""
SELECT submission_id, CASE submission_id % 3 WHEN 0 THEN {_doc_sql('')} WHEN 1 THEN {_doc_sql('')} ELSE '{{}}' END AS metadata FROM subs"""))
def metadata_fallback(spark, d):
    """Nested documents, flat documents, and no document."""
    flat = F.to_json(F.struct(F.col("natural_key").alias("Rated entity"), F.col("sector").alias("CorporateSector")))
    nested = F.concat(F.lit('{"metadata":'), flat, F.lit("}"))
    kind = F.col("submission_id") % 3
    docs = fx.subs(spark, d).select("submission_id", F.when(kind == 0, nested).when(kind == 1, flat).alias("parsed_data"))
    return docs.select("submission_id", history.metadata_document(F.col("parsed_data")).alias("metadata"))


# === reports =====================================================================================


@query(with_views(["files"], """
SELECT run_id, outcome, execution_stage, substr(error_message, 1, 10) AS error_prefix, count(*) AS file_count
FROM files GROUP BY 1, 2, 3, 4"""))
def dq_upload_report(spark, d):
    return audit.upload_report(fx.file_details(spark, d))


@query(with_views(["missing", "outside"], """
SELECT file_id AS submission_id, substr(error, 1, 15) AS error_type, count(*) AS error_per_file
FROM (SELECT * FROM missing UNION ALL SELECT * FROM outside) GROUP BY 1, 2"""))
def dq_file_report(spark, d):
    return audit.error_report(submission_errors_explode(spark, d))
