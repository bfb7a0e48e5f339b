"""ANSI-SQL forms of the derived views, used only by the oracle queries."""

from __future__ import annotations

VIEWS = {
    "subs": """
SELECT o_orderkey AS submission_id, c_name AS natural_key, n_name AS country_of_origin,
       c_mktsegment AS sector, o_orderpriority AS accounting_principles, o_orderstatus AS currency,
       'December' AS year_end, o_orderdate AS submitted_at
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
    "inds": """
SELECT l_orderkey AS submission_id, l_linenumber AS pos, min(p_type) AS sector,
       CAST(min(l_quantity) AS BIGINT) AS weight, min(l_linestatus) AS score
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey, l_linenumber""",
    "metrics": """
SELECT l_orderkey AS submission_id, l_returnflag AS metric_name, year(l_shipdate) AS calendar_year,
       year(l_shipdate) >= 2000 AS is_forecast, CAST(max(l_extendedprice) AS DECIMAL(18,4)) AS metric_value,
       max(l_linestatus) AS processing_status
FROM lineitem GROUP BY l_orderkey, l_returnflag, year(l_shipdate)""",
    "filelog": """
SELECT doc_id AS ingest_seq, source AS run_id, text AS content,
       CASE WHEN n_chars % 3 = 0 THEN 'failure' ELSE 'success' END AS verdict,
       CASE WHEN n_chars % 3 = 0 THEN '3.Validation' ELSE '5.Transform' END AS stage
FROM documents""",
    "cells": """
SELECT submission_id AS file_id, row_idx, 1 AS col_idx, k AS value
FROM subs CROSS JOIN (VALUES (0,'Rated entity'),(1,'Country of origin'),(2,'CorporateSector'),
  (3,'Accounting principles'),(4,'Reporting Currency/Units'),(5,'Industry risk'),(6,'Industry weight'),
  (7,'Industry risk score'),(13,'Notes')) AS t(row_idx, k)
UNION ALL
SELECT submission_id, row_idx, 2, CASE row_idx WHEN 0 THEN natural_key WHEN 1 THEN concat('  ', country_of_origin, ' ')
  WHEN 2 THEN sector WHEN 3 THEN accounting_principles ELSE currency END
FROM subs CROSS JOIN (VALUES (0),(1),(2),(3),(4)) AS t(row_idx)
UNION ALL SELECT submission_id, 5, 1 + pos, sector FROM inds
UNION ALL SELECT submission_id, 6, 1 + pos, CASE WHEN weight % 10 = 0 THEN 'n/a' ELSE CAST(weight AS VARCHAR) END FROM inds
UNION ALL SELECT submission_id, 7, 1 + pos, score FROM inds
UNION ALL SELECT submission_id, 8, 1, '[METRICS]' FROM subs WHERE submission_id % 97 <> 0
UNION ALL SELECT submission_id, 8, 2 + y - 1995, CASE WHEN y >= 2000 THEN concat(CAST(y AS VARCHAR), 'E') ELSE CAST(y AS VARCHAR) END
FROM subs CROSS JOIN (VALUES (1995),(1996),(1997),(1998),(1999),(2000),(2001)) AS t(y)
UNION ALL SELECT DISTINCT submission_id, CASE metric_name WHEN 'A' THEN 9 WHEN 'N' THEN 10 ELSE 11 END, 1, metric_name FROM metrics
UNION ALL SELECT submission_id, CASE metric_name WHEN 'A' THEN 9 WHEN 'N' THEN 10 ELSE 11 END,
  2 + calendar_year - 1995, CAST(metric_value AS VARCHAR) FROM metrics
UNION ALL SELECT DISTINCT submission_id, CASE metric_name WHEN 'A' THEN 9 WHEN 'N' THEN 10 ELSE 11 END, 9, 'Locked' FROM metrics""",
    # --- grid level ---
    "cl": """
SELECT file_id, row_idx, col_idx, value,
       CASE WHEN trim(value) = '' OR lower(trim(value)) IN ('no data','n/a','na') THEN NULL ELSE trim(value) END AS v
FROM cells""",
    "anchor": """
SELECT file_id, min(row_idx) AS a FROM cells WHERE col_idx = 1 AND value = '[METRICS]' GROUP BY file_id""",
    "vals": """
SELECT file_id, row_idx, list(v ORDER BY col_idx) AS vs FROM cl WHERE col_idx >= 2 AND v IS NOT NULL GROUP BY file_id, row_idx""",
    "meta": """
SELECT k.file_id, k.row_idx, k.v AS key, coalesce(vs, CAST([] AS VARCHAR[])) AS vs
FROM cl k JOIN anchor ON anchor.file_id = k.file_id AND k.row_idx < a
LEFT JOIN vals ON vals.file_id = k.file_id AND vals.row_idx = k.row_idx
WHERE k.col_idx = 1 AND k.v IS NOT NULL""",
    "years": """
SELECT file_id, pos - 1 AS pos, vs[pos] AS year_label
FROM (SELECT vals.file_id, vs, unnest(range(1, len(vs) + 1)) AS pos
      FROM vals JOIN anchor ON anchor.file_id = vals.file_id AND vals.row_idx = a)""",
    "block": """
SELECT file_id, row_idx, v AS metric_name FROM (
  SELECT k.file_id, k.row_idx, k.v, a, row_number() OVER (PARTITION BY k.file_id ORDER BY k.row_idx) AS rn
  FROM cl k JOIN anchor ON anchor.file_id = k.file_id AND k.row_idx > a WHERE k.col_idx = 1 AND k.v IS NOT NULL)
WHERE row_idx = a + rn""",
    "points": """
SELECT b.file_id, b.metric_name, y.year_label, y.pos, c.v AS value, s.v AS status
FROM block b JOIN years y ON y.file_id = b.file_id
LEFT JOIN cl c ON c.file_id = b.file_id AND c.row_idx = b.row_idx AND c.col_idx = y.pos + 2
LEFT JOIN (SELECT file_id, max(pos) + 1 AS n FROM years GROUP BY file_id) ny ON ny.file_id = b.file_id
LEFT JOIN cl s ON s.file_id = b.file_id AND s.row_idx = b.row_idx AND s.col_idx = ny.n + 2""",
    # --- rules ---
    "rules": """
SELECT * FROM (VALUES
 (1,'Rated entity',TRUE,CAST(NULL AS VARCHAR[])),
 (2,'Country of origin',TRUE,['NATION_0','NATION_1','NATION_2','NATION_3','NATION_4','NATION_5','NATION_6','NATION_7',
   'NATION_8','NATION_9','NATION_10','NATION_11','NATION_12','NATION_13','NATION_14','NATION_15','NATION_16',
   'NATION_17','NATION_18','NATION_19','NATION_20','NATION_21','NATION_22','NATION_23']),
 (3,'CorporateSector',TRUE,['MACHINERY','BUILDING','AUTOMOBILE','FURNITURE','HOUSEHOLD']),
 (4,'Industry risk',TRUE,['STANDARD','ECONOMY','LARGE','MEDIUM','PROMO','SMALL']),
 (5,'Industry risk score',FALSE,['O','F','']),
 (6,'Industry weight',FALSE,CAST(NULL AS VARCHAR[])),
 (7,'Reporting Currency/Units',TRUE,['O','F','P']),
 (8,'Accounting principles',TRUE,['1-URGENT','2-HIGH','3-MEDIUM','4-NOT SPECIFIED'])) AS r(no, field, required, allowed)""",
    "kv": """
SELECT anchor.file_id, r.no, r.field, r.required, r.allowed, coalesce(m.vs, CAST([] AS VARCHAR[])) AS vs
FROM anchor CROSS JOIN rules r LEFT JOIN meta m ON m.file_id = anchor.file_id AND m.key = r.field""",
    "missing": """
SELECT file_id, no, 0 AS pos, concat('Missing mandatory field: ''', field, '''') AS error
FROM kv WHERE required AND len(vs) = 0""",
    "outside": """
SELECT file_id, no, pos, concat('Value violation on ''', field, ''': Element ''', x, ''' is out of bounds.') AS error
FROM (SELECT file_id, no, field, allowed, vs[pos] AS x, pos
      FROM (SELECT *, unnest(range(1, len(vs) + 1)) AS pos FROM kv WHERE allowed IS NOT NULL))
WHERE NOT list_contains(allowed, trim(x))""",
    "vec": """
SELECT anchor.file_id, coalesce(s.vs, CAST([] AS VARCHAR[])) AS s, coalesce(w.vs, CAST([] AS VARCHAR[])) AS w,
       coalesce(c.vs, CAST([] AS VARCHAR[])) AS c
FROM anchor
LEFT JOIN meta s ON s.file_id = anchor.file_id AND s.key = 'Industry risk'
LEFT JOIN meta w ON w.file_id = anchor.file_id AND w.key = 'Industry weight'
LEFT JOIN meta c ON c.file_id = anchor.file_id AND c.key = 'Industry risk score'""",
    "zipped": """
SELECT file_id, pos, s[pos] AS sector,
       CASE WHEN pos > len(w) THEN '0' WHEN TRY_CAST(w[pos] AS DOUBLE) <= 1
            THEN concat(CAST(CAST(round_even(TRY_CAST(w[pos] AS DOUBLE) * 100, 0) AS BIGINT) AS VARCHAR), '%')
            WHEN TRY_CAST(w[pos] AS DOUBLE) > 1 THEN concat(CAST(CAST(trunc(TRY_CAST(w[pos] AS DOUBLE)) AS BIGINT) AS VARCHAR), '%')
            ELSE w[pos] END AS weight,
       CASE WHEN pos > len(c) THEN '' ELSE c[pos] END AS score
FROM (SELECT *, unnest(range(1, greatest(len(s), len(w), len(c)) + 1)) AS pos FROM vec)""",
    "allocation": """
SELECT file_id, sum(TRY_CAST(trim(replace(weight, '%', '')) AS DOUBLE)) AS total,
       count(*) - count(TRY_CAST(trim(replace(weight, '%', '')) AS DOUBLE)) AS unreadable
FROM zipped GROUP BY file_id""",
    "boundary": """
SELECT file_id, string_agg(error, '; ' ORDER BY no, pos) AS errors, count(*) AS n
FROM (SELECT * FROM missing UNION ALL SELECT * FROM outside) GROUP BY file_id""",
    # --- payload level ---
    "aggs": """
SELECT submission_id, md5(string_agg(concat(sector, '|', CAST(weight AS VARCHAR), '|', score), ',' ORDER BY pos)) AS agg_hash
FROM inds WHERE submission_id % 3 <> 0 GROUP BY submission_id""",
    "wrows": """
SELECT s.*, agg_hash,
       CASE WHEN s.submission_id % 3 <> 0 THEN accounting_principles END AS business_risk_profile,
       CASE WHEN s.submission_id % 3 <> 0 THEN currency END AS liquidity_notches,
       md5(concat_ws('|', natural_key, country_of_origin, sector, accounting_principles, currency, year_end)) AS eh,
       md5(concat_ws('|', CASE WHEN s.submission_id % 3 <> 0 THEN accounting_principles END,
                          CASE WHEN s.submission_id % 3 <> 0 THEN currency END, agg_hash)) AS ph
FROM subs s LEFT JOIN aggs ON aggs.submission_id = s.submission_id""",
    "flags": """
SELECT *, prev_eh IS NULL OR eh <> prev_eh AS ec, prev_eh IS NULL OR eh <> prev_eh OR ph <> prev_ph AS pc
FROM (SELECT *, lag(eh) OVER w AS prev_eh, lag(ph) OVER w AS prev_ph FROM wrows
      WINDOW w AS (PARTITION BY natural_key ORDER BY submitted_at, submission_id))""",
    "keyed": """
SELECT *, last_value(CASE WHEN ec THEN submission_id END IGNORE NULLS) OVER w AS entity_key,
       last_value(CASE WHEN pc THEN submission_id END IGNORE NULLS) OVER w AS profile_key
FROM flags WINDOW w AS (PARTITION BY natural_key ORDER BY submitted_at, submission_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    "ents": """
SELECT submission_id AS entity_key, natural_key, natural_key AS entity_name, country_of_origin, sector,
       accounting_principles, currency, year_end, eh AS entity_hash_key, valid_to IS NULL AS is_current,
       submitted_at AS valid_from, valid_to, submission_id
FROM (SELECT *, lead(submitted_at) OVER (PARTITION BY natural_key ORDER BY submitted_at, submission_id) AS valid_to
      FROM flags WHERE ec)""",
    "profs": """
SELECT profile_key, entity_key, natural_key, eh AS entity_hash_key, ph AS profile_hash_key,
       agg_hash AS industry_aggregate_hash_key, business_risk_profile, liquidity_notches,
       valid_to IS NULL AS is_current, submitted_at AS valid_from, valid_to
FROM (SELECT *, lead(submitted_at) OVER (PARTITION BY natural_key ORDER BY submitted_at, submission_id) AS valid_to
      FROM keyed WHERE pc)""",
    "indrows": """
SELECT DISTINCT p.profile_key, p.profile_hash_key, md5(concat_ws('|', i.sector, CAST(i.weight AS VARCHAR), i.score)) AS industry_hash_key,
       p.industry_aggregate_hash_key, i.sector AS sector_name, CAST(i.weight AS DOUBLE) AS industry_weight_percentage,
       i.score AS industry_risk_score, p.is_current, p.valid_from, p.valid_to
FROM profs p JOIN inds i ON i.submission_id = p.profile_key WHERE p.profile_key % 3 <> 0""",
    "facts": """
SELECT entity_key, profile_key, industry_aggregate_hash_key, submission_id, metric_name, year_label, calendar_year,
       is_forecast, metric_value, format('{:,.2f}', CAST(metric_value AS DOUBLE)) AS metric_value_formatted,
       processing_status, submitted_at AS updated_at
FROM (SELECT k.entity_key, k.profile_key, k.agg_hash AS industry_aggregate_hash_key, m.submission_id, m.metric_name,
             concat(CAST(m.calendar_year AS VARCHAR), CASE WHEN m.is_forecast THEN 'E' ELSE '' END) AS year_label,
             CAST(m.calendar_year AS INTEGER) AS calendar_year, m.is_forecast, m.metric_value, st.processing_status, k.submitted_at,
             row_number() OVER (PARTITION BY k.entity_key, k.profile_key, m.metric_name, m.calendar_year
                                ORDER BY k.submitted_at DESC, k.submission_id DESC) AS rn
      FROM keyed k JOIN metrics m ON m.submission_id = k.submission_id
      JOIN (SELECT submission_id, metric_name, max(processing_status) AS processing_status FROM metrics GROUP BY 1, 2) st
        ON st.submission_id = m.submission_id AND st.metric_name = m.metric_name
      WHERE k.agg_hash IS NOT NULL)
WHERE rn = 1""",
    "files": """
SELECT event_id AS id, user_id AS run_id, concat('file_', CAST(event_id AS VARCHAR), '.xlsm') AS file_name, ts AS processed_at,
       CASE event_type WHEN 'error' THEN 'FAILURE' WHEN 'signup' THEN 'SKIPPED' ELSE 'SUCCESS' END AS outcome,
       event_id AS submission_id,
       CASE event_type WHEN 'error' THEN '3.Validation' WHEN 'signup' THEN '1.Initial' ELSE '5.Transform' END AS execution_stage,
       CASE event_type WHEN 'error' THEN concat('Value violation on ''', props, '''')
            WHEN 'signup' THEN 'Duplicate file checksum detected' END AS error_message
FROM events""",
}

NEEDS = {
    "subs": [], "inds": [], "metrics": [], "filelog": [], "files": [],
    "cells": ["subs", "inds", "metrics"], "cl": ["cells"], "anchor": ["cells"], "vals": ["cl"],
    "meta": ["cl", "anchor", "vals"], "years": ["vals", "anchor"], "block": ["cl", "anchor"],
    "points": ["block", "years", "cl"], "rules": [], "kv": ["anchor", "rules", "meta"], "missing": ["kv"],
    "outside": ["kv"], "vec": ["anchor", "meta"], "zipped": ["vec"], "allocation": ["zipped"],
    "boundary": ["missing", "outside"],
    "aggs": ["inds"], "wrows": ["subs", "aggs"], "flags": ["wrows"], "keyed": ["flags"], "ents": ["flags"],
    "profs": ["keyed"], "indrows": ["profs", "inds"], "facts": ["keyed", "metrics"],
}


def with_views(names: list[str], body: str, **extra: str) -> str:
    """``WITH`` clause with the named views and everything they need, in dependency order.

    ``extra`` replaces views of the same name; other names are added after the known views.
    """
    order: list[str] = []

    def visit(name: str) -> None:
        if name not in order:
            for need in NEEDS.get(name, []):
                visit(need)
            order.append(name)

    for name in [*names, *extra]:
        visit(name)
    views = {**VIEWS, **extra}
    return "WITH " + ",\n".join(f"{n} AS ({views[n]})" for n in order) + "\n" + body
