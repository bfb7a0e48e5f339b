"""One query per operator over its whole table, with SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronograde.llm import bpe, centroids, decontam, fill_middle, html_extract, line_dedup, packing, pii, quality, simhash, topk, toxicity, warc
from chronograde.llm.common import stage, table

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.classes(table(spark, sf_dir, "documents"))


def op2_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.train_and_score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document whose id is divisible by 20 is a query, with its whole text, against all documents."""
    docs = table(spark, sf_dir, "documents")
    queries = docs.where("doc_id % 20 = 0").select(F.col("doc_id").alias("query_id"), "text")
    return topk.top_k(docs, queries).withColumn("score", F.round("score", 4))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.read_records(stage(spark, warc.write_records(table(spark, sf_dir, "pages")), "warc"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), RANKS, public_tokenizers.PATTERN)


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return bpe.digests(bpe.encode(docs, TOKENIZER, bpe.ship_lexicon(spark, docs, TOKENIZER)))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.remove_later(table(spark, sf_dir, "documents")).select("doc_id", "text")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.digests(fill_middle.transform(table(spark, sf_dir, "documents")))


def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_simhash, op2_html, op3_toxicity, op4_pii, op5_topk, op6_warc, op7_packing, op8_bpe,
                            op9_line_dedup, op10_decontamination, op11_fill_middle, op12_quality, op13_centroids)}

def _lloyd_sql(k: int, rounds: int) -> str:
    """Every round spelt out: assignment to the nearest centroid, then floored means; centroids without vectors stay."""
    steps = [f"""a{i} AS MATERIALIZED (SELECT id, c FROM (SELECT id, min_by(c, d * {k} + c) AS c FROM (SELECT v.id, m.c,
  list_sum(list_transform(list_zip(v.v, m.v), lambda x: (x[1] - x[2]) * (x[1] - x[2])))::BIGINT AS d FROM v CROSS JOIN m{i} m) GROUP BY id)),
m{i + 1} AS MATERIALIZED (SELECT m.c, coalesce(n.v, m.v) AS v FROM m{i} m LEFT JOIN (SELECT c, list(floored ORDER BY j) AS v FROM (
  SELECT c, j, (sum(x) - ((sum(x) % count(*)) + count(*)) % count(*))::BIGINT // count(*) AS floored FROM (
    SELECT c, unnest(v.v) AS x, generate_subscripts(v.v, 1) AS j FROM a{i} JOIN v USING (id)) GROUP BY c, j) GROUP BY c) n ON n.c = m.c)"""
             for i in range(rounds)]
    return f"""WITH v AS MATERIALIZED (SELECT vec_id, row_number() OVER () AS id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: isfinite(x))) = 64),
m0 AS MATERIALIZED (SELECT (row_number() OVER (ORDER BY sha256('3:' || vec_id), v) - 1)::INTEGER AS c, v FROM v QUALIFY c < {k}),
{", ".join(steps)},
f AS (SELECT id, vec_id, m.c, list_sum(list_transform(list_zip(v.v, m.v), lambda x: (x[1] - x[2]) * (x[1] - x[2])))::BIGINT AS d
  FROM v CROSS JOIN m{rounds} m QUALIFY row_number() OVER (PARTITION BY id ORDER BY d, m.c) = 1)
SELECT vec_id, c AS cluster, d AS distance, (sum(d) OVER (PARTITION BY c))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia,
       sha256(array_to_string(m.v, ',')) AS centroid_sha256 FROM f JOIN m{rounds} m USING (c)"""


ORACLES: dict[str, str] = {
    "op5_topk": """
WITH w AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+')) AS word FROM documents),
tf AS (SELECT doc_id, word, count(*) AS tf FROM w GROUP BY 1, 2),
len AS (SELECT d.doc_id, coalesce(sum(tf), 0) AS n FROM documents d LEFT JOIN tf USING (doc_id) GROUP BY 1),
tot AS (SELECT count(*) AS docs, avg(n) AS mean FROM len),
df AS (SELECT word, count(*) AS df FROM tf GROUP BY 1),
p AS (SELECT doc_id, word, ln(1 + (docs - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * n / mean)) AS s
      FROM tf JOIN len USING (doc_id) JOIN df USING (word) CROSS JOIN tot),
r AS (SELECT q.doc_id AS query_id, p.doc_id, sum(q.tf * p.s) AS score FROM tf q JOIN p USING (word)
      WHERE q.doc_id % 20 = 0 GROUP BY 1, 2)
SELECT query_id, doc_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, doc_id) AS INTEGER) AS rank,
       round(score, 4) AS score
FROM r QUALIFY rank <= 10""",
    "op9_line_dedup": """
WITH l AS (SELECT doc_id, unnest(range(len(p))) AS line_no, unnest(p) AS line
           FROM (SELECT doc_id, string_split(text, chr(10)) AS p FROM documents)),
s AS (SELECT * FROM (SELECT doc_id, line_no, list_distinct(list_filter(string_split(
          regexp_replace(lower(line), '[\\t\\r\\x0b\\x0c]', ' ', 'g'), ' '), lambda x: x <> '')) AS ws, len(ws) AS n FROM l) WHERE n >= 1),
t AS (SELECT doc_id, line_no, n, unnest(ws) AS word FROM s),
f AS (SELECT word, count(*) AS c FROM t GROUP BY 1),
p AS (SELECT doc_id, line_no, n, word FROM t JOIN f USING (word)
      QUALIFY row_number() OVER (PARTITION BY doc_id, line_no ORDER BY c, word) <= n - ceil(0.8 * n - 1e-9) + 1),
c AS (SELECT DISTINCT a.doc_id, a.line_no, b.doc_id AS b_doc, b.line_no AS b_line FROM p a JOIN p b USING (word)
      WHERE (b.doc_id, b.line_no) < (a.doc_id, a.line_no) AND b.n >= 0.8 * a.n - 1e-9 AND a.n >= 0.8 * b.n - 1e-9),
g AS (SELECT DISTINCT c.doc_id, c.line_no FROM c JOIN s a ON a.doc_id = c.doc_id AND a.line_no = c.line_no
      JOIN s b ON b.doc_id = b_doc AND b.line_no = b_line
      WHERE len(list_intersect(a.ws, b.ws)) >= 0.8 * (a.n + b.n - len(list_intersect(a.ws, b.ws))) - 1e-9)
SELECT l.doc_id, coalesce(string_agg(line, chr(10) ORDER BY l.line_no) FILTER (g.doc_id IS NULL), '') AS text
FROM l LEFT JOIN g ON g.doc_id = l.doc_id AND g.line_no = l.line_no GROUP BY 1""",
    "op11_fill_middle": """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || doc_id) AS h FROM documents),
l AS (SELECT doc_id, text, regexp_extract_all(text, '[^\\n]*\\n|[^\\n]+') AS u, len(u) AS n,
             ('0x' || substr(h, 1, 8))::BIGINT % (n + 1) AS c1, ('0x' || substr(h, 9, 8))::BIGINT % (n + 1) AS c2,
             ('0x' || substr(h, 17, 8))::BIGINT % 100 AS c3, ('0x' || substr(h, 25, 8))::BIGINT % 100 AS c4 FROM d),
p AS (SELECT doc_id, text, n, CASE WHEN text = '' OR regexp_matches(text, '<[PSM]>') OR c3 >= 100 THEN 'plain'
             WHEN c4 < 50 THEN 'spm' ELSE 'psm' END AS form,
             array_to_string(u[1:least(c1, c2)], '') AS pre, array_to_string(u[least(c1, c2) + 1:greatest(c1, c2)], '') AS mid,
             array_to_string(u[greatest(c1, c2) + 1:], '') AS suf FROM l)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
              ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(text) AS restored_sha256 FROM p""",
    "op13_centroids": _lloyd_sql(8, 10),
}
