"""Queries of extraction, filter audit and resampling, each beside its SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statweave.llm import filter_audit, html_content, importance
from statweave.llm.registry import query
from statweave.sources.tables import table

IMPORTANCE_SQL = r"""
WITH steps AS (
  SELECT list(v ORDER BY i) AS tab FROM (
    SELECT i, list_reduce(list_concat([i], range(8)),
                          lambda c, b: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS v
    FROM (SELECT unnest(range(256)) AS i))),
dw AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
bw AS (
  SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
dt AS (SELECT r, unnest(ws) AS w FROM dw),
bt AS (SELECT unnest(ws) AS w FROM bw),
bytes AS (
  SELECT w, list_transform(range(octet_length(encode(w))), lambda i: ('0x' || substr(hex(encode(w)), 2 * i + 1, 2))::BIGINT) AS bs
  FROM (SELECT w FROM dt UNION SELECT w FROM bt)),
buckets AS (
  SELECT w, xor(list_reduce(list_concat([4294967295::BIGINT], bs),
                            lambda c, b: xor(c // 256, tab[xor(c, b) % 256 + 1])), 4294967295) % 10000 AS b
  FROM bytes, steps),
s AS (SELECT b, count(*) AS n FROM dt JOIN buckets USING (w) GROUP BY b),
t AS (SELECT b, count(*) AS n FROM bt JOIN buckets USING (w) GROUP BY b),
totals AS (SELECT (SELECT count(*) FROM dt) AS s_all, (SELECT count(*) FROM bt) AS t_all),
gains AS (
  SELECT b, floor(1000 * ln(((coalesce(t.n, 0) + 1) * (s_all + 10000))::DOUBLE
                            / ((coalesce(s.n, 0) + 1) * (t_all + 10000))::DOUBLE))::BIGINT AS g
  FROM s FULL JOIN t USING (b), totals),
weights AS (SELECT r, sum(g)::BIGINT AS weight FROM dt JOIN buckets USING (w) JOIN gains USING (b) GROUP BY r),
scores AS (
  SELECT r, doc_id, len(ws)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((
           ('0x' || substr(sha256('2024:' || doc_id::VARCHAR), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM dw LEFT JOIN weights USING (r)),
places AS (
  SELECT r, row_number() OVER (ORDER BY score DESC, doc_id, r) AS place, count(*) OVER () AS n
  FROM scores WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 10 * n // 100 THEN place END AS rank
FROM scores LEFT JOIN places USING (r)
"""

AUDIT_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws
  FROM documents),
m AS (
  SELECT doc_id, part,
         (len(ws) < 50)::INT + 2 * (100 * len(list_distinct(ws)) < 65 * len(ws))::INT
         + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t))::INT
         + 8 * regexp_matches(t, '[#$%&*|]')::INT
         + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY t),
                         min(doc_id) OVER (PARTITION BY t) IS NOT NULL)::INT AS mask
  FROM d),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
counts AS (
  SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM m LEFT JOIN l USING (doc_id) GROUP BY part, mask),
letter AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f, unnest([1, 2, 4, 8, 16]) AS bit),
perm AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM letter a, letter b, letter c, letter d, letter e WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31
    AND len(list_distinct([a.bit, b.bit, c.bit, d.bit, e.bit])) = 5),
plan AS (
  SELECT filter_order, step, bits[step] AS own, coalesce(list_sum(bits[1:step - 1]), 0)::INT AS before
  FROM (SELECT filter_order, bits, unnest(range(1, 6))::INT AS step FROM perm)),
per AS (
  SELECT part, filter_order, step, own,
         coalesce(sum(n) FILTER (mask & (own | before) = 0), 0)::BIGINT AS kept,
         coalesce(sum(n) FILTER (mask & own <> 0 AND mask & before = 0), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER (mask & own <> 0 AND mask & before <> 0), 0)::BIGINT AS redundant,
         coalesce(sum(n) FILTER (mask = own), 0)::BIGINT AS unique_fails,
         coalesce(sum(good) FILTER (mask & own <> 0 AND mask & before = 0), 0)::BIGINT AS good_lost,
         coalesce(sum(toxic) FILTER (mask & own <> 0 AND mask & before = 0), 0)::BIGINT AS toxic_lost
  FROM counts, plan GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM per
"""


@query("op11_html_extraction")
def op11_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_content.extracted(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.withColumn("n_chars", F.length("text").cast("bigint"))


@query("op12_filter_audit", AUDIT_SQL)
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return filter_audit.audit(docs, table(spark, sf_dir, "labels"))


@query("op13_importance_resampling", IMPORTANCE_SQL)
def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.importance_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
