"""Queries of the operators over whole document texts."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statweave.llm import context_tree, decontaminate, near_dedup, packing, quality, token_files, toxicity
from statweave.llm.registry import query
from statweave.sources.tables import table

QUALITY_SQL = r"""
WITH base AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws
  FROM documents),
wins AS (
  SELECT r, i, ws[i:i+7] AS win FROM (SELECT r, ws, unnest(range(1, greatest(len(ws) - 6, 1))) AS i FROM base)
  WHERE len(ws) >= 8),
rep AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, win) AS c FROM wins) WHERE c > 1),
hit AS (SELECT r, count(DISTINCT i + j) AS n FROM rep, range(8) AS g(j) GROUP BY r),
line AS (
  SELECT r, list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ls FROM base),
m AS (
  SELECT doc_id, len(ws)::BIGINT AS n_words,
         length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
         len(ls) AS n_lines, coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM base JOIN line USING (r) LEFT JOIN hit USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words OR 10 * n_symbols > 3 * n_words
            OR 10 * n_dup_lines > 3 * n_lines OR word_chars > 15 * n_words OR word_chars < 2 * n_words) AS kept
FROM m
"""

LEAK_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (
  SELECT item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, win, len(win) AS n FROM (
    SELECT item_id, ws[i:i+9] AS win FROM (
      SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS i FROM b WHERE len(ws) > 0))),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT r, n, i, ws[i:i+n-1] AS win FROM (
    SELECT r, n, ws, unnest(range(1, len(ws) - n + 2)) AS i FROM d, sizes WHERE len(ws) >= n)),
hits AS (SELECT dw.r, dw.i, dw.n, bw.item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.win = bw.win),
words AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hits) GROUP BY r),
items AS (
  SELECT r, count(*) AS n_items, string_agg(k, ',' ORDER BY k) AS ids
  FROM (SELECT DISTINCT r, item_id::VARCHAR AS k FROM hits) GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""


@query("op4_quality_rules", QUALITY_SQL)
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(table(spark, sf_dir, "documents"))


@query("op6_decontamination", LEAK_SQL)
def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op7_toxicity")
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from rows whose crc32(doc_id) mod 4 is not 2; scores every row."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), usable=~held_out)
    return toxicity.scored(docs, model).select(
        "doc_id",
        held_out.alias("held_out"),
        F.col("_score").alias("score"),
        (F.col("_score") >= 0.3).cast("int").alias("predicted"),
    )


@query("op9_minhash_near_dedup")
def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.class_report(table(spark, sf_dir, "documents"), words=3, percent=85)


@query("op5_packing")
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    lengths = packing.token_lengths(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return packing.packed(lengths)


@query("op8_token_files")
def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents encoded, written as compressed shards, read back and digested."""
    path = public_tokenizers.path("word_bpe_49k.json")
    shards = token_files.write_shards(table(spark, sf_dir, "documents"), path)
    return token_files.read_documents(shards).withColumnRenamed("key", "doc_id")


@query("op2_lm_scoring")
def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from rows whose crc32(doc_id) mod 7 is not 2; scores every row."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return context_tree.score_report(docs, F.crc32(F.col("doc_id").cast("string")) % 7 == 2)
