"""The thin ``opN_*`` queries over the driver's tables, and DuckDB statements
for those that SQL can express."""

from __future__ import annotations

import string

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import (bpe, centroids, decontaminate, exact_dedup, hard_negatives, langid,
                          quality, secret_scan, simhash, substring_dedup, token_output, toxicity,
                          url_filter)
from tidemark.llm.common import read_table

TOKENIZER = "word_bpe_49k.json"


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(_docs(spark, sf_dir), read_table(spark, sf_dir, "labels"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated_passages(_docs(spark, sf_dir))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(_docs(spark, sf_dir))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(_docs(spark, sf_dir), read_table(spark, sf_dir, "labels"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(_docs(spark, sf_dir),
                                       read_table(spark, sf_dir, "benchmark"))


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_docs(spark, sf_dir))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify_languages(_docs(spark, sf_dir))


def op8_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output.token_digests(_docs(spark, sf_dir), public_tokenizers.path(TOKENIZER))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_digests(_docs(spark, sf_dir))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(_docs(spark, sf_dir), public_tokenizers.path(TOKENIZER))


def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.page_verdicts(read_table(spark, sf_dir, "pages"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(read_table(spark, sf_dir, "embeddings"))


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster_digests(read_table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (
    op1_toxicity, op2_substring_dedup, op3_exact_dedup, op4_quality_classifier,
    op5_decontamination, op6_simhash_near_dedup, op7_language_id, op8_token_output,
    op9_secret_scan, op10_bpe, op11_url_filter, op12_hard_negatives, op13_centroids)}


_LOWER = (f"translate(coalesce(text, ''), '{string.ascii_uppercase}', "
          f"'{string.ascii_lowercase}')")

_OP2 = r"""
WITH w AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'),
                             lambda x: x <> '') AS words
  FROM documents),
windows AS (
  SELECT doc_id, i, words[i:i + 12] AS g
  FROM (SELECT doc_id, words, unnest(generate_series(1, len(words) - 12)) AS i FROM w)),
least AS (SELECT g, min(doc_id) AS m FROM windows GROUP BY g),
gone AS (
  SELECT DISTINCT doc_id, i + k AS p
  FROM (SELECT windows.doc_id, i, unnest(generate_series(0, 12)) AS k
        FROM windows JOIN least USING (g) WHERE m < windows.doc_id)),
each AS (
  SELECT doc_id, unnest(words) AS word, unnest(generate_series(1, len(words))) AS p FROM w),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text, count(*) AS n
  FROM each ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words,
       CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""

_OP3 = f"""
WITH d AS (SELECT doc_id, sha256({_LOWER}) AS text_sha256, {_LOWER} AS content FROM documents),
g AS (SELECT content, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY content)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256
FROM d JOIN g USING (content)
"""

_OP5 = rf"""
WITH item AS (
  SELECT CAST(item_id AS VARCHAR) AS item, w, least(10, len(w)) AS k
  FROM (SELECT item_id,
               regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
        FROM benchmark)
  WHERE len(w) > 0),
item_windows AS (
  SELECT DISTINCT item, k, w[i:i + k - 1] AS g
  FROM (SELECT item, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i FROM item)),
doc AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
sizes AS (SELECT DISTINCT k FROM item_windows),
doc_windows AS (
  SELECT doc_id, k, i, w[i:i + k - 1] AS g
  FROM (SELECT doc_id, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i
        FROM doc, sizes WHERE len(w) >= k)),
hits AS (
  SELECT doc_id, item, k, i FROM doc_windows JOIN item_windows USING (k, g)),
words AS (
  SELECT doc_id, count(DISTINCT i + o) AS n_hit
  FROM (SELECT doc_id, i, unnest(generate_series(0, k - 1)) AS o FROM hits) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

ORACLE_SQL = {
    "op2_substring_dedup": _OP2,
    "op3_exact_dedup": _OP3,
    "op5_decontamination": _OP5,
    "op9_secret_scan": secret_scan.ORACLE_SQL,
    "op11_url_filter": url_filter.ORACLE_SQL,
    "op12_hard_negatives": hard_negatives.ORACLE_SQL,
    "op13_centroids": centroids.ORACLE_SQL,
}
