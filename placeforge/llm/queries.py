"""Queries of the training-data operators over the synthetic tables, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from placeforge.llm import decontam, density, fertility, hashtree, nbest, qda, simhash, sufdedup, urllm, weakpii
from placeforge.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fertility.calibrated_fertility(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_url_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urllm.url_filter(table(spark, sf_dir, "pages"))


def op3_hash_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hashtree.hash_tree_shards(table(spark, sf_dir, "documents"))


def op4_text_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    return density.extract(table(spark, sf_dir, "pages"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sufdedup.substring_dedup(table(spark, sf_dir, "documents"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_weak_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weakpii.find_pii(table(spark, sf_dir, "documents"))


def op9_nbest_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nbest.encode_documents(table(spark, sf_dir, "documents"))


def op10_quality_qda(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qda.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_fertility, op2_url_lm, op3_hash_tree, op4_text_density, op5_suffix_dedup, op6_simhash,
        op7_decontaminate, op8_weak_pii, op9_nbest_pieces, op10_quality_qda, pipeline,
    )
}

_WORDS = r"""[x FOR x IN string_split(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g'), ' ') IF x <> '']"""

ORACLE: dict[str, str] = {
    "op7_decontaminate": f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS gram
  FROM (SELECT item_id, w, least(len(w), 13) AS n, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i FROM b WHERE len(w) > 0)
),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS gram
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)
),
h AS (SELECT doc_id, i, n, item_id FROM dw JOIN bw USING (n, gram)),
hw AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM h)) GROUP BY doc_id),
hi AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM h) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, (coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w)) AS contaminated
FROM d LEFT JOIN hw USING (doc_id) LEFT JOIN hi USING (doc_id)
""",
}
