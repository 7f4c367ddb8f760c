"""One query per operator over its whole table, and the SQL twins where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (
    attention_lm,
    conversation_repair,
    curve_shards,
    embedding_dedup,
    fill_middle,
    license_scan,
    mixing,
    packing,
    perplexity,
    secret_scan,
    simhash,
    substring_dedup,
    token_files,
)
from .texts import documents

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer(name: str) -> str:
    """The place of a public tokenizer file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(documents(spark, sf_dir))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(documents(spark, sf_dir))


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(documents(spark, sf_dir))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_files(documents(spark, sf_dir), tokenizer("word_bpe_49k.json"))


def op7_curve_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curve_shards.shards(documents(spark, sf_dir), 24)


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perplexity.quality(documents(spark, sf_dir))


def op9_sequence_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), tokenizer("byte_bpe_50k.json"))


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair_report(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.digests(documents(spark, sf_dir))


def subwords() -> attention_lm.Subwords:
    """A public byte-level vocabulary and its pattern."""
    import public_tokenizers

    return attention_lm.Subwords(tokenizer("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op13_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attention_lm.scores(documents(spark, sf_dir), subwords())


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_embedding_near_dedup,
        op2_substring_dedup,
        op3_secret_scan,
        op4_source_mixing,
        op5_license_scan,
        op6_token_files,
        op7_curve_shards,
        op8_quality_rules,
        op9_sequence_packing,
        op10_simhash_near_dedup,
        op11_conversation_repair,
        op12_fill_middle,
        op13_lm_scores,
    )
}

# All pairs of usable rows within a label, and reachability by ever smaller rows.
NEAR_SQL = """
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS row, vec_id, label, embedding::DOUBLE[] AS x,
         label IS NOT NULL AND vec_id IS NOT NULL AND coalesce(len(embedding), 0) > 0
         AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0
         AND len(list_filter(embedding, lambda e: e <> 0)) > 0 AS usable
  FROM embeddings),
links AS (
  SELECT a.row AS a, b.row AS b, b.vec_id FROM v a, v b
  WHERE a.usable AND b.usable AND a.label = b.label AND a.row <> b.row AND len(a.x) = len(b.x)
    AND list_cosine_similarity(a.x, b.x) >= 0.98),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
least AS (SELECT a, min(vec_id) AS least FROM reach JOIN v ON v.row = b GROUP BY a),
degree AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, least(vec_id, coalesce(least, vec_id)) AS component_id,
       vec_id = least(vec_id, coalesce(least, vec_id)) AS kept
FROM v LEFT JOIN least ON least.a = v.row LEFT JOIN degree ON degree.a = v.row
"""

# Water-filled targets in closed form, then running totals over the whole hash order.
MIX_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '-')) AS key
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (
  SELECT *, [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight,
         3 * source_size AS most, (SELECT sum(source_size) FROM s)::BIGINT AS total FROM s),
r AS (
  SELECT *, row_number() OVER o AS place,
         total - coalesce(sum(most) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
         sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS sharers
  FROM w WINDOW o AS (ORDER BY most::DOUBLE / weight, source NULLS LAST)),
f AS (SELECT place AS k, rest AS k_rest, sharers AS k_sharers FROM r
      WHERE weight * rest <= most * sharers ORDER BY place LIMIT 1),
t AS (
  SELECT source, source_size,
         coalesce(CASE WHEN k IS NULL OR place < k THEN most::DOUBLE
                       ELSE (weight * k_rest)::DOUBLE / k_sharers::DOUBLE END, 0) AS target
  FROM r LEFT JOIN f ON true),
b AS (
  SELECT *, CASE WHEN source_size > 0 THEN round(target)::BIGINT // source_size ELSE 0 END AS epochs FROM t),
p AS (
  SELECT d.doc_id, d.size, b.source_size, b.target, b.epochs,
         round(b.target)::BIGINT - b.epochs * b.source_size AS rest,
         count(*) OVER (PARTITION BY d.source, key, d.doc_id, d.size) AS twins,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY key, d.doc_id NULLS FIRST, d.size)::BIGINT AS through
  FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, target,
       (epochs * size + greatest(0, least(size, floor((rest - through + twins * size)::DOUBLE / twins))))::BIGINT AS taken
FROM p
"""

ORACLE_SQL: dict[str, str] = {
    "op1_embedding_near_dedup": NEAR_SQL,
    "op4_source_mixing": MIX_SQL,
    "op5_license_scan": license_scan.oracle_sql(),
    "op11_conversation_repair": conversation_repair.ORACLE_SQL,
    "op12_fill_middle": fill_middle.ORACLE_SQL,
}
