"""A training-data pipeline of five operators over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and
read again as the next stage's input. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shopflow.llm import mixing, packing, perplexity, secret_scan, simhash
from shopflow.llm.queries import tokenizer
from shopflow.llm.texts import documents
from shopflow.session import stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return perplexity.keep(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, that with the smallest id."""
    return simhash.one_per_group(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked; every document stays."""
    return secret_scan.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are cut or repeated to their targets, in whole documents."""
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix as pieces of training sequences."""
    return packing.pack(docs, tokenizer("byte_bpe_50k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("simhash near-dedup", near_dedup),
    ("secret scan", mask_secrets),
    ("source mixing", mix_sources),
    ("packing", pack_sequences),
]

# Perplexity, fingerprints, compressed sizes and token ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, from the table of documents."""
    now = documents(spark, sf_dir)
    for name, stage in STAGES:
        now = stored(stage(spark, now, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return now
