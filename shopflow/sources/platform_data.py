"""Platform tables (usage, query history, job runs, lineage, tags) derived from the test
tables, row for row, so that the platform reports have input that grows with the data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import prepare
from .testdata import table


def usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as metered usage."""
    prepare(spark)
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").cast("date").alias("usage_date"),
        F.col("l_returnflag").alias("sku_name"),
        F.col("l_linestatus").alias("usage_unit"),
        (F.col("l_quantity") * F.col("l_discount")).alias("usage_quantity"),
        F.struct(F.col("l_suppkey").cast("string").alias("warehouse_id")).alias("usage_metadata"),
    )


def query_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as statements: their whole text, run time and volume by length."""
    prepare(spark)
    start = F.lit("2024-01-01").cast("timestamp")
    return table(spark, sf_dir, "documents").select(
        F.col("text").alias("statement_text"),
        F.when(F.col("lang") == "en", "SELECT").otherwise("INSERT").alias("statement_type"),
        F.col("n_chars").alias("total_duration_ms"),
        (F.col("n_chars") * 1_000_000).alias("read_bytes"),
        F.col("doc_id").alias("read_rows"),
        F.timestamp_add("MINUTE", F.col("doc_id").cast("int"), start).alias("start_time"),
    )


def _workspace(customer: str) -> Column:
    return F.floor(F.col(customer) / 100).alias("workspace_id")


def job_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as runs, lasting a second per unit of price."""
    prepare(spark)
    began = F.col("o_orderdate").cast("timestamp")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("run_id"),
        F.col("o_custkey").alias("job_id"),
        _workspace("o_custkey"),
        began.alias("period_start_time"),
        F.timestamp_add("SECOND", F.floor("o_totalprice").cast("int"), began).alias("period_end_time"),
        F.col("o_orderstatus").alias("result_state"),
        F.col("o_orderpriority").alias("termination_code"),
    )


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as jobs."""
    prepare(spark)
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("job_id"),
        _workspace("c_custkey"),
        F.col("c_mktsegment").alias("name"),
    )


def lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as table reads."""
    prepare(spark)
    layer = F.when(F.col("event_type").isin("view", "purchase"), "gold").otherwise("silver")
    catalog = F.when(F.col("event_type") == "error", "other").otherwise("ecommerce")
    return table(spark, sf_dir, "events").select(
        F.concat_ws(".", catalog, layer, "event_type").alias("source_table_full_name"),
        catalog.alias("source_table_catalog"),
        F.col("user_id").cast("string").alias("created_by"),
        F.col("ts").cast("timestamp").alias("event_time"),
    )


def tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as column tags."""
    prepare(spark)
    size = F.col("p_size")
    return table(spark, sf_dir, "part").select(
        F.lit("ecommerce").alias("catalog_name"),
        F.lower("p_type").alias("schema_name"),
        F.col("p_name").alias("table_name"),
        F.col("p_brand").alias("column_name"),
        F.when(size < 15, "pii").when(size < 35, "sensitivity").otherwise("domain").alias("tag_name"),
        size.cast("string").alias("tag_value"),
    )
