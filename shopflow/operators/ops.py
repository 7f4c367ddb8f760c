"""Platform reports over usage, query history, job runs and lineage tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..fixed_values import CATALOG, JOB_NAME
from ..functions.columns import from_units, ratio, units


def _since(as_of: str, days: int) -> Column:
    return F.lit(as_of).cast("timestamp") - F.expr(f"INTERVAL {int(days)} DAYS")


def daily_dbu_cost(usage: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    """Usage and warehouses per day, SKU and unit."""
    first = F.date_sub(F.lit(as_of).cast("date"), days)
    return (
        usage.where(F.col("usage_date") >= first)
        .groupBy("usage_date", "sku_name", "usage_unit")
        .agg(
            F.sum(units("usage_quantity")).alias("quantity"),
            F.count_distinct("usage_metadata.warehouse_id").alias("warehouses"),
        )
        .select(
            "usage_date",
            "sku_name",
            "usage_unit",
            F.round(from_units(F.col("quantity")), 2).alias("dbus"),
            "warehouses",
        )
        .orderBy(F.desc("usage_date"), F.desc("dbus"), "sku_name", "usage_unit")
    )


def statement_preview(text: str, chars: int = 160) -> Column:
    """Start of the statement with runs of whitespace collapsed."""
    return F.left(F.regexp_replace(text, r"\s+", " "), F.lit(chars))


def expensive_queries(
    history: DataFrame, as_of: str, days: int = 7, min_ms: int = 5000, n: int = 50
) -> DataFrame:
    """SELECT statements with most cumulative run time.

    Texts are cut to their preview before the shuffle, so only previews travel.
    """
    return (
        history.where(
            (F.col("start_time") >= _since(as_of, days)) & (F.col("statement_type") == "SELECT")
        )
        .groupBy(statement_preview("statement_text").alias("statement_preview"))
        .agg(
            F.count(F.lit(1)).alias("executions"),
            F.sum("total_duration_ms").alias("ms"),
            F.count("total_duration_ms").alias("timed"),
            F.sum("read_bytes").alias("bytes"),
            F.sum("read_rows").alias("rows"),
            F.count("read_rows").alias("counted"),
        )
        .where(F.col("ms") > min_ms)
        .orderBy(F.desc("ms"), "statement_preview")
        .limit(n)
        .select(
            "statement_preview",
            "executions",
            F.round(F.col("ms").cast("double") / 1000.0, 1).alias("total_seconds"),
            F.round(ratio(F.col("ms"), F.col("timed")) / 1000.0, 2).alias("avg_seconds"),
            F.round(F.col("bytes").cast("double") / 1e9, 2).alias("total_gb_read"),
            F.round(ratio(F.col("rows"), F.col("counted")), 0).alias("avg_rows_read"),
        )
    )


def pipeline_runs(runs: DataFrame, jobs: DataFrame, name: str = JOB_NAME, n: int = 50) -> DataFrame:
    """The newest runs of one job with their duration."""
    ours = jobs.where(F.col("name") == name).select("job_id", "workspace_id")
    seconds = F.unix_timestamp("period_end_time") - F.unix_timestamp("period_start_time")
    return (
        runs.join(ours, ["job_id", "workspace_id"])
        .select(
            "run_id",
            F.col("period_start_time").alias("started_at"),
            F.col("period_end_time").alias("ended_at"),
            F.round(seconds / 60.0, 1).alias("duration_min"),
            "result_state",
            "termination_code",
        )
        .orderBy(F.desc("started_at"), "run_id")
        .limit(n)
    )


def table_usage(
    lineage: DataFrame, as_of: str, catalog: str = CATALOG, days: int = 30
) -> DataFrame:
    """Reads, readers and last read per table."""
    return (
        lineage.where(
            (F.col("source_table_catalog") == catalog)
            & (F.col("event_time") >= _since(as_of, days))
        )
        .groupBy(F.col("source_table_full_name").alias("table_name"))
        .agg(
            F.count(F.lit(1)).alias("read_events"),
            F.count_distinct("created_by").alias("distinct_users"),
            F.max("event_time").alias("last_read"),
        )
        .orderBy(F.desc("read_events"), "table_name")
    )
