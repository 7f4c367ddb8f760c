"""The platform reports and the inventory of personal data as catalog views.

A view is stored as SQL over catalog tables, so it outlives the session that made it and always
shows the tables' present rows. The texts give the results of ``operators.ops`` and
``operators.governance``; amounts are summed as decimals here as well.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession

from ..fixed_values import CATALOG, JOB_NAME

# the tables a view reads, by the name its text uses
SOURCES = {
    "usage": "ops.usage",
    "history": "ops.query_history",
    "runs": "ops.job_runs",
    "jobs": "ops.jobs",
    "lineage": "ops.lineage",
    "tags": "ops.column_tags",
}

TEXTS = {
    "daily_dbu_cost": """
SELECT usage_date, sku_name, usage_unit,
       round(CAST(sum(CAST(usage_quantity AS DECIMAL(28,10))) AS DOUBLE), 2) AS dbus,
       count(DISTINCT usage_metadata.warehouse_id) AS warehouses
FROM {usage} WHERE usage_date >= date_sub({today}, {usage_days})
GROUP BY usage_date, sku_name, usage_unit ORDER BY usage_date DESC, dbus DESC, sku_name, usage_unit""",
    "expensive_queries": r"""
SELECT statement_preview, executions, round(CAST(ms AS DOUBLE) / 1000.0D, 1) AS total_seconds,
       round(CAST(ms AS DOUBLE) / nullif(timed, 0) / 1000.0D, 2) AS avg_seconds,
       round(CAST(bytes AS DOUBLE) / 1e9D, 2) AS total_gb_read,
       round(CAST(counted_rows AS DOUBLE) / nullif(counted, 0), 0) AS avg_rows_read
FROM (SELECT left(regexp_replace(statement_text, r'\s+', ' '), 160) AS statement_preview, count(*) AS executions,
             sum(total_duration_ms) AS ms, count(total_duration_ms) AS timed, sum(read_bytes) AS bytes,
             sum(read_rows) AS counted_rows, count(read_rows) AS counted
      FROM {history}
      WHERE start_time >= CAST({today} AS TIMESTAMP) - INTERVAL {query_days} DAYS AND statement_type = 'SELECT'
      GROUP BY 1)
WHERE ms > 5000 ORDER BY ms DESC, statement_preview LIMIT 50""",
    "pipeline_runs": """
SELECT run_id, period_start_time AS started_at, period_end_time AS ended_at,
       round((unix_timestamp(period_end_time) - unix_timestamp(period_start_time)) / 60.0D, 1) AS duration_min,
       result_state, termination_code
FROM {runs} JOIN {jobs} USING (job_id, workspace_id) WHERE name = '{job}'
ORDER BY started_at DESC, run_id LIMIT 50""",
    "table_usage": """
SELECT source_table_full_name AS table_name, count(*) AS read_events,
       count(DISTINCT created_by) AS distinct_users, max(event_time) AS last_read
FROM {lineage}
WHERE source_table_catalog = '{catalog}' AND event_time >= CAST({today} AS TIMESTAMP) - INTERVAL {read_days} DAYS
GROUP BY source_table_full_name ORDER BY read_events DESC, table_name""",
    "pii_inventory": """
SELECT catalog_name, schema_name, table_name, column_name,
       max(tag_value) FILTER (WHERE tag_name = 'pii') AS pii_class,
       max(tag_value) FILTER (WHERE tag_name = 'sensitivity') AS sensitivity
FROM {tags} WHERE catalog_name = '{catalog}' GROUP BY catalog_name, schema_name, table_name, column_name
HAVING pii_class IS NOT NULL ORDER BY schema_name, table_name, column_name""",
}


def create_views(
    spark: SparkSession,
    database: str = "ops",
    sources: Mapping[str, str] = SOURCES,
    as_of: str | None = None,
    job: str = JOB_NAME,
    catalog: str = CATALOG,
    usage_days: int = 30,
    query_days: int = 7,
    read_days: int = 30,
) -> list[str]:
    """Create or replace every view whose tables exist; returns their names. Without ``as_of``
    a view's window of days ends on the day it is read."""
    present = {name: table for name, table in sources.items() if spark.catalog.tableExists(table)}
    values = {
        **present,
        "today": f"DATE '{as_of}'" if as_of else "current_date()",
        "job": job,
        "catalog": catalog,
        "usage_days": int(usage_days),
        "query_days": int(query_days),
        "read_days": int(read_days),
    }
    made = []
    for name, text in TEXTS.items():
        if all(table in present for table in SOURCES if "{" + table + "}" in text):
            spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS {text.format(**values)}")
            made.append(f"{database}.{name}")
    return made
