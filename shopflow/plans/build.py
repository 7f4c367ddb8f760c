"""The whole run: raw files -> bronze -> silver -> gold -> checks, drift, alerts.

Every layer is written before the next one reads it, so each later query scans only the
columns it needs of a finished table. Tables are replaced as new versions; a failed run
leaves the previous ones in place and can simply be started again, under the same id: every
attempt writes its own versions, and the metric history keeps one set of rows per run.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import alerts, drift, governance, integrity, layout, quality, rollup, silver
from ..schemas import BRONZE_EVENTS, METRICS_HISTORY
from ..session import prepare
from ..sources import tables
from ..streaming.ingest import ingest
from .layers import GOLD, Layers
from .views import create_views

# gold tables are independent of each other; small ones would leave a cluster idle
CONCURRENT_TABLES = 4
# the metric history is merged when it has this many small files
HISTORY_KEYS, HISTORY_FILES = ("snapshot_ts", "metric_name"), 8


@dataclass(frozen=True)
class Run:
    """What a run leaves for the caller to decide on."""

    rows_ingested: int
    integrity: DataFrame
    reconciliation: DataFrame
    drift: DataFrame
    alerts: DataFrame


def _publish(table: DataFrame, name: str, root: str, version: str) -> DataFrame:
    done = tables.replace_table(
        governance.with_column_comments(table, name), name, root, version
    )
    governance.comment_on_table(done.sparkSession, name)
    return done


def build_bronze(spark: SparkSession, raw: str, root: str) -> int:
    """Load the files that arrived since the last run."""
    location = f"{root}/bronze/events"
    added = ingest(spark, raw, location, f"{root}/ledger/bronze_events")
    tables.create_table(spark, "bronze.events", BRONZE_EVENTS, location)
    governance.comment_on_table(spark, "bronze.events")
    spark.catalog.refreshTable("bronze.events")
    return added


def _bucket_count(spark: SparkSession, path: str) -> int:
    """Buckets of about a file's size, at least one per core, at most what Spark allows."""
    files = layout.file_count(layout.stored_bytes(spark, path))
    most = int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets"))
    return min(most, max(files, spark.sparkContext.defaultParallelism))


def build_silver(spark: SparkSession, root: str, version: str) -> None:
    bronze = spark.table("bronze.events")
    fact = integrity.enforce_domain(silver.fact_events(bronze))
    files = layout.file_count(layout.stored_bytes(spark, f"{root}/bronze/events"))
    files = max(files, spark.sparkContext.defaultParallelism)
    _publish(layout.clustered(fact, files=files), "silver.fact_events", root, version)
    _publish(silver.dim_product(bronze), "silver.dim_product", root, version)
    rolled = tables.replace_bucketed(
        rollup.session_rollup(spark.table("silver.fact_events")),
        "silver.session_rollup",
        root,
        version,
        rollup.BUCKET_KEY,
        _bucket_count(spark, f"{root}/silver/fact_events/{version}"),
    )
    _publish(silver.dim_session(rolled), "silver.dim_session", root, version)
    for name in layout.STATISTICS_COLUMNS:
        layout.analyze(spark, name)


def build_gold(
    spark: SparkSession, root: str, version: str, names: Iterable[str] = GOLD, **parameters
) -> None:
    layers = Layers(
        spark.table("bronze.events"),
        spark.table("silver.fact_events"),
        spark.table("silver.dim_session"),
        spark.table("silver.session_rollup"),
        **parameters,
    )
    with ThreadPoolExecutor(CONCURRENT_TABLES) as pool:
        list(pool.map(lambda n: _publish(layers[n], f"gold.{n}", root, version), names))


def gold_tables(spark: SparkSession) -> dict[str, DataFrame]:
    return {
        "bronze_events": spark.table("bronze.events"),
        **{name: spark.table(f"gold.{name}") for name in GOLD},
    }


def build_governance(spark: SparkSession, root: str, version: str) -> None:
    """Schema comments, the tags as tables, and the stored views whose tables exist."""
    for name in tables.DATABASES:
        governance.comment_on_database(spark, name)
    tags = _publish(governance.column_tags(spark), "ops.column_tags", root, version)
    _publish(governance.table_tags(spark), "ops.table_tags", root, version)
    tables.create_view(governance.pii_inventory(tags), "pii_inventory")
    create_views(spark)


def record_drift(
    spark: SparkSession,
    root: str,
    run_id: str,
    at: datetime,
    threshold: float,
    version: str,
    metrics: Mapping[str, drift.Metric] = drift.METRICS,
) -> DataFrame:
    """Append this run's metrics to the history and compare with the run before.

    The previous values are read before the current ones are appended. Rows that an earlier
    attempt of this run left are replaced.
    """
    history = tables.create_table(
        spark, "ops.metrics_history", METRICS_HISTORY, f"{root}/ops/metrics_history"
    )
    rows = drift.previous_metrics(history, run_id).collect()  # one row per metric
    previous = spark.createDataFrame(rows, "metric_name string, value double")
    current = drift.metrics_snapshot(spark, gold_tables(spark), run_id, at, metrics)
    if history.where(F.col("run_id") == run_id).isEmpty():
        tables.append(current, "ops.metrics_history")
    else:
        others = history.where(~F.col("run_id").eqNullSafe(run_id))
        tables.replace_table(others.unionByName(current), "ops.metrics_history", root, version)
    # every run appends a few rows in files of their own
    layout.compact_small(spark, tables.location(spark, "ops.metrics_history"), HISTORY_KEYS, least_files=HISTORY_FILES)
    spark.catalog.refreshTable("ops.metrics_history")
    return drift.metric_drift(current, previous, threshold)


def integrity_report(spark: SparkSession) -> DataFrame:
    fact = spark.table("silver.fact_events")
    product, session = spark.table("silver.dim_product"), spark.table("silver.dim_session")
    checks = (
        integrity.key_check(product, "dim_product_key", "product_id"),
        integrity.key_check(session, "dim_session_key", "user_session"),
        integrity.reference_check(fact, "product_id", product, "product_id", "fact_product"),
        integrity.reference_check(
            fact, "user_session", session, "user_session", "fact_session"
        ),
        integrity.domain_check(fact, "fact_event_type"),
    )
    return tables.union_evolving(*checks)


def build_all(
    spark: SparkSession,
    raw: str,
    root: str,
    run_id: str,
    at: datetime,
    drift_threshold: float = drift.DRIFT_THRESHOLD_PCT,
    metrics: Mapping[str, drift.Metric] = drift.METRICS,
    alert_limits: Mapping[str, float] | None = None,
    **parameters,
) -> Run:
    """One full run. ``run_id`` names it in the metric history; a failed run is repeated under
    its id. ``metrics`` are recorded and compared; ``alert_limits`` are limits of
    ``alerts.standard_rules`` by name."""
    prepare(spark)
    version = f"{run_id}-{uuid.uuid4().hex[:8]}"
    tables.create_databases(spark)
    added = build_bronze(spark, raw, root)
    build_silver(spark, root, version)
    build_gold(spark, root, version, **parameters)
    build_governance(spark, root, version)
    moved = record_drift(spark, root, run_id, at, drift_threshold, version, metrics)
    gold = gold_tables(spark)
    return Run(
        rows_ingested=added,
        integrity=integrity_report(spark),
        reconciliation=quality.layer_reconciliation(
            gold["bronze_events"],
            spark.table("silver.fact_events"),
            spark.table("silver.dim_session"),
            spark.table("silver.dim_product"),
        ),
        drift=moved,
        alerts=alerts.evaluate_alerts(
            alerts.standard_rules(gold, at.date().isoformat(), **(alert_limits or {}))
        ),
    )
