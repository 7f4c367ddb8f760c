"""The whole run over raw files, twice, with a new month in between."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from shopflow.operators import descriptive, drift, layout
from shopflow.plans import build
from shopflow.plans.build import build_all
from shopflow.plans.layers import GOLD
from shopflow.sources.raw_csv import read_raw, write_raw
from shopflow.sources.testdata import staged_bronze

SF = "/root/testdata/sf0.001"
PARAMETERS = dict(anchor="medium.ring", split_date="2024-01-03", recency_anchor="2024-02-01")


@pytest.fixture(scope="module")
def runs(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lake"))
    raw = f"{root}/raw"
    staged = staged_bronze(spark, SF)
    first = F.col("event_time") < "2024-01-16"
    write_raw(staged.where(first), f"{raw}/2024-01-a")
    one = build_all(spark, raw, f"{root}/out", "r1", datetime(2024, 1, 16), **PARAMETERS)
    kept = {
        "drift": one.drift.collect(),
        "funnel": spark.table("gold.funnel").first(),
        "rows": one.rows_ingested,
    }
    write_raw(staged.where(~first), f"{raw}/2024-01-b")
    two = build_all(spark, raw, f"{root}/out", "r2", datetime(2024, 2, 1), **PARAMETERS)
    return raw, kept, two


def test_second_run_loads_only_the_new_files(spark, runs):
    raw, first, second = runs
    total = staged_bronze(spark, SF).count()
    assert first["rows"] + second.rows_ingested == total
    assert spark.table("bronze.events").count() == total
    assert read_raw(spark, raw).count() == total


def test_all_tables_exist_and_match_a_direct_computation(spark, runs):
    for name in GOLD:
        assert spark.table(f"gold.{name}").columns
    bronze = spark.table("bronze.events")
    from shopflow.operators import silver

    direct = descriptive.funnel(silver.dim_session(silver.fact_events(bronze))).first()
    assert spark.table("gold.funnel").first() == direct
    assert spark.table("gold.funnel").first() != runs[1]["funnel"]


def test_drift_compares_with_the_run_before(spark, runs):
    _, first, second = runs
    assert {r["status"] for r in first["drift"]} == {"baseline"}
    status = {r["metric_name"]: r["status"] for r in second.drift.collect()}
    assert len(status) == 10
    assert status["total_revenue"] == "drift"
    assert spark.table("ops.metrics_history").count() == 20


def test_alerts_and_reconciliation(spark, runs):
    second = runs[2]
    alerts = {r["alert_name"]: r for r in second.alerts.collect()}
    assert set(alerts) == {"cart_gap", "stale_gold", "unlabeled_category"}
    assert alerts["stale_gold"]["value"] == 48.0 and alerts["stale_gold"]["breached"]
    counts = second.reconciliation.first()
    assert counts["accepted_rows"] == counts["fact_rows"] + counts["duplicate_rows"]
    assert counts["bronze_rows"] == counts["accepted_rows"] + counts["rows_other_event_type"]


def test_integrity_report_is_clean(runs):
    for row in runs[2].integrity.collect():
        for column in ("duplicated_keys", "null_key_rows", "orphan_rows", "violations"):
            assert not row[column]


def test_comments_and_statistics_are_stored(spark, runs):
    described = {
        r["col_name"]: r for r in spark.sql("DESCRIBE EXTENDED silver.fact_events").collect()
    }
    assert described["price"]["comment"]
    assert described["Comment"]["data_type"]
    assert "rows" in described["Statistics"]["data_type"]
    column = spark.sql("DESCRIBE EXTENDED silver.fact_events event_type").collect()
    stats = {r["info_name"]: r["info_value"] for r in column}
    assert stats["distinct_count"] == "3"


def test_tags_comments_and_inventory_are_stored(spark, runs):
    assert spark.table("pii_inventory").count() > 0
    tagged = spark.table("ops.column_tags").where("tag_name = 'pii'")
    assert spark.table("pii_inventory").count() == tagged.count()
    assert spark.table("ops.table_tags").count() > 0
    described = spark.sql("DESCRIBE DATABASE gold").collect()
    assert {r["info_name"]: r["info_value"] for r in described}["Comment"]


def test_compaction_keeps_the_ranges_apart(spark, runs, tmp_path):
    fact = spark.table("silver.fact_events")
    small, large = str(tmp_path / "small"), str(tmp_path / "large")
    layout.clustered(fact, files=16).write.parquet(small)
    size = layout.stored_bytes(spark, small)
    files = layout.compact(spark, small, large, layout.FACT_KEYS, target_bytes=size // 3)
    assert 3 <= files < 16
    ranges = (
        spark.read.parquet(large)
        .groupBy(F.col("_metadata.file_path").alias("file"))
        .agg(F.min("event_date").alias("lo"), F.max("event_date").alias("hi"))
        .orderBy("lo", "hi")
        .collect()
    )
    assert len(ranges) > 1
    assert all(a["hi"] <= b["lo"] for a, b in zip(ranges, ranges[1:]))


def test_a_run_can_be_repeated_with_other_metrics_and_limits(spark, runs, monkeypatch):
    monkeypatch.setattr(build, "HISTORY_FILES", 2)
    raw, _, second = runs
    root = raw.rsplit("/", 1)[0]
    metrics = {**drift.METRICS, "days": drift.Metric("daily_metrics", lambda: F.count(F.lit(1)))}
    again = build_all(
        spark, raw, f"{root}/out", "r2", datetime(2024, 2, 1),
        metrics=metrics, alert_limits={"stale_hours_limit": 1000.0}, **PARAMETERS,
    )
    assert again.rows_ingested == 0
    alerts = {r["alert_name"]: r for r in again.alerts.collect()}
    assert not alerts["stale_gold"]["breached"]
    history = spark.table("ops.metrics_history")
    assert history.count() == 21 and history.where("run_id = 'r2'").count() == 11
    assert "days" in {r["metric_name"] for r in again.drift.collect()}
    assert len(history.inputFiles()) == 1  # its small files are merged


def test_clustered_fact_keeps_dates_together(spark, runs):
    parts = (
        layout.clustered(spark.table("silver.fact_events"), files=4)
        .groupBy(F.spark_partition_id().alias("p"))
        .agg(F.min("event_date").alias("lo"), F.max("event_date").alias("hi"))
        .orderBy("p")
        .collect()
    )
    assert len(parts) > 1
    assert all(a["hi"] <= b["lo"] for a, b in zip(parts, parts[1:]))
