from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from shopflow.operators import alerts, drift
from shopflow.schemas import METRICS_HISTORY
from tests.events import one, rows

PAIR = "metric_name string, value double"


def changes(spark, current, previous, threshold=10.0):
    table = drift.metric_drift(
        spark.createDataFrame(current, PAIR), spark.createDataFrame(previous, PAIR), threshold
    )
    return {r["metric_name"]: (r["pct_change"], r["status"]) for r in rows(table)}


def test_drift_cases(spark):
    got = changes(
        spark,
        [
            ("new", 5.0),
            ("old_null", 5.0),
            ("failed", None),
            ("still_zero", 0.0),
            ("from_zero", 5.0),
            ("up", 110.0),
            ("down", 90.0),
            ("under", 109.99),
        ],
        [
            ("old_null", None),
            ("failed", 1.0),
            ("still_zero", 0.0),
            ("from_zero", 0.0),
            ("up", 100.0),
            ("down", 100.0),
            ("under", 100.0),
            ("retired", 1.0),
        ],
    )
    assert got["new"] == (None, "baseline") and got["old_null"] == (None, "baseline")
    assert got["failed"] == (None, "error")
    assert got["still_zero"] == (0.0, "ok")
    assert got["from_zero"] == (float("inf"), "drift")
    assert got["up"] == (10.0, "drift") and got["down"] == (-10.0, "drift")
    assert got["under"][1] == "ok"
    assert "retired" not in got


def test_previous_metrics_takes_the_latest_other_run(spark):
    def row(metric, value, day, run):
        return (metric, value, datetime(2024, 1, day), run)

    history = spark.createDataFrame(
        [
            row("a", 1.0, 1, "r1"),
            row("a", 2.0, 2, "r2"),
            row("a", 3.0, 3, "r3"),
            row("b", 9.0, 1, "r1"),
            row("b", None, 2, "r2"),
            row("c", 7.0, 3, "r3"),
        ],
        METRICS_HISTORY,
    )
    got = {r["metric_name"]: r["value"] for r in rows(drift.previous_metrics(history, "r3"))}
    assert got == {"a": 2.0, "b": None}


def test_snapshot_survives_a_failing_metric(spark):
    good = spark.range(3)
    metrics = {
        "rows": drift.Metric("good", lambda: F.count("*")),
        "no_table": drift.Metric("missing", lambda: F.count("*")),
        "no_column": drift.Metric("good", lambda: F.max("nope")),
        "fails": drift.Metric("good", lambda: F.max(F.raise_error(F.lit("boom")).cast("int"))),
        "empty": drift.Metric("good", lambda: F.max(F.when(F.col("id") < 0, 1))),
    }
    at = datetime(2024, 1, 1)
    got = rows(drift.metrics_snapshot(spark, {"good": good}, "r1", at, metrics))
    assert {r["metric_name"]: r["value"] for r in got} == {
        "rows": 3.0,
        "no_table": None,
        "no_column": None,
        "fails": None,
        "empty": None,
    }
    assert {r["run_id"] for r in got} == {"r1"}


@pytest.mark.parametrize("value, breached", [(60.0, False), (60.01, True), (None, False)])
def test_alert_threshold_is_strict(spark, value, breached):
    quality = spark.createDataFrame(
        [("purchase_without_cart", value), ("missing_category_code", 99.0)],
        "check_name string, pct_affected double",
    )
    got = one(alerts.evaluate(alerts.cart_gap(quality)))
    assert (got["value"], got["breached"]) == (value, breached)


def test_stale_gold_counts_hours_from_midnight(spark):
    daily = spark.createDataFrame([("2024-01-01",), ("2024-01-03",)], "d string").select(
        F.col("d").cast("date").alias("event_date")
    )
    for as_of, hours, breached in (("2024-01-04", 24.0, False), ("2024-01-05", 48.0, True)):
        got = one(alerts.evaluate(alerts.stale_gold(daily, as_of)))
        assert (got["value"], got["breached"]) == (hours, breached)
    empty = one(alerts.evaluate(alerts.stale_gold(daily.limit(0), "2024-01-05")))
    assert (empty["value"], empty["breached"]) == (None, False)
