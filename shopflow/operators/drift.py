"""Headline metrics per run, their history, and drift between runs."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..fixed_values import DRIFT_THRESHOLD_PCT
from ..functions.columns import from_units, units
from ..schemas import METRICS_HISTORY

Tables = Mapping[str, DataFrame]


@dataclass(frozen=True)
class Metric:
    """A named scalar: an aggregate over one table."""

    table: str
    value: Callable[[], Column]


def _funnel(column: str) -> Metric:
    return Metric("funnel", lambda: F.max(column))


def _quality(check: str) -> Metric:
    return Metric(
        "data_quality", lambda: F.max(F.when(F.col("check_name") == check, F.col("pct_affected")))
    )


def _whole_amount(column: str) -> Column:
    return F.round(from_units(F.sum(units(column))), 0)


# the ten headline metrics
METRICS: dict[str, Metric] = {
    "bronze_row_count": Metric("bronze_events", lambda: F.count(F.lit(1))),
    "view_to_cart_pct": _funnel("view_to_cart_pct"),
    "cart_to_purchase_pct": _funnel("cart_to_purchase_pct"),
    "view_to_purchase_pct": _funnel("view_to_purchase_pct"),
    "dq_purchase_without_cart_pct": _quality("purchase_without_cart"),
    "dq_missing_category_pct": _quality("missing_category_code"),
    "dq_missing_brand_pct": _quality("missing_brand"),
    "total_revenue": Metric("daily_metrics", lambda: _whole_amount("revenue")),
    "total_sessions": Metric("daily_metrics", lambda: F.sum("sessions")),
    "abandoned_cart_value": Metric(
        "cart_abandonment", lambda: _whole_amount("abandoned_cart_value")
    ),
}


def _evaluate(table: DataFrame, metrics: Mapping[str, Metric], names: Iterable[str]) -> DataFrame:
    """One pass over a table for all its metrics, one row per metric."""
    row = table.agg(*(metrics[n].value().cast("double").alias(n) for n in names))
    pairs = (F.struct(F.lit(n).alias("metric_name"), F.col(n).alias("value")) for n in names)
    return row.select(F.inline(F.array(*pairs)))


def _by_table(metrics: Mapping[str, Metric]) -> dict[str, list[str]]:
    names = defaultdict(list)
    for name, metric in metrics.items():
        names[metric.table].append(name)
    return names


def metric_values(tables: Tables, metrics: Mapping[str, Metric] = METRICS) -> DataFrame:
    """One row per metric, as one plan that reads each table once."""
    rows = [_evaluate(tables[t], metrics, names) for t, names in _by_table(metrics).items()]
    return reduce(DataFrame.unionByName, rows)


def metrics_snapshot(
    spark: SparkSession,
    tables: Tables,
    run_id: str,
    snapshot_ts: datetime,
    metrics: Mapping[str, Metric] = METRICS,
) -> DataFrame:
    """History rows of one run. A metric that fails is recorded as NULL and the run goes on:
    where a table's metrics cannot be had together, each is tried by itself. Only the scalar
    values reach the driver."""
    values: dict[str, float | None] = {}

    def attempt(table: str, names: list[str]) -> None:
        try:
            for row in _evaluate(tables[table], metrics, names).collect():
                values[row["metric_name"]] = row["value"]
        except (PySparkException, KeyError):
            if len(names) > 1:
                for name in names:
                    attempt(table, [name])

    for table, names in _by_table(metrics).items():
        attempt(table, names)
    rows = [(name, values.get(name), snapshot_ts, run_id) for name in metrics]
    return spark.createDataFrame(rows, METRICS_HISTORY)


def previous_metrics(history: DataFrame, before_run: str) -> DataFrame:
    """The latest recorded value of each metric among the other runs."""
    return (
        history.where(F.col("run_id") != before_run)
        .groupBy("metric_name")
        .agg(F.max_by("value", F.struct("snapshot_ts", "run_id")).alias("value"))
    )


def metric_drift(
    current: DataFrame, previous: DataFrame, threshold: float = DRIFT_THRESHOLD_PCT
) -> DataFrame:
    """Relative change per current metric.

    No current value is an error, no previous value a baseline; a move away from zero
    counts as infinite. A change of exactly the threshold is drift.
    """
    cur, old = F.col("current_value"), F.col("previous_value")
    change = F.when(
        cur.isNotNull() & old.isNotNull(),
        F.when(old != 0, (cur - old) / F.nullif(old, F.lit(0.0)) * 100)
        .when(cur == 0, F.lit(0.0))
        .otherwise(F.lit(float("inf"))),
    )
    return (
        current.select("metric_name", F.col("value").alias("current_value"))
        .join(
            previous.select("metric_name", F.col("value").alias("previous_value")),
            "metric_name",
            "left",
        )
        .select("metric_name", "previous_value", "current_value", change.alias("pct_change"))
        .withColumn(
            "status",
            F.when(cur.isNull(), "error")
            .when(old.isNull(), "baseline")
            .when(F.abs("pct_change") >= threshold, "drift")
            .otherwise("ok"),
        )
    )
