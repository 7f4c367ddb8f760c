"""Threshold alerts over gold tables: each is one value, evaluated as a one-row table."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..fixed_values import CART_GAP_LIMIT, STALE_HOURS_LIMIT, UNLABELED_LIMIT


@dataclass(frozen=True)
class Rule:
    """``value`` (a one-row, one-column table) must not exceed ``threshold``."""

    name: str
    value: DataFrame
    threshold: float
    reason: str


def evaluate(rule: Rule) -> DataFrame:
    """The rule's value and whether it breaches. A missing value is not a breach."""
    value = rule.value.select(F.col(rule.value.columns[0]).cast("double").alias("value"))
    return value.select(
        F.lit(rule.name).alias("alert_name"),
        "value",
        F.lit(rule.threshold).alias("threshold"),
        F.coalesce(F.col("value") > rule.threshold, F.lit(False)).alias("breached"),
        F.lit(rule.reason).alias("reason"),
    )


def _check_value(data_quality: DataFrame, check: str) -> DataFrame:
    return data_quality.where(F.col("check_name") == check).select("pct_affected")


def cart_gap(data_quality: DataFrame, limit: float = CART_GAP_LIMIT) -> Rule:
    return Rule(
        "cart_gap",
        _check_value(data_quality, "purchase_without_cart"),
        limit,
        "most of the funnel's cart stage would be inferred, not measured",
    )


def stale_gold(daily_metrics: DataFrame, as_of: str, limit: float = STALE_HOURS_LIMIT) -> Rule:
    """Hours from the latest day in the data to ``as_of`` (a date)."""
    hours = F.date_diff(F.lit(as_of).cast("date"), F.max("event_date")) * 24
    return Rule(
        "stale_gold",
        daily_metrics.agg(hours.alias("hours_since_latest_data")),
        limit,
        "more than one scheduled refresh was missed",
    )


def unlabeled_category(data_quality: DataFrame, limit: float = UNLABELED_LIMIT) -> Rule:
    return Rule(
        "unlabeled_category",
        _check_value(data_quality, "missing_category_code"),
        limit,
        "category rankings would leave out too much of the catalogue",
    )


def standard_rules(
    tables: Mapping[str, DataFrame],
    as_of: str,
    cart_gap_limit: float = CART_GAP_LIMIT,
    stale_hours_limit: float = STALE_HOURS_LIMIT,
    unlabeled_limit: float = UNLABELED_LIMIT,
) -> list[Rule]:
    return [
        cart_gap(tables["data_quality"], cart_gap_limit),
        stale_gold(tables["daily_metrics"], as_of, stale_hours_limit),
        unlabeled_category(tables["data_quality"], unlabeled_limit),
    ]


def evaluate_alerts(rules: list[Rule]) -> DataFrame:
    return reduce(DataFrame.unionByName, (evaluate(rule) for rule in rules))
