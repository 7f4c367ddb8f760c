"""The tables of one run as DataFrames, each defined once from the bronze events."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame

from ..fixed_values import (
    ANCHOR_CATEGORY,
    ELEVATED_CUTS,
    MEGA_CUTS,
    RECENCY_ANCHOR,
    SPLIT_DATE,
)
from ..operators import deep_dive, descriptive, diagnostic, quality, silver


class Layers:
    """Lazy silver and gold tables. Nothing runs until a table is written or shown."""

    def __init__(
        self,
        bronze: DataFrame,
        fact: DataFrame | None = None,
        session: DataFrame | None = None,
        rollup: DataFrame | None = None,
        *,
        anchor: str = ANCHOR_CATEGORY,
        mega: int = MEGA_CUTS,
        elevated: int = ELEVATED_CUTS,
        period: str = "month",
        split_date: str = SPLIT_DATE,
        recency_anchor: str = RECENCY_ANCHOR,
    ):
        self.bronze_events = bronze
        self.anchor = anchor
        self.mega, self.elevated, self.period = mega, elevated, period
        self.split_date, self.recency_anchor = split_date, recency_anchor
        self.rollup = rollup
        if fact is not None:
            self.fact_events = fact
        if session is not None:
            self.dim_session = session

    @cached_property
    def fact_events(self) -> DataFrame:
        return silver.fact_events(self.bronze_events)

    @property
    def events(self) -> DataFrame:
        """What the summing operators read: the stored rollup if there is one."""
        return self.fact_events if self.rollup is None else self.rollup

    @cached_property
    def dim_product(self) -> DataFrame:
        return silver.dim_product(self.bronze_events)

    @cached_property
    def dim_session(self) -> DataFrame:
        return silver.dim_session(self.events)

    @cached_property
    def daily_metrics(self) -> DataFrame:
        return descriptive.daily_metrics(self.events)

    @cached_property
    def funnel(self) -> DataFrame:
        return descriptive.funnel(self.dim_session)

    @cached_property
    def cart_abandonment(self) -> DataFrame:
        return descriptive.cart_abandonment(self.fact_events, self.dim_session)

    @cached_property
    def category_performance(self) -> DataFrame:
        return descriptive.category_performance(self.events)

    @cached_property
    def brand_performance(self) -> DataFrame:
        return descriptive.brand_performance(self.events)

    @cached_property
    def top_products(self) -> DataFrame:
        return descriptive.top_products(self.events)

    @cached_property
    def user_summary(self) -> DataFrame:
        return descriptive.user_summary(self.events)

    @cached_property
    def hourly_pattern(self) -> DataFrame:
        return descriptive.hourly_pattern(self.fact_events)

    @cached_property
    def data_quality(self) -> DataFrame:
        return quality.data_quality(self.bronze_events, self.fact_events, self.dim_session)

    @cached_property
    def intent_by_view_depth(self) -> DataFrame:
        return diagnostic.intent_by_view_depth(self.events)

    @cached_property
    def cart_conversion_by_price(self) -> DataFrame:
        return diagnostic.cart_conversion_by_price(self.events)

    @cached_property
    def attach_opportunity(self) -> DataFrame:
        return diagnostic.attach_opportunity(self.events, self.anchor)

    @cached_property
    def price_change_effect(self) -> DataFrame:
        return diagnostic.price_change_effect(self.events)

    @cached_property
    def category_recovery_check(self) -> DataFrame:
        return diagnostic.category_recovery_check(self.fact_events)

    @cached_property
    def discount_tier_analysis(self) -> DataFrame:
        return deep_dive.discount_tier_analysis(
            self.events, self.mega, self.elevated, self.period
        )

    @cached_property
    def november_cohort_behavior(self) -> DataFrame:
        return deep_dive.cohort_behavior(self.events, self.split_date).withColumnRenamed(
            "conversion_pct", "november_conversion_pct"
        )

    @cached_property
    def rfm_segmentation(self) -> DataFrame:
        return deep_dive.rfm_segmentation(self.events, self.recency_anchor)

    @cached_property
    def buyer_retention_oct_to_nov(self) -> DataFrame:
        return deep_dive.buyer_retention(self.events, self.split_date).withColumnsRenamed(
            {"period_1_buyers": "october_buyers", "returned": "returned_in_november"}
        )

    def __getitem__(self, name: str) -> DataFrame:
        return getattr(self, name)


# build order of the gold layer: descriptive, quality, diagnostic, deep dive
GOLD = (
    "daily_metrics",
    "funnel",
    "cart_abandonment",
    "category_performance",
    "brand_performance",
    "top_products",
    "user_summary",
    "hourly_pattern",
    "data_quality",
    "intent_by_view_depth",
    "cart_conversion_by_price",
    "attach_opportunity",
    "price_change_effect",
    "category_recovery_check",
    "discount_tier_analysis",
    "november_cohort_behavior",
    "rfm_segmentation",
    "buyer_retention_oct_to_nov",
)
