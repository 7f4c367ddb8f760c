"""Queries behind dashboards and assistants. Each reads finished gold tables.

Gold tables are never joined to each other: every one is aggregated on its own grain.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..fixed_values import BUYER_LAST, BUYER_STEPS, FUNNEL_STAGES, INTENT_LAST
from ..functions.columns import UNKNOWN, below, from_units, mean_of_units, pct, units


def _top(table: DataFrame, n: int, by: str, tie: str) -> DataFrame:
    return table.orderBy(F.desc(by), tie).limit(n)


def dash_funnel(funnel: DataFrame) -> DataFrame:
    return funnel


def dash_daily(daily_metrics: DataFrame) -> DataFrame:
    return daily_metrics.orderBy("event_date")


def dash_funnel_stages(funnel: DataFrame) -> DataFrame:
    """The funnel row turned into one row per stage."""
    stages = F.array(
        *(
            F.struct(F.lit(label).alias("stage"), F.col(column).alias("sessions"))
            for label, column in FUNNEL_STAGES
        )
    )
    return funnel.select(F.inline(stages)).orderBy("stage")


def dash_data_quality(data_quality: DataFrame) -> DataFrame:
    return data_quality.select(
        "check_name", "description", "affected_rows", "pct_affected", "business_impact"
    ).orderBy(F.desc_nulls_last("pct_affected"), "check_name")


def dash_intent(intent: DataFrame) -> DataFrame:
    label = F.concat(F.col("band_order").cast("string"), F.lit(". "), F.col("view_band"))
    return intent.orderBy("band_order").select(
        label.alias("view_band"), "conversion_pct", "unconverted_value", "unconverted_pairs"
    )


def dash_price_bands(price_bands: DataFrame) -> DataFrame:
    return price_bands.select(
        "price_band", "cart_conversion_pct", "carted_items", "abandoned_value"
    ).orderBy("price_band")


def dash_attach(attach: DataFrame, n: int = 8) -> DataFrame:
    return _top(attach, n, "sessions", "attached_category").select(
        "attached_category", "sessions", "pct_of_phone_buyers", "revenue"
    )


def dash_repeat_buyers(user_summary: DataFrame) -> DataFrame:
    """Users and spend by how often they bought."""
    return (
        user_summary.groupBy(
            below(F.col("purchase_count"), BUYER_STEPS, BUYER_LAST).alias("buyer_segment")
        )
        .agg(
            F.count(F.lit(1)).alias("users"),
            F.round(from_units(F.sum(units("total_spend"))), 0).alias("total_spend"),
        )
        .orderBy("buyer_segment")
    )


def dash_abandonment(cart_abandonment: DataFrame) -> DataFrame:
    return cart_abandonment.orderBy("event_date")


def dash_categories(category_performance: DataFrame, n: int = 15) -> DataFrame:
    labelled = category_performance.where(F.col("category_code") != UNKNOWN)
    return _top(labelled, n, "revenue", "category_code")


def dash_brands(brand_performance: DataFrame, n: int = 15) -> DataFrame:
    return _top(brand_performance, n, "revenue", "brand")


def dash_hourly(hourly_pattern: DataFrame) -> DataFrame:
    return hourly_pattern.orderBy("hour_of_day")


def dash_top_products(top_products: DataFrame, n: int = 25) -> DataFrame:
    return _top(top_products, n, "revenue", "product_id").select(
        "product_id", "category_code", "brand", "views", "purchases", "revenue"
    )


def dash_totals(daily_metrics: DataFrame) -> DataFrame:
    """Headline counters. Users and sessions are sums of daily counts and the conversion
    is an unweighted mean of days."""
    rate = "conversion_rate_pct"
    mean = mean_of_units(F.sum(units(rate)), F.count(rate))
    return daily_metrics.agg(
        from_units(F.sum(units("revenue"))).alias("total_revenue"),
        F.sum("sessions").alias("total_sessions"),
        F.sum("unique_users").alias("total_users"),
        mean.alias("avg_conversion_pct"),
    )


def dash_totals_exact(user_summary: DataFrame, dim_session: DataFrame) -> DataFrame:
    """The same counters over the whole period: each user and session once, pooled conversion."""
    users = user_summary.agg(F.count("user_id"))
    return dim_session.agg(
        from_units(F.sum(units("session_revenue"))).alias("total_revenue"),
        F.count(F.lit(1)).alias("total_sessions"),
        F.count_if("has_purchase").alias("buying"),
    ).select(
        "total_revenue",
        "total_sessions",
        users.scalar().alias("total_users"),
        pct(F.col("buying"), F.col("total_sessions")).alias("conversion_pct"),
    )


def dash_abandoned_total(cart_abandonment: DataFrame) -> DataFrame:
    return cart_abandonment.agg(
        from_units(F.sum(units("abandoned_cart_value"))).alias("abandoned_value")
    )


def _millions(amount: Column) -> Column:
    return F.round(from_units(F.sum(amount)) / 1e6, 1)


def booth_headline(
    daily_metrics: DataFrame,
    cart_abandonment: DataFrame,
    intent: DataFrame,
    attach_rate: DataFrame,
    top_band: str = INTENT_LAST,
) -> DataFrame:
    """Four headline numbers, each a scalar over its own table."""
    revenue = daily_metrics.agg(_millions(units("revenue")))
    lost = cart_abandonment.agg(_millions(units("abandoned_cart_value")))
    pool = intent.where(F.col("view_band") == top_band).agg(_millions(units("unconverted_value")))
    return attach_rate.select(
        revenue.scalar().alias("revenue_m"),
        lost.scalar().alias("abandoned_m"),
        pool.scalar().alias("intent_pool_m"),
        "attach_pct",
    )


def booth_price_bands(price_bands: DataFrame) -> DataFrame:
    return price_bands.select("price_band", "cart_conversion_pct").orderBy("price_band")


def booth_attach(attach: DataFrame, n: int = 6) -> DataFrame:
    return _top(attach, n, "sessions", "attached_category").select("attached_category", "sessions")


def booth_intent(intent: DataFrame) -> DataFrame:
    return intent.orderBy("band_order").select("view_band", "conversion_pct")


def ask_funnel(funnel: DataFrame) -> DataFrame:
    return funnel.select(
        "sessions_with_view",
        "sessions_with_cart",
        "sessions_with_purchase",
        "view_to_cart_pct",
        "cart_to_purchase_pct",
        "view_to_purchase_pct",
    )


def ask_browsed_not_bought(category_performance: DataFrame, min_views: int = 100_000) -> DataFrame:
    """Much-viewed labelled categories, worst conversion first."""
    return (
        category_performance.where(
            (F.col("category_code") != UNKNOWN) & (F.col("views") > min_views)
        )
        .select("category_code", "views", "purchases", "revenue", "view_to_purchase_pct")
        .orderBy("view_to_purchase_pct", "category_code")
    )


def ask_abandonment(cart_abandonment: DataFrame) -> DataFrame:
    return cart_abandonment.agg(
        F.sum("abandoned_sessions").alias("abandoned_sessions"),
        from_units(F.sum(units("abandoned_cart_value"))).alias("abandoned_cart_value"),
    )


def ask_repeat_buyers(user_summary: DataFrame) -> DataFrame:
    return user_summary.agg(
        F.count(F.lit(1)).alias("users"),
        F.count_if(F.col("purchase_count") > 0).alias("buyers"),
        F.count_if(F.col("purchase_count") > 1).alias("repeat_buyers"),
    )
