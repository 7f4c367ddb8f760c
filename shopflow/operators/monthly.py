"""Period-by-period analyses. ``period`` is month, half_month or week.

Sessions belong to the period they started in, so period counts add up to the total.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.columns import from_units, pct, period_start, ratio, units
from .diagnostic import price_moves


def _sessions_by_period(dim_session: DataFrame, period: str) -> DataFrame:
    start = F.col("session_start").cast("date")
    return dim_session.groupBy(period_start(start, period).alias("period"))


def monthly_cart_gap(dim_session: DataFrame, period: str = "month") -> DataFrame:
    """Purchasing sessions without any cart event, per period."""
    bought = F.col("has_purchase")
    return (
        _sessions_by_period(dim_session.where(bought), period)
        .agg(
            F.count(F.lit(1)).alias("purchase_sessions"),
            F.count_if(~F.col("has_cart")).alias("missing_cart_event"),
        )
        .withColumn(
            "missing_cart_pct", pct(F.col("missing_cart_event"), F.col("purchase_sessions"))
        )
    )


def monthly_cart_logging_rate(dim_session: DataFrame, period: str = "month") -> DataFrame:
    """Sessions with a logged cart event among all sessions, per period."""
    return (
        _sessions_by_period(dim_session, period)
        .agg(
            F.count(F.lit(1)).alias("sessions"),
            F.count_if("has_cart").alias("sessions_with_cart"),
        )
        .withColumn("cart_logging_pct", pct(F.col("sessions_with_cart"), F.col("sessions")))
    )


def monthly_session_depth(dim_session: DataFrame, period: str = "month") -> DataFrame:
    """Mean events per session, per period."""
    return (
        _sessions_by_period(dim_session, period)
        .agg(F.count(F.lit(1)).alias("sessions"), F.sum("event_count").alias("events"))
        .withColumn(
            "events_per_session", F.round(ratio(F.col("events"), F.col("sessions")), 2)
        )
    )


def month_over_month(dim_session: DataFrame, period: str = "month") -> DataFrame:
    """Sessions and purchasing sessions per period with growth over the one before.

    The window runs over one row per period.
    """
    rows = _sessions_by_period(dim_session, period).agg(
        F.count(F.lit(1)).alias("sessions"),
        F.count_if("has_purchase").alias("purchase_sessions"),
    )
    before = Window.orderBy("period")

    def growth(column: str):
        old = F.lag(column).over(before)
        return pct(F.col(column) - old, old)

    return rows.select(
        "period",
        "sessions",
        "purchase_sessions",
        growth("sessions").alias("sessions_growth_pct"),
        growth("purchase_sessions").alias("purchase_sessions_growth_pct"),
    )


def monthly_abandonment_ratio(
    cart_abandonment: DataFrame, daily_metrics: DataFrame, period: str = "month"
) -> DataFrame:
    """Abandoned value against revenue per period.

    The two daily tables are stacked and folded once, not joined: a join of daily rows
    would lose the days on which only one of them has a row.
    """
    lost = cart_abandonment.select(
        "event_date", "abandoned_sessions", units("abandoned_cart_value").alias("lost")
    )
    earned = daily_metrics.select("event_date", units("revenue").alias("earned"))
    rows = (
        lost.unionByName(earned, allowMissingColumns=True)
        .groupBy(period_start("event_date", period).alias("period"))
        .agg(
            F.coalesce(F.sum("abandoned_sessions"), F.lit(0)).alias("abandoned_sessions"),
            from_units(F.coalesce(F.sum("lost"), F.lit(0))).alias("abandoned_value"),
            from_units(F.coalesce(F.sum("earned"), F.lit(0))).alias("revenue"),
        )
    )
    return rows.withColumn(
        "abandoned_to_revenue_pct", pct(F.col("abandoned_value"), F.col("revenue"), 1)
    )


def price_change_by_month(events: DataFrame, period: str = "month") -> DataFrame:
    """Conversion by price move, per period."""
    return (
        price_moves(events)
        .groupBy(period_start("event_date", period).alias("period"), "price_move")
        .agg(
            F.count(F.lit(1)).alias("product_days"),
            F.sum("views").alias("views"),
            F.sum("purchases").alias("purchases"),
        )
        .withColumn("conversion_pct", pct(F.col("purchases"), F.col("views")))
    )


def category_revenue_share(category_performance: DataFrame) -> DataFrame:
    """Revenue per category and its share of the total, one row per category."""
    total = category_performance.agg(F.sum(units("revenue")))
    return category_performance.select(
        F.col("category_code"),
        F.col("revenue"),
        pct(F.col("revenue"), from_units(total.scalar())).alias("revenue_share_pct"),
    )


def buyer_rates(user_summary: DataFrame) -> DataFrame:
    """Share of users who buy, and of buyers who buy again."""
    return user_summary.agg(
        F.count(F.lit(1)).alias("users"),
        F.count_if(F.col("purchase_count") > 0).alias("buyers"),
        F.count_if(F.col("purchase_count") > 1).alias("repeat_buyers"),
    ).select(
        "*",
        pct(F.col("buyers"), F.col("users")).alias("buyer_pct"),
        pct(F.col("repeat_buyers"), F.col("buyers")).alias("repeat_pct"),
    )


def peak_hours(hourly_pattern: DataFrame, tz_offset: int = 3, n: int = 6) -> DataFrame:
    """The hours with most revenue, in UTC and local time."""
    return (
        hourly_pattern.select(
            "hour_of_day",
            F.pmod(F.col("hour_of_day") + tz_offset, F.lit(24)).cast("int").alias("local_hour"),
            "revenue",
        )
        .orderBy(F.desc("revenue"), "hour_of_day")
        .limit(n)
    )


def brand_mix(brand_performance: DataFrame, n: int = 10) -> DataFrame:
    """Purchases, revenue and order value of the n brands with most revenue."""
    return (
        brand_performance.select("brand", "purchases", "revenue", "avg_order_value")
        .orderBy(F.desc("revenue"), "brand")
        .limit(n)
    )
