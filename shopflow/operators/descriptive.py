"""Descriptive gold tables: what happened, by day, funnel stage, category, brand,
product, user and hour.

Parameters named ``events`` take the fact or its stored rollup (``operators.rollup``).

Distinct counts go through rollups whose grouping key already is the distinct key.
That replaces the row multiplication Spark plans for several COUNT(DISTINCT)s, and
the wide key keeps a dominant day, category or brand from filling one reducer: the
narrow final grouping only merges sums that the map tasks have reduced already.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import (
    UNKNOWN,
    from_units,
    is_event,
    mean_of_units,
    or_unknown,
    pct,
    revenue,
    times,
    units,
)
from .rollup import counted, summed


def daily_metrics(events: DataFrame) -> DataFrame:
    """Traffic, conversion and revenue per day."""
    by_product = (
        counted(events)
        .groupBy("event_date", "user_session", "product_id")
        .agg(*summed("views", "carts", "purchases", "revenue"))
    )
    by_session = by_product.groupBy("event_date", "user_session").agg(
        F.count_if((F.col("views") > 0) & F.col("product_id").isNotNull()).alias("viewed_products"),
        *summed("carts", "purchases", "revenue"),
    )
    by_day = by_session.groupBy("event_date").agg(
        F.count("user_session").alias("sessions"),
        F.sum("viewed_products").alias("product_views"),
        F.count_if(F.col("carts") > 0).alias("sessions_with_cart"),
        F.count_if(F.col("purchases") > 0).alias("sessions_with_purchase"),
        F.sum("revenue").alias("revenue"),
        F.sum("purchases").alias("purchase_events"),
    )
    # users do not follow from sessions (a session may carry two ids): own narrow rollup
    users = events.groupBy("event_date").agg(F.count_distinct("user_id").alias("unique_users"))
    return (
        by_day.join(users, by_day["event_date"].eqNullSafe(users["event_date"]))
        .select(
            by_day["event_date"],
            "unique_users",
            "sessions",
            "product_views",
            "sessions_with_cart",
            "sessions_with_purchase",
            from_units(F.col("revenue")).alias("revenue"),
            "purchase_events",
            pct(F.col("sessions_with_purchase"), F.col("sessions")).alias("conversion_rate_pct"),
        )
    )


def funnel(dim_session: DataFrame) -> DataFrame:
    """Session funnel in one row.

    Cart events are under-logged, so stages are monotonic: a purchase implies a cart
    and a cart implies a view. The raw cart counts stand beside the adjusted ones.
    """
    view, cart, purchase = F.col("has_view"), F.col("has_cart"), F.col("has_purchase")
    stages = dim_session.agg(
        F.count(F.lit(1)).alias("total_sessions"),
        F.count_if(view | cart | purchase).alias("sessions_with_view"),
        F.count_if(cart | purchase).alias("sessions_with_cart"),
        F.count_if(purchase).alias("sessions_with_purchase"),
        F.count_if(cart).alias("sessions_cart_logged"),
        F.count_if(purchase & ~cart).alias("purchases_missing_cart_event"),
    )
    seen, carted, bought = (F.col(f"sessions_with_{s}") for s in ("view", "cart", "purchase"))
    return stages.select(
        "*",
        pct(carted, seen).alias("view_to_cart_pct"),
        pct(bought, carted).alias("cart_to_purchase_pct"),
        pct(bought, seen).alias("view_to_purchase_pct"),
    )


def cart_abandonment(fact: DataFrame, dim_session: DataFrame) -> DataFrame:
    """Carts of sessions that never bought, per day.

    An item counts once per (day, session, user, product, price). Every session of the
    fact is in ``dim_session``, so dropping the few sessions that bought equals keeping
    the many that did not, and shuffles far less. Sessions and users are counted in two
    rollups of what is left, so no row is multiplied for the two distinct counts.
    """
    carted = (
        fact.where(is_event("cart"))
        .select("event_date", "user_session", "user_id", "product_id", "price")
        .distinct()
    )
    buyers = dim_session.where("has_purchase").select("user_session")
    lost = (
        carted.join(buyers, "user_session", "left_anti")
        .groupBy("event_date", "user_session", "user_id")
        .agg(F.sum(units("price")).alias("value"))
    )
    by_session = (
        lost.groupBy("event_date", "user_session")
        .agg(F.sum("value").alias("value"))
        .groupBy("event_date")
        .agg(
            F.count("user_session").alias("abandoned_sessions"),
            from_units(F.sum("value")).alias("abandoned_cart_value"),
        )
    )
    by_user = (
        lost.select(F.col("event_date").alias("day"), "user_id")
        .distinct()
        .groupBy("day")
        .agg(F.count("user_id").alias("affected_users"))
    )
    return by_session.join(by_user, F.col("event_date").eqNullSafe(F.col("day"))).select(
        "event_date", "abandoned_sessions", "affected_users", "abandoned_cart_value"
    )


def _by_pair(events: DataFrame, label: Column, name: str) -> DataFrame:
    """Per (label, session, product): how often viewed, carted, bought, and for how much."""
    return (
        counted(events)
        .groupBy(label.alias(name), "user_session", "product_id")
        .agg(*summed("views", "carts", "purchases", "revenue", "sold"))
    )


def _pairs(count: str) -> Column:
    known = F.col("user_session").isNotNull() & F.col("product_id").isNotNull()
    return F.count_if((F.col(count) > 0) & known)


def category_performance(events: DataFrame) -> DataFrame:
    """Views and carts (distinct session-product pairs), purchases and revenue per category."""
    rows = _by_pair(events, or_unknown("category_code"), "category_code")
    return (
        rows.groupBy("category_code")
        .agg(
            _pairs("views").alias("views"),
            _pairs("carts").alias("carts"),
            F.sum("purchases").alias("purchases"),
            from_units(F.sum("revenue")).alias("revenue"),
        )
        .withColumn("view_to_purchase_pct", pct(F.col("purchases"), F.col("views")))
    )


def brand_performance(events: DataFrame) -> DataFrame:
    """Views, purchases, revenue and order value per known brand."""
    rows = _by_pair(events.where(F.col("brand") != UNKNOWN), F.col("brand"), "brand")
    return (
        rows.groupBy("brand")
        .agg(
            _pairs("views").alias("views"),
            F.sum("purchases").alias("purchases"),
            F.sum("revenue").alias("sales"),
            F.sum("sold").alias("sold"),
        )
        .select(
            "brand",
            "views",
            "purchases",
            from_units(F.col("sales")).alias("revenue"),
            mean_of_units(F.col("sales"), F.col("sold")).alias("avg_order_value"),
        )
    )


def top_products(events: DataFrame, n: int = 100) -> DataFrame:
    """The n products with most revenue; here views are rows, not distinct pairs.

    Category and brand are the smallest values seen for the product. They are grouping
    keys of the first step, so its aggregate stays a hash aggregate on numbers.
    """
    measures = ("views", "purchases", "revenue")
    by_attributes = (
        counted(events).groupBy("product_id", "category_code", "brand").agg(*summed(*measures))
    )
    return (
        by_attributes.groupBy("product_id")
        .agg(
            F.min("category_code").alias("category_code"),
            F.min("brand").alias("brand"),
            *summed(*measures),
        )
        .orderBy(F.desc("revenue"), "product_id")
        .limit(n)
        .withColumn("revenue", from_units(F.col("revenue")))
    )


def user_summary(events: DataFrame) -> DataFrame:
    """Sessions, activity span, purchases and spend per user."""
    by_session = (
        counted(events)
        .groupBy("user_id", "user_session")
        .agg(
            F.min("event_date").alias("first_date"),
            F.max("event_date").alias("last_date"),
            *summed("purchases", "revenue"),
        )
    )
    return by_session.groupBy("user_id").agg(
        F.count("user_session").alias("total_sessions"),
        F.max("last_date").alias("last_active_date"),
        F.date_diff(F.max("last_date"), F.min("first_date")).alias("active_span_days"),
        F.sum("purchases").alias("purchase_count"),
        from_units(F.sum("revenue")).alias("total_spend"),
    )


def hourly_pattern(fact: DataFrame) -> DataFrame:
    """Sessions, purchases and revenue per hour of day (UTC)."""
    by_session = fact.groupBy(F.hour("event_time").alias("hour_of_day"), "user_session").agg(
        times("purchase").alias("purchases"), revenue().alias("revenue")
    )
    return by_session.groupBy("hour_of_day").agg(
        F.count("user_session").alias("sessions"),
        F.sum("purchases").alias("purchases"),
        from_units(F.sum("revenue")).alias("revenue"),
    )
