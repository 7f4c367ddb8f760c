"""Typed fact and its two dimensions, from untyped bronze events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import from_units, or_unknown
from .rollup import counted, summed

# fixed values: the event vocabulary
EVENT_TYPES = ("view", "cart", "purchase", "remove_from_cart")


def accepted() -> Column:
    """Bronze rows that enter the fact."""
    return (
        F.col("event_time").isNotNull()
        & F.col("user_session").isNotNull()
        & F.col("event_type").isin(*EVENT_TYPES)
    )


def _finite(value: Column) -> Column:
    """NULL for NaN and infinities, which text can spell but no sum can hold."""
    return F.when(F.abs(value) < float("inf"), value)


def typed_events(bronze: DataFrame) -> DataFrame:
    """Accepted bronze rows with the fact's types, repeats still included.

    Text that does not parse becomes NULL instead of failing the job;
    ``layer_reconciliation`` counts those cells.
    """
    return bronze.where(accepted()).select(
        F.col("event_time").try_cast("timestamp").alias("event_time"),
        F.col("event_time").try_cast("date").alias("event_date"),
        "event_type",
        F.col("product_id").try_cast("bigint").alias("product_id"),
        F.col("category_id").try_cast("decimal(30,0)").alias("category_id"),
        "category_code",
        or_unknown("brand").alias("brand"),
        _finite(F.col("price").try_cast("double")).alias("price"),
        F.col("user_id").try_cast("bigint").alias("user_id"),
        "user_session",
    )


def fact_events(bronze: DataFrame) -> DataFrame:
    """One row per distinct typed event.

    The shuffle key is the whole row, so copies of one event are folded in the map
    tasks and no single product, session or day can fill a reducer.
    """
    return typed_events(bronze).distinct()


def product_state(bronze: DataFrame) -> DataFrame:
    """Newest attribute texts per product, as one value that states of parts merge by ``max``."""
    attributes = ("category_id", "category_code", "brand", "price")
    return (
        bronze.select(
            F.col("product_id").try_cast("bigint").alias("product_id"),
            F.struct(
                F.col("event_time").try_cast("timestamp").alias("seen"), *attributes
            ).alias("row"),
        )
        .where(F.col("product_id").isNotNull())
        .groupBy("product_id")
        .agg(F.max("row").alias("row"))
    )


def product_attributes(state: DataFrame) -> DataFrame:
    level = F.split("row.category_code", r"\.")
    return state.select(
        "product_id",
        F.col("row.category_id").try_cast("decimal(30,0)").alias("category_id"),
        "row.category_code",
        or_unknown("row.category_code").alias("category_code_clean"),
        F.get(level, F.lit(0)).alias("category_l1"),
        F.get(level, F.lit(1)).alias("category_l2"),
        "row.brand",
        or_unknown("row.brand").alias("brand_clean"),
        F.col("row.price").try_cast("double").alias("price"),
    )


def dim_product(bronze: DataFrame) -> DataFrame:
    """Newest attributes per product (ties: the greatest attribute texts).

    A maximum over (time, attributes) keeps one row per product and map task before the
    shuffle, so a best-selling product never puts its rows into one task. Attributes stay
    text until then: only the surviving rows are cast.
    """
    return product_attributes(product_state(bronze))


def session_products(events: DataFrame) -> DataFrame:
    """Rollup to (session, product): the first step of the session dimension."""
    return counted(events).groupBy("user_session", "product_id").agg(
        F.min("user_id").alias("user_id"),
        F.min("first_event").alias("first_event"),
        F.max("last_event").alias("last_event"),
        *summed("events", "views", "carts", "purchases", "revenue"),
    )


def dim_session(events: DataFrame) -> DataFrame:
    """One row per session: span, volume, stages reached, revenue.

    Going through (session, product) makes the distinct product count a plain count
    and spreads a session that holds a large share of all events over its products.
    """
    return (
        session_products(events)
        .groupBy("user_session")
        .agg(
            F.min("user_id").alias("user_id"),
            F.min("first_event").alias("session_start"),
            F.max("last_event").alias("session_end"),
            F.sum("events").alias("event_count"),
            F.count("product_id").alias("distinct_products"),
            (F.sum("views") > 0).alias("has_view"),
            (F.sum("carts") > 0).alias("has_cart"),
            (F.sum("purchases") > 0).alias("has_purchase"),
            from_units(F.sum("revenue")).alias("session_revenue"),
        )
    )
