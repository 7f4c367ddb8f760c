"""Descriptions, classification tags and the inventory of personal data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..fixed_values import CATALOG, COLUMN_TAGS, TABLE_TAGS
from ..schemas import COLUMN_TAGS as COLUMN_TAG_SCHEMA, TABLE_TAGS as TABLE_TAG_SCHEMA

DATABASE_COMMENTS = {
    "bronze": "Events as delivered, one row per source row, all columns text.",
    "silver": "Typed and deduplicated events with product and session dimensions.",
    "gold": "Business tables; dashboards read only these.",
    "ops": "Run history and platform reports.",
}

TABLE_COMMENTS = {
    "bronze.events": "One row per source row. Not for analysis: read silver.fact_events.",
    "silver.fact_events": "One row per distinct typed event.",
    "silver.dim_product": "One row per product with the newest attributes seen.",
    "silver.dim_session": "One row per session with the funnel stages it reached.",
    "gold.funnel": "One row. A purchase implies a cart and a cart implies a view; raw counts beside.",
    "gold.data_quality": "One row per check, with what follows from ignoring it.",
    "gold.intent_by_view_depth": "One row per view-depth band of (user, product) pairs.",
    "gold.cart_conversion_by_price": "One row per price band of carted (session, product) pairs.",
    "gold.attach_opportunity": "One row per category bought together with the anchor category.",
    "gold.price_change_effect": "One row per price move of product-days; observational.",
    "gold.category_recovery_check": "One row: can blank category codes be filled by category id?",
    "gold.discount_tier_analysis": "One row per month and tier of same-day price cuts.",
    "gold.november_cohort_behavior": "One row per cohort: new in the period or returning.",
    "gold.rfm_segmentation": "One row per recency group of buyers.",
    "gold.buyer_retention_oct_to_nov": "One row: earlier buyers who bought again.",
}

COLUMN_COMMENTS = {
    "silver.dim_session": {"has_cart": "A cart event was logged; under-reported at the source."},
    "silver.fact_events": {"price": "Unit price at the time; a purchase row is one unit."},
    "silver.dim_product": {"category_l1": "First segment of the category code."},
}


def with_column_comments(table: DataFrame, name: str) -> DataFrame:
    """The same table with documented columns; the comment is stored on write."""
    for column, text in COLUMN_COMMENTS.get(name, {}).items():
        table = table.withMetadata(column, {"comment": text})
    return table


def comment_on_table(spark: SparkSession, name: str) -> None:
    if name in TABLE_COMMENTS:
        text = TABLE_COMMENTS[name].replace("'", r"\'")
        spark.sql(f"COMMENT ON TABLE {name} IS '{text}'")


def comment_on_database(spark: SparkSession, name: str) -> None:
    text = DATABASE_COMMENTS[name].replace("'", r"\'")
    spark.sql(f"COMMENT ON DATABASE {name} IS '{text}'")


def column_tags(spark: SparkSession) -> DataFrame:
    rows = [
        (CATALOG, *place, tag, value)
        for place, tags in COLUMN_TAGS.items()
        for tag, value in tags.items()
    ]
    return spark.createDataFrame(rows, COLUMN_TAG_SCHEMA)


def table_tags(spark: SparkSession) -> DataFrame:
    rows = [
        (CATALOG, *place, tag, value)
        for place, tags in TABLE_TAGS.items()
        for tag, value in tags.items()
    ]
    return spark.createDataFrame(rows, TABLE_TAG_SCHEMA)


def pii_inventory(tags: DataFrame, catalog: str = CATALOG) -> DataFrame:
    """Columns tagged as personal data with their class and sensitivity."""
    place = ["catalog_name", "schema_name", "table_name", "column_name"]
    return (
        tags.where(F.col("catalog_name") == catalog)
        .groupBy(*place)
        .pivot("tag_name", ["pii", "sensitivity"])
        .agg(F.max("tag_value"))
        .withColumnRenamed("pii", "pii_class")
        .where(F.col("pii_class").isNotNull())
        .orderBy(*place[1:])
    )
