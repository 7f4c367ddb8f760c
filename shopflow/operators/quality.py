"""Data-quality checks and row-count reconciliation, one pass per table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..fixed_values import QUALITY_TEXTS
from ..functions.columns import is_blank, pct
from .silver import EVENT_TYPES


def _checks(table: DataFrame, **checks: tuple[Column, Column]) -> DataFrame:
    """One row per check, from a single aggregate over the table.

    Each check is (condition counted as affected, condition counted as base).
    """
    counts = []
    for name, (affected, base) in checks.items():
        counts += [F.count_if(affected).alias(f"{name}_hit"), F.count_if(base).alias(f"{name}_of")]
    rows = F.array(
        *(
            F.struct(
                F.lit(name).alias("check_name"),
                F.lit(QUALITY_TEXTS[name][0]).alias("description"),
                F.col(f"{name}_hit").alias("affected_rows"),
                pct(F.col(f"{name}_hit"), F.col(f"{name}_of")).alias("pct_affected"),
                F.lit(QUALITY_TEXTS[name][1]).alias("business_impact"),
            )
            for name in checks
        )
    )
    return table.agg(*counts).select(F.inline(rows))


def bronze_checks(bronze: DataFrame) -> DataFrame:
    every = F.lit(True)
    return _checks(
        bronze,
        missing_category_code=(is_blank("category_code"), every),
        missing_brand=(is_blank("brand"), every),
    )


def fact_checks(fact: DataFrame) -> DataFrame:
    return _checks(fact, zero_or_negative_price=(F.col("price") <= 0, F.lit(True)))


def session_checks(dim_session: DataFrame) -> DataFrame:
    bought = F.col("has_purchase")
    long = F.col("session_end") > F.col("session_start") + F.expr("INTERVAL 24 HOURS")
    return _checks(
        dim_session,
        purchase_without_cart=(bought & ~F.col("has_cart"), bought),
        purchase_without_view=(bought & ~F.col("has_view"), bought),
        multiday_sessions=(long, F.lit(True)),
    )


def data_quality(bronze: DataFrame, fact: DataFrame, dim_session: DataFrame) -> DataFrame:
    """All checks, worst share first."""
    return (
        bronze_checks(bronze)
        .unionByName(session_checks(dim_session))
        .unionByName(fact_checks(fact))
        .orderBy(F.desc_nulls_last("pct_affected"), "check_name")
    )


_CASTS = {
    "event_time": "timestamp",
    "product_id": "bigint",
    "category_id": "decimal(30,0)",
    "price": "double",
    "user_id": "bigint",
}


def layer_reconciliation(
    bronze: DataFrame, fact: DataFrame, dim_session: DataFrame, dim_product: DataFrame
) -> DataFrame:
    """Where rows go between layers: filtered, unparsable, duplicate, and what each grain keeps."""
    no_key = F.col("event_time").isNull() | F.col("user_session").isNull()
    known = F.coalesce(F.col("event_type").isin(*EVENT_TYPES), F.lit(False))
    malformed = F.lit(False)
    for name, kind in _CASTS.items():
        filled = ~is_blank(name)
        malformed = malformed | (filled & F.col(name).try_cast(kind).isNull())
    raw = bronze.agg(
        F.count(F.lit(1)).alias("bronze_rows"),
        F.count_if(no_key).alias("rows_without_key"),
        F.count_if(~no_key & ~known).alias("rows_other_event_type"),
        F.count_if(~no_key & known).alias("accepted_rows"),
        F.count_if(malformed).alias("rows_with_malformed_text"),
    )
    products = dim_product.agg(F.count(F.lit(1)))
    facts = fact.agg(F.count(F.lit(1)))
    sessions = dim_session.agg(F.count(F.lit(1)))
    return raw.select(
        "*",
        facts.scalar().alias("fact_rows"),
        sessions.scalar().alias("session_rows"),
        products.scalar().alias("product_rows"),
    ).withColumn("duplicate_rows", F.col("accepted_rows") - F.col("fact_rows"))
