"""Key, reference and domain checks. Each returns one row of counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from .silver import EVENT_TYPES


def key_check(table: DataFrame, name: str, *keys: str) -> DataFrame:
    """Duplicate and missing values of a declared primary key."""
    missing = F.lit(False)
    for key in keys:
        missing = missing | F.col(key).isNull()
    groups = table.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum(F.when(missing, F.col("n"))), F.lit(0)).alias("null_key_rows"),
        F.count_if(~missing & (F.col("n") > 1)).alias("duplicated_keys"),
        F.coalesce(F.sum(F.when(~missing, F.col("n") - 1)), F.lit(0)).alias("surplus_rows"),
    ).select(F.lit(name).alias("check_name"), "*")


def reference_check(
    child: DataFrame, child_key: str, parent: DataFrame, parent_key: str, name: str
) -> DataFrame:
    """Child rows whose key is absent from the parent; NULL keys refer to nothing and pass.

    Child rows are folded to one per key first, so a hot key is one row in the join.
    """
    used = (
        child.where(F.col(child_key).isNotNull())
        .groupBy(F.col(child_key).alias("key"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    orphans = used.join(parent.select(F.col(parent_key).alias("key")), "key", "left_anti")
    return orphans.agg(
        F.count(F.lit(1)).alias("orphan_keys"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("orphan_rows"),
    ).select(F.lit(name).alias("check_name"), "*")


def domain_check(
    table: DataFrame, name: str, column: str = "event_type", allowed: Sequence[str] = EVENT_TYPES
) -> DataFrame:
    """Rows whose value is outside the allowed set; as in a CHECK constraint NULL passes."""
    return table.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(~F.col(column).isin(*allowed)).alias("violations"),
    ).select(F.lit(name).alias("check_name"), "*")


def enforce_domain(
    table: DataFrame, column: str = "event_type", allowed: Sequence[str] = EVENT_TYPES
) -> DataFrame:
    """The same table, failing the job that reads it when a value is outside the set."""
    value = F.col(column)
    wrong = F.raise_error(F.concat(F.lit(f"{column} outside its domain: "), value))
    checked = F.when(~value.isin(*allowed), wrong.cast("string")).otherwise(value)
    return table.withColumn(column, checked)
