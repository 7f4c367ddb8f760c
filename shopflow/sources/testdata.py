"""A bronze clickstream derived from the star-schema test tables.

``events`` gives time, user, type and amount, ``part`` gives product, category and
brand. Every event is kept; every 50th is delivered twice, so that deduplication has
work to do. All columns are text, as a raw CSV load would leave them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..session import prepare

# a file's schema is read from its footer once; later scans of the path are given it
_SCHEMAS: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def staged_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    part = table(spark, sf_dir, "part").select(
        F.col("p_partkey"),
        F.col("p_size").cast("string").alias("category_id"),
        F.when(F.col("p_type") == "PROMO", "")
        .otherwise(F.concat_ws(".", F.lower("p_type"), F.get(F.split("p_name", " "), F.lit(1))))
        .alias("category_code"),
        F.when(F.col("p_size") % 7 == 0, "").otherwise(F.col("p_brand")).alias("brand"),
    )
    copies = F.when(F.col("event_id") % 50 == 0, 2).otherwise(1)
    part_key = F.get_json_object("props", "$.k").cast("long")
    events = table(spark, sf_dir, "events").select(
        F.col("ts"),
        F.col("user_id"),
        F.when(F.col("event_type") == "click", "cart").otherwise(F.col("event_type")).alias("event_type"),
        F.when(F.col("event_id") % 97 == 0, 0.0).otherwise(F.col("value") * 4).alias("price"),
        # one scan: a repeated delivery is an extra row from the same record. As the
        # exploded value the key is parsed once, not again by the join's NULL filter.
        F.explode(F.array_repeat(part_key, copies)).alias("p_partkey"),
    )
    visit = F.floor(F.datediff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date")) / 3)
    return events.join(part, "p_partkey").select(
        F.col("ts").cast("string").alias("event_time"),
        "event_type",
        F.col("p_partkey").cast("string").alias("product_id"),
        "category_id",
        "category_code",
        "brand",
        F.col("price").cast("decimal(18,2)").cast("string").alias("price"),
        F.col("user_id").cast("string").alias("user_id"),
        F.concat_ws("-", F.col("user_id").cast("string"), visit.cast("string")).alias("user_session"),
    )
