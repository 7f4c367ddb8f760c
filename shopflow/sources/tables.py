"""Catalog tables over Parquet: scans, full refresh, append, views, schema evolution."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, types as T

DATABASES = ("bronze", "silver", "gold", "ops")


def create_databases(spark: SparkSession) -> None:
    for name in DATABASES:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")


def create_table(spark: SparkSession, name: str, schema: T.StructType, location: str) -> DataFrame:
    """An empty typed table, unless it exists already."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet LOCATION '{location}'")
    return spark.table(name)


def replace_table(table: DataFrame, name: str, root: str, version: str) -> DataFrame:
    """Full refresh: write a new version beside the old, then point the catalog at it.

    A reader sees the old rows or the new ones, never a half-written folder, and a plan
    may read the version it is about to replace.
    """
    spark = table.sparkSession
    location = f"{root}/{name.replace('.', '/')}/{version}"
    table.write.mode("errorifexists").parquet(location)
    if spark.catalog.tableExists(name) and spark.table(name).schema == table.schema:
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{location}'")
        spark.catalog.refreshTable(name)
    else:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.catalog.createTable(name, path=location, source="parquet", schema=table.schema)
    return spark.table(name)


def replace_bucketed(
    table: DataFrame, name: str, root: str, version: str, keys: Sequence[str], buckets: int
) -> DataFrame:
    """Full refresh of a table whose rows are stored by hash of ``keys``.

    Joins and groupings that contain the keys read it without a shuffle.
    """
    spark = table.sparkSession
    # readers keep the old version until the new one is complete
    coming, former = f"{name}__next", f"{name}__former"
    if spark.catalog.tableExists(former) and not spark.catalog.tableExists(name):
        spark.sql(f"ALTER TABLE {former} RENAME TO {name}")  # a run died between the two renames
    for entry in (coming, former):
        spark.sql(f"DROP TABLE IF EXISTS {entry}")  # external: files stay
    (
        table.repartition(buckets, *keys)
        .write.mode("errorifexists")
        .format("parquet")
        .bucketBy(buckets, *keys)
        .option("path", f"{root}/{name.replace('.', '/')}/{version}")
        .saveAsTable(coming)
    )
    if spark.catalog.tableExists(name):
        spark.sql(f"ALTER TABLE {name} RENAME TO {former}")
    spark.sql(f"ALTER TABLE {coming} RENAME TO {name}")
    spark.sql(f"DROP TABLE IF EXISTS {former}")
    return spark.table(name)


def append(table: DataFrame, name: str) -> None:
    table.write.mode("append").insertInto(name)


def location(spark: SparkSession, name: str) -> str:
    """The folder of a stored table."""
    described = spark.sql(f"DESCRIBE FORMATTED {name}").where("col_name = 'Location'")
    return described.first()["data_type"]


def create_view(table: DataFrame, name: str) -> None:
    table.createOrReplaceTempView(name)


def exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def read_evolving(spark: SparkSession, *paths: str) -> DataFrame:
    """Parquet files of which later ones may carry additional columns."""
    return spark.read.option("mergeSchema", True).parquet(*paths)


def union_evolving(*tables: DataFrame) -> DataFrame:
    """Stack tables by column name; a column one of them lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
