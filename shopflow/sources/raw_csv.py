"""Raw event files: CSV with a header in month folders, read as text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..schemas import RAW_COLUMNS, RAW_EVENTS


def with_source_file(events: DataFrame) -> DataFrame:
    return events.select(*RAW_COLUMNS, F.col("_metadata.file_path").alias("source_file"))


def read_raw(spark: SparkSession, root: str) -> DataFrame:
    """All ``root/<month>/*.csv`` files, nothing inferred and nothing cast.

    Blank fields arrive as NULL. Large files are split by Spark, so they need not be cut.
    """
    files = spark.read.schema(RAW_EVENTS).option("header", True).csv(f"{root}/*/*.csv")
    return with_source_file(files)


def write_raw(events: DataFrame, path: str) -> None:
    """Write one delivery (a month folder) of raw files."""
    events.select(*RAW_COLUMNS).write.mode("errorifexists").option("header", True).csv(path)
