"""Incremental load of raw files whose columns move, go missing or are added.

As in ``ingest`` the stream's checkpoint is the ledger of loaded files. Within a micro-batch
the new files are grouped by their header; each group is read by its own column names, and the
groups are stacked by name. A column a file lacks is NULL, a column only some files have is
added to bronze. A batch is written to a folder of its own, ``load=<batch>``, which a repeated
attempt replaces: so no row is loaded twice, and what came last can be read alone.
"""

from __future__ import annotations

import csv
from collections import defaultdict
from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..schemas import BRONZE_EVENTS, RAW_COLUMNS
from ..sources.tables import exists, read_evolving, union_evolving

# fixed values: the columns of Spark's whole-file source; only the path is read here
_FILES = "path string, modificationTime timestamp, length bigint, content binary"


def header(spark: SparkSession, path: str) -> tuple[str, ...]:
    """The column names in a file's first line, none for an empty file."""
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    stream = place.getFileSystem(spark._jsc.hadoopConfiguration()).open(place)
    try:
        line = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8")).readLine()
    finally:
        stream.close()
    names = next(csv.reader([(line or "").removeprefix("﻿")]), [])
    return tuple(name.strip() for name in names)


def _checked(names: tuple[str, ...], path: str) -> tuple[str, ...]:
    if len(set(names)) < len(names) or not all(names):
        raise ValueError(f"{path}: a column without a name or with another's")
    if not set(names) & set(RAW_COLUMNS):
        raise ValueError(f"{path}: no known column in the header")
    return names


def read_by_header(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Raw files as text by column name: the raw columns, ``source_file``, then added ones."""
    groups: dict[tuple[str, ...], list[str]] = defaultdict(list)
    for path in paths:
        if names := header(spark, path):
            groups[_checked(names, path)].append(path)
    tables = [spark.createDataFrame([], BRONZE_EVENTS)]
    for names, files in sorted(groups.items()):
        schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
        rows = spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(files)
        tables.append(rows.select("*", F.col("_metadata.file_path").alias("source_file")))
    return union_evolving(*tables)


def _load(batch: DataFrame, number: int, target: str, rows: list[int]) -> None:
    spark = batch.sparkSession
    paths = sorted(row.path for row in batch.select("path").collect())  # new files, not their rows
    place = f"{target}/load={number}"
    read_by_header(spark, paths).write.mode("overwrite").parquet(place)
    rows.append(spark.read.parquet(place).count())


def ingest_evolving(
    spark: SparkSession,
    root: str,
    target: str,
    checkpoint: str,
    max_files_per_batch: int | None = None,
) -> int:
    """Append all new ``root/<month>/*.csv`` files to ``target``; returns the rows added."""
    files = spark.readStream.format("binaryFile").schema(_FILES).option("pathGlobFilter", "*.csv")
    if max_files_per_batch:
        files = files.option("maxFilesPerTrigger", max_files_per_batch)
    rows: list[int] = []
    query = (
        files.load(f"{root}/*/")
        .select("path")
        .writeStream.foreachBatch(partial(_load, target=target, rows=rows))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return sum(rows)


def loaded(spark: SparkSession, target: str, after: int = -1) -> DataFrame:
    """The rows of the loads after a given one, with their number as ``load``; columns that
    older loads lack are NULL there. Only the folders of those loads are read."""
    if not exists(spark, target):
        return spark.createDataFrame([], BRONZE_EVENTS).withColumn("load", F.lit(0))
    return read_evolving(spark, target).where(F.col("load") > after)
