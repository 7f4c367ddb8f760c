"""Incremental load of raw files into bronze.

The stream's checkpoint is the ledger of loaded files: a run takes the files it has not
seen, commits them and stops. Running it again loads nothing twice, and a run that lost
its executors or driver resumes from the last commit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schemas import BRONZE_EVENTS, RAW_EVENTS
from ..sources.raw_csv import with_source_file


def ingest(
    spark: SparkSession,
    root: str,
    target: str,
    checkpoint: str,
    max_files_per_batch: int | None = None,
) -> int:
    """Append all new ``root/<month>/*.csv`` files to ``target``; returns the rows added."""
    # keep the progress of every batch of this run, so that the row count is complete
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "1000000")
    files = (
        spark.readStream.schema(RAW_EVENTS)
        .option("header", True)
        .option("enforceSchema", False)  # a header with other columns fails, it is not ignored
        .option("pathGlobFilter", "*.csv")
    )
    if max_files_per_batch:
        files = files.option("maxFilesPerTrigger", max_files_per_batch)
    query = (
        with_source_file(files.csv(f"{root}/*/"))
        .writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return sum(progress.numInputRows for progress in query.recentProgress)


def bronze_events(spark: SparkSession, target: str) -> DataFrame:
    """The loaded rows. Reads through the sink's commit log, so uncommitted files of a
    failed attempt are not seen."""
    return spark.read.schema(BRONZE_EVENTS).parquet(target)
