"""Session settings and the shared working folder.

Nothing here picks a master, executor size or broadcast limit: those belong to the
cluster. The settings below are the ones the results (time zone) or the plans
(adaptive execution, skew handling) rely on.
"""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import DataFrame, SparkSession

SESSION_CONF = {
    # event_time text without a zone is UTC; dates and hours are cut in UTC
    "spark.sql.session.timeZone": "UTC",
    # run-time partition sizing and splitting of skewed join partitions
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # the stored column statistics are used
    "spark.sql.cbo.enabled": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings the operators rely on to an existing session."""
    for key, value in SESSION_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: int | str = "*", app: str = "shopflow", **conf: str) -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        # no Python call sites in plans: capturing them slows plan building
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach.

    ``spark.checkpoint.dir`` of the session, or, where it is unset, a folder in the
    session's warehouse, which every executor reaches as well.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        named = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_intermediate"
    return named.rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no earlier run has used."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def stored(table: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and continue from the files.

    For results that several branches of a plan read: the work behind them runs once,
    and a lost executor costs a re-read, not a recomputation. ``discard`` removes the
    files when nothing reads them any more.
    """
    path = fresh_path(table.sparkSession, label)
    table.write.option("compression", "zstd").parquet(path)
    return table.sparkSession.read.schema(table.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder through the session's own file system layer."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def discard(*tables: DataFrame) -> None:
    """Delete the files of tables made by ``stored``."""
    for table in tables:
        for folder in {name.rsplit("/", 1)[0] for name in table.inputFiles()}:
            remove(table.sparkSession, folder)


def release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of frames nothing refers to any more.

    Spark removes them after the driver's next garbage collection, which a long job on a
    quiet driver can wait for; this asks for it.
    """
    gc.collect()
    spark._jvm.System.gc()
