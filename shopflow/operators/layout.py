"""Physical layout: clustered write, compaction, column statistics."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from ..session import discard, stored

TARGET_FILE_BYTES = 128 * 1024 * 1024
FACT_KEYS = ("event_date", "product_id")

STATISTICS_COLUMNS = {
    "silver.fact_events": (
        "event_date",
        "event_type",
        "product_id",
        "user_id",
        "user_session",
        "brand",
    ),
    "silver.dim_session": ("user_session", "has_view", "has_cart", "has_purchase"),
    "silver.dim_product": ("product_id", "category_code", "brand_clean"),
}


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Size of a table on storage, from the file system's own summary."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    folder = jvm.org.apache.hadoop.fs.Path(path)
    return int(folder.getFileSystem(conf).getContentSummary(folder).getLength())


def file_count(size: int, target: int = TARGET_FILE_BYTES) -> int:
    return max(1, math.ceil(size / target))


def clustered(
    table: DataFrame,
    keys: Sequence[str] = FACT_KEYS,
    files: int | None = None,
) -> DataFrame:
    """Rows ordered for data skipping: ranges of the keys across files, sorted within.

    Row-group minima and maxima then let a date or product filter skip most files.
    Ranges are cut by sampled volume. The event time closes the range key, so a day and
    product with very many events is spread over several files.
    """
    order = [*keys, *(c for c in ("event_time", "user_session") if c in table.columns)]
    spread = (
        table.repartitionByRange(files, *order) if files else table.repartitionByRange(*order)
    )
    return spread.sortWithinPartitions(*order)


# ranks per key of the interleaved order: 2 ** RANK_BITS ranges of about equal volume
RANK_BITS = 6


def _ordinal(table: DataFrame, key: str) -> Column:
    return F.unix_date(key) if isinstance(table.schema[key].dataType, T.DateType) else F.col(key)


def _rank(value: Column, cuts: list) -> Column:
    """Number of cut points up to a value; NULL is below all."""
    if not cuts:
        return F.lit(0)
    return F.coalesce(F.size(F.filter(F.array(*map(F.lit, cuts)), lambda cut: cut <= value)), F.lit(0))


def interleaved_key(table: DataFrame, keys: Sequence[str] = FACT_KEYS) -> Column:
    """The bits of the keys' quantile ranks in turn, the highest first: rows close in this
    number are close in every key. The cut points (a bounded list) come from one pass."""
    shares = F.array(*(F.lit(i / 2**RANK_BITS) for i in range(1, 2**RANK_BITS)))
    row = table.agg(*(F.percentile_approx(_ordinal(table, k), shares, 10_000).alias(k) for k in keys)).first()
    key = F.lit(0).cast("long")
    ranks = [_rank(_ordinal(table, k), sorted(set(row[k] or []))) for k in keys]
    for bit in reversed(range(RANK_BITS)):
        for rank in ranks:
            key = F.shiftleft(key, 1).bitwiseOR(F.shiftright(rank, bit).bitwiseAND(F.lit(1)).cast("long"))
    return key


def interleaved(table: DataFrame, keys: Sequence[str] = FACT_KEYS, files: int | None = None) -> DataFrame:
    """Rows ordered so that a filter on any one of the keys skips files.

    ``clustered`` orders by the first key and then the second, which serves the second alone
    badly. Rows of one rank pair are spread further by the keys and the event time.
    """
    order = ["_interleaved", *keys, *(c for c in ("event_time", "user_session") if c in table.columns)]
    keyed = table.withColumn("_interleaved", interleaved_key(table, keys))
    spread = keyed.repartitionByRange(files, *order) if files else keyed.repartitionByRange(*order)
    return spread.sortWithinPartitions(*order).drop("_interleaved")


def file_ranges(files: DataFrame, key: str) -> DataFrame:
    """Least and greatest key of every file of a Parquet scan."""
    return files.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.min(key).alias("lo"), F.max(key).alias("hi")
    )


def files_opened(ranges: DataFrame, values: DataFrame) -> DataFrame:
    """How many files a filter on each value must open; ``values``: one column ``value``."""
    return (
        values.join(ranges, F.col("value").between(F.col("lo"), F.col("hi")), "left")
        .groupBy("value")
        .agg(F.count("lo").alias("files"))
    )


def overlap_depth(ranges: DataFrame) -> DataFrame:
    """How far the ranges ``lo`` to ``hi`` (ends included) overlap, in one row: their number,
    the most and the mean number of ranges that hold a range's lower end, itself included, and
    a quality of 1 where none overlap and 0 where all do.

    A sweep over the ends: each opening adds one, each end takes one. Equal ends are folded,
    the rest is range-partitioned, and a running sum needs the sums of the partitions before it
    (one row each) and those inside its own. No range is compared with another.
    """
    ends = ranges.where("lo IS NOT NULL AND hi IS NOT NULL").select(
        F.inline(
            F.array(
                F.struct(F.col("lo").alias("at"), F.lit(0).alias("closing")),
                F.struct(F.col("hi").alias("at"), F.lit(1).alias("closing")),
            )
        )
    )
    folded = ends.groupBy("at", "closing").agg(F.count(F.lit(1)).alias("rows"))
    change = F.when(F.col("closing") == 0, F.col("rows")).otherwise(-F.col("rows"))
    dealt = stored(
        folded.repartitionByRange("at", "closing").withColumn("slice", F.spark_partition_id()), "overlap-ends"
    ).withColumn("change", change)
    before = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = dealt.groupBy("slice").agg(F.sum("change").alias("change"))
    slices = slices.select("slice", F.coalesce(F.sum("change").over(before), F.lit(0)).alias("open_before"))
    inside = F.sum("change").over(Window.partitionBy("slice").orderBy("at", "closing"))
    depth = (
        dealt.withColumn("inside", inside)
        .join(slices, "slice")
        .where("closing = 0")
        .select("rows", (F.col("inside") + F.col("open_before")).alias("depth"))
    )
    total = depth.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("ranges"),
        F.max("depth").alias("max_depth"),
        F.sum(F.col("depth") * F.col("rows")).alias("sum_depth"),
    )
    mean = F.col("sum_depth").cast("double") / F.col("ranges")
    return total.select(
        "ranges",
        "max_depth",
        F.when(F.col("ranges") > 0, F.round(mean, 4)).alias("mean_depth"),
        F.when(F.col("ranges") > 1, F.round(1 - (mean - 1) / (F.col("ranges") - 1), 4)).alias("quality"),
    )


def compact(
    spark: SparkSession,
    source: str,
    target: str,
    keys: Sequence[str] = (),
    target_bytes: int = TARGET_FILE_BYTES,
) -> int:
    """Rewrite many small Parquet files as few large ones under a new path.

    With ``keys``, the new files hold ranges of them again, so a clustered table stays so.
    """
    files = file_count(stored_bytes(spark, source), target_bytes)
    rows = spark.read.parquet(source)
    dealt = clustered(rows, keys, files) if keys else rows.repartition(files)
    dealt.write.mode("errorifexists").parquet(target)
    return files


WORK = "_compaction"  # readers skip folders that start with an underscore


def _folder(spark: SparkSession, path: str):
    """A function that makes paths below a folder, and their file system."""
    made = spark._jvm.org.apache.hadoop.fs.Path
    return (lambda *parts: made("/".join([path, *parts]))), made(path).getFileSystem(spark._jsc.hadoopConfiguration())


def _sum_before(table: DataFrame, order: Sequence[str], value: str, name: str, label: str) -> DataFrame:
    """The rows, and the sum of ``value`` over all rows before each in an order without ties.

    Rows are range-partitioned; the only window without a partition is over one row per range.
    """
    dealt = stored(table.repartitionByRange(*order).withColumn("_slice", F.spark_partition_id()), label)
    earlier = Window.rowsBetween(Window.unboundedPreceding, -1)
    slices = dealt.groupBy("_slice").agg(F.sum(value).alias("_sum"))
    slices = slices.select("_slice", F.sum("_sum").over(earlier.orderBy("_slice")).alias("_slices_before"))
    inside = F.sum(value).over(earlier.partitionBy("_slice").orderBy(*order))
    total = F.coalesce(inside, F.lit(0)) + F.coalesce("_slices_before", F.lit(0))
    return dealt.withColumn("_inside", inside).join(slices, "_slice").withColumn(name, total).drop("_slice", "_inside", "_slices_before")


def merge_groups(files: DataFrame, target_bytes: int, least_files: int = 2) -> DataFrame:
    """(file, group) of the files to merge, from ``files`` (file, bytes, lo).

    Neighbours in the order of ``lo`` share a group until it holds ``target_bytes``; a group of
    fewer than ``least_files`` files is left alone. Groups are numbered in key order.
    """
    before = _sum_before(files, ("lo", "file"), "bytes", "_before", "compaction-order")
    grouped = before.select("file", F.floor(F.col("_before") / target_bytes).cast("int").alias("group"))
    enough = grouped.groupBy("group").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_files)
    return grouped.join(enough.select("group"), "group").select("file", "group")


def finish_compaction(spark: SparkSession, path: str) -> None:
    """Complete a compaction that died while files were swapped, or forget one that had not
    written all its files. Every step can be repeated."""
    at, system = _folder(spark, path)
    if system.exists(at(WORK, "plan", "_SUCCESS")):
        system.mkdirs(at(WORK, "old"))
        # names of the merged files, which the file system takes one by one
        for row in spark.read.parquet(f"{path}/{WORK}/plan").toLocalIterator():
            if system.exists(at(row["file"])) and not system.rename(at(row["file"]), at(WORK, "old", row["file"])):
                raise OSError(f"{path}/{row['file']} could not be moved")
        for status in system.listStatus(at(WORK, "new")):
            name = status.getPath().getName()
            if name.endswith(".parquet") and not system.rename(at(WORK, "new", name), at(name)):
                raise OSError(f"{path}/{WORK}/new/{name} could not be moved")
    system.delete(at(WORK), True)


def compact_small(
    spark: SparkSession,
    path: str,
    keys: Sequence[str] = (),
    target_bytes: int = TARGET_FILE_BYTES,
    small_bytes: int | None = None,
    least_files: int = 2,
) -> int:
    """Merge the small files of a Parquet folder in place; returns how many were merged.

    Files of ``small_bytes`` (half the target) or more are neither read nor renamed. Small files
    that are neighbours by their least ``keys`` become one file of about the target size, sorted
    by the keys; a task writes one group, so it holds less than one and a half targets.

    The new files are written beside the table, then the list of the old ones, which commits the
    merge, then files are moved. A run that dies is completed or forgotten by the next one. The
    caller is the only writer; during the moves a reader can miss rows, but reads none twice.
    Folders with partitions, and those whose files a stream's log names, are refused.
    """
    finish_compaction(spark, path)
    at, system = _folder(spark, path)
    for status in system.listStatus(at()):
        name = status.getPath().getName()
        if name == "_spark_metadata" or (status.isDirectory() and name[0] not in "_."):
            raise ValueError(f"{path} is not a plain folder of files: {name}")
    if not any(status.getPath().getName().endswith(".parquet") for status in system.listStatus(at())):
        return 0
    limit = target_bytes // 2 if small_bytes is None else small_bytes
    # the condition on the size prunes files before any is opened
    small = spark.read.option("mergeSchema", True).parquet(path).where(F.col("_metadata.file_size") < limit)
    files = small.groupBy(F.col("_metadata.file_name").alias("file")).agg(
        F.first("_metadata.file_size").alias("bytes"), F.min(F.struct(F.lit(0).alias("_"), *keys)).alias("lo")
    )
    plan = stored(merge_groups(files, target_bytes, least_files), "compaction-plan")
    merged, most = plan.agg(F.count(F.lit(1)), F.max("group")).first()
    if merged:
        rows = small.withColumn("_file", F.col("_metadata.file_name"))
        rows = rows.join(plan.withColumnRenamed("file", "_file").withColumnRenamed("group", "_group"), "_file")
        dealt = rows.repartitionById(most + 1, "_group")
        dealt = dealt.sortWithinPartitions(*keys) if keys else dealt
        dealt.drop("_file", "_group").write.mode("overwrite").parquet(f"{path}/{WORK}/new")
        plan.write.parquet(f"{path}/{WORK}/plan")
        finish_compaction(spark, path)
    discard(plan)
    return merged


def analyze(spark: SparkSession, name: str) -> None:
    """Column statistics for the cost-based optimizer."""
    columns = ", ".join(STATISTICS_COLUMNS[name])
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR COLUMNS {columns}")
