"""Equal-sized buckets over a global order, without pulling all rows into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import stored

# hex digits of the hash that cuts rows of one value into slices: 16 ** 3 slices
SLICE_DIGITS = 3


def tie_slice(tie: str) -> Column:
    return F.substring(F.md5(F.col(tie).cast("string")), 1, SLICE_DIGITS)


def distributed_ntile(rows: DataFrame, value: str, tie: str, n: int, name: str) -> DataFrame:
    """``ntile(n)`` over ``value`` descending (NULL last), ties ordered by
    ``(tie_slice(tie), tie)``.

    ``ntile`` without a partition sorts every row in a single task. Here a row's global
    rank is the sum of three counts:

    * rows with a greater value: the distinct values are range-partitioned, so this is a
      running sum inside a range plus the rows of the ranges before it (one row per range),
    * rows of the same value in earlier hash slices: a running sum over the slices,
    * its position inside its slice: ``row_number`` over 1/4096 of a value's rows, so a
      value that holds a third of all rows is still spread over the cluster.

    ``value`` may have any type that Spark orders; NaN is the greatest. ``tie`` must identify
    a row. ``rows`` is read by two branches: pass a stored table. The distinct values are
    stored on call, which fixes their ranges.
    """
    keyed = rows.withColumn("_value", F.col(value)).withColumn("_slice", tie_slice(tie))

    slices = keyed.groupBy("_value", "_slice").agg(F.count(F.lit(1)).alias("_rows"))
    down = F.desc_nulls_last("_value")
    values = slices.groupBy("_value").agg(F.sum("_rows").alias("_value_rows"))
    values = stored(
        values.repartitionByRange(down).sortWithinPartitions(down).withColumn("_range", F.spark_partition_id()),
        "ranking-values",
    )
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = values.groupBy("_range").agg(F.sum("_value_rows").alias("_range_rows"))
    ranges = ranges.select(
        "_range",
        F.coalesce(F.sum("_range_rows").over(before), F.lit(0)).alias("_before"),
        F.sum("_range_rows").over(Window.partitionBy()).alias("_total"),
    )
    inside = Window.partitionBy("_range").orderBy(down)
    above = F.sum("_value_rows").over(inside) - F.col("_value_rows")
    values = values.withColumn("_inside", above).join(ranges, "_range")
    values = values.select(
        F.col("_value").alias("_same"), (F.col("_before") + F.col("_inside")).alias("_above"), "_total"
    )
    earlier = Window.partitionBy("_value").orderBy("_slice")
    offsets = (
        slices.withColumn("_earlier", F.sum("_rows").over(earlier) - F.col("_rows"))
        .join(values, F.col("_value").eqNullSafe(F.col("_same")))
        .select("_same", F.col("_slice").alias("_same_slice"), "_earlier", "_above", "_total")
    )

    position = F.row_number().over(Window.partitionBy("_value", "_slice").orderBy(tie))
    same = F.col("_value").eqNullSafe(F.col("_same")) & (F.col("_slice") == F.col("_same_slice"))
    ranked = keyed.withColumn("_position", position).join(offsets, same)

    rank = F.col("_above") + F.col("_earlier") + F.col("_position") - 1
    size = F.floor(F.col("_total") / n)
    larger = F.col("_total") % n  # the first `larger` buckets hold one row more
    edge = larger * (size + 1)
    bucket = F.when(rank < edge, F.floor(rank / (size + 1))).otherwise(
        larger + F.floor((rank - edge) / F.nullif(size, F.lit(0)))
    )
    return ranked.select(*rows.columns, (bucket + 1).cast("int").alias(name))
