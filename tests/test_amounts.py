"""Sums of amounts are exact, whatever their size or number of digits."""

from __future__ import annotations

from pyspark.sql import functions as F

from shopflow.functions.columns import from_units, units
from shopflow.sources import tables


def total(frame):
    return frame.agg(from_units(F.sum(units("x"))).alias("t")).first().t


def test_small_and_large_amounts(spark):
    assert total(spark.range(1000).select(F.lit(0.00004).alias("x"))) == 0.04
    assert total(spark.range(100_000).select(F.lit(0.00014).alias("x"))) == 14.0
    assert total(spark.createDataFrame([(1e15,), (0.25,)], "x double")) == 1e15 + 0.25


def test_failed_bucketed_write_keeps_the_old_table(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS kept")
    root = str(tmp_path)
    tables.replace_bucketed(spark.range(5), "kept.t", root, "v1", ["id"], 2)
    broken = spark.range(5).select(F.raise_error(F.lit("no")).cast("long").alias("id"))
    try:
        tables.replace_bucketed(broken, "kept.t", root, "v2", ["id"], 2)
        raise AssertionError("the write should fail")
    except Exception as error:
        assert "no" in str(error)
    assert spark.table("kept.t").count() == 5
    tables.replace_bucketed(spark.range(7), "kept.t", root, "v3", ["id"], 2)
    assert spark.table("kept.t").count() == 7
