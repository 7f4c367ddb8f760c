from __future__ import annotations

import shutil

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from shopflow.schemas import BRONZE_EVENTS, METRICS_HISTORY, RAW_COLUMNS
from shopflow.sources import tables
from shopflow.sources.raw_csv import read_raw
from shopflow.streaming.ingest import bronze_events, ingest

HEADER = ",".join(RAW_COLUMNS)


def deliver(root, month, name, *lines):
    folder = root / month
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join((HEADER, *lines)) + "\n")


LINE = "2019-10-01 00:00:00 UTC,view,44600062,2103807459595387724,appliances.kitchen,shiseido,35.79,541312140,72d76fde"
BLANK = "2019-10-01 00:00:01 UTC,view,1,2,,\"\",1.0,3,s"


def test_ingest_is_incremental_and_idempotent(spark, tmp_path):
    raw, target, ledger = tmp_path / "raw", str(tmp_path / "bronze"), str(tmp_path / "ledger")
    deliver(raw, "2019-Oct", "part1.csv", LINE, BLANK)
    deliver(raw, "2019-Nov", "part1.csv", LINE)
    assert ingest(spark, str(raw), target, ledger) == 3
    assert ingest(spark, str(raw), target, ledger) == 0
    deliver(raw, "2019-Nov", "part2.csv", LINE)
    deliver(raw, "2019-Dec", "part1.csv", LINE, LINE)
    assert ingest(spark, str(raw), target, ledger, max_files_per_batch=1) == 3
    loaded = bronze_events(spark, target)
    assert loaded.schema == BRONZE_EVENTS
    assert loaded.count() == 6
    assert loaded.select("source_file").distinct().count() == 4
    # nothing is cast, and blank fields arrive as NULL whether quoted or not
    first = loaded.where("product_id = '44600062'").first()
    assert (first["event_time"], first["price"]) == ("2019-10-01 00:00:00 UTC", "35.79")
    blank = loaded.where("product_id = '1'").first()
    assert blank["category_code"] is None and blank["brand"] is None
    direct = read_raw(spark, str(raw))
    assert direct.exceptAll(loaded).count() == 0 and direct.count() == 6


def test_files_of_a_failed_attempt_are_not_read(spark, tmp_path):
    target = tmp_path / "bronze"
    deliver(tmp_path / "raw", "2019-Oct", "a.csv", LINE, LINE)
    ingest(spark, str(tmp_path / "raw"), str(target), str(tmp_path / "ledger"))
    written = next(target.glob("*.parquet"))
    shutil.copy(written, target / "part-stray.parquet")
    tables.create_databases(spark)
    table = tables.create_table(spark, "bronze.stray_test", BRONZE_EVENTS, str(target))
    assert table.count() == bronze_events(spark, str(target)).count() == 2


def test_read_takes_one_level_of_folders(spark, tmp_path):
    deliver(tmp_path, "2019-Oct", "a.csv", LINE)
    deliver(tmp_path, "2019-Oct/deeper", "b.csv", LINE)
    deliver(tmp_path, ".", "top.csv", LINE)
    assert read_raw(spark, str(tmp_path)).count() == 1


def test_additive_schema_evolution(spark, tmp_path):
    spark.range(2).write.parquet(str(tmp_path / "v1"))
    wide = spark.range(3).withColumn("extra", F.lit("x"))
    wide.write.parquet(str(tmp_path / "v2"))
    merged = tables.read_evolving(spark, str(tmp_path / "v1"), str(tmp_path / "v2"))
    assert merged.count() == 5 and merged.where("extra IS NULL").count() == 2
    stacked = tables.union_evolving(spark.range(2).toDF("id"), wide)
    assert stacked.columns == ["id", "extra"] and stacked.count() == 5


def test_replace_reads_the_version_it_replaces(spark, tmp_path):
    tables.create_databases(spark)
    root = str(tmp_path)
    tables.replace_table(spark.range(3), "gold.swap", root, "v1")
    again = spark.table("gold.swap").union(spark.table("gold.swap"))
    assert tables.replace_table(again, "gold.swap", root, "v2").count() == 6
    wider = spark.table("gold.swap").withColumn("more", F.lit(1))
    assert tables.replace_table(wider, "gold.swap", root, "v3").columns == ["id", "more"]
    assert spark.read.parquet(f"{root}/gold/swap/v1").count() == 3


def test_create_append_and_view(spark, tmp_path):
    tables.create_databases(spark)
    where = str(tmp_path / "history")
    first = tables.create_table(spark, "ops.history_test", METRICS_HISTORY, where)
    assert first.schema == METRICS_HISTORY and first.count() == 0
    row = spark.sql("SELECT 'm', 1D, TIMESTAMP '2024-01-01', 'r'")
    tables.append(row, "ops.history_test")
    tables.create_table(spark, "ops.history_test", METRICS_HISTORY, where)
    assert spark.table("ops.history_test").count() == 1
    tables.create_view(spark.table("ops.history_test"), "history_view")
    assert spark.sql("SELECT value FROM history_view").first()[0] == 1.0


def test_a_died_swap_of_a_bucketed_table_loses_neither_version(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS swapped LOCATION '{tmp_path / 'db'}'")
    root, name = str(tmp_path / "lake"), "swapped.numbers"
    tables.replace_bucketed(spark.range(10), name, root, "v1", ["id"], 2)
    spark.sql(f"ALTER TABLE {name} RENAME TO {name}__former")  # died between the renames
    with pytest.raises(AnalysisException):  # the next run fails as well: its folder exists
        tables.replace_bucketed(spark.range(30), name, root, "v1", ["id"], 2)
    assert spark.table(name).count() == 10
    assert tables.replace_bucketed(spark.range(30), name, root, "v2", ["id"], 2).count() == 30
    assert "numbers__former" not in {t.name for t in spark.catalog.listTables("swapped")}
