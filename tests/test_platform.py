from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from shopflow.functions.columns import mask_user_id
from shopflow.operators import governance, layout, ops
from tests.events import one, rows

HISTORY = (
    "statement_text string, statement_type string, total_duration_ms bigint, read_bytes bigint,"
    " read_rows bigint, start_time timestamp"
)


def test_daily_usage(spark):
    usage = spark.createDataFrame(
        [
            (date(2024, 1, 31), "sql", "DBU", 0.1, ("w1",)),
            (date(2024, 1, 31), "sql", "DBU", 0.2, ("w2",)),
            (date(2024, 1, 31), "sql", "DBU", 1.0, ("w2",)),
            (date(2024, 1, 31), "jobs", "DBU", 2.0, (None,)),
            (date(2024, 1, 1), "sql", "DBU", 5.0, ("w1",)),
            (date(2023, 12, 31), "sql", "DBU", 5.0, ("w1",)),
        ],
        "usage_date date, sku_name string, usage_unit string, usage_quantity double,"
        " usage_metadata struct<warehouse_id: string>",
    )
    got = rows(ops.daily_dbu_cost(usage, "2024-01-31"))
    assert [(r["usage_date"].day, r["sku_name"], r["dbus"], r["warehouses"]) for r in got] == [
        (31, "jobs", 2.0, 0),
        (31, "sql", 1.3, 2),
        (1, "sql", 5.0, 1),
    ]


def test_expensive_queries(spark):
    now = datetime(2024, 1, 8)
    history = spark.createDataFrame(
        [
            ("SELECT  1\n FROM t", "SELECT", 3000, 2_000_000_000, 10, now),
            ("SELECT 1 FROM\tt", "SELECT", 3001, None, 20, now),
            ("SELECT 2", "SELECT", 5000, 1, 1, now),  # not above the limit
            ("INSERT", "INSERT", 9000, 1, 1, now),
            ("SELECT old", "SELECT", 9000, 1, 1, datetime(2023, 12, 31, 23, 59)),
            ("SELECT edge", "SELECT", 9000, 1, 1, datetime(2024, 1, 1)),
            ("x" * 200, "SELECT", 6000, 1, 1, now),
        ],
        HISTORY,
    )
    got = rows(ops.expensive_queries(history, "2024-01-08"))
    assert [r["statement_preview"] for r in got] == ["SELECT edge", "SELECT 1 FROM t", "x" * 160]
    both = got[1]
    assert (both["executions"], both["total_seconds"], both["avg_seconds"]) == (2, 6.0, 3.0)
    assert (both["total_gb_read"], both["avg_rows_read"]) == (2.0, 15.0)


def test_job_runs(spark):
    def run(run_id, job, workspace, hour):
        began = datetime(2024, 1, 1, hour)
        return (run_id, job, workspace, began, datetime(2024, 1, 1, hour, 1, 30), "OK", None)

    runs = spark.createDataFrame(
        [run(1, 1, 1, 1), run(2, 1, 1, 2), run(3, 1, 2, 3), run(4, 2, 1, 4)],
        "run_id int, job_id int, workspace_id int, period_start_time timestamp,"
        " period_end_time timestamp, result_state string, termination_code string",
    )
    jobs = spark.createDataFrame(
        [(1, 1, "ours"), (2, 1, "theirs")], "job_id int, workspace_id int, name string"
    )
    got = rows(ops.pipeline_runs(runs, jobs, "ours"))
    assert [(r["run_id"], r["duration_min"]) for r in got] == [(2, 1.5), (1, 1.5)]
    assert [r["run_id"] for r in rows(ops.pipeline_runs(runs, jobs, "ours", 1))] == [2]


def test_table_usage(spark):
    read = "source_table_full_name string, source_table_catalog string, created_by string, event_time timestamp"
    lineage = spark.createDataFrame(
        [
            ("ecommerce.gold.a", "ecommerce", "x", datetime(2024, 1, 31)),
            ("ecommerce.gold.a", "ecommerce", "x", datetime(2024, 1, 30)),
            ("ecommerce.gold.b", "ecommerce", "y", datetime(2024, 1, 1)),
            ("ecommerce.gold.b", "ecommerce", "y", datetime(2023, 12, 31)),
            ("other.t", "other", "x", datetime(2024, 1, 31)),
        ],
        read,
    )
    got = rows(ops.table_usage(lineage, "2024-01-31"))
    assert [(r["table_name"], r["read_events"], r["distinct_users"]) for r in got] == [
        ("ecommerce.gold.a", 2, 1),
        ("ecommerce.gold.b", 1, 1),
    ]
    assert got[0]["last_read"] == datetime(2024, 1, 31)


def test_pii_inventory_lists_only_personal_data(spark):
    got = rows(governance.pii_inventory(governance.column_tags(spark)))
    assert [(r["schema_name"], r["table_name"], r["column_name"]) for r in got] == [
        ("bronze", "events", "user_id"),
        ("gold", "user_summary", "user_id"),
        ("silver", "dim_session", "user_id"),
        ("silver", "fact_events", "user_id"),
        ("silver", "fact_events", "user_session"),
    ]
    assert {r["pii_class"] for r in got} == {"pseudonymous_id"}
    assert got[-1]["sensitivity"] == "internal"
    assert governance.table_tags(spark).where("tag_name = 'layer'").count() == 4


def test_mask_keeps_counts_and_hides_ids(spark):
    users = spark.range(1000).withColumn(
        "user_id", F.when(F.col("id") > 0, F.col("id") % 300)
    )
    got = one(
        users.select("user_id", mask_user_id("user_id").alias("m")).agg(
            F.count_distinct("user_id").alias("plain"),
            F.count_distinct("m").alias("masked"),
            F.count_if(F.col("m") == F.col("user_id")).alias("same"),
            F.count_if(F.col("m").isNull()).alias("nulls"),
        )
    )
    assert got == {"plain": 300, "masked": 300, "same": 0, "nulls": 1}
    plain = users.select(mask_user_id("user_id", privileged=True).alias("m"))
    assert plain.exceptAll(users.select("user_id")).count() == 0


def test_compaction_keeps_rows_and_makes_fewer_files(spark, tmp_path):
    small, large = str(tmp_path / "small"), str(tmp_path / "large")
    spark.range(1000).repartition(16).write.parquet(small)
    assert layout.compact(spark, small, large) == 1
    assert len(list((tmp_path / "large").glob("*.parquet"))) == 1
    assert spark.read.parquet(large).count() == 1000
    assert layout.file_count(0) == 1
    assert layout.file_count(3 * layout.TARGET_FILE_BYTES + 1) == 4
