"""Benchmark: headline queries over the test tables, and one full table build.

Prints one JSON line. Every query starts from the raw Parquet tables (nothing is cached
between queries) and is computed in full through a ``noop`` write; the number is the
median of the warm runs. ``build_all`` goes from CSV files to all finished tables.

BENCH_SF_DIR, BENCH_CPUS, BENCH_RUNS choose the input, cores and repetitions.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from datetime import datetime

from shopflow.plans.build import build_all
from shopflow.plans.registry import COHORT_SPLIT, QUERIES, RECENCY, ANCHOR
from shopflow.session import local_session
from shopflow.sources.raw_csv import write_raw
from shopflow.sources.testdata import staged_bronze

HEADLINE = (
    "fact_events",
    "dim_product",
    "dim_session",
    "daily_metrics",
    "funnel",
    "cart_abandonment",
    "category_performance",
    "brand_performance",
    "top_products",
    "user_summary",
    "hourly_pattern",
    "data_quality",
    "intent_by_view_depth",
    "cart_conversion_by_price",
    "attach_opportunity",
    "price_change_effect",
    "category_recovery_check",
    "discount_tier_analysis",
    "cohort_behavior",
    "rfm_segmentation",
    "buyer_retention",
    "metric_drift",
    "primary_key_check",
    "foreign_key_check",
    "daily_dbu_cost",
    "expensive_queries",
    "job_runs",
)


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    work = tempfile.mkdtemp(prefix="shopflow-bench-")
    spark = local_session(
        cpus,
        "shopflow-bench",
        **{
            "spark.sql.warehouse.dir": f"{work}/warehouse",
            "spark.checkpoint.dir": f"{work}/shared",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    seconds = {}
    for name in HEADLINE:

        def run(query=QUERIES[name]):
            query(spark, sf_dir).write.format("noop").mode("overwrite").save()

        run()  # warm-up: class loading and code generation
        seconds[name] = round(statistics.median(timed(run) for _ in range(runs)), 3)

    bronze = staged_bronze(spark, sf_dir)
    write_raw(bronze, f"{work}/raw/2024-01")
    build = timed(
        lambda: build_all(
            spark,
            f"{work}/raw",
            f"{work}/out",
            "bench",
            datetime(2024, 2, 1),
            anchor=ANCHOR,
            split_date=COHORT_SPLIT,
            recency_anchor=RECENCY,
        )
    )
    total = sum(seconds.values())
    print(
        json.dumps(
            {
                "metric": "sum of median warm query seconds",
                "value": round(total, 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "build_all_sec": round(build, 3),
                "build_all_rows": bronze.count(),
                "cpus": cpus,
                "spark": spark.version,
                "shuffle_partitions": spark.conf.get("spark.sql.shuffle.partitions"),
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    sys.exit(main())
