"""One key holding a third of all rows changes neither results nor the shape of plans."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from shopflow.operators import deep_dive, descriptive, diagnostic, silver
from shopflow.plans.layers import Layers
from shopflow.sources.testdata import staged_bronze
from tests.events import rows


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    """A fact in which one session, user, product and day hold half of the rows."""
    path = str(tmp_path_factory.mktemp("skew") / "fact")
    plain = silver.fact_events(staged_bronze(spark, "/root/testdata/sf0.001"))
    hot = plain.select(
        "event_time",
        F.lit("2024-01-05").cast("date").alias("event_date"),
        "event_type",
        F.lit(7).cast("bigint").alias("product_id"),
        "category_id",
        F.lit("").alias("category_code"),
        "brand",
        "price",
        F.lit(1).cast("bigint").alias("user_id"),
        F.lit("bot").alias("user_session"),
    )
    plain.unionByName(hot).write.parquet(path)
    return spark.read.parquet(path)


def test_rollups_equal_direct_distinct_counts(spark, skewed):
    skewed.createOrReplaceTempView("f")
    pair = "CASE WHEN event_type = 'view' THEN concat(user_session, '-', product_id) END"
    want = spark.sql(
        f"SELECT event_date, count(DISTINCT user_id) u, count(DISTINCT user_session) s,"
        f" count(DISTINCT {pair}) v FROM f GROUP BY event_date"
    )
    got = descriptive.daily_metrics(skewed).select(
        "event_date", "unique_users", "sessions", "product_views"
    )
    assert got.exceptAll(want).count() == 0 and got.count() == want.count()
    want = spark.sql(
        f"SELECT coalesce(nullif(category_code, ''), 'unknown') c, count(DISTINCT {pair}) v"
        " FROM f GROUP BY 1"
    )
    got = descriptive.category_performance(skewed).select("category_code", "views")
    assert got.exceptAll(want).count() == 0 and got.count() == want.count()


def test_invariants(skewed):
    session = silver.dim_session(skewed)
    funnel = rows(descriptive.funnel(session))[0]
    stages = [funnel[f"sessions_with_{s}"] for s in ("view", "cart", "purchase")]
    assert stages == sorted(stages, reverse=True)
    pairs = diagnostic.user_product_interest(skewed).where("views > 0").count()
    bands = rows(diagnostic.intent_by_view_depth(skewed))
    assert sum(r["user_product_pairs"] for r in bands) == pairs
    carted = skewed.where("event_type = 'cart'").select("user_session", "product_id").distinct()
    bands = rows(diagnostic.cart_conversion_by_price(skewed))
    assert sum(r["carted_items"] for r in bands) == carted.count()
    groups = rows(deep_dive.rfm_segmentation(skewed, "2024-02-01"))
    assert max(r["buyers"] for r in groups) - min(r["buyers"] for r in groups) <= 1


def test_no_plan_multiplies_or_gathers_rows(skewed):
    """No cross join, no Python, no window over everything but a bounded aggregate."""
    tables = Layers(skewed, skewed, silver.dim_session(skewed), anchor="medium.ring")
    for name in (
        "daily_metrics",
        "category_performance",
        "brand_performance",
        "top_products",
        "user_summary",
        "hourly_pattern",
        "cart_abandonment",
        "intent_by_view_depth",
        "cart_conversion_by_price",
        "attach_opportunity",
        "price_change_effect",
        "discount_tier_analysis",
        "november_cohort_behavior",
    ):
        plan = tables[name]._jdf.queryExecution().executedPlan().toString()
        for word in ("CartesianProduct", "NestedLoopJoin", "Python", "ObjectHashAggregate"):
            assert word not in plan, (name, word)
        if name == "cart_abandonment":
            assert "Expand" not in plan


def test_filters_and_columns_reach_the_scan(skewed):
    plan = (
        diagnostic.attach_rate_overall(skewed, "medium.ring")
        ._jdf.queryExecution()
        .executedPlan()
        .toString()
    )
    assert "EqualTo(event_type,purchase)" in plan
    assert "ReadSchema: struct<event_type:string,category_code:string,user_session:string>" in plan
