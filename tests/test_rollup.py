"""The stored rollup gives the same tables as the fact, and spares the wide shuffles."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from shopflow.operators import diagnostic, rollup, silver
from shopflow.plans.layers import Layers
from shopflow.sources import tables
from shopflow.sources.testdata import staged_bronze
from tests.events import fact, rows

PARAMETERS = dict(
    anchor="medium.ring", mega=10, elevated=5, split_date="2024-01-03", recency_anchor="2024-02-01"
)


@pytest.fixture(scope="module")
def stores(spark, tmp_path_factory):
    tables.create_databases(spark)
    root = str(tmp_path_factory.mktemp("rollup"))
    bronze = staged_bronze(spark, "/root/testdata/sf0.001")
    silver.fact_events(bronze).write.parquet(f"{root}/fact")
    events = spark.read.parquet(f"{root}/fact")
    rolled = tables.replace_bucketed(
        rollup.session_rollup(events), "silver.rollup_test", root, "v1", rollup.BUCKET_KEY, 4
    )
    return bronze, events, rolled


@pytest.mark.parametrize(
    "name",
    [
        "dim_session",
        "daily_metrics",
        "category_performance",
        "brand_performance",
        "top_products",
        "user_summary",
        "intent_by_view_depth",
        "cart_conversion_by_price",
        "attach_opportunity",
        "price_change_effect",
        "discount_tier_analysis",
        "november_cohort_behavior",
        "rfm_segmentation",
        "buyer_retention_oct_to_nov",
    ],
)
def test_same_result_from_rollup(stores, name):
    bronze, events, rolled = stores
    direct = Layers(bronze, events, **PARAMETERS)[name]
    via = Layers(bronze, events, rollup=rolled, **PARAMETERS)[name]
    assert direct.schema.simpleString() == via.schema.simpleString()
    assert direct.count() == via.count()
    assert direct.exceptAll(via).count() == 0


def test_pair_groupings_read_the_buckets_without_a_shuffle(stores):
    _, _, rolled = stores
    pairs = rolled.groupBy("event_date", "user_session", "product_id").agg(F.sum("views"))
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan and "Exchange" not in plan


def test_nulls_and_unpriced_events_survive_the_rollup(spark):
    events = fact(
        spark,
        {"product_id": None, "user_id": None, "category_code": None},
        {"event_type": "purchase", "price": None},
        {"event_type": "purchase", "price": 3},
        {"event_type": "cart", "price": 8},
        {"event_type": "remove_from_cart", "price": 99},
    )
    folded = rollup.session_rollup(events)
    got = rows(folded, "product_id")
    assert len(got) == 2
    pair = next(r for r in got if r["product_id"] == 1)
    assert (pair["events"], pair["carts"], pair["purchases"], pair["sold"]) == (4, 1, 2, 1)
    assert (pair["revenue"], pair["priced"]) == (3, 3)
    assert (pair["seen_price"], pair["cart_price"]) == (3.0, 8.0)
    assert rows(silver.dim_session(folded)) == rows(silver.dim_session(events))
    direct = rows(diagnostic.cart_conversion_by_price(events))
    assert rows(diagnostic.cart_conversion_by_price(folded)) == direct
