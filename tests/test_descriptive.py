from __future__ import annotations

from shopflow.operators import descriptive, silver
from tests.events import fact, one, rows


def test_funnel_is_monotonic(spark):
    events = fact(
        spark,
        {"user_session": "v"},
        {"user_session": "c", "event_type": "cart"},
        {"user_session": "p", "event_type": "purchase"},
        {"user_session": "vcp"},
        {"user_session": "vcp", "event_type": "cart"},
        {"user_session": "vcp", "event_type": "purchase"},
        {"user_session": "r", "event_type": "remove_from_cart"},
    )
    assert one(descriptive.funnel(silver.dim_session(events))) == {
        "total_sessions": 5,
        "sessions_with_view": 4,
        "sessions_with_cart": 3,
        "sessions_with_purchase": 2,
        "sessions_cart_logged": 2,
        "purchases_missing_cart_event": 1,
        "view_to_cart_pct": 75.0,
        "cart_to_purchase_pct": 66.67,
        "view_to_purchase_pct": 50.0,
    }


def test_funnel_of_nothing(spark):
    got = one(descriptive.funnel(silver.dim_session(fact(spark, {}).limit(0))))
    assert got["total_sessions"] == 0 and got["view_to_cart_pct"] is None


def test_daily_views_count_pairs_once(spark):
    events = fact(
        spark,
        *({"event_time": f"2024-01-01 10:00:{i:02}"} for i in range(11)),  # one pair
        {"product_id": None},  # a view of no product
        {"user_session": "s2", "user_id": 2, "product_id": 2},
        {"user_session": "s2", "user_id": 3, "event_type": "cart"},
        {"user_session": "s2", "user_id": None, "event_type": "purchase", "price": 0.1},
        {"user_session": "s2", "user_id": None, "event_type": "purchase", "price": 0.2},
        {"event_time": "2024-01-02 00:00:00", "event_type": "cart"},
    )
    first, second = rows(descriptive.daily_metrics(events), "event_date")
    assert (first["unique_users"], first["sessions"], first["product_views"]) == (3, 2, 2)
    assert (first["sessions_with_cart"], first["sessions_with_purchase"]) == (1, 1)
    assert (first["revenue"], first["purchase_events"]) == (0.3, 2)
    assert first["conversion_rate_pct"] == 50.0
    assert (second["sessions"], second["product_views"], second["revenue"]) == (1, 0, 0.0)


def test_cart_abandonment(spark):
    cart = {"event_type": "cart", "user_session": "left", "price": 5}
    events = fact(
        spark,
        cart,
        {**cart, "event_time": "2024-01-01 11:00:00"},  # same item again: once
        {**cart, "price": 6},  # price change: again
        {**cart, "event_time": "2024-01-02 00:00:01"},  # over midnight: again
        {**cart, "user_session": "bought"},
        {"event_type": "purchase", "user_session": "bought", "event_time": "2024-01-05 00:00:00"},
        {"user_session": "looked"},
    )
    one_day, next_day = rows(
        descriptive.cart_abandonment(events, silver.dim_session(events)), "event_date"
    )
    assert (one_day["abandoned_sessions"], one_day["affected_users"]) == (1, 1)
    assert one_day["abandoned_cart_value"] == 11.0
    assert next_day["abandoned_cart_value"] == 5.0


def test_categories_and_brands(spark):
    events = fact(
        spark,
        *({"event_time": f"2024-01-01 10:00:{i:02}"} for i in range(3)),
        {"product_id": None},
        {"event_type": "cart"},
        {"event_type": "cart", "event_time": "2024-01-01 12:00:00"},
        {"event_type": "purchase", "price": 10},
        {"event_type": "purchase", "price": None, "product_id": 2},
        {"category_code": "", "brand": "unknown", "event_type": "purchase", "price": 1},
        {"category_code": None, "brand": "unknown"},
        {"brand": "quiet", "category_code": "other"},
    )
    got = {r["category_code"]: r for r in rows(descriptive.category_performance(events))}
    phone = got["electronics.phone"]
    assert (phone["views"], phone["carts"], phone["purchases"]) == (1, 1, 2)
    assert (phone["revenue"], phone["view_to_purchase_pct"]) == (10.0, 200.0)
    assert (got["unknown"]["views"], got["unknown"]["purchases"]) == (1, 1)
    brands = {r["brand"]: r for r in rows(descriptive.brand_performance(events))}
    assert set(brands) == {"acme", "quiet"}
    # an unpriced purchase counts as a purchase but not in the mean
    assert (brands["acme"]["purchases"], brands["acme"]["avg_order_value"]) == (2, 10.0)
    assert brands["quiet"]["avg_order_value"] is None


def test_top_products_breaks_ties_and_limits(spark):
    events = fact(
        spark,
        {"product_id": 3, "event_type": "purchase", "price": 5},
        {"product_id": 2, "event_type": "purchase", "price": 5, "brand": "zeta"},
        {"product_id": 2, "brand": "beta", "category_code": None},
        {"product_id": 2, "brand": "beta", "event_time": "2024-01-01 11:00:00"},
        {"product_id": 1},
    )
    first, second = rows(descriptive.top_products(events, 2))
    assert [first["product_id"], second["product_id"]] == [2, 3]
    assert (first["views"], first["brand"]) == (2, "beta")  # views are rows here
    assert first["category_code"] == "electronics.phone"


def test_user_summary_and_hours(spark):
    events = fact(
        spark,
        {"event_time": "2024-01-01 23:59:59"},
        {"event_time": "2024-01-04 00:00:00", "user_session": "s2"},
        {"event_time": "2024-01-04 00:30:00", "user_session": "s2", "event_type": "purchase"},
        {"user_id": None, "user_session": "s3"},
    )
    got = {r["user_id"]: r for r in rows(descriptive.user_summary(events))}
    assert (got[1]["total_sessions"], got[1]["active_span_days"]) == (2, 3)
    assert (got[1]["purchase_count"], got[1]["total_spend"]) == (1, 100.0)
    assert got[None]["total_sessions"] == 1
    hours = {r["hour_of_day"]: r for r in rows(descriptive.hourly_pattern(events))}
    assert set(hours) == {0, 10, 23}
    assert (hours[0]["sessions"], hours[0]["purchases"], hours[0]["revenue"]) == (1, 1, 100.0)
