from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from shopflow.functions.ranking import distributed_ntile
from shopflow.operators import deep_dive, diagnostic
from tests.events import fact, one, rows

PHONE = "electronics.smartphone"


def views(product: int, n: int, **more):
    return [
        {"product_id": product, "event_time": f"2024-01-01 10:00:{i:02}", **more} for i in range(n)
    ]


def test_intent_bands(spark):
    events = fact(
        spark,
        *(row for p, n in enumerate((1, 2, 3, 4, 9, 10, 11)) for row in views(p, n, price=10)),
        {"product_id": 6, "event_type": "purchase", "price": 12},
        {"product_id": 99, "event_type": "purchase"},  # bought without a view
        {"product_id": 98, "event_type": "cart"},
    )
    got = rows(diagnostic.intent_by_view_depth(events), "band_order")
    assert [(r["view_band"], r["user_product_pairs"]) for r in got] == [
        ("1 view", 1),
        ("2-3 views", 2),
        ("4-9 views", 2),
        ("10+ views", 2),
    ]
    last = got[-1]
    assert (last["converted"], last["conversion_pct"]) == (1, 50.0)
    assert (last["unconverted_pairs"], last["unconverted_value"]) == (1, 10.0)
    segment = rows(diagnostic.retargeting_segment(events))
    assert [(r["product_id"], r["views"], r["price"]) for r in segment] == [(5, 10, 10.0)]


def test_price_bands(spark):
    prices = (9.99, 10, 25, 50, 100, 500, 1000, None)
    events = fact(
        spark,
        *({"product_id": i, "event_type": "cart", "price": p} for i, p in enumerate(prices)),
        {"product_id": 1, "event_type": "purchase", "price": 12},
        {"product_id": 77, "event_type": "purchase"},  # never carted
    )
    got = {r["price_band"]: r for r in rows(diagnostic.cart_conversion_by_price(events))}
    assert {k: v["carted_items"] for k, v in got.items()} == {
        "1. under 10": 1,
        "2. 10-25": 1,
        "3. 25-50": 1,
        "4. 50-100": 1,
        "5. 100-500": 1,
        "6. 500-1000": 1,
        "7. 1000+": 2,  # the NULL price too
    }
    assert (got["2. 10-25"]["purchased"], got["2. 10-25"]["cart_conversion_pct"]) == (1, 100.0)
    assert got["2. 10-25"]["abandoned_value"] == 0.0
    assert got["7. 1000+"]["abandoned_value"] == 1000.0


def sale(session, category, price=10.0, **more):
    return {
        "user_session": session,
        "category_code": category,
        "price": price,
        "event_type": "purchase",
        **more,
    }


def test_attach(spark):
    events = fact(
        spark,
        sale("a", PHONE),
        sale("a", "audio", 5),
        sale("a", "audio", 6),
        sale("a", "clock", 7),
        sale("b", PHONE),
        sale("b", ""),
        sale("b", None, product_id=2),
        sale("c", PHONE),
        sale("c", PHONE, product_id=2),
        sale("d", "audio"),  # no anchor
        {"user_session": "b", "category_code": "audio"},  # only viewed
    )
    got = {r["attached_category"]: r for r in rows(diagnostic.attach_opportunity(events))}
    assert set(got) == {"audio", "clock"}
    audio = got["audio"]
    assert (audio["sessions"], audio["pct_of_phone_buyers"]) == (1, 33.333)
    assert (audio["avg_price"], audio["revenue"]) == (5.5, 11.0)
    assert one(diagnostic.attach_rate_overall(events)) == {
        "anchor_sessions": 3,
        "attached_sessions": 1,
        "attach_pct": 33.33,
    }
    uplift = one(diagnostic.attach_uplift(events, target_pct=100))
    assert (uplift["attached_category"], uplift["extra_sessions"]) == ("audio", 2.0)
    assert uplift["uplift_value"] == 11.0


def day(n: int, price, product=1, kind="view"):
    return {
        "product_id": product,
        "event_time": f"2024-01-{n:02} 10:00:00",
        "price": price,
        "event_type": kind,
    }


def test_price_moves(spark):
    events = fact(
        spark,
        day(1, 100),  # first day: no move
        day(2, 95),  # exactly 0.95: stable
        day(9, 99.75),  # exactly 1.05 after a gap: stable
        day(10, 90),  # cut
        day(10, 90, kind="purchase"),
        day(11, 95),  # rise
        day(1, 0, product=2),
        day(2, 5, product=2),  # previous price 0: left out
    )
    got = {r["price_move"]: r for r in rows(diagnostic.price_change_effect(events))}
    assert {k: v["product_days"] for k, v in got.items()} == {
        "stable": 2,
        "price cut >5%": 1,
        "price rise >5%": 1,
    }
    cut = got["price cut >5%"]
    assert (cut["views"], cut["purchases"], cut["conversion_pct"]) == (1, 1, 100.0)


@pytest.mark.parametrize(
    "codes, want",
    [
        (((1, ""), (2, "x")), (1, 1, 0, "NOT")),
        (((1, ""), (1, "x"), (2, None)), (2, 1, 1, "PARTIALLY")),
        (((None, ""), (None, "x")), (1, 1, 0, "NOT")),  # a NULL id links nothing
    ],
)
def test_category_recovery(spark, codes, want):
    events = fact(spark, *({"category_id": i, "category_code": c} for i, c in codes))
    got = one(diagnostic.category_recovery_check(events))
    assert (
        got["category_ids_with_blank_code"],
        got["category_ids_with_known_code"],
        got["recoverable_ids"],
    ) == want[:3]
    assert got["verdict"].startswith(want[3])


def test_sale_day_tiers(spark):
    def cuts(d, n):  # n products cut on day d of the month
        return [
            row for p in range(n) for row in (day(d, 100, 100 * d + p), day(d + 1, 50, 100 * d + p))
        ]

    events = fact(spark, *cuts(1, 2), *cuts(5, 3), *cuts(9, 4), *cuts(13, 5))
    got = rows(deep_dive.discount_tier_analysis(events, mega=5, elevated=3), "sale_day_tier")
    assert [(r["sale_day_tier"][0], r["days"], r["views"]) for r in got] == [
        ("1", 1, 5),
        ("2", 2, 7),
        ("3", 1, 2),
    ]
    assert [r["products_cut"] for r in rows(deep_dive.top_cut_days(events, 2))] == [5, 4]


def test_cohorts(spark):
    events = fact(
        spark,
        {"user_id": 1, "event_time": "2019-10-31 23:59:59"},
        {"user_id": 1, "event_time": "2019-11-01 00:00:00"},
        {"user_id": 2, "event_time": "2019-11-01 00:00:00"},
        {"user_id": 2, "event_time": "2019-11-02 00:00:00", "event_type": "purchase"},
        {"user_id": 3, "event_time": "2019-10-05 00:00:00"},  # never came back
        {"user_id": None, "event_time": "2019-11-02 00:00:00"},
    )
    got = {r["user_cohort"]: r for r in rows(deep_dive.cohort_behavior(events))}
    old, new = got["returning (first seen October)"], got["new to November"]
    assert (old["users"], old["views"], old["conversion_pct"]) == (1, 1, 0.0)
    assert (new["users"], new["views"], new["conversion_pct"]) == (1, 1, 100.0)


def test_retention(spark):
    def buys(user, when):
        return {"user_id": user, "event_time": f"{when} 00:00:00", "event_type": "purchase"}

    events = fact(
        spark,
        buys(1, "2019-10-31"),
        buys(1, "2019-11-01"),
        buys(2, "2019-10-01"),
        buys(3, "2019-11-05"),
        buys(None, "2019-10-01"),
        buys(None, "2019-11-01"),
    )
    got = one(deep_dive.buyer_retention(events))
    assert (got["period_1_buyers"], got["returned"], got["pct_returned"]) == (3, 1, 33.33)
    later = events.where(F.col("event_date") >= "2019-11-01")
    assert one(deep_dive.buyer_retention(later))["pct_returned"] is None


@pytest.mark.parametrize("n", [1, 3, 4, 5, 7, 50])
def test_recency_groups_differ_by_at_most_one(spark, n):
    events = fact(
        spark,
        *(
            {
                "user_id": u,
                "user_session": f"s{u}",
                "event_type": "purchase",
                "price": 10 + u,
                "event_time": f"2019-11-{1 + (u % 3):02} 00:00:00",
            }
            for u in range(n)
        ),
        {"user_id": 1000, "user_session": "x"},  # spent nothing
        {"user_id": None, "user_session": "y", "event_type": "purchase"},
    )
    got = rows(deep_dive.rfm_segmentation(events), "recency_score")
    sizes = [r["buyers"] for r in got]
    assert [r["recency_score"] for r in got] == list(range(1, min(n, 4) + 1))
    assert sum(sizes) == n and max(sizes) - min(sizes) <= 1
    assert sizes == sorted(sizes, reverse=True)
    days = [r["avg_recency_days"] for r in got]
    assert days == sorted(days, reverse=True)


def test_distributed_ntile_equals_ntile(spark):
    """Against the single-task window, with a third of all rows on one value and a NULL."""
    values = [7] * 100 + [i % 17 for i in range(199)] + [None]
    table = spark.createDataFrame(list(enumerate(values)), "id bigint, v int")
    table.createOrReplaceTempView("ranked")
    want = spark.sql(
        "SELECT id, ntile(7) OVER (ORDER BY v DESC NULLS LAST,"
        " substring(md5(cast(id AS string)), 1, 3), id) AS b FROM ranked"
    ).collect()
    got = distributed_ntile(table, "v", "id", 7, "b").select("id", "b").collect()
    assert {r["id"]: r["b"] for r in got} == {r["id"]: r["b"] for r in want}
    assert max(r["b"] for r in got) == 7


def test_distributed_ntile_ranks_fractions(spark):
    """Values that differ only after the point, NaN and infinity, over several ranges."""
    values = [i / 1000 for i in range(500)] + [0.25] * 200 + [float("nan"), float("inf"), None, -0.5]
    table = spark.createDataFrame(list(enumerate(values)), "id bigint, v double")
    table.createOrReplaceTempView("fractions")
    want = spark.sql(
        "SELECT id, ntile(5) OVER (ORDER BY v DESC NULLS LAST,"
        " substring(md5(cast(id AS string)), 1, 3), id) AS b FROM fractions"
    ).collect()
    got = distributed_ntile(table, "v", "id", 5, "b").select("id", "b").collect()
    assert len(got) == len(values)
    assert {r["id"]: r["b"] for r in got} == {r["id"]: r["b"] for r in want}
