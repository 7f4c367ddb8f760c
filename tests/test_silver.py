from __future__ import annotations

import datetime as dt

import pytest
from pyspark.errors import PySparkException

from shopflow.operators import integrity, quality, silver
from tests.events import bronze, fact, one, rows


def test_fact_filters_types_and_deduplicates(spark):
    raw = bronze(
        spark,
        {},
        {},  # exact duplicate
        {"price": 100.5},
        {"event_type": "remove_from_cart"},
        {"event_type": "signup"},
        {"event_type": None},
        {"user_session": None},
        {"event_time": None},
        {"brand": ""},
        {"brand": None, "price": "free"},  # malformed price
        {"event_time": "2024-01-01 10:00:00 UTC"},  # same instant as the first row
        {"event_time": "2024-01-02 00:00:01 UTC"},
    )
    got = rows(silver.fact_events(raw), "event_time", "event_type", "price", "brand")
    assert len(got) == 6
    assert {r["brand"] for r in got} == {"acme", "unknown"}
    assert [r["price"] for r in got if r["brand"] == "unknown"] == [100.0, None]
    assert {r["event_date"] for r in got} == {dt.date(2024, 1, 1), dt.date(2024, 1, 2)}
    assert "remove_from_cart" in {r["event_type"] for r in got}


def test_fact_keeps_category_code_raw(spark):
    got = rows(silver.fact_events(bronze(spark, {"category_code": ""}, {"category_code": None})))
    assert {r["category_code"] for r in got} == {"", None}


def test_dim_product_takes_the_newest_row(spark):
    raw = bronze(
        spark,
        {"event_time": "2024-01-01 10:00:00", "brand": "old", "price": 9},
        {"event_time": "2024-01-03 10:00:00", "brand": "new", "price": 7},
        {"event_time": "2024-01-02 10:00:00", "brand": "mid"},
        {"product_id": 2, "category_code": "toys", "brand": ""},
        {"product_id": 3, "category_code": "", "brand": None},
        {"product_id": 4, "category_code": None},
        {"product_id": 5, "brand": "a", "price": 1},  # tie on time
        {"product_id": 5, "brand": "b", "price": 1},
        {"product_id": 6, "event_time": None, "brand": "undated"},
        {"product_id": None},
    )
    got = {r["product_id"]: r for r in rows(silver.dim_product(raw))}
    assert set(got) == {1, 2, 3, 4, 5, 6}
    assert (got[1]["brand"], got[1]["price"]) == ("new", 7.0)
    assert (got[1]["category_l1"], got[1]["category_l2"]) == ("electronics", "phone")
    assert (got[2]["category_l1"], got[2]["category_l2"]) == ("toys", None)
    assert got[2]["brand"] == "" and got[2]["brand_clean"] == "unknown"
    assert got[3]["category_code_clean"] == "unknown" and got[3]["brand_clean"] == "unknown"
    assert got[4]["category_l1"] is None and got[4]["category_code_clean"] == "unknown"
    assert got[5]["brand"] == "b"
    assert got[6]["brand"] == "undated"


def test_dim_session_flags_span_and_revenue(spark):
    events = fact(
        spark,
        {"user_session": "buy", "event_type": "purchase", "price": 10.1, "user_id": 7},
        {"user_session": "buy", "event_type": "purchase", "price": 0.2, "user_id": 5},
        {"user_session": "buy", "event_type": "view", "product_id": 2, "user_id": 6},
        {"user_session": "buy", "event_type": "view", "product_id": None, "user_id": 6},
        {"user_session": "cart", "event_type": "cart", "user_id": None},
        {"user_session": "cart", "event_type": "cart", "event_time": "2024-01-02 11:00:00"},
        {"user_session": "odd", "event_type": "remove_from_cart"},
        {"user_session": "unpriced", "event_type": "purchase", "price": None},
    )
    got = {r["user_session"]: r for r in rows(silver.dim_session(events))}
    buy = got["buy"]
    assert (buy["user_id"], buy["event_count"], buy["distinct_products"]) == (5, 4, 2)
    assert (buy["has_view"], buy["has_cart"], buy["has_purchase"]) == (True, False, True)
    assert buy["session_revenue"] == 10.3  # exact, not 10.299999999999999
    cart = got["cart"]
    assert (cart["user_id"], cart["has_cart"], cart["has_purchase"]) == (1, True, False)
    assert cart["session_end"] - cart["session_start"] == dt.timedelta(hours=25)
    assert not any(got["odd"][f] for f in ("has_view", "has_cart", "has_purchase"))
    assert got["odd"]["session_revenue"] == 0.0
    assert got["unpriced"]["session_revenue"] is None


def test_quality_checks(spark):
    raw = bronze(
        spark,
        {"category_code": ""},
        {"category_code": None, "brand": ""},
        {"brand": None},
        {},
    )
    events = fact(
        spark,
        {"user_session": "a", "event_type": "purchase", "price": 0},
        {"user_session": "a", "event_time": "2024-01-02 10:00:00"},  # exactly 24 hours
        {"user_session": "b", "event_type": "cart", "price": -1},
        {"user_session": "b", "event_type": "purchase", "event_time": "2024-01-02 10:00:01"},
        {"user_session": "c", "price": None},
    )
    table = quality.data_quality(raw, events, silver.dim_session(events))
    got = {r["check_name"]: (r["affected_rows"], r["pct_affected"]) for r in rows(table)}
    assert got == {
        "missing_category_code": (2, 50.0),
        "missing_brand": (2, 50.0),
        "purchase_without_cart": (1, 50.0),
        "purchase_without_view": (1, 50.0),
        "zero_or_negative_price": (2, 40.0),
        "multiday_sessions": (1, 33.33),
    }


def test_quality_checks_on_empty_tables(spark):
    raw = bronze(spark, {}).limit(0)
    events = fact(spark, {}).limit(0)
    got = rows(quality.data_quality(raw, events, silver.dim_session(events)))
    assert len(got) == 6
    assert {(r["affected_rows"], r["pct_affected"]) for r in got} == {(0, None)}


def test_reconciliation_adds_up(spark):
    raw = bronze(
        spark,
        {},
        {},
        {"price": "free"},
        {"event_time": None},
        {"user_session": None, "event_type": "signup"},
        {"event_type": "signup"},
        {"event_type": None},
        {"product_id": "x"},
    )
    events = silver.fact_events(raw)
    got = one(quality.layer_reconciliation(raw, events, silver.dim_session(events), silver.dim_product(raw)))
    assert got["bronze_rows"] == 8
    assert got["rows_without_key"] == 2
    assert got["rows_other_event_type"] == 2
    assert got["accepted_rows"] == 4 and got["fact_rows"] == 3 and got["duplicate_rows"] == 1
    assert got["rows_with_malformed_text"] == 2
    assert got["session_rows"] == 1 and got["product_rows"] == 1


def test_key_reference_and_domain_checks(spark):
    table = spark.createDataFrame([(1,), (1,), (1,), (2,), (None,)], "k int")
    assert one(integrity.key_check(table, "t", "k")) == {
        "check_name": "t",
        "row_count": 5,
        "null_key_rows": 1,
        "duplicated_keys": 1,
        "surplus_rows": 2,
    }
    parent = spark.createDataFrame([(2,), (3,)], "id int")
    assert one(integrity.reference_check(table, "k", parent, "id", "fk")) == {
        "check_name": "fk",
        "orphan_keys": 1,
        "orphan_rows": 3,
    }
    types = spark.createDataFrame([("view",), ("click",), (None,)], "event_type string")
    assert one(integrity.domain_check(types, "d"))["violations"] == 1


def test_enforced_domain_fails_the_job(spark):
    good = spark.createDataFrame([("view",), (None,)], "event_type string")
    assert integrity.enforce_domain(good).count() == 2
    bad = spark.createDataFrame([("view",), ("click",)], "event_type string")
    with pytest.raises(PySparkException, match="outside its domain"):
        integrity.enforce_domain(bad).collect()
