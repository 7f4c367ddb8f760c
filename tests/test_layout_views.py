"""Interleaved layout, overlap of files, tier limits, cohort triangle, stored views."""

from __future__ import annotations

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from shopflow.operators import deep_dive, layout
from shopflow.plans import views
from shopflow.schemas import FACT_EVENTS


def opened(spark, path, key, values):
    ranges = layout.file_ranges(spark.read.parquet(path), key)
    wanted = spark.createDataFrame([(v,) for v in values], f"value {'date' if key == 'event_date' else 'long'}")
    return sum(r.files for r in layout.files_opened(ranges, wanted).collect())


def test_interleaved_order_serves_both_keys(spark, tmp_path):
    days = 32
    table = spark.range(32_000).select(
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % days).cast("int")).alias("event_date"),
        (F.col("id") * 7919 % 1000).alias("product_id"),
        "id",
    )
    for name, write in (("lexicographic", layout.clustered), ("interleaved", layout.interleaved)):
        write(table, files=16).write.parquet(str(tmp_path / name))
    dates = [date(2024, 1, 1) + timedelta(d) for d in range(days)]
    lex, both = str(tmp_path / "lexicographic"), str(tmp_path / "interleaved")
    products = range(0, 1000, 10)
    assert opened(spark, both, "product_id", products) * 2 < opened(spark, lex, "product_id", products)
    assert opened(spark, both, "event_date", dates) < 16 * days / 2  # a day still skips most files
    assert spark.read.parquet(both).exceptAll(table).isEmpty() and spark.read.parquet(both).count() == 32_000


def test_interleaved_takes_nulls_ties_and_no_rows(spark):
    odd = spark.createDataFrame([(None, None)] * 3 + [(date(2024, 1, 1), 5)] * 50 + [(date(2024, 1, 2), None)], "event_date date, product_id long")
    for table in (odd, odd.where("false")):
        assert sorted(map(repr, layout.interleaved(table, files=3).collect())) == sorted(map(repr, table.collect()))


def by_comparison(ranges):
    kept = [(a, b) for a, b in ranges if a is not None and b is not None]
    depths = [sum(lo <= a <= hi for lo, hi in kept) for a, _ in kept]
    n = len(kept)
    mean = sum(depths) / n if n else None
    return n, max(depths, default=None), mean, 1 - (mean - 1) / (n - 1) if n > 1 else None


@pytest.mark.parametrize("kind", ["random", "equal", "apart", "nested", "empty"])
def test_overlap_depth(spark, kind):
    rng = random.Random(8)
    ranges = {
        "random": [(a, a + rng.randrange(40)) for a in (rng.randrange(300) for _ in range(200))] + [(None, 3), (None, None)],
        "equal": [(4, 4)] * 60,
        "apart": [(10 * i, 10 * i + 9) for i in range(50)],
        "nested": [(i, 100 - i) for i in range(50)],
        "empty": [],
    }[kind]
    row = layout.overlap_depth(spark.createDataFrame(ranges, "lo long, hi long")).first()
    n, most, mean, quality = by_comparison(ranges)
    assert (row.ranges, row.max_depth) == (n, most)
    assert row.mean_depth == (None if mean is None else pytest.approx(mean, abs=1e-4))
    assert row.quality == (None if quality is None else pytest.approx(quality, abs=1e-4))


def test_tier_limits_are_nearest_ranks(spark):
    def limits(cuts):
        rows = spark.createDataFrame([(c,) for c in cuts], "products_cut long")
        return tuple(deep_dive.tier_limits(rows, 0.9, 0.5).first())

    assert limits(range(1, 11)) == (10, 9, 5)
    assert limits([7] * 20) == (20, 7, 7)  # ties: every day reaches the limit
    assert limits([1, 1, 1, 50]) == (4, 50, 1)
    assert limits([]) == (0, None, None)


def sale(day, user, price=1.0, kind="purchase"):
    return (None, day and date.fromisoformat(day), kind, 1, None, None, "b", price, user, f"s{user}")


def test_cohort_triangle(spark):
    rows = [
        sale("2024-01-05", 1), sale("2024-03-01", 1, 2.5), sale("2024-01-31", 2), sale("2024-02-01", 2), sale("2024-02-09", 3),
        sale("2024-01-01", 3, kind="view"), sale(None, 4), sale("2024-01-01", None), sale("2023-12-31", 5, None),
    ] + [sale("2024-02-10", 9, 0.1) for _ in range(300)] + [sale("2024-04-10", 9)]  # a heavy user
    made = deep_dive.cohort_triangle(spark.createDataFrame(rows, FACT_EVENTS)).collect()
    found = {(str(r.cohort), r.period_offset): tuple(r)[2:] for r in made}
    assert found == {
        ("2023-12-01", 0): (1, 1, 1, None, 100.0),  # no price is known
        ("2024-01-01", 0): (2, 2, 2, 2.0, 100.0),
        ("2024-01-01", 1): (2, 1, 1, 1.0, 50.0),
        ("2024-01-01", 2): (2, 1, 1, 2.5, 50.0),
        ("2024-02-01", 0): (2, 2, 301, 31.0, 100.0),
        ("2024-02-01", 2): (2, 1, 1, 1.0, 50.0),
    }
    for period in ("week", "half_month"):
        cells = deep_dive.cohort_triangle(spark.createDataFrame(rows, FACT_EVENTS), period).collect()
        assert sum(r.purchases for r in cells) == 307 and all(r.period_offset >= 0 for r in cells)
        assert sum(r.users for r in cells if r.period_offset == 0) == 5
    assert deep_dive.cohort_triangle(spark.createDataFrame([], FACT_EVENTS)).collect() == []


def test_views_outlive_the_session_and_follow_their_tables(spark, tmp_path):
    spark.sql(f"CREATE DATABASE stored_views LOCATION '{tmp_path / 'db'}'")
    tags = "catalog_name string, schema_name string, table_name string, column_name string, tag_name string, tag_value string"
    spark.createDataFrame([("ecommerce", "silver", "fact", "user_id", "pii", "yes")], tags).write.saveAsTable("stored_views.tags")
    made = views.create_views(spark, "stored_views", {"tags": "stored_views.tags", "usage": "stored_views.none"})
    assert made == ["stored_views.pii_inventory"]
    other = spark.newSession()
    assert [tuple(r) for r in other.table("stored_views.pii_inventory").collect()] == [("ecommerce", "silver", "fact", "user_id", "yes", None)]
    more = spark.createDataFrame([("ecommerce", "silver", "fact", "session", "pii", "yes"), ("ecommerce", "silver", "fact", "brand", "domain", "x")], tags)
    more.write.mode("append").saveAsTable("stored_views.tags")
    assert spark.newSession().table("stored_views.pii_inventory").count() == 2
