"""Tables kept up to date from new deliveries equal a full rebuild and leave the rest alone."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from shopflow.operators import descriptive, silver
from shopflow.plans import incremental
from shopflow.plans.incremental import Lake, update
from shopflow.schemas import BRONZE_EVENTS, RAW_COLUMNS
from shopflow.streaming import evolving
from shopflow.streaming.evolving import ingest_evolving, loaded


def deliver(root, month, name, rows, columns=RAW_COLUMNS, names=None):
    folder = root / month
    folder.mkdir(parents=True, exist_ok=True)
    lines = [",".join(names or columns), *(",".join(str(r.get(c, "")) for c in columns) for r in rows)]
    (folder / name).write_text("\n".join(lines) + "\n")


def event(day, user, product, kind="view", session=None, price="5.0", at="10:00:00"):
    return {
        "event_time": f"{day} {at} UTC" if day else "no time", "event_type": kind, "product_id": product,
        "category_id": 7, "category_code": "a.b", "brand": "x", "price": price, "user_id": user,
        "user_session": session or f"s{user}",
    }


def files(folder, key):
    """Files below each partition, with the time they were written."""
    return {
        p.name: {(f.name, f.stat().st_mtime_ns) for f in p.glob("*.parquet")} for p in folder.glob(f"{key}=*")
    }


def rows_of(table):
    return sorted(repr(tuple(r)) for r in table.select(sorted(table.columns)).collect())  # NaN included


def assert_equals_rebuild(spark, lake):
    bronze = loaded(spark, lake.path("bronze/events")).select(*BRONZE_EVENTS.names)
    fact = silver.fact_events(bronze)
    sessions = silver.dim_session(fact)
    for kept, direct in (
        (lake.table("silver/fact_events"), fact),
        (incremental.dim_product(lake), silver.dim_product(bronze)),
        (lake.table("silver/dim_session"), sessions),
        (lake.table("gold/daily_metrics"), descriptive.daily_metrics(fact)),
        (lake.table("gold/cart_abandonment"), descriptive.cart_abandonment(fact, sessions)),
    ):
        assert rows_of(kept) == rows_of(direct)


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))


def test_late_events_touch_their_days_only(spark, tmp_path, lake):
    raw = tmp_path / "raw"
    first = [event(f"2024-01-0{d}", u, 10 * d + u, kind) for d in range(1, 8) for u in range(5) for kind in ("view", "cart")]
    deliver(raw, "a", "1.csv", first)
    assert update(spark, str(raw), lake.root)["daily_metrics"] == [f"2024-01-0{d}" for d in range(1, 8)]
    assert_equals_rebuild(spark, lake)
    gold, fact = (tmp_path / "lake" / n for n in ("gold/daily_metrics", "silver/fact_events"))
    before, stored = files(gold, "day"), files(fact, "day")

    # a late event, a repeated one and a new day
    deliver(raw, "b", "1.csv", [event("2024-01-03", 99, 5, session="new"), first[0], event("2024-01-09", 1, 1, session="t")])
    changed = update(spark, str(raw), lake.root)
    assert changed["daily_metrics"] == ["2024-01-01", "2024-01-03", "2024-01-09"]
    assert_equals_rebuild(spark, lake)
    after = files(gold, "day")
    for d in (2, 4, 5, 6, 7):
        assert after[f"day=2024-01-0{d}"] == before[f"day=2024-01-0{d}"]
    assert after["day=2024-01-03"] != before["day=2024-01-03"]
    # the fact only grows: no stored file is rewritten, the repeated event adds no row
    assert all(found <= files(fact, "day")[name] for name, found in stored.items())
    assert update(spark, str(raw), lake.root) == {}


def test_a_purchase_settles_the_carts_of_other_days(spark, tmp_path, lake):
    raw = tmp_path / "raw"
    deliver(raw, "a", "1.csv", [event("2024-01-01", 1, 3, "cart", "long"), event("2024-01-03", 1, 3, "view", "long"), event("2024-01-02", 2, 4, "cart")])
    update(spark, str(raw), lake.root)
    gold = tmp_path / "lake/gold/cart_abandonment"
    assert set(files(gold, "day")) == {"day=2024-01-01", "day=2024-01-02"}
    kept = files(gold, "day")["day=2024-01-02"]
    deliver(raw, "b", "1.csv", [event("2024-01-05", 1, 3, "purchase", "long")])
    update(spark, str(raw), lake.root)
    assert_equals_rebuild(spark, lake)
    after = files(gold, "day")  # the first day has no abandoned cart left, and no folder
    assert set(after) == {"day=2024-01-02"}
    assert rows_of(lake.table("gold/cart_abandonment").select("abandoned_sessions")) == ["(1,)"]
    assert len(kept) == 1


def test_random_deliveries(spark, tmp_path, lake, monkeypatch):
    monkeypatch.setattr(incremental, "PARTS", 4)
    rng, raw = random.Random(4), tmp_path / "raw"
    for run in range(2):
        rows = []
        for _ in range(150):
            day = rng.choice([None, *(f"2024-01-{d:02}" for d in range(1, 9))])
            rows.append(event(day, rng.randrange(9), rng.choice([1, 2, 3, "", "x"]), rng.choice(["view", "cart", "purchase", "other"]),
                              rng.choice(["", None, "p", "q", "r"]), rng.choice(["1.5", "", "nan", "2"]), f"0{rng.randrange(9)}:00:00"))
        deliver(raw, f"m{run}", "1.csv", rows + rows[:20])
        update(spark, str(raw), lake.root)
        assert_equals_rebuild(spark, lake)


@pytest.mark.parametrize("step", ["gold/cart_abandonment", "silver/dim_session"])
def test_a_failed_run_is_repeated(spark, tmp_path, lake, monkeypatch, step):
    raw = tmp_path / "raw"
    deliver(raw, "a", "1.csv", [event(f"2024-01-0{d}", d, d, "cart") for d in range(1, 4)])
    update(spark, str(raw), lake.root)
    deliver(raw, "b", "1.csv", [event("2024-01-02", 8, 1), event("2024-01-04", 2, 2, "purchase", "s2")])
    replace = Lake.replace

    def fails(self, name, *rest):
        if name == step:
            raise RuntimeError("executors lost")
        replace(self, name, *rest)

    monkeypatch.setattr(Lake, "replace", fails)
    with pytest.raises(RuntimeError):
        update(spark, str(raw), lake.root)
    monkeypatch.undo()
    update(spark, str(raw), lake.root)
    assert_equals_rebuild(spark, lake)


def test_second_run_reads_new_loads_and_touched_days(spark, tmp_path, lake):
    raw = tmp_path / "raw"
    for month in "ab":
        deliver(raw, month, "1.csv", [event(f"2024-01-0{d}", d, d) for d in range(1, 6)])
        update(spark, str(raw), lake.root)
    new = loaded(spark, lake.path("bronze/events"), 0)
    plan = new._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(load" in plan
    fact = lake.read("silver/fact_events", silver.fact_events(new).select("*", incremental.day()))
    plan = fact.where(F.col("day").isin(["2024-01-02"]))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_columns_move_go_missing_and_are_added(spark, tmp_path):
    raw, target, ledger = tmp_path / "raw", str(tmp_path / "bronze"), str(tmp_path / "ledger")
    one = event("2024-01-01", 1, 2)
    deliver(raw, "a", "1.csv", [one])
    deliver(raw, "a", "2.csv", [one], tuple(reversed(RAW_COLUMNS)))
    deliver(raw, "a", "3.csv", [{**one, "campaign": "c1"}], (*RAW_COLUMNS[3:], "campaign"))
    (raw / "a" / "empty.csv").write_text("")
    assert ingest_evolving(spark, str(raw), target, ledger) == 3
    deliver(raw, "b", "4.csv", [{**one, "site": "z"}], ("site", *RAW_COLUMNS), ("﻿site", *RAW_COLUMNS))
    assert ingest_evolving(spark, str(raw), target, ledger, max_files_per_batch=1) == 1
    assert ingest_evolving(spark, str(raw), target, ledger) == 0
    rows = {r.source_file.rsplit("/", 1)[1]: r for r in loaded(spark, target).collect()}
    assert set(rows) == {f"{n}.csv" for n in range(1, 5)}
    for name in ("1.csv", "2.csv", "4.csv"):
        assert all(rows[name][c] == str(one[c]) for c in RAW_COLUMNS)
    assert rows["3.csv"].event_time is None and rows["3.csv"].price == "5.0"
    assert [rows[f"{n}.csv"].campaign for n in range(1, 5)] == [None, None, "c1", None]
    assert [rows[f"{n}.csv"].site for n in range(1, 5)] == [None, None, None, "z"]
    assert loaded(spark, target, 0).select("source_file").distinct().count() == 1
    assert loaded(spark, str(tmp_path / "none")).columns == [*BRONZE_EVENTS.names, "load"]


@pytest.mark.parametrize("names", [("a", "b"), ("price", "price"), ("price", "")])
def test_a_foreign_header_fails_the_load(spark, tmp_path, names):
    deliver(tmp_path / "raw", "a", "1.csv", [], names)
    with pytest.raises(ValueError):
        evolving.read_by_header(spark, [str(tmp_path / "raw/a/1.csv")])
