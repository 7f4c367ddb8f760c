"""Small event tables for the operator tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from shopflow.schemas import FACT_EVENTS, RAW_COLUMNS, RAW_EVENTS

DEFAULTS = {
    "event_time": "2024-01-01 10:00:00",
    "event_type": "view",
    "product_id": 1,
    "category_id": 10,
    "category_code": "electronics.phone",
    "brand": "acme",
    "price": 100.0,
    "user_id": 1,
    "user_session": "s1",
}


def bronze(spark: SparkSession, *rows: dict) -> DataFrame:
    """Raw text rows; unnamed columns take the defaults."""
    filled = [{**DEFAULTS, **row} for row in rows]
    data = [
        tuple(None if r[c] is None else str(r[c]) for c in RAW_COLUMNS) for r in filled
    ]
    return spark.createDataFrame(data, RAW_EVENTS)


def fact(spark: SparkSession, *rows: dict) -> DataFrame:
    """Typed fact rows; the date follows from the time."""
    typed = bronze(spark, *rows)
    columns = {
        f.name: F.col("event_time" if f.name == "event_date" else f.name).cast(f.dataType)
        for f in FACT_EVENTS.fields
    }
    return typed.select(*(c.alias(name) for name, c in columns.items()))


def rows(frame: DataFrame, *key: str) -> list[dict]:
    out = [r.asDict() for r in frame.collect()]
    return sorted(out, key=lambda r: tuple(str(r[k]) for k in key)) if key else out


def one(frame: DataFrame) -> dict:
    (row,) = rows(frame)
    return row
