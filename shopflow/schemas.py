"""Schemas of the tables that cross a storage boundary."""

from __future__ import annotations

from pyspark.sql import types as T

RAW_COLUMNS = (
    "event_time",
    "event_type",
    "product_id",
    "category_id",
    "category_code",
    "brand",
    "price",
    "user_id",
    "user_session",
)


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


RAW_EVENTS = _schema(**{name: T.StringType() for name in RAW_COLUMNS})

BRONZE_EVENTS = T.StructType(RAW_EVENTS.fields + [T.StructField("source_file", T.StringType())])

FACT_EVENTS = _schema(
    event_time=T.TimestampType(),
    event_date=T.DateType(),
    event_type=T.StringType(),
    product_id=T.LongType(),
    category_id=T.DecimalType(30, 0),
    category_code=T.StringType(),
    brand=T.StringType(),
    price=T.DoubleType(),
    user_id=T.LongType(),
    user_session=T.StringType(),
)

METRICS_HISTORY = _schema(
    metric_name=T.StringType(),
    value=T.DoubleType(),
    snapshot_ts=T.TimestampType(),
    run_id=T.StringType(),
)

COLUMN_TAGS = _schema(
    catalog_name=T.StringType(),
    schema_name=T.StringType(),
    table_name=T.StringType(),
    column_name=T.StringType(),
    tag_name=T.StringType(),
    tag_value=T.StringType(),
)

TABLE_TAGS = _schema(
    catalog_name=T.StringType(),
    schema_name=T.StringType(),
    table_name=T.StringType(),
    tag_name=T.StringType(),
    tag_value=T.StringType(),
)
