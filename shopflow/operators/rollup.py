"""Event counts: one form for single events and for the stored rollup.

Most tables need, per group, how many views, carts and purchases there were and for how
much. ``counted`` gives each event these measures as columns; ``session_rollup`` folds
them to (session, product, day, user, category, brand). Both have the same columns, so
every operator that sums them reads either: the fact directly, or in a full run the
rollup, which has fewer and narrower rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import is_event, units, units_where

KEYS = ("user_session", "product_id", "event_date", "user_id", "category_code", "brand")

# The rollup is stored in buckets of this key. Groups that contain both columns then need
# no shuffle, and a session with very many events is still spread over its products.
BUCKET_KEY = ("user_session", "product_id")

SUMMED = ("events", "views", "carts", "purchases", "revenue", "sold", "amount", "priced")

_COUNT_OF = {"view": "views", "cart": "carts", "purchase": "purchases"}


def is_rollup(events: DataFrame) -> bool:
    return "events" in events.columns


def only(events: DataFrame, *event_types: str) -> DataFrame:
    """Rows with any of the event types; on the fact this filter reaches the scan."""
    if not is_rollup(events):
        return events.where(F.col("event_type").isin(*event_types))
    some: Column = F.lit(False)
    for name in event_types:
        some = some | (F.col(_COUNT_OF[name]) > 0)
    return events.where(some)


def counted(events: DataFrame) -> DataFrame:
    """The measures of each row; amounts in exact units (see ``functions.columns``).

    ``revenue`` and ``sold``: value and number of priced purchases. ``amount`` and
    ``priced``: the same over all events. ``seen_price`` and ``cart_price``: the price when
    viewed or bought, and when carted or bought.
    """
    if is_rollup(events):
        return events

    def flag(condition: Column) -> Column:
        return F.when(condition, 1).otherwise(0).cast("bigint")

    view, cart, purchase = is_event("view"), is_event("cart"), is_event("purchase")
    has_price = F.col("price").isNotNull()
    return events.select(
        *KEYS,
        F.col("event_time").alias("first_event"),
        F.col("event_time").alias("last_event"),
        F.lit(1).cast("bigint").alias("events"),
        flag(view).alias("views"),
        flag(cart).alias("carts"),
        flag(purchase).alias("purchases"),
        units_where(purchase).alias("revenue"),
        flag(purchase & has_price).alias("sold"),
        units("price").alias("amount"),
        flag(has_price).alias("priced"),
        F.when(view | purchase, F.col("price")).alias("seen_price"),
        F.when(cart | purchase, F.col("price")).alias("cart_price"),
    )


def summed(*names: str) -> list[Column]:
    return [F.sum(name).alias(name) for name in names]


def session_rollup(fact: DataFrame) -> DataFrame:
    """The measures folded to ``KEYS``: the shared first step of most gold tables."""
    return (
        counted(fact)
        .groupBy(*KEYS)
        .agg(
            F.min("first_event").alias("first_event"),
            F.max("last_event").alias("last_event"),
            *summed(*SUMMED),
            F.max("seen_price").alias("seen_price"),
            F.max("cart_price").alias("cart_price"),
        )
    )
