"""Diagnostic gold tables: intent, price bands, attach rate, price moves, category repair.

Parameters named ``events`` take the fact or its stored rollup (``operators.rollup``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..fixed_values import (
    ANCHOR_CATEGORY,
    INTENT_LAST,
    INTENT_STEPS,
    PRICE_LAST,
    PRICE_MOVE_PCT,
    PRICE_STEPS,
    RECOVERY_NONE,
    RECOVERY_PARTIAL,
)
from ..functions.columns import (
    below,
    from_units,
    is_blank,
    mean_of_units,
    pct,
    units,
    units_where,
)
from .rollup import counted, only, summed

Steps = Sequence[tuple[float, str]]


def user_product_interest(events: DataFrame) -> DataFrame:
    """Per (user, product) viewed or bought: views, whether bought, highest price seen."""
    return (
        counted(only(events, "view", "purchase"))
        .groupBy("user_id", "product_id")
        .agg(
            F.sum("views").alias("views"),
            (F.sum("purchases") > 0).alias("bought"),
            F.max("seen_price").alias("price"),
        )
    )


def _lost_value() -> Column:
    return F.round(from_units(F.sum(units_where(~F.col("bought")))), 0)


def intent_by_view_depth(
    events: DataFrame, steps: Steps = INTENT_STEPS, last: str = INTENT_LAST
) -> DataFrame:
    """Conversion and unconverted value by how often a user viewed a product."""
    order = [(bound, i) for i, (bound, _) in enumerate(steps, start=1)]
    pairs = user_product_interest(events).where("views > 0")
    return (
        pairs.groupBy(
            below(F.col("views"), steps, last).alias("view_band"),
            below(F.col("views"), order, len(order) + 1).alias("band_order"),
        )
        .agg(
            F.count(F.lit(1)).alias("user_product_pairs"),
            F.count_if("bought").alias("converted"),
            F.count_if(~F.col("bought")).alias("unconverted_pairs"),
            _lost_value().alias("unconverted_value"),
        )
        .select(
            "view_band",
            "band_order",
            "user_product_pairs",
            "converted",
            pct(F.col("converted"), F.col("user_product_pairs")).alias("conversion_pct"),
            "unconverted_pairs",
            "unconverted_value",
        )
    )


def retargeting_segment(events: DataFrame, min_views: int = 10) -> DataFrame:
    """The (user, product) pairs viewed at least ``min_views`` times and never bought."""
    return (
        user_product_interest(events)
        .where((F.col("views") >= min_views) & ~F.col("bought"))
        .select("user_id", "product_id", "views", "price")
    )


def cart_conversion_by_price(
    events: DataFrame, steps: Steps = PRICE_STEPS, last: str = PRICE_LAST
) -> DataFrame:
    """Share of carted (session, product) pairs that were bought, per price band."""
    carted = (
        counted(only(events, "cart", "purchase"))
        .groupBy("user_session", "product_id")
        .agg(
            F.max("cart_price").alias("price"),
            (F.sum("purchases") > 0).alias("bought"),
            F.sum("carts").alias("carts"),
        )
        .where("carts > 0")
    )
    return (
        carted.groupBy(below(F.col("price"), steps, last).alias("price_band"))
        .agg(
            F.count(F.lit(1)).alias("carted_items"),
            F.count_if("bought").alias("purchased"),
            _lost_value().alias("abandoned_value"),
        )
        .select(
            "price_band",
            "carted_items",
            "purchased",
            pct(F.col("purchased"), F.col("carted_items"), 1).alias("cart_conversion_pct"),
            "abandoned_value",
        )
    )


def _session_category_sales(events: DataFrame) -> DataFrame:
    """Purchases folded to (session, category): a session is at most as many rows as
    there are categories, whatever its number of purchases."""
    return (
        counted(only(events, "purchase"))
        .groupBy("user_session", "category_code")
        .agg(*summed("sold", "revenue"))
    )


def _anchor_sessions(events: DataFrame, anchor: str) -> DataFrame:
    return (
        only(events, "purchase")
        .where(F.col("category_code") == anchor)
        .select("user_session")
        .distinct()
    )


def _other_sales(events: DataFrame, anchor: str) -> DataFrame:
    """Sales of labelled categories other than the anchor, in sessions that bought the anchor."""
    others = _session_category_sales(events).where(
        (F.col("category_code") != anchor) & ~is_blank("category_code")
    )
    return others.join(_anchor_sessions(events, anchor), "user_session", "left_semi")


def attach_opportunity(events: DataFrame, anchor: str = ANCHOR_CATEGORY) -> DataFrame:
    """What buyers of the anchor category bought with it in the same session."""
    anchors = _anchor_sessions(events, anchor).agg(F.count(F.lit(1)))
    return (
        _other_sales(events, anchor)
        .groupBy(F.col("category_code").alias("attached_category"))
        .agg(
            F.count(F.lit(1)).alias("sessions"),
            *summed("sold", "revenue"),
        )
        .select(
            "attached_category",
            "sessions",
            pct(F.col("sessions"), anchors.scalar(), 3).alias("pct_of_phone_buyers"),
            mean_of_units(F.col("revenue"), F.col("sold")).alias("avg_price"),
            F.round(from_units(F.col("revenue")), 0).alias("revenue"),
        )
    )


def attach_rate_overall(events: DataFrame, anchor: str = ANCHOR_CATEGORY) -> DataFrame:
    """Sessions that bought the anchor, and those of them that bought anything else labelled.

    Counts sessions once, unlike the sum over ``attach_opportunity``.
    """
    by_session = (
        only(events, "purchase")
        .groupBy("user_session")
        .agg(
            F.count_if(F.col("category_code") == anchor).alias("anchors"),
            F.count_if(
                (F.col("category_code") != anchor) & ~is_blank("category_code")
            ).alias("others"),
        )
        .where("anchors > 0")
    )
    return by_session.agg(
        F.count(F.lit(1)).alias("anchor_sessions"),
        F.count_if(F.col("others") > 0).alias("attached_sessions"),
    ).withColumn("attach_pct", pct(F.col("attached_sessions"), F.col("anchor_sessions")))


def product_days(events: DataFrame) -> DataFrame:
    """Per (product, day): average price to the cent, purchases and views."""
    days = (
        counted(events)
        .groupBy("product_id", "event_date")
        .agg(*summed("amount", "priced", "purchases", "views"))
    )
    return days.select(
        "product_id",
        "event_date",
        mean_of_units(F.col("amount"), F.col("priced")).alias("avg_price"),
        "purchases",
        "views",
    )


def price_moves(events: DataFrame, move_pct: float = PRICE_MOVE_PCT) -> DataFrame:
    """Product-days with a positive price on the product's previous active day, labelled
    as cut, rise or stable.

    The window sees one row per active day of a product, so it stays as short as the
    calendar however many events a product has.
    """
    history = Window.partitionBy("product_id").orderBy("event_date")
    before = F.col("prev_price")
    move = (
        F.when(F.col("avg_price") < before * ((100 - move_pct) / 100), f"price cut >{move_pct}%")
        .when(F.col("avg_price") > before * ((100 + move_pct) / 100), f"price rise >{move_pct}%")
        .otherwise("stable")
    )
    return (
        product_days(events)
        .withColumn("prev_price", F.lag("avg_price").over(history))
        .where("prev_price > 0")
        .withColumn("price_move", move)
    )


def price_cuts(events: DataFrame, move_pct: float = PRICE_MOVE_PCT) -> DataFrame:
    return price_moves(events, move_pct).where(F.col("price_move") == f"price cut >{move_pct}%")


def price_change_effect(events: DataFrame, move_pct: float = PRICE_MOVE_PCT) -> DataFrame:
    """Conversion on product-days after a price cut, after a rise, and otherwise."""
    return (
        price_moves(events, move_pct)
        .groupBy("price_move")
        .agg(
            F.count(F.lit(1)).alias("product_days"),
            F.sum("views").alias("views"),
            F.sum("purchases").alias("purchases"),
        )
        .withColumn("conversion_pct", pct(F.col("purchases"), F.col("views")))
    )


def category_recovery_check(fact: DataFrame) -> DataFrame:
    """Whether blank category codes could be filled from rows with the same category id.

    One pass: an id is recoverable when it occurs both with and without a code.
    """
    blank = is_blank("category_code")
    ids = fact.groupBy("category_id").agg(
        (F.count_if(blank) > 0).alias("blank"), (F.count_if(~blank) > 0).alias("known")
    )
    counts = ids.agg(
        F.count_if("blank").alias("category_ids_with_blank_code"),
        F.count_if("known").alias("category_ids_with_known_code"),
        F.count_if(F.col("blank") & F.col("known") & F.col("category_id").isNotNull()).alias(
            "recoverable_ids"
        ),
    )
    return counts.withColumn(
        "verdict",
        F.when(F.col("recoverable_ids") == 0, RECOVERY_NONE).otherwise(RECOVERY_PARTIAL),
    )


def attach_uplift(
    events: DataFrame, anchor: str = ANCHOR_CATEGORY, target_pct: float = 10.0
) -> DataFrame:
    """Value of raising the overall attach rate to ``target_pct``, at the average price of
    the category that is attached most often."""
    best = (
        attach_opportunity(events, anchor)
        .orderBy(F.desc("sessions"), "attached_category")
        .limit(1)
        .select(F.struct("attached_category", "avg_price").alias("best"))
    )
    overall = attach_rate_overall(events, anchor)
    extra = F.greatest(
        F.col("anchor_sessions") * (target_pct / 100) - F.col("attached_sessions"), F.lit(0.0)
    )
    return overall.select(
        "anchor_sessions",
        "attached_sessions",
        best.scalar().alias("best"),  # one subquery: the category is looked for once
        F.round(extra, 0).alias("extra_sessions"),
    ).select(
        "anchor_sessions",
        "attached_sessions",
        "best.attached_category",
        "best.avg_price",
        "extra_sessions",
        F.round(F.col("extra_sessions") * F.col("best.avg_price"), 2).alias("uplift_value"),
    )


def recovery_sizing(
    cart_abandonment: DataFrame, low: float = 0.05, high: float = 0.15
) -> DataFrame:
    """Range of abandoned value that a recovery campaign would bring back."""
    lost = F.sum(units("abandoned_cart_value"))
    return cart_abandonment.agg(
        from_units(lost).alias("abandoned_value"),
        F.round(from_units(lost) * low, 2).alias("recoverable_low"),
        F.round(from_units(lost) * high, 2).alias("recoverable_high"),
    )
