"""Follow-up analyses: sale-day tiers, user cohorts, recency segments, retention.

Parameters named ``events`` take the fact or its stored rollup (``operators.rollup``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..fixed_values import (
    COHORT_NEW,
    COHORT_RETURNING,
    ELEVATED_CUTS,
    MEGA_CUTS,
    RECENCY_ANCHOR,
    SPLIT_DATE,
    TIER_BACKGROUND,
    TIER_ELEVATED,
    TIER_MEGA,
)
from ..functions.columns import from_units, pct, period_number, period_start, ratio, units
from ..functions.ranking import distributed_ntile
from ..session import stored
from .diagnostic import price_cuts
from .rollup import counted, only, summed


# shares of days below the limits of the sale-day tiers that follow from the data
MEGA_SHARE, ELEVATED_SHARE = 0.95, 0.75


def _day(text: str) -> Column:
    return F.lit(text).cast("date")


def cut_days(events: DataFrame) -> DataFrame:
    """Per day: products whose price was cut, with the day's views and purchases of them."""
    return (
        price_cuts(events)
        .where(F.col("event_date").isNotNull())
        .groupBy("event_date")
        .agg(
            F.count("product_id").alias("products_cut"),
            F.sum("views").alias("views"),
            F.sum("purchases").alias("purchases"),
        )
    )


def _with_tier(days: DataFrame, mega: int | Column, elevated: int | Column) -> DataFrame:
    cuts = F.col("products_cut")
    return days.withColumn(
        "sale_day_tier",
        F.when(cuts >= mega, TIER_MEGA)
        .when(cuts >= elevated, TIER_ELEVATED)
        .otherwise(TIER_BACKGROUND),
    )


def _tier_totals(days: DataFrame, *keys: str) -> DataFrame:
    return (
        days.groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("days"),
            F.sum("purchases").alias("purchases"),
            F.sum("views").alias("views"),
        )
        .withColumn("conversion_pct", pct(F.col("purchases"), F.col("views")))
    )


def discount_tier_analysis(
    events: DataFrame, mega: int = MEGA_CUTS, elevated: int = ELEVATED_CUTS, period: str = "month"
) -> DataFrame:
    """Conversion of price-cut product-days by month and by how many products were cut that day.

    The tier follows from the day, so the cuts are folded to days first and no join back
    is needed.
    """
    days = _with_tier(cut_days(events), mega, elevated)
    return _tier_totals(
        days.withColumn("month", period_start("event_date", period)), "month", "sale_day_tier"
    )


def sale_tier_totals(
    events: DataFrame, mega: int = MEGA_CUTS, elevated: int = ELEVATED_CUTS
) -> DataFrame:
    """The tiers over the whole period."""
    return _tier_totals(_with_tier(cut_days(events), mega, elevated), "sale_day_tier")


def tier_limits(days: DataFrame, mega: float = MEGA_SHARE, elevated: float = ELEVATED_SHARE) -> DataFrame:
    """Tier cut-offs of the data themselves: the least number of products cut that at least the
    given share of days do not exceed (exact, by nearest rank). ``days``: ``cut_days``."""

    def limit(share: float) -> Column:
        return F.expr(f"percentile_disc({share}) WITHIN GROUP (ORDER BY products_cut)").cast("bigint")

    return days.agg(
        F.count(F.lit(1)).alias("days"), limit(mega).alias("mega_cuts"), limit(elevated).alias("elevated_cuts")
    )


def quantile_tier_analysis(
    events: DataFrame, mega: float = MEGA_SHARE, elevated: float = ELEVATED_SHARE, period: str = "month"
) -> DataFrame:
    """``discount_tier_analysis`` with the limits of ``tier_limits`` in place of fixed ones.

    The days (one row each) are read twice, for the limits and for the tiers: they are stored."""
    days = stored(cut_days(events), "cut-days")
    limits = tier_limits(days, mega, elevated)
    tiered = _with_tier(days, limits.select("mega_cuts").scalar(), limits.select("elevated_cuts").scalar())
    return _tier_totals(
        tiered.withColumn("month", period_start("event_date", period)), "month", "sale_day_tier"
    )


def cohort_triangle(events: DataFrame, period: str = "month") -> DataFrame:
    """Buyers by the period of their first purchase and the periods since: how many bought,
    how often and for how much, and which share of the cohort they are.

    Purchases are folded to (user, period) once. A user's first period is a minimum over those
    few rows, one per period, so users are not joined back and a heavy user is no large group.
    """
    start = period_start("event_date", period)
    bought = (
        counted(only(events, "purchase"))
        .where(F.col("user_id").isNotNull() & F.col("event_date").isNotNull())
        .groupBy("user_id", start.alias("period"))
        .agg(*summed("purchases", "revenue"))
    )
    first = F.min("period").over(Window.partitionBy("user_id"))
    cells = (
        bought.withColumn("cohort", first)
        .withColumn("period_offset", period_number("period", period) - period_number("cohort", period))
        .groupBy("cohort", "period_offset")
        .agg(F.count(F.lit(1)).alias("users"), *summed("purchases", "revenue"))
    )
    size = F.max(F.when(F.col("period_offset") == 0, F.col("users"))).over(Window.partitionBy("cohort"))
    return cells.select(
        "cohort",
        "period_offset",
        size.alias("cohort_users"),
        "users",
        "purchases",
        from_units(F.col("revenue")).alias("revenue"),
        pct(F.col("users"), size).alias("retained_pct"),
    )


def top_cut_days(events: DataFrame, n: int = 10) -> DataFrame:
    """The days on which most products were cut."""
    return (
        cut_days(events)
        .select("event_date", "products_cut")
        .orderBy(F.desc("products_cut"), "event_date")
        .limit(n)
    )


def cohort_behavior(
    events: DataFrame,
    split_date: str = SPLIT_DATE,
    returning: str = COHORT_RETURNING,
    new: str = COHORT_NEW,
) -> DataFrame:
    """Activity from ``split_date`` on, of users first seen before it and of new ones.

    One aggregate per user holds both the first day and the later activity, in place of
    joining first days back to the events.
    """
    later = F.col("event_date") >= _day(split_date)
    users = (
        counted(events)
        .where(F.col("user_id").isNotNull())
        .groupBy("user_id")
        .agg(
            F.min("event_date").alias("first_date"),
            F.count_if(later).alias("active"),
            *(
                F.sum(F.when(later, F.col(name)).otherwise(0)).alias(name)
                for name in ("views", "purchases")
            ),
        )
        .where("active > 0")
    )
    return (
        users.groupBy(
            F.when(F.col("first_date") < _day(split_date), returning)
            .otherwise(new)
            .alias("user_cohort")
        )
        .agg(
            F.count(F.lit(1)).alias("users"),
            F.sum("views").alias("views"),
            F.sum("purchases").alias("purchases"),
        )
        .withColumn("conversion_pct", pct(F.col("purchases"), F.col("views")))
    )


def buyer_recency(events: DataFrame, anchor_date: str = RECENCY_ANCHOR) -> DataFrame:
    """Recency in days, sessions and spend of every user who spent anything."""
    by_session = (
        counted(events)
        .where(F.col("user_id").isNotNull())
        .groupBy("user_id", "user_session")
        .agg(F.max("event_date").alias("last_date"), F.sum("revenue").alias("spend"))
    )
    return (
        by_session.groupBy("user_id")
        .agg(
            F.date_diff(_day(anchor_date), F.max("last_date")).alias("recency_days"),
            F.count("user_session").alias("frequency"),
            from_units(F.sum("spend")).alias("monetary"),
        )
        .where("monetary > 0")
    )


def rfm_scores(events: DataFrame, anchor_date: str = RECENCY_ANCHOR, n: int = 4) -> DataFrame:
    """Recency, frequency and spend score of every buyer, from 1 to n (n = best)."""
    scored = stored(buyer_recency(events, anchor_date), "buyers")
    for column, name in (
        ("recency_days", "recency_score"),
        ("frequency", "frequency_score"),
        ("monetary", "monetary_score"),
    ):
        # group 1 has the greatest values: the longest absence, but not the most sessions
        by = F.col(column) if column == "recency_days" else -F.col(column)
        ranked = distributed_ntile(scored.withColumn("_by", by), "_by", "user_id", n, name)
        scored = stored(ranked.drop("_by"), f"buyers-{name}")
    return scored


def rfm_segmentation(
    events: DataFrame, anchor_date: str = RECENCY_ANCHOR, n: int = 4
) -> DataFrame:
    """Buyers in n equal groups by recency (n = most recent), with their averages.

    Ranking reads the buyers more than once, so they are stored first: the events are
    scanned and folded to buyers a single time.
    """
    buyers = stored(buyer_recency(events, anchor_date), "buyers")
    scored = distributed_ntile(buyers, "recency_days", "user_id", n, "recency_score")
    return (
        scored.groupBy("recency_score")
        .agg(
            F.count(F.lit(1)).alias("buyers"),
            F.sum("recency_days").alias("days"),
            F.count("recency_days").alias("dated"),
            F.sum("frequency").alias("sessions"),
            F.sum(units("monetary")).alias("spend"),
        )
        .select(
            "recency_score",
            "buyers",
            F.round(ratio(F.col("days"), F.col("dated")), 1).alias("avg_recency_days"),
            F.round(ratio(F.col("sessions"), F.col("buyers")), 1).alias("avg_sessions"),
            F.round(ratio(from_units(F.col("spend")), F.col("buyers")), 0).alias("avg_spend"),
        )
    )


def buyer_retention(events: DataFrame, split_date: str = SPLIT_DATE) -> DataFrame:
    """Buyers before ``split_date`` and how many of them bought again from then on."""
    day = F.col("event_date")
    buyers = (
        only(events, "purchase")
        .groupBy("user_id")
        .agg(
            (F.count_if(day < _day(split_date)) > 0).alias("earlier"),
            (F.count_if(day >= _day(split_date)) > 0).alias("later"),
        )
    )
    back = F.col("earlier") & F.col("later") & F.col("user_id").isNotNull()
    return buyers.agg(
        F.count_if("earlier").alias("period_1_buyers"), F.count_if(back).alias("returned")
    ).withColumn("pct_returned", pct(F.col("returned"), F.col("period_1_buyers")))
