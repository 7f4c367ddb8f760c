"""Every operator as a query over the test tables: ``name -> f(spark, sf_dir)``."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.columns import mask_user_id
from ..operators import (
    alerts,
    bi,
    deep_dive,
    diagnostic,
    drift,
    governance,
    integrity,
    layout,
    monthly,
    ops,
    quality,
)
from ..session import fresh_path, prepare
from ..sources import platform_data
from ..sources.raw_csv import write_raw
from ..sources.testdata import staged_bronze, table
from ..streaming.evolving import ingest_evolving, loaded
from ..streaming.ingest import bronze_events, ingest
from . import incremental, views
from .layers import Layers

Query = Callable[[SparkSession, str], DataFrame]

# parameters under which the operators have something to find in the test tables
ANCHOR = "medium.ring"
COHORT_SPLIT = "2024-01-03"
RETENTION_SPLIT = "2024-01-29"
MEGA, ELEVATED = 52, 45
RECENCY = "2024-02-01"
AS_OF = "2024-02-01"
PERIOD = "half_month"
LAST_RUN = "2024-01-30"
DEEP_VIEWS = 2
INTENT = ((2, "1 view"), (3, "2 views"))
INTENT_TOP = "3+ views"
MANY_VIEWS = 20
SKIPPING_FILES = 64
ATTACH_TARGET = 60.0


def layers(spark: SparkSession, sf_dir: str) -> Layers:
    return Layers(
        staged_bronze(spark, sf_dir),
        anchor=ANCHOR,
        mega=MEGA,
        elevated=ELEVATED,
        period=PERIOD,
        split_date=COHORT_SPLIT,
        recency_anchor=RECENCY,
    )


def _on(build: Callable[[Layers], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(layers(spark, sf_dir))


def _with_plain_ids(frame: DataFrame) -> DataFrame:
    return frame.withColumn("category_id", F.col("category_id").cast("bigint"))


def _intent(t: Layers) -> DataFrame:
    return diagnostic.intent_by_view_depth(t.fact_events, INTENT, INTENT_TOP)


def _daily_history(t: Layers) -> DataFrame:
    """Daily metrics as metric history: one run per day."""
    day = F.col("event_date")
    names = ("unique_users", "sessions", "revenue", "purchase_events", "conversion_rate_pct")
    rows = F.array(
        *(
            F.struct(F.lit(n).alias("metric_name"), F.col(n).cast("double").alias("value"))
            for n in names
        )
    )
    return t.daily_metrics.select(
        F.inline(rows),
        day.cast("timestamp").alias("snapshot_ts"),
        day.cast("string").alias("run_id"),
    )


def _drift(t: Layers) -> DataFrame:
    history = _daily_history(t)
    current = history.where(F.col("run_id") == LAST_RUN)
    return drift.metric_drift(current, drift.previous_metrics(history, LAST_RUN))


def _primary_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = layers(spark, sf_dir)
    lines = table(spark, sf_dir, "lineitem")
    return (
        integrity.key_check(t.dim_product, "dim_product", "product_id")
        .unionByName(integrity.key_check(t.dim_session, "dim_session", "user_session"))
        .unionByName(integrity.key_check(lines, "lineitem", "l_orderkey", "l_linenumber"))
    )


def _foreign_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = layers(spark, sf_dir)
    lines, parts = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    check = integrity.reference_check
    return (
        check(t.fact_events, "product_id", t.dim_product, "product_id", "fact_product")
        .unionByName(
            check(t.fact_events, "user_session", t.dim_session, "user_session", "fact_session")
        )
        .unionByName(check(lines, "l_partkey", parts, "p_partkey", "lineitem_part"))
        .unionByName(check(parts, "p_partkey", t.dim_product, "product_id", "part_seen"))
    )


def _domains(t: Layers) -> DataFrame:
    return integrity.domain_check(t.bronze_events, "bronze_events").unionByName(
        integrity.domain_check(integrity.enforce_domain(t.fact_events), "fact_events")
    )


def _masking(t: Layers) -> DataFrame:
    masked = mask_user_id("user_id")
    plain = mask_user_id("user_id", privileged=True)
    return t.fact_events.groupBy("event_type").agg(
        F.count_distinct("user_id").alias("users"),
        F.count_distinct(masked).alias("masked_users"),
        F.count_if(plain == F.col("user_id")).alias("unmasked_rows"),
    )


def _bronze_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries of raw files, loaded by two runs and a third that finds nothing new."""
    staged = staged_bronze(spark, sf_dir)
    root = fresh_path(spark, "raw")
    target, ledger = fresh_path(spark, "bronze"), fresh_path(spark, "ledger")
    first = F.col("event_time") < "2024-01-16"
    write_raw(staged.where(first), f"{root}/2024-01-a")
    ingest(spark, root, target, ledger)
    write_raw(staged.where(~first), f"{root}/2024-01-b")
    ingest(spark, root, target, ledger)
    ingest(spark, root, target, ledger)
    return bronze_events(spark, target).drop("source_file")


# the second delivery: the last days, and rows of some products that come late
LATE_FROM = "2024-01-24"
LATE_PRODUCTS = 97


def deliveries(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    staged = staged_bronze(spark, sf_dir)
    late = (F.col("event_time") >= LATE_FROM) | (F.col("product_id").cast("long") % LATE_PRODUCTS == 1)
    moved = [F.col(c) for c in reversed(staged.columns)]
    return staged.where(~late), staged.where(late).select(F.lit("spring").alias("campaign"), *moved)


def _deliver(rows: DataFrame, path: str) -> None:
    rows.write.option("header", True).csv(path)


def _bronze_evolving(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries, the second with other column order and one column more; each row with
    the month folder it came from."""
    raw, target, ledger = (fresh_path(spark, n) for n in ("raw", "bronze", "ledger"))
    for rows, month in zip(deliveries(spark, sf_dir), ("2024-01", "2024-02")):
        _deliver(rows, f"{raw}/{month}")
        ingest_evolving(spark, raw, target, ledger)
    ingest_evolving(spark, raw, target, ledger)
    month = F.element_at(F.split("source_file", "/"), -2)
    return loaded(spark, target).withColumn("month", month).drop("source_file", "load")


def _incremental(build: Callable[[incremental.Lake], DataFrame]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        """Two deliveries, each applied when it came."""
        raw, lake = fresh_path(spark, "raw"), incremental.Lake(spark, fresh_path(spark, "lake"))
        for rows, month in zip(deliveries(spark, sf_dir), ("2024-01", "2024-02")):
            _deliver(rows, f"{raw}/{month}")
            incremental.update(spark, raw, lake.root)
        return build(lake)

    return query


def _clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "clustered")
    layout.clustered(layers(spark, sf_dir).fact_events).write.parquet(path)
    return _with_plain_ids(spark.read.parquet(path))


def _compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    small, large = fresh_path(spark, "small"), fresh_path(spark, "large")
    layout.clustered(layers(spark, sf_dir).fact_events).write.parquet(small)
    layout.compact(spark, small, large, layout.FACT_KEYS)
    return _with_plain_ids(spark.read.parquet(large))


def _merged_small(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact after its late half, in many small files, is merged beside the early one."""
    path = fresh_path(spark, "merged")
    fact = layers(spark, sf_dir).fact_events
    late = F.coalesce(F.dayofmonth("event_date") > 15, F.lit(False))
    layout.clustered(fact.where(~late), files=2).write.parquet(path)
    large = layout.stored_bytes(spark, path)
    layout.clustered(fact.where(late), files=SKIPPING_FILES).write.mode("append").parquet(path)
    layout.compact_small(spark, path, layout.FACT_KEYS, target_bytes=large // 4)
    return _with_plain_ids(spark.read.parquet(path))


def _interleaved(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "interleaved")
    layout.interleaved(layers(spark, sf_dir).fact_events).write.parquet(path)
    return _with_plain_ids(spark.read.parquet(path))


def _file_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each part's line items as a file, with the range of its order keys."""
    ranges = table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(
        F.min("l_orderkey").alias("lo"), F.max("l_orderkey").alias("hi")
    )
    return layout.overlap_depth(ranges)


def _skipping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the interleaved layout opens fewer files than the lexicographic one for a
    filter on the second key, summed over all its values, at equal numbers of files."""
    fact = layers(spark, sf_dir).fact_events
    values = fact.select(F.col("product_id").alias("value")).distinct()
    opened = []
    for write in (layout.clustered, layout.interleaved):
        path = fresh_path(spark, "skipping")
        write(fact, files=SKIPPING_FILES).write.parquet(path)
        ranges = layout.file_ranges(spark.read.parquet(path), "product_id")
        opened.append(layout.files_opened(ranges, values).agg(F.sum("files").alias("n"), F.count("*").alias("products")))
    return opened[0].join(opened[1].withColumnRenamed("n", "m"), "products").select(
        "products", (F.col("m") * 2 < F.col("n")).alias("at_most_half")
    )


VIEW_NAMES = ("daily_dbu_cost", "expensive_queries", "pipeline_runs", "table_usage", "pii_inventory")


def _view(name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        """A stored view over catalog tables, read by another session."""
        database, root = f"views_{uuid.uuid4().hex}", fresh_path(spark, "platform")
        spark.sql(f"CREATE DATABASE {database} LOCATION '{root}'")
        make = {
            "usage": platform_data.usage, "history": platform_data.query_history, "runs": platform_data.job_runs,
            "jobs": platform_data.jobs, "lineage": platform_data.lineage, "tags": platform_data.tags,
        }
        needed = {s: f for s, f in make.items() if "{" + s + "}" in views.TEXTS[name]}
        for source, build in needed.items():
            build(spark, sf_dir).write.option("path", f"{root}/{source}").saveAsTable(f"{database}.{source}")
        as_of = {"daily_dbu_cost": "2001-11-05", "expensive_queries": "2024-01-07"}.get(name, "2024-01-31")
        views.create_views(
            spark, database, {s: f"{database}.{s}" for s in make}, as_of, job="BUILDING", usage_days=3000
        )
        return prepare(spark.newSession()).table(f"{database}.{name}")

    return query


def _alert(rule: Callable[[Layers], alerts.Rule]) -> Query:
    return _on(lambda t: alerts.evaluate(rule(t)))


QUERIES: dict[str, Query] = {
    # bronze and silver
    "bronze_events": _on(lambda t: t.bronze_events),
    "bronze_ingest": _bronze_ingest,
    "bronze_evolving": _bronze_evolving,
    "incremental_fact_events": _incremental(lambda k: _with_plain_ids(k.table("silver/fact_events"))),
    "incremental_dim_product": _incremental(lambda k: _with_plain_ids(incremental.dim_product(k))),
    "incremental_dim_session": _incremental(lambda k: k.table("silver/dim_session")),
    "incremental_daily_metrics": _incremental(lambda k: k.table("gold/daily_metrics")),
    "incremental_cart_abandonment": _incremental(lambda k: k.table("gold/cart_abandonment")),
    "fact_events": _on(lambda t: _with_plain_ids(t.fact_events)),
    "dim_product": _on(lambda t: _with_plain_ids(t.dim_product)),
    "dim_session": _on(lambda t: t.dim_session),
    # descriptive gold
    "daily_metrics": _on(lambda t: t.daily_metrics),
    "funnel": _on(lambda t: t.funnel),
    "cart_abandonment": _on(lambda t: t.cart_abandonment),
    "category_performance": _on(lambda t: t.category_performance),
    "brand_performance": _on(lambda t: t.brand_performance),
    "top_products": _on(lambda t: t.top_products),
    "user_summary": _on(lambda t: t.user_summary),
    "hourly_pattern": _on(lambda t: t.hourly_pattern),
    # diagnostic gold
    "intent_by_view_depth": _on(lambda t: t.intent_by_view_depth),
    "intent_custom_bands": _on(_intent),
    "cart_conversion_by_price": _on(lambda t: t.cart_conversion_by_price),
    "attach_opportunity": _on(lambda t: t.attach_opportunity),
    "price_change_effect": _on(lambda t: t.price_change_effect),
    "category_recovery_check": _on(lambda t: t.category_recovery_check),
    # deep dive
    "discount_tier_analysis": _on(lambda t: t.discount_tier_analysis),
    "tier_limits": _on(lambda t: deep_dive.tier_limits(deep_dive.cut_days(t.fact_events))),
    "quantile_tier_analysis": _on(
        lambda t: deep_dive.quantile_tier_analysis(t.fact_events, period=PERIOD)
    ),
    "cohort_triangle": _on(lambda t: deep_dive.cohort_triangle(t.fact_events, "week")),
    "cohort_behavior": _on(lambda t: deep_dive.cohort_behavior(t.fact_events, COHORT_SPLIT)),
    "rfm_segmentation": _on(lambda t: t.rfm_segmentation),
    "rfm_scores": _on(lambda t: deep_dive.rfm_scores(t.fact_events, RECENCY)),
    "buyer_retention": _on(lambda t: deep_dive.buyer_retention(t.fact_events, RETENTION_SPLIT)),
    # quality, drift, alerts
    "data_quality": _on(lambda t: t.data_quality),
    "layer_reconciliation": _on(
        lambda t: quality.layer_reconciliation(
            t.bronze_events, t.fact_events, t.dim_session, t.dim_product
        )
    ),
    "metrics_snapshot": _on(drift.metric_values),
    "previous_metrics": _on(lambda t: drift.previous_metrics(_daily_history(t), LAST_RUN)),
    "metric_drift": _on(_drift),
    "alert_cart_gap": _alert(lambda t: alerts.cart_gap(t.data_quality)),
    "alert_stale_gold": _alert(lambda t: alerts.stale_gold(t.daily_metrics, AS_OF)),
    "alert_unlabeled_category": _alert(lambda t: alerts.unlabeled_category(t.data_quality)),
    "evaluate_alerts": _on(lambda t: alerts.evaluate_alerts(alerts.standard_rules(t, AS_OF))),
    # integrity, governance, layout
    "primary_key_check": _primary_keys,
    "foreign_key_check": _foreign_keys,
    "domain_check": _on(_domains),
    "mask_user_id": _on(_masking),
    "pii_inventory": lambda spark, d: governance.pii_inventory(platform_data.tags(spark, d)),
    "clustered_fact": _clustered,
    "compacted_fact": _compacted,
    "merged_small_files": _merged_small,
    "interleaved_fact": _interleaved,
    "interleaved_skipping": _skipping,
    "file_overlap": _file_overlap,
    # platform reports
    "daily_dbu_cost": lambda spark, d: ops.daily_dbu_cost(
        platform_data.usage(spark, d), "2001-11-05", days=3000
    ),
    "expensive_queries": lambda spark, d: ops.expensive_queries(
        platform_data.query_history(spark, d), "2024-01-07"
    ),
    "job_runs": lambda spark, d: ops.pipeline_runs(
        platform_data.job_runs(spark, d), platform_data.jobs(spark, d), "BUILDING"
    ),
    "table_usage": lambda spark, d: ops.table_usage(platform_data.lineage(spark, d), "2024-01-31"),
    **{f"view_{name}": _view(name) for name in VIEW_NAMES},
    # dashboards
    "dash_funnel": _on(lambda t: bi.dash_funnel(t.funnel)),
    "dash_daily": _on(lambda t: bi.dash_daily(t.daily_metrics)),
    "dash_funnel_stages": _on(lambda t: bi.dash_funnel_stages(t.funnel)),
    "dash_data_quality": _on(lambda t: bi.dash_data_quality(t.data_quality)),
    "dash_intent": _on(lambda t: bi.dash_intent(t.intent_by_view_depth)),
    "dash_price_bands": _on(lambda t: bi.dash_price_bands(t.cart_conversion_by_price)),
    "dash_attach": _on(lambda t: bi.dash_attach(t.attach_opportunity)),
    "dash_repeat_buyers": _on(lambda t: bi.dash_repeat_buyers(t.user_summary)),
    "dash_abandonment": _on(lambda t: bi.dash_abandonment(t.cart_abandonment)),
    "dash_categories": _on(lambda t: bi.dash_categories(t.category_performance)),
    "dash_brands": _on(lambda t: bi.dash_brands(t.brand_performance)),
    "dash_hourly": _on(lambda t: bi.dash_hourly(t.hourly_pattern)),
    "dash_top_products": _on(lambda t: bi.dash_top_products(t.top_products)),
    "dash_totals": _on(lambda t: bi.dash_totals(t.daily_metrics)),
    "dash_totals_exact": _on(lambda t: bi.dash_totals_exact(t.user_summary, t.dim_session)),
    "dash_abandoned_total": _on(lambda t: bi.dash_abandoned_total(t.cart_abandonment)),
    "booth_headline": _on(
        lambda t: bi.booth_headline(
            t.daily_metrics,
            t.cart_abandonment,
            _intent(t),
            diagnostic.attach_rate_overall(t.fact_events, ANCHOR),
            INTENT_TOP,
        )
    ),
    "booth_price_bands": _on(lambda t: bi.booth_price_bands(t.cart_conversion_by_price)),
    "booth_attach": _on(lambda t: bi.booth_attach(t.attach_opportunity)),
    "booth_intent": _on(lambda t: bi.booth_intent(t.intent_by_view_depth)),
    "ask_funnel": _on(lambda t: bi.ask_funnel(t.funnel)),
    "ask_browsed_not_bought": _on(
        lambda t: bi.ask_browsed_not_bought(t.category_performance, MANY_VIEWS)
    ),
    "ask_abandonment": _on(lambda t: bi.ask_abandonment(t.cart_abandonment)),
    "ask_repeat_buyers": _on(lambda t: bi.ask_repeat_buyers(t.user_summary)),
    # published analyses
    "monthly_cart_gap": _on(lambda t: monthly.monthly_cart_gap(t.dim_session, PERIOD)),
    "monthly_cart_logging_rate": _on(
        lambda t: monthly.monthly_cart_logging_rate(t.dim_session, PERIOD)
    ),
    "monthly_abandonment_ratio": _on(
        lambda t: monthly.monthly_abandonment_ratio(t.cart_abandonment, t.daily_metrics, PERIOD)
    ),
    "category_revenue_share": _on(lambda t: monthly.category_revenue_share(t.category_performance)),
    "price_change_by_month": _on(lambda t: monthly.price_change_by_month(t.fact_events, PERIOD)),
    "top_cut_days": _on(lambda t: deep_dive.top_cut_days(t.fact_events)),
    "sale_tier_totals": _on(lambda t: deep_dive.sale_tier_totals(t.fact_events, MEGA, ELEVATED)),
    "monthly_session_depth": _on(lambda t: monthly.monthly_session_depth(t.dim_session, PERIOD)),
    "buyer_rates": _on(lambda t: monthly.buyer_rates(t.user_summary)),
    "attach_rate_overall": _on(lambda t: diagnostic.attach_rate_overall(t.fact_events, ANCHOR)),
    "retargeting_segment": _on(lambda t: diagnostic.retargeting_segment(t.fact_events, DEEP_VIEWS)),
    "recovery_sizing": _on(lambda t: diagnostic.recovery_sizing(t.cart_abandonment)),
    "attach_uplift": _on(lambda t: diagnostic.attach_uplift(t.fact_events, ANCHOR, ATTACH_TARGET)),
    "peak_hours": _on(lambda t: monthly.peak_hours(t.hourly_pattern)),
    "month_over_month": _on(lambda t: monthly.month_over_month(t.dim_session, PERIOD)),
    "brand_mix": _on(lambda t: monthly.brand_mix(t.brand_performance)),
}
