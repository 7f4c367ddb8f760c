"""Silver and date-keyed gold kept up to date from new deliveries alone.

A run reads the bronze loads that no earlier run has applied and touches what they change:

* **fact**: partitioned by day. New events are compared with the stored events of their own
  days (late events included), and only unknown ones are appended.
* **rollup**: recomputed for the days of the new rows from the fact's partitions.
* **products**: newest attributes per product as mergeable state, in hash parts; the parts of
  the new products are replaced.
* **sessions**: the touched sessions are recomputed from the rollup's days they span; their
  hash parts are replaced.
* **daily_metrics**: the days of the new rows. **cart_abandonment**: all days of the touched
  sessions, since a purchase today settles the cart of yesterday. Only these days' folders are
  overwritten; a day that is left without rows loses its folder.

Days and parts are found before anything is written, from the new rows themselves, and every
step replaces what it wrote before. So a run that died can be repeated: the load counts as
applied when its number is written last.

Lists on the driver: the touched days and parts, whatever the number of rows.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..operators import descriptive, rollup, silver
from ..session import discard, prepare, remove, stored
from ..sources.tables import exists
from ..streaming.evolving import ingest_evolving, loaded

NO_DAY = "none"
PARTS = 64


def day() -> Column:
    """The partition of a row: its date, or one for events without."""
    return F.coalesce(F.col("event_date").cast("string"), F.lit(NO_DAY)).alias("day")


def part(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(PARTS)).cast("int").alias("part")


@dataclass(frozen=True)
class Lake:
    """The incrementally kept tables below one folder."""

    spark: SparkSession
    root: str

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def read(self, name: str, empty: DataFrame) -> DataFrame:
        """A stored table; before the first run, no rows like those of ``empty``."""
        if not exists(self.spark, self.path(name)):
            return empty.where(F.lit(False))
        return self.spark.read.schema(empty.schema).parquet(self.path(name))

    def table(self, name: str) -> DataFrame:
        """A kept table without its partition column; it may have no rows, hence no files."""
        text = self.spark.read.text(self.path(f"schemas/{name}"), wholetext=True).first()[0]
        schema = T.StructType.fromJson(json.loads(text))
        return self.spark.read.schema(schema).parquet(self.path(name)).drop("day", "part")

    def remember(self, name: str, schema: T.StructType) -> None:
        if not exists(self.spark, self.path(f"schemas/{name}")):
            row = self.spark.createDataFrame([(schema.json(),)], "value string")
            row.write.mode("overwrite").text(self.path(f"schemas/{name}"))

    def replace(self, name: str, rows: DataFrame, key: str, touched: list) -> None:
        """Replace the touched partitions by ``rows``, which hold no others."""
        self.remember(name, rows.schema)
        ready = stored(rows, f"incremental-{name.replace('/', '-')}")  # may be read from the table itself
        (
            ready.hint("rebalance", key)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(key)
            .parquet(self.path(name))
        )
        left = {row[0] for row in ready.select(key).distinct().collect()}
        for gone in set(touched) - left:
            remove(self.spark, f"{self.path(name)}/{key}={gone}")
        discard(ready)

    def applied(self) -> int:
        """The last load that is in the tables."""
        if not exists(self.spark, self.path("applied")):
            return -1
        return self.spark.read.parquet(self.path("applied")).agg(F.max("load")).first()[0]


def _values(rows: DataFrame, column: Column) -> list:
    """Few distinct values: days or parts."""
    return sorted(row[0] for row in rows.select(column).distinct().collect())


def _append_fact(lake: Lake, typed: DataFrame, days: list[str]) -> DataFrame:
    """Add the events that their days do not hold yet; returns the whole fact."""
    known = lake.read("silver/fact_events", typed).where(F.col("day").isin(days))
    fresh = (
        known.withColumn("stored", F.lit(True))
        .unionByName(typed.withColumn("stored", F.lit(False)))
        .groupBy(*typed.columns)  # NULLs are equal here, in a join they would not be
        .agg(F.bool_or("stored").alias("stored"))
        .where(~F.col("stored"))
        .drop("stored")
    )
    lake.remember("silver/fact_events", typed.schema)
    fresh.hint("rebalance", "day").write.mode("append").partitionBy("day").parquet(lake.path("silver/fact_events"))
    return lake.read("silver/fact_events", typed)


def _merge_products(lake: Lake, bronze: DataFrame) -> None:
    new = silver.product_state(bronze).select("*", part("product_id"))
    parts = _values(new, F.col("part"))
    old = lake.read("silver/product_state", new).where(F.col("part").isin(parts))
    merged = old.unionByName(new).groupBy("product_id", "part").agg(F.max("row").alias("row"))
    lake.replace("silver/product_state", merged, "part", parts)


def _spanned_days(sessions: DataFrame) -> list[str]:
    """All days on which sessions may have events."""
    dates = F.sequence(F.col("session_start").cast("date"), F.col("session_end").cast("date"))
    return _values(sessions.where("session_end IS NOT NULL").select(F.explode(dates).alias("d")), F.col("d").cast("string"))


def apply(lake: Lake, bronze: DataFrame) -> dict[str, list[str]]:
    """Bring all tables up to date with new bronze rows; the days touched per gold table."""
    typed = stored(silver.fact_events(bronze).select("*", day()), "incremental-typed")
    days = _values(typed, F.col("day"))
    touched = typed.select("user_session").distinct()

    fact = _append_fact(lake, typed, days)
    _merge_products(lake, bronze)

    rolled = rollup.session_rollup(fact.where(F.col("day").isin(days))).select("*", day())
    like_rolled = rolled.where(F.lit(False))
    lake.replace("silver/session_rollup", rolled, "day", days)
    rolled = lake.read("silver/session_rollup", like_rolled)

    like_session = silver.dim_session(like_rolled).select("*", part("user_session"))
    before = lake.read("silver/dim_session", like_session)
    parts = _values(touched, part("user_session"))
    in_parts = before.where(F.col("part").isin(parts))
    span = sorted({*days, NO_DAY, *_spanned_days(in_parts.join(touched, "user_session", "left_semi"))})
    again = silver.dim_session(
        rolled.where(F.col("day").isin(span)).join(touched, "user_session", "left_semi")
    ).select("*", part("user_session"))
    lake.replace(
        "silver/dim_session",
        in_parts.join(touched, "user_session", "left_anti").unionByName(again),
        "part",
        parts,
    )
    sessions = lake.read("silver/dim_session", like_session)

    lake.replace(
        "gold/daily_metrics",
        descriptive.daily_metrics(rolled.where(F.col("day").isin(days))).select("*", day()),
        "day",
        days,
    )
    lake.replace(
        "gold/cart_abandonment",
        descriptive.cart_abandonment(fact.where(F.col("day").isin(span)), sessions).select("*", day()),
        "day",
        span,
    )
    discard(typed)
    return {"daily_metrics": days, "cart_abandonment": span}


def update(spark: SparkSession, raw: str, root: str) -> dict[str, list[str]]:
    """Load the new raw files and apply every load that no run has applied."""
    prepare(spark)
    lake = Lake(spark, root)
    ingest_evolving(spark, raw, lake.path("bronze/events"), lake.path("ledger/bronze_events"))
    new = loaded(spark, lake.path("bronze/events"), lake.applied())
    last = new.agg(F.max("load")).first()[0]
    if last is None:
        return {}
    changed = apply(lake, new)
    spark.range(1).select(F.lit(last).cast("long").alias("load")).write.mode("append").parquet(lake.path("applied"))
    return changed


def dim_product(lake: Lake) -> DataFrame:
    return silver.product_attributes(lake.table("silver/product_state"))
