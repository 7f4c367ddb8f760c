"""Mixing sources to target weights, to the exact budget, in hash-random order.

Sources in code-point order (NULL last) weigh 5, 2, 1, 5, 2, 1, ... and share the corpus'
words. A target stops at ``MOST_EPOCHS`` times its source's size; the excess is shared
again by weight until no target is above its limit. That fixed point has a closed form:
with the sources in order of limit per weight, the first k are at their limits and the
others get the rest by weight, for the smallest k at which none of them is above.

A source is repeated for as many whole epochs as its budget holds, and the rest is cut from
its documents in the order of a hash of their ids. The order is never sorted as a whole: the
hash is uniform, so its leading digits range-partition each source evenly. Sizes are summed
per source and range, running totals over the ranges find the range in which the budget
ends, and only that range, one per source, is sorted and summed document by document. All
other documents compare their hash with the cut. A hot source only has more ranges.

**Edge rows.** A NULL text or one without words has size 0 and is taken 0 times. A NULL
doc_id has a hash of its own. Rows equal in id and size stand at one place of the order and
share what the cut gives them, each rounded down. A source without words, and every source
of an empty table, has target 0. Other columns are not read by ``plan``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from shopflow.session import stored

from .texts import WORD

WEIGHTS = (5, 2, 1)
MOST_EPOCHS = 3
RANGE_ROWS = 20_000  # documents in a range, about
DIGITS = 8  # hex digits of the hash that can name a range


def order_key() -> Column:
    """The hash-random key of a document."""
    return F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("-")))


def targets(sizes: DataFrame) -> DataFrame:
    """source, source_size, target, from one row (source, source_size) per source."""
    ranked = sizes.withColumn(
        "weight",
        F.element_at(
            F.array(*map(F.lit, WEIGHTS)),
            ((F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1) % len(WEIGHTS) + 1),
        ).cast("long"),
    ).withColumn("most", F.col("source_size") * MOST_EPOCHS)
    by_limit = Window.orderBy(F.col("most") / F.col("weight"), F.asc_nulls_last("source"))
    through = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_limit.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    rest = ranked.select(
        "*",
        (F.sum("source_size").over(Window.partitionBy()) - F.coalesce(F.sum("most").over(through), F.lit(0))).alias(
            "left"
        ),
        F.sum("weight").over(onward).alias("sharers"),
        F.row_number().over(by_limit).alias("place"),
    )
    # the first source that stays within its limit when it shares with all after it
    fits = F.col("weight") * F.col("left") <= F.col("most") * F.col("sharers")
    first = F.min(F.when(fits, F.struct("place", "left", "sharers"))).over(Window.partitionBy())
    share = (F.col("weight") * F.col("first.left")).cast("double") / F.col("first.sharers")
    target = F.when(F.col("place") < F.col("first.place"), F.col("most").cast("double")).otherwise(share)
    return rest.withColumn("first", first).select(
        "source", "source_size", F.coalesce(target, F.lit(0.0)).alias("target")
    )


def plan(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The documents (doc_id, source, size, key) and the cut of each source.

    A cut has the source's size, target, whole ``epochs``, and the place in the order
    (key, doc_id, size) where the last epoch ends, with the words each row there still gets.
    """
    sized = stored(
        docs.select(
            F.col("doc_id").cast("long"),
            F.col("source").cast("string"),
            F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        ).withColumn("key", order_key()),
        "mixing-sizes",
    )
    rows = sized.count()
    digits = 0
    while 16**digits * RANGE_ROWS < rows and digits < DIGITS:
        digits += 1
    piece = F.substring("key", 1, digits)
    ranges = sized.groupBy("source", piece.alias("range")).agg(F.sum("size").alias("words"))
    ranges = stored(ranges, "mixing-ranges")
    aims = targets(ranges.groupBy("source").agg(F.sum("words").alias("source_size")))
    budget = F.round("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0))
    aims = aims.withColumn("epochs", epochs.cast("long")).withColumn(
        "rest", budget - F.col("epochs") * F.col("source_size")
    )
    aims = stored(aims, "mixing-targets")

    before = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    running = ranges.select("source", "range", "words", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("before"))
    rests = aims.select(F.col("source").alias("aim_source"), "rest")
    there = running.join(rests, F.col("source").eqNullSafe(F.col("aim_source")))
    there = there.where("before < rest and before + words >= rest").select("aim_source", F.col("range").alias("cut_range"), "rest", "before")
    here = F.col("source").eqNullSafe(F.col("aim_source")) & (piece == F.col("cut_range"))
    inside = sized.join(there, here).select("source", "key", "doc_id", "size", "rest", "before")
    order = [F.col("key"), F.asc_nulls_first("doc_id"), F.col("size")]
    place = Window.partitionBy("source").orderBy(*order).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    cut = (
        inside.groupBy("source", "key", "doc_id", "size", "rest", "before")
        .agg(F.count(F.lit(1)).alias("rows"))
        .withColumn("through", F.col("before") + F.sum(F.col("size") * F.col("rows")).over(place))
        .where("through - size * rows < rest and through >= rest")
        .select(
            F.col("source").alias("cut_source"),
            F.col("key").alias("cut_key"),
            F.col("doc_id").alias("cut_doc"),
            F.col("size").alias("cut_size"),
            F.floor((F.col("rest") - F.col("through") + F.col("size") * F.col("rows")) / F.col("rows")).alias("cut_words"),
        )
    )
    aims = aims.withColumnRenamed("source", "aim_source")
    cuts = aims.join(cut, F.col("aim_source").eqNullSafe(F.col("cut_source")), "left").drop("cut_source")
    return sized, stored(cuts, "mixing-cuts")


def _position() -> Column:
    """-1, 0, 1: before the cut of its source, at it, after it. Zero-size rows are before."""
    def first_nulls(name: str) -> Column:
        c = F.col(name)
        return F.struct(c.isNotNull(), c)

    own = F.struct(F.col("key"), first_nulls("doc_id"), F.col("size"))
    cut = F.struct(F.col("cut_key"), first_nulls("cut_doc"), F.col("cut_size"))
    return F.when(F.col("cut_key").isNull(), F.lit(1)).when(own < cut, -1).when(own == cut, 0).otherwise(1)


def mix(docs: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of every row of ``docs``."""
    sized, cuts = plan(docs)
    at = _position()
    extra = F.when(at < 0, F.col("size")).when(at == 0, F.col("cut_words")).otherwise(F.lit(0))
    return sized.join(cuts, F.col("source").eqNullSafe(F.col("aim_source"))).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("epochs") * F.col("size") + extra).cast("long").alias("taken"),
    )


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix itself: rows of ``docs``, all columns unchanged, once for each time taken.

    Documents stay whole: the one at the cut is taken once more, or, if the source's budget
    ends at a document's end, not. A source can exceed its target by less than a document
    (by a group of equal rows, if the cut falls on one).
    """
    _, cuts = plan(docs)
    at = _position()
    whole = docs.select(
        F.struct("*").alias("row"),
        F.col("doc_id").cast("long"),
        F.col("source").cast("string"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
    ).withColumn("key", order_key())
    times = F.when(F.col("size") == 0, F.lit(0)).otherwise(F.col("epochs") + F.when(at <= 0, 1).otherwise(0))
    joined = whole.join(cuts, F.col("source").eqNullSafe(F.col("aim_source"))).select("row", times.cast("int").alias("times"))
    return (
        joined.where("times > 0")
        .select("row", F.explode(F.sequence(F.lit(1), F.col("times"))).alias("epoch"))
        .select("row.*")
    )
