"""Mixing sources to target weights by capped water-filling and seeded sampling.

Targets: sources share the word budget by weight; a source that would pass ``max_epochs`` times its size is clamped there
and the excess goes to the others by weight, until none is above. Sampling: every document of a source is taken a whole
number of times, and the words still missing come from a further, fractional pass over the source in a seeded order. The
document in which that pass ends is taken in part, so that a source meets its target to the word.

Defined results: a null text has size 0; a null source is a source of its own, sorted last; a null doc_id is sampled like
any other; repeated rows count each; an empty table gives an empty result; further columns are carried along untouched.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harborline.functions.ranking import row_index
from harborline.llm.common import stored, word_count

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = "mix-1"
_HASH_BITS, _BUCKET_BITS, _FINE_BITS = 60, 20, 10


def seeded(doc_id: Column, seed: str = SEED) -> Column:
    """60-bit hash of the id; the order of the fractional pass."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, _HASH_BITS // 4), 16, 10).cast("long")


def weighted_sources(sized: DataFrame, weights: Sequence[int] = WEIGHTS) -> DataFrame:
    """``_key, source_size, weight`` per source; weights repeat along the sources by code point, null last."""
    sources = sized.groupBy("_key").agg(F.sum("size").alias("source_size"))
    # keys start with 0 for a text and 1 for null
    ranked = row_index(sources, ["_key"], "_rank")
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    return ranked.select("_key", "source_size", weight.cast("long").alias("weight"))


def water_fill(sources: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Adds ``target`` (double). One aggregate over the sources a round; rounds end when no source gets newly clamped.

    The level, budget left over open weight, only rises, so the two numbers of the last round say who is clamped.
    """
    cap = F.col("source_size") * max_epochs
    exact = lambda c: c.cast("decimal(19,0)")
    left = open_weight = 0
    clamped, before = F.lit(False), -1
    while True:
        row = sources.agg(
            F.sum("source_size").alias("total"), F.sum(F.when(clamped, cap)).alias("held"),
            F.sum(F.when(~clamped, F.col("weight"))).alias("open"), F.count(F.when(clamped, 1)).alias("n"),
        ).first()
        if row["n"] == before or not row["total"] or row["open"] is None:
            break
        before = row["n"]
        left, open_weight = row["total"] - (row["held"] or 0), row["open"]
        clamped = exact(cap) * F.lit(Decimal(open_weight)) < exact(F.col("weight")) * F.lit(Decimal(left))
    share = (F.col("weight") * F.lit(left)).cast("double") / F.lit(float(open_weight or 1))
    return sources.withColumn("target", F.when(clamped, cap.cast("double")).otherwise(share))


def _cut(sized: DataFrame, plan: DataFrame) -> DataFrame:
    """Adds to the plan the bucket in which the fractional pass of each source ends, and the words before that bucket.

    Two steps of at most 1024 sums a source replace a running sum over all its documents.
    """
    coarse = F.shiftright("_bucket", _FINE_BITS)
    ends = plan.filter(F.col("_extra") > 0).select("_key", "_extra")

    def ending(sums: DataFrame, at: str, base: Column) -> DataFrame:
        before = F.sum("_words").over(Window.partitionBy("_key").orderBy(at)) - F.col("_words") + base
        return sums.withColumn("_before", before).filter(
            (F.col("_before") < F.col("_extra")) & (F.col("_extra") <= F.col("_before") + F.col("_words"))
        )

    first = ending(
        sized.groupBy("_key", coarse.alias("_coarse")).agg(F.sum("size").alias("_words")).join(ends, "_key"), "_coarse", F.lit(0)
    ).select("_key", "_coarse", "_extra", F.col("_before").alias("_base"))
    second = ending(
        sized.withColumn("_coarse", coarse).join(first, ["_key", "_coarse"])
        .groupBy("_key", "_bucket", "_extra", "_base").agg(F.sum("size").alias("_words")), "_bucket", F.col("_base")
    ).select("_key", F.col("_bucket").alias("_end"), "_before")
    return plan.join(second, "_key", "left")


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """``row`` (the document as a struct), ``size, source_size, target, taken`` and ``copies`` (whole copies, the part rounded)."""
    sized = docs.select(
        F.struct("*").alias("row"), F.col("doc_id").alias("_id"),
        F.when(F.col("source").isNull(), "1").otherwise(F.concat(F.lit("0"), "source")).alias("_key"),
        word_count(F.col("text")).alias("size"), seeded(F.col("doc_id"), seed).alias("_hash"),
    ).withColumn("_bucket", F.shiftright("_hash", _HASH_BITS - _BUCKET_BITS))
    light = stored(sized.select("_key", "size", "_bucket"), "mix-sizes")
    goal = F.floor(F.col("target") + 0.5).cast("long")
    size = F.greatest(F.col("source_size"), F.lit(1))
    whole = F.floor(goal / size).cast("long")
    plan = water_fill(stored(weighted_sources(light, weights), "mix-sources"), max_epochs).select(
        "_key", "source_size", "target", whole.alias("_whole"), (goal - whole * size).alias("_extra")
    )
    plan = stored(_cut(light, plan), "mix-plan")
    placed = sized.join(plan, "_key")
    inside = F.coalesce(F.col("_bucket") == F.col("_end"), F.lit(False))
    passed = F.coalesce(F.col("_bucket") < F.col("_end"), F.lit(False))
    outer = placed.filter(~inside).withColumn("_part", F.when(passed, F.col("size")).otherwise(F.lit(0)))
    order = Window.partitionBy("_key").orderBy("_hash", F.col("_id").asc_nulls_last(), "size")
    running = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size")
    left = F.col("_extra") - F.col("_before") - running
    edge = placed.filter(inside).withColumn("_part", F.greatest(F.lit(0), F.least(left, F.col("size"))))
    rounded = F.when((F.col("_part") > 0) & (F.col("_part") * 2 >= F.col("size")), 1).otherwise(0)
    return outer.unionByName(edge).select(
        "row", "size", "source_size", "target",
        (F.col("_whole") * F.col("size") + F.col("_part")).cast("long").alias("taken"),
        (F.col("_whole") + rounded).cast("int").alias("copies"),
    )
