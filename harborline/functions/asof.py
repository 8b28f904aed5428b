"""The nearest event of the same key before or after each row, without a range join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_SPREAD = 1 << 20


def nearest(rows: DataFrame, events: DataFrame, keys: Sequence[str], at: str, values: Sequence[str], name: str,
            later: bool, slot: str = "DAY") -> DataFrame:
    """Add ``name``, a struct of ``at`` and ``values``: with ``later`` of the first event strictly after the row,
    otherwise of the last event at or before it; null where there is none.

    Events with a null key or time are never found, and rows with one find nothing. Of events at the same time the
    one with the smallest values is taken (``later``), or the one with the largest.

    Time is cut into slots. A window within key and slot finds the event in the row's own slot; one row per key and
    slot carries the nearest event of the other slots. So a key that holds a large share of all rows is split by
    time, and the only window over a whole key holds as many rows as there are slots. Names with a leading
    underscore are reserved.
    """
    unknown = F.col(at).isNull()
    for key in keys:
        unknown = unknown | F.col(key).isNull()
    place = [*keys, "_slot", "_spread"]
    moved = rows.select(
        *keys, F.date_trunc(slot, at).alias("_slot"), F.col(at).alias("_at"), F.struct("*").alias("_row"),
        # Rows that cannot find anything go to places of their own, spread over the shuffle.
        F.when(unknown, F.lit(1) + F.pmod(F.xxhash64(*rows.columns), F.lit(_SPREAD)).cast("int")).otherwise(0).alias("_spread"),
    )
    marks = events.filter(~unknown).select(
        *keys, F.date_trunc(slot, at).alias("_slot"), F.col(at).alias("_at"), F.struct(at, *values).alias("_event"),
        F.lit(0).alias("_spread"),
    )
    both = moved.unionByName(marks, allowMissingColumns=True)
    pick = F.min if later else F.max
    clock = F.unix_micros(F.col("_at").cast("timestamp"))
    # Both directions look back in their order; a frame that shrinks towards the end would cost a pass per row.
    within = Window.partitionBy(*place).orderBy(-clock if later else clock).rangeBetween(
        Window.unboundedPreceding, -1 if later else 0)
    beyond = Window.partitionBy(*keys).orderBy(F.desc("_slot") if later else F.asc("_slot")).rowsBetween(
        Window.unboundedPreceding, -1)
    carried = (
        both.filter(F.col("_spread") == 0).groupBy(*place).agg(pick("_event").alias("_edge"))
        .select(*place, pick("_edge").over(beyond).alias("_carried"))
    )
    return (
        both.withColumn("_own", pick("_event").over(within)).filter(F.col("_row").isNotNull())
        .join(carried, place, "left")
        .select("_row.*", F.coalesce("_own", "_carried").alias(name))
    )


def hours_between(start: Column, end: Column) -> Column:
    """Hours with fractions, exact to the microsecond."""
    micros = F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))
    return micros / F.lit(3.6e9)
