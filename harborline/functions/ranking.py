"""First-row-per-key reductions and a distributed row index."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harborline.session import cut_lineage

_LOCAL_BITS = 33  # monotonically_increasing_id keeps the partition above this many bits


def first_per(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first in ``order``; end ``order`` with a unique tie-break.

    Written as ``row_number() = 1`` so that Spark places a window group limit before the shuffle:
    each task sends at most one row per key, also for a key that holds a third of the input.
    """
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def last_seen(df: DataFrame, keys: Sequence[str], ts: str, tie: Sequence[str] = ()) -> DataFrame:
    """Latest row per key by event time."""
    return first_per(df, keys, [F.col(ts).desc_nulls_last(), *[F.col(c).desc_nulls_last() for c in tie]])


def drop_repeats(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key subset; among different rows with one key the choice is by value, not by arrival."""
    rest = [c for c in df.columns if c not in keys]
    return first_per(df, keys, [F.col(c).asc_nulls_last() for c in rest] or [F.lit(1)])


def row_index(df: DataFrame, order: Sequence[str], name: str = "row_index") -> DataFrame:
    """Zero-based position in a global, unique order, without putting all rows in one task.

    Rows are range-partitioned and sorted, each partition numbers its own rows, and the per-partition
    counts (one row per partition) give the offsets. The numbered rows are checkpointed because the
    range boundaries are sampled and may differ if computed twice.
    """
    numbered = cut_lineage(
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id())
    )
    part = F.shiftright("_id", _LOCAL_BITS)
    counts = numbered.groupBy(part.alias("_part")).agg(F.count("*").alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    position = F.col("_offset") + F.col("_id").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    # Bounded by the number of partitions of one shuffle.
    return (
        numbered.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, position.cast("long"))
        .drop("_id", "_part", "_offset")
    )
