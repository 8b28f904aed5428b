"""A join that stays balanced when some keys hold a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fewest keys that may count as hot; with more shuffle partitions than this, their number decides.
MIN_HOT_KEYS = 1000
_SPREAD = 1 << 20


def lookup(big: DataFrame, table: DataFrame, key: str, rows: str, spread_by: Sequence[str], max_hot: int | None = None) -> DataFrame:
    """Inner join of ``big`` with ``table``, which has one row per key and in ``rows`` the key's row count in ``big``.

    Keys with more than ``1 / max_hot`` of all rows are fewer than ``max_hot`` by arithmetic, so their
    table rows are broadcast. By default that share is at most one shuffle partition's, so no key left to the
    shuffle outweighs a partition. Rows that found theirs that way take a salt no table row has and spread
    evenly over the shuffle join that serves all other keys. Adaptive skew splitting cannot help here,
    because the table side is usually already partitioned by the key and brings no shuffle of its own.

    ``table`` is read three times; pass one that is cheap to read again.
    """
    if max_hot is None:
        max_hot = max(MIN_HOT_KEYS, int(big.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    values = [c for c in table.columns if c not in (key, rows)]
    found = F.struct(*values)
    limit = table.agg(F.sum(rows) / F.lit(max_hot)).scalar()
    hot = table.withColumn("_limit", limit).filter(F.col(rows) > F.col("_limit")).select(key, found.alias("_hot"))
    # Zero for every row, but not a literal: Spark would turn a literal into a filter and shuffle by key alone.
    no_salt = (F.col(rows) < 0).cast("int")
    cold = table.select(key, no_salt.alias("_salt"), found.alias("_cold"))
    salt = F.when(F.col("_hot").isNull(), 0).otherwise(F.lit(1) + F.pmod(F.xxhash64(*spread_by), F.lit(_SPREAD)).cast("int"))
    return (
        big.join(F.broadcast(hot), key, "left")
        .withColumn("_salt", salt)
        .join(cold, [key, "_salt"], "left")
        .withColumn("_found", F.coalesce("_hot", "_cold"))
        .filter(F.col("_found").isNotNull())
        .select(*big.columns, *[F.col(f"_found.{c}").alias(c) for c in values])
    )
