"""Helpers for columns that may be missing, mistyped or optional."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def existing(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """The wanted columns that the frame has, in the wanted order."""
    return df.select(*[name for name in wanted if name in df.columns])


def first_available(df: DataFrame, names: Sequence[str], default: object) -> Column:
    """Value of the first named column that the frame has, otherwise the default."""
    for name in names:
        if name in df.columns:
            return F.col(name)
    return F.lit(default)


def number_or_zero(value: Column) -> Column:
    return F.coalesce(value.try_cast("double"), F.lit(0.0))


def where_given(df: DataFrame, **wanted: object) -> DataFrame:
    """Equality filters for the criteria that are set; ``None`` and ``Todos`` mean no filter."""
    for name, value in wanted.items():
        if value is None or value == "Todos":
            continue
        if isinstance(value, (list, tuple, set)):
            df = df.filter(F.col(name).isin(*value))
        else:
            df = df.filter(F.col(name) == F.lit(value))
    return df


def stable_key(*parts: Column) -> Column:
    """Repeatable row identifier, equal on every retry of a task."""
    return F.sha2(F.concat_ws("\x1f", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]), 256)


def pseudo_stock(key: Column, size: int = 100) -> Column:
    """Repeatable stock figure in ``0..size-1`` from the hash of a key."""
    return F.pmod(F.abs(F.hash(key).cast("long")), F.lit(size)).cast("int")


def route_name(origin: Column, dest: Column) -> Column:
    return F.concat_ws(" -> ", origin, dest)


def shorten(text: Column, size: int = 120) -> Column:
    return F.when(F.length(text) > size, F.concat(F.substring(text, 1, size), F.lit("..."))).otherwise(text)
