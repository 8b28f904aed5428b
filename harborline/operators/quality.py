"""Data-quality reports as DataFrames."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _missing(*names: str) -> dict[str, Column]:
    return {f"missing_{name}": F.col(name).isNull() for name in names}


def ship_contract() -> dict[str, Column]:
    """Rule name to violation condition for the position topic."""
    return {
        **_missing("event_type", "ts", "ship_id", "route_id", "origin_port", "dest_port", "lat", "lon", "speed_kn",
                   "heading"),
        "wrong_event_type": F.col("event_type") != "ship_position",
        "heading_out_of_range": ~F.col("heading").between(0, 360),
    }


def alert_contract() -> dict[str, Column]:
    return {
        **_missing("event_type", "ts", "source", "severity", "region", "text", "confidence"),
        "wrong_event_type": F.col("event_type") != "global_alert",
        "severity_out_of_range": ~F.col("severity").between(1, 5),
        "confidence_out_of_range": ~F.col("confidence").between(0.0, 1.0),
        "unknown_source": ~F.col("source").isin("clima", "noticias"),
    }


def violations(df: DataFrame, contract: Mapping[str, Column]) -> DataFrame:
    """Violation count per rule in one pass over the rows: ``rule, violations, checked``."""
    counts = df.agg(
        F.count("*").alias("checked"), *[F.count_if(rule).alias(f"_{i}") for i, rule in enumerate(contract.values())]
    )
    rows = F.array(
        *[F.struct(F.lit(name).alias("rule"), F.col(f"_{i}").alias("violations")) for i, name in enumerate(contract)]
    )
    return counts.select(F.explode(rows).alias("r"), "checked").select("r.rule", "r.violations", "checked")


def split_by_contract(df: DataFrame, contract: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Rows that break no rule, and the rejects with the names of the rules they break."""
    broken = F.array_compact(F.array(*[F.when(rule, F.lit(name)) for name, rule in contract.items()]))
    tagged = df.withColumn("broken_rules", broken)
    return (
        tagged.filter(F.size("broken_rules") == 0).drop("broken_rules"),
        tagged.filter(F.size("broken_rules") > 0),
    )


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``table_name, row_count``; each count reads only file footers when the source allows it."""
    counts = [df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
              for name, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)


def catalog_counts(spark: SparkSession, database: str, names: list[str]) -> DataFrame:
    """Row count of every expected catalog table; a missing table gets a null count."""
    found = {n: spark.table(f"{database}.{n}") for n in names if spark.catalog.tableExists(f"{database}.{n}")}
    missing = spark.createDataFrame([(n, None) for n in names if n not in found], "table_name string, row_count long")
    return row_counts(found).unionByName(missing) if found else missing


def schema_check(spark: SparkSession, actual: T.StructType, expected: T.StructType) -> DataFrame:
    """``column_name, expected_type, actual_type, status`` for all columns of either schema."""
    have = {f.name: f.dataType.simpleString() for f in actual.fields}
    want = {f.name: f.dataType.simpleString() for f in expected.fields}
    rows = []
    for name in sorted(have.keys() | want.keys()):
        status = (
            "missing" if name not in have else "extra" if name not in want
            else "ok" if have[name] == want[name] else "type_differs"
        )
        rows.append((name, want.get(name), have.get(name), status))
    return spark.createDataFrame(rows, "column_name string, expected_type string, actual_type string, status string")
