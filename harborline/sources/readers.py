"""Batch and streaming reads: raw JSON lines, message topics, catalog tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def json_lines(spark: SparkSession, path: str, schema: T.StructType, keep_file: bool = False) -> DataFrame:
    """One JSON object per text line, read with a fixed schema; a broken line becomes an all-null row.

    ``path`` may be a glob over landing folders (``kind/yyyy/MM/dd/HHmm/*.jsonl``) or the root of a
    ``dt=``-partitioned landing table, where a filter on ``dt`` prunes folders.
    """
    lines = spark.read.text(path)
    extra = [F.col("_metadata.file_path").alias("source_file")] if keep_file else []
    partitions = [F.col(c) for c in lines.columns if c != "value"]
    # As in staging.parse_json: the generator keeps later filters from repeating the parse.
    return lines.select(F.inline_outer(F.array(F.from_json("value", schema))), *partitions, *extra)


def landed_lines(spark: SparkSession, root: str, kind: str, schema: T.StructType) -> DataFrame:
    """Objects of one kind from the folders a landing stream writes; other kinds' folders are not read."""
    lines = spark.read.text(root).filter(F.col("kind") == kind)
    return lines.select(F.inline_outer(F.array(F.from_json("value", schema))))


def messages(
    spark: SparkSession,
    topic: str,
    fmt: str = "kafka",
    options: Mapping[str, str] | None = None,
    starting_offsets: str = "earliest",
    ending_offsets: str = "latest",
) -> DataFrame:
    """Bounded read of a topic. Other formats (text, json, parquet) read the path given as ``topic``."""
    reader = spark.read.format(fmt).options(**dict(options or {}))
    if fmt != "kafka":
        return reader.load(topic)
    return (
        reader.option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .option("endingOffsets", ending_offsets)
        .load()
    )


def message_stream(
    spark: SparkSession,
    topics: str | Sequence[str],
    fmt: str = "kafka",
    schema: T.StructType | None = None,
    options: Mapping[str, str] | None = None,
    starting_offsets: str = "latest",
    per_trigger: int | None = None,
) -> DataFrame:
    """Stream of a topic (or of several), or of the files under a path for the other formats.

    ``per_trigger`` bounds one micro-batch: offsets for a topic, files for a path.
    """
    reader = spark.readStream.format(fmt).options(**dict(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "kafka":
        names = topics if isinstance(topics, str) else ",".join(topics)
        reader = reader.option("subscribe", names).option("startingOffsets", starting_offsets)
        if per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", per_trigger)
        return reader.load()
    if per_trigger:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    return reader.load(topics)


def table_rows(spark: SparkSession, table: str, columns: Sequence[str] | None = None, limit: int | None = None) -> DataFrame:
    """Projected look at a catalog table; all rows unless a limit is given."""
    df = spark.table(table)
    df = df.select(*columns) if columns else df
    return df if limit is None else df.limit(limit)


# Catalog names behind the named results of the serving layer.
NAMED_RESULTS = {
    "ports": "dim_ports",
    "routes": "dim_routes",
    "stock": "dim_articles_valladolid",
    "alerts": "fact_alerts",
    "weather": "fact_weather_operational",
    "centrality": "fact_graph_centrality",
    "ships": "stg_ships",
    "gantt": "fact_article_gantt",
    "orders": "fact_customer_orders_douai",
    "air": "fact_air_recovery_options",
}


def named_result(spark: SparkSession, name: str, database: str, columns: Sequence[str] | None = None,
                 limit: int | None = None) -> DataFrame:
    return table_rows(spark, f"{database}.{NAMED_RESULTS[name]}", columns, limit)


def recent_rows(df: DataFrame, ts: str, as_of, hours: int = 24) -> DataFrame:
    """Rows of the last ``hours`` before ``as_of``, newest first."""
    since = F.timestamp_add("HOUR", F.lit(-hours), as_of)
    return df.filter(F.col(ts) >= since).orderBy(F.col(ts).desc())
