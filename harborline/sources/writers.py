"""Batch sinks: tables, serving rows, keyed messages, TSV, versioned state and the result bundle."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from harborline.functions.columns import stable_key
from harborline.functions.ranking import last_seen
from harborline.schemas import SERVING_KEYS, SERVING_TABLES
from harborline.sources.tables import append_once, complete_versions, read_latest_version, replace_table, version_path


def overwrite_table(df: DataFrame, table: str, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace a catalog table over versioned Parquet folders; readers see the old rows until the new ones are complete."""
    replace_table(df, table, path, partition_by)


def write_dimension(df: DataFrame, table: str, path: str) -> None:
    """A small dimension as one file; facts keep their own partitions."""
    overwrite_table(df.coalesce(1), table, path)


def create_database(spark: SparkSession, database: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")


def list_tables(spark: SparkSession, database: str) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN {database}")


def list_databases(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW DATABASES")


def conform(df: DataFrame, table: str, **defaults: Column) -> DataFrame:
    """Project to a serving table's declared columns and types; missing columns become null."""
    given = {name: F.col(name) for name in df.columns} | defaults
    return df.select(
        *[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in SERVING_TABLES[table].fields]
    )


def append_serving_rows(df: DataFrame, table: str, path: str, token: str, written_at: Column | None = None) -> None:
    """Append metric, alert or prediction rows with the write time. The same batch ``token`` again adds nothing twice."""
    append_once(serving_rows(df, table, written_at), path, token)


def serving_rows(df: DataFrame, table: str, written_at: Column | None = None) -> DataFrame:
    """Rows of a serving table with the time they are written and, where the table has one, their id."""
    at = written_at if written_at is not None else F.current_timestamp()
    time_column = "processed_at" if "processed_at" in SERVING_TABLES[table].names else "created_at"
    rows = conform(df, table, **{time_column: at})
    id_column = {"route_alerts": "alert_id", "ml_predictions": "prediction_id"}.get(table)
    return rows.withColumn(id_column, stable_key(*[F.col(c) for c in SERVING_KEYS[table]])) if id_column else rows


def publish_events(df: DataFrame, key: str, topic: str | None = None) -> DataFrame:
    """Keyed JSON messages, ready for a topic writer (``key``, ``value`` and optionally ``topic``)."""
    columns = [F.col(key).cast("string").alias("key"), F.to_json(F.struct("*")).alias("value")]
    return df.select(*columns, *([F.lit(topic).alias("topic")] if topic else []))


def export_tsv(df: DataFrame, path: str) -> None:
    """Tab-separated text, null as empty, written by the executors."""
    text = df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
    text.write.mode("overwrite").option("sep", "\t").option("nullValue", "").option("emptyValue", "").csv(path)


def upsert_latest(new_rows: DataFrame, base: str, version: int, keys: Sequence[str], ts: str,
                  tie: Sequence[str] = ()) -> None:
    """Merge rows into the latest-state table: newest row per key wins, whatever the arrival order.

    The merged state is written as a new version computed from an older one, so a replayed batch
    rewrites the same version with the same content.
    """
    spark = new_rows.sparkSession
    incoming = last_seen(new_rows, keys, ts, tie)
    current = read_latest_version(spark, base, before=version)
    merged = incoming if current is None else last_seen(
        current.unionByName(incoming, allowMissingColumns=True), keys, ts, tie
    )
    merged.write.mode("overwrite").parquet(version_path(base, version))


# ---- Result bundle -------------------------------------------------------------------------------

BUNDLE_KEY_SECTIONS = ("ships_latest", "stock_valladolid", "customer_orders_douai", "article_gantt")


def plain_json_types(df: DataFrame) -> DataFrame:
    """Decimals as doubles; timestamps and dates leave as ISO text through the JSON writer."""
    return df.select(
        *[F.col(f.name).cast("double").alias(f.name) if f.dataType.typeName() == "decimal" else F.col(f.name)
          for f in df.schema.fields]
    )


def write_counted(df: DataFrame, write: Callable[[DataFrame], None]) -> int:
    """Write the rows and return how many they were, counted in the write job itself instead of by a second scan.

    A task that ran again after an executor was lost may be counted twice: right for reports and for telling
    whether there are rows at all, not for balances.
    """
    seen = Observation()
    write(df.observe(seen, F.count(F.lit(1)).alias("rows")))
    return seen.get["rows"]


def write_bundle(spark: SparkSession, sections: Mapping[str, Callable[[], DataFrame]], base: str, version: int,
                 key_sections: Sequence[str] = BUNDLE_KEY_SECTIONS) -> DataFrame:
    """Write every named result as JSON and report one status row per section.

    A section that fails is reported and skipped. The version is published only when a key section
    has rows; until then readers keep the last good version.
    """
    target = version_path(base, version)
    status = []
    filled = False
    for name, build in sections.items():
        try:
            rows = write_counted(plain_json_types(build()), lambda df: df.write.mode("overwrite").json(f"{target}/{name}"))
            filled = filled or (rows > 0 and name in key_sections)
            status.append((name, "ok" if rows else "empty", None, rows))
        except Exception as error:  # one broken section must not hide the other ones
            status.append((name, "error", str(error).splitlines()[0], None))
    report = spark.createDataFrame(status, "section string, status string, error string, rows long")
    if filled:
        # The marker of a publishable version is written last.
        report.coalesce(1).write.mode("overwrite").json(f"{base}/published/version={version:012d}")
    return report


def read_bundle_section(spark: SparkSession, base: str, section: str, schema: str | None = None) -> DataFrame:
    """A section of the newest published version."""
    versions = complete_versions(spark, f"{base}/published")
    if not versions:
        raise FileNotFoundError(f"no published version under {base}")
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.json(f"{version_path(base, versions[-1])}/{section}")
