"""Streaming jobs: windowed metrics, latest state, raw landing. All are checkpointed and restartable.

``trigger`` takes the keywords of ``DataStreamWriter.trigger``: ``availableNow=True`` runs the stream
as a scheduled micro-batch job, ``processingTime="30 seconds"`` keeps it running.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from harborline import schemas
from harborline.functions.calendar import event_time
from harborline.operators import staging, weather
from harborline.sources.tables import append_once, drop_old_versions, read_latest_version, version_for
from harborline.sources.writers import serving_rows, upsert_latest
from harborline.streaming import windows

MICRO_BATCH = {"availableNow": True}
LANDING_TRIGGER = {"processingTime": "30 seconds"}


def checkpoint_path(base: str, name: str, version: int = 1) -> str:
    """Checkpoint of one version of a query; changing a query's state layout means a new version."""
    return f"{base}/checkpoints/{name}-v{version}"


def start_batches(df: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str,
                  trigger: Mapping[str, object] = MICRO_BATCH, mode: str = "append", name: str | None = None,
                  skip_empty: bool = True) -> StreamingQuery:
    """Run ``write`` for every micro-batch, with ``skip_empty`` only for those that have rows. A replayed batch keeps its id."""
    def each(batch: DataFrame, batch_id: int) -> None:
        if not skip_empty or not batch.isEmpty():
            write(batch, batch_id)

    writer = df.writeStream.foreachBatch(each).outputMode(mode).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    return writer.trigger(**dict(trigger)).start()


def run_name(checkpoint: str) -> str:
    """Name of the query version that a checkpoint belongs to; batch ids are unique within it only."""
    return checkpoint.rstrip("/").rsplit("/", 1)[-1]


def _batch_folder(table: str, path: str, checkpoint: str) -> Callable[[DataFrame, int], None]:
    """Each batch is appended once, so a replay after a failure adds nothing twice.

    A new checkpoint counts batches from 0 again; its name keeps its folders apart from those of the versions before.
    """
    run = run_name(checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        append_once(serving_rows(batch, table), path, f"{run}-{batch_id}")
    return write


def ship_metrics_query(ships: DataFrame, path: str, checkpoint: str, trigger: Mapping[str, object] = MICRO_BATCH) -> StreamingQuery:
    metrics = windows.ship_metrics(windows.with_watermark(ships))
    return start_batches(metrics, _batch_folder("ship_metrics", path, checkpoint), checkpoint, trigger)


def alert_metrics_query(alerts: DataFrame, path: str, checkpoint: str, trigger: Mapping[str, object] = MICRO_BATCH) -> StreamingQuery:
    metrics = windows.alert_metrics(windows.with_watermark(alerts))
    return start_batches(metrics, _batch_folder("alert_metrics", path, checkpoint), checkpoint, trigger)


def window_risk_query(ships: DataFrame, alerts: DataFrame, path: str, checkpoint: str, trigger: Mapping[str, object] = MICRO_BATCH) -> StreamingQuery:
    """Risk class of every closed window, destination and route, from two streams; each batch is appended once."""
    run = run_name(checkpoint)
    risks = windows.stream_window_risk(windows.with_watermark(ships), windows.with_watermark(alerts))
    return start_batches(risks, lambda batch, i: append_once(batch, path, f"{run}-{i}"), checkpoint, trigger)


def weather_fact_query(snapshots: DataFrame, context: DataFrame, path: str, checkpoint: str,
                       trigger: Mapping[str, object] = MICRO_BATCH) -> StreamingQuery:
    """Weather observations joined with the static route context and written as operational facts."""
    now = F.current_timestamp()
    facts = weather.operational_fact(weather.enrich_weather(snapshots, context, now), now)
    return (
        facts.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
        .option("path", path).trigger(**dict(trigger)).start()
    )


def latest_state_query(ships: DataFrame, base: str, checkpoint: str, tie: Sequence[str] = (),
                       trigger: Mapping[str, object] = MICRO_BATCH) -> StreamingQuery:
    """Keep the newest row per ship, merged batch by batch into a versioned table.

    Versions go on counting when the checkpoint changes, and a replayed batch gets the version it had; older versions than
    the last two are removed.
    """
    run = run_name(checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        version = version_for(batch.sparkSession, base, f"{run}-{batch_id}")
        upsert_latest(batch, base, version, ["ship_id"], "event_ts", tie)
        drop_old_versions(batch.sparkSession, base)

    return start_batches(ships, write, checkpoint, trigger)


def read_state(spark: SparkSession, base: str) -> DataFrame:
    """The newest complete version of a latest-state table."""
    state = read_latest_version(spark, base)
    if state is None:
        raise FileNotFoundError(f"no complete state under {base}")
    return state


def landing_rows(messages: DataFrame, topic: str = "topic", value: str = "value", host: str | None = None) -> DataFrame:
    """Raw messages as flat lines, lineage fields at the end of the object, with landing kind and minute folder.

    Folders follow the event's own time, so a replay lands in the same place. Messages whose time
    cannot be read land under ``dt=unknown``.
    """
    text = F.col(value).cast("string")
    ts = event_time(F.get_json_object(text, "$.ts"))
    return (
        staging.add_lineage(messages, host=host)
        .withColumn("kind", staging.landing_kind(F.col(topic), F.get_json_object(text, "$.source")))
        .filter(F.col("kind").isNotNull())
        .select(
            staging.flat_line(text, F.struct(*schemas.LINEAGE.names)).alias("value"), "kind",
            F.coalesce(F.date_format(ts, "yyyy-MM-dd"), F.lit("unknown")).alias("dt"),
            F.coalesce(F.date_format(ts, "HHmm"), F.lit("unknown")).alias("hhmm"),
        )
    )


def landing_query(messages: DataFrame, path: str, checkpoint: str, trigger: Mapping[str, object] = LANDING_TRIGGER,
                  by: Sequence[str] = ("kind", "dt", "hhmm")) -> StreamingQuery:
    """Exactly-once landing of JSON lines, partitioned by kind and minute, as ``readers.landed_lines`` reads them.

    ``by=("kind", "dt")`` gives larger files when a minute holds few messages.
    """
    rows = messages.drop(*[c for c in ("kind", "dt", "hhmm") if c not in by])
    return (
        rows.writeStream.format("text").outputMode("append").partitionBy(*by).option("checkpointLocation", checkpoint)
        .option("path", path).trigger(**dict(trigger)).start()
    )


def run_together(spark: SparkSession, queries: Sequence[StreamingQuery]) -> None:
    """Wait for all queries; when one fails, stop the others and raise its error."""
    while any(q.isActive for q in queries):
        try:
            spark.streams.awaitAnyTermination()
            spark.streams.resetTerminated()
        except Exception:
            for query in queries:
                query.stop()
            raise
    for query in queries:
        query.awaitTermination()
