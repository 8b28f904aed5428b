"""Fifteen-minute metrics of positions and alerts. The same functions serve batch and stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harborline.functions.bands import risk_class

# Fixed values.
WINDOW = "15 minutes"
WATERMARK = "15 minutes"


def with_watermark(df: DataFrame, delay: str = WATERMARK) -> DataFrame:
    """Watermark on ``event_ts``; zone-less times are read as session time first, which watermarks need."""
    return df.withColumn("event_ts", F.col("event_ts").cast("timestamp")).withWatermark("event_ts", delay)


def _flat(df: DataFrame) -> DataFrame:
    """Window start and end as columns: the serving tables key on them."""
    rest = [c for c in df.columns if c != "window"]
    return df.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *rest)


def ship_metrics(ships: DataFrame, window: str = WINDOW) -> DataFrame:
    """Speed and mean position per window, destination and route."""
    return _flat(
        ships.groupBy(F.window("event_ts", window).alias("window"), "dest_port", "route_id").agg(
            F.avg("speed_kn").alias("avg_speed"),
            F.stddev("speed_kn").alias("speed_std"),
            F.count("*").alias("ship_count"),
            F.avg("lat").alias("avg_lat"),
            F.avg("lon").alias("avg_lon"),
        )
    )


def alert_metrics(alerts: DataFrame, window: str = WINDOW) -> DataFrame:
    """Severity and confidence per window, region and source."""
    return _flat(
        alerts.groupBy(F.window("event_ts", window).alias("window"), "region", "source").agg(
            F.avg("severity").alias("avg_severity"),
            F.avg("confidence").alias("avg_confidence"),
            F.count("*").alias("alert_count"),
        )
    )


def window_risk(ship_windows: DataFrame, alert_windows: DataFrame) -> DataFrame:
    """Risk class per window, destination and route, from the window's alert severity and speed spread.

    Alerts are first reduced to one row per window (mean over all its alerts), so the join does not
    pair every route with every region. A window without alerts has severity 0.
    """
    severity = F.sum(F.col("avg_severity") * F.col("alert_count")) / F.sum("alert_count")
    per_window = alert_windows.groupBy("window_start").agg(severity.alias("severity_avg"))
    return _classified(ship_windows.join(per_window, "window_start", "left"))


def _classified(rows: DataFrame) -> DataFrame:
    return (
        rows.withColumn("severity_avg", F.coalesce("severity_avg", F.lit(0.0)))
        .withColumn("risk_class", risk_class(F.round("severity_avg", 6), F.round("speed_std", 6)))
        .select("window_start", "window_end", "dest_port", "route_id", "severity_avg", "speed_std", "ship_count", "risk_class")
    )


def stream_window_risk(ships: DataFrame, alerts: DataFrame, window: str = WINDOW) -> DataFrame:
    """:func:`window_risk` on two watermarked streams: both are aggregated by window, then joined by window.

    The join holds a window's rows until both watermarks have passed it; then a window without alerts leaves with severity 0.
    """
    def of(df: DataFrame, *keys: str):
        return df.groupBy(F.window("event_ts", window).alias("window"), *keys)

    speeds = of(ships, "dest_port", "route_id").agg(F.stddev("speed_kn").alias("speed_std"), F.count("*").alias("ship_count"))
    severities = of(alerts).agg(F.avg("severity").alias("severity_avg"))
    return _classified(_flat(speeds.join(severities, "window", "left")))
