"""Explicit schemas of raw events and of the tables kept for serving."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(), "double": T.DoubleType(), "int": T.IntegerType(), "bigint": T.LongType(),
    "boolean": T.BooleanType(), "timestamp": T.TimestampType(),
}


def _struct(spec: str) -> T.StructType:
    """Nullable fields from ``name type, name type``; usable before a session exists."""
    pairs = (field.split() for field in spec.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


SHIP_POSITION = _struct(
    "event_type string, ts string, ship_id string, route_id string, origin_port string, dest_port string, "
    "lat double, lon double, speed_kn double, heading double"
)

GLOBAL_ALERT = _struct(
    "event_type string, ts string, source string, severity int, region string, text string, confidence double"
)

WEATHER_SNAPSHOT = _struct(
    "ts string, temperature_c double, humidity_pct int, wind_speed_kmh double, wind_direction_deg int, "
    "weather_code int, port_ref string, source string, event_type string, region string"
)

WEATHER_RESPONSE = T.StructType([
    T.StructField("current", _struct(
        "time string, temperature_2m double, relative_humidity_2m int, wind_speed_10m double, wind_direction_10m int, "
        "weather_code int"
    ))
])

LINEAGE = _struct("_ingestion_ts string, _ingestion_host string, _ingestion_partition int, _ingestion_offset bigint")

SHIP_METRICS = _struct(
    "window_start timestamp, window_end timestamp, dest_port string, route_id string, avg_speed double, "
    "speed_std double, ship_count bigint, avg_lat double, avg_lon double, processed_at timestamp"
)

ALERT_METRICS = _struct(
    "window_start timestamp, window_end timestamp, region string, source string, avg_severity double, "
    "avg_confidence double, alert_count bigint, processed_at timestamp"
)

ML_PREDICTIONS = _struct(
    "prediction_id string, ship_id string, dest_port string, predicted_delay_hours double, risk_category string, "
    "model_used string, confidence double, created_at timestamp"
)

ROUTE_ALERTS = _struct(
    "alert_id string, dest_port string, risk_level string, risk_score double, severity int, recommendation string, "
    "email_sent boolean, created_at timestamp"
)

VEHICLE_LATEST_STATE = _struct(
    "ship_id string, event_ts timestamp, route_id string, origin_port string, dest_port string, warehouse string, "
    "lat double, lon double, speed_kn double, heading double, stock_on_hand int, reorder_point int, "
    "updated_at timestamp"
)

SERVING_TABLES = {
    "ship_metrics": SHIP_METRICS,
    "alert_metrics": ALERT_METRICS,
    "ml_predictions": ML_PREDICTIONS,
    "route_alerts": ROUTE_ALERTS,
    "vehicle_latest_state": VEHICLE_LATEST_STATE,
}

# Key columns of each serving table. Window tables carry every grouping key, so two routes (or two
# sources) that share a window never overwrite each other.
SERVING_KEYS = {
    "ship_metrics": ["window_start", "window_end", "dest_port", "route_id"],
    "alert_metrics": ["window_start", "window_end", "region", "source"],
    "ml_predictions": ["ship_id", "created_at"],
    "route_alerts": ["dest_port", "created_at"],
    "vehicle_latest_state": ["ship_id"],
}


def with_lineage(schema: T.StructType) -> T.StructType:
    """The event schema plus the lineage fields added at landing, so staging keeps them."""
    return T.StructType(schema.fields + LINEAGE.fields)
