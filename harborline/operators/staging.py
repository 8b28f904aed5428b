"""From raw lines and messages to typed, deduplicated staging tables. Works on batch and stream alike,
except the deduplication, which is a batch step."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harborline import schemas
from harborline.functions.bands import wind_severity
from harborline.functions.calendar import event_time
from harborline.functions.columns import pseudo_stock
from harborline.functions.ranking import drop_repeats

# Fixed values.
WAREHOUSE = "Valladolid"
SKU = "SKU-SEA-001"
REORDER_POINT = 30
WEATHER_DEFAULTS = {
    "event_type": "weather_snapshot",
    "source": "open_meteo",
    "region": "Estrecho de Gibraltar",
    "port_ref": "Algeciras",
}
ALERT_ROUTES = {"clima": "clima", "noticias": "noticias"}
ALERT_ROUTE_OTHER = "noticias"

SHIP_KEYS = ["ship_id", "ts"]
ALERT_KEYS = ["ts", "region", "text"]
WEATHER_KEYS = ["ts", "source", "port_ref", "event_type"]


def parse_json(df: DataFrame, schema: T.StructType, value: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """Message value to columns; a value that is not valid JSON gives nulls.

    The parsed struct goes through a generator on purpose. Filters on its fields then stay above the
    parse; with a plain projection each of them would be pushed below it and parse the text again.
    """
    data = F.from_json(F.col(value).cast("string"), schema)
    parsed = df.select(F.inline_outer(F.array(data)), *keep)
    return parsed.select(*schema.names, *keep)


def of_type(df: DataFrame, event_type: str) -> DataFrame:
    return df.filter(F.col("event_type") == event_type)


def require(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(columns))


def ship_events(lines: DataFrame, value: str = "value", schema: T.StructType = schemas.SHIP_POSITION) -> DataFrame:
    """Typed positions with event time, for streams: mixed topics are filtered by event type."""
    parsed = of_type(parse_json(lines, schema, value), "ship_position").withColumn("event_ts", event_time(F.col("ts")))
    return require(parsed, ["event_ts", "ship_id", "dest_port", "route_id"])


def alert_events(lines: DataFrame, value: str = "value", schema: T.StructType = schemas.GLOBAL_ALERT) -> DataFrame:
    parsed = parse_json(lines, schema, value).withColumn("event_ts", event_time(F.col("ts")))
    return require(parsed, ["event_ts", "region", "source"])


def stage_ships(positions: DataFrame, event_type: str | None = "ship_position") -> DataFrame:
    """Clean positions: required fields, one row per ship and time, UTC time, warehouse stock context."""
    rows = of_type(positions, event_type) if event_type else positions
    rows = drop_repeats(require(rows, ["ship_id", "ts", "lat", "lon"]), SHIP_KEYS)
    return rows.withColumns(
        {
            "ts_utc": event_time(F.col("ts")),
            "warehouse": F.lit(WAREHOUSE),
            "sku": F.lit(SKU),
            "reorder_point": F.lit(REORDER_POINT),
            "stock_on_hand": pseudo_stock(F.col("ship_id")),
        }
    )


def stage_alerts(alerts: DataFrame) -> DataFrame:
    rows = drop_repeats(require(alerts, ["ts", "region", "text"]), ALERT_KEYS)
    return rows.withColumn("ts_utc", event_time(F.col("ts")))


def stage_weather(snapshots: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    rows = drop_repeats(require(snapshots, WEATHER_KEYS), WEATHER_KEYS)
    return rows.withColumns(
        {
            "event_ts": event_time(F.col("ts")),
            "severity": wind_severity(F.col("wind_speed_kmh")),
            "ingested_at": ingested_at if ingested_at is not None else F.current_timestamp(),
        }
    )


def reshape_weather(responses: DataFrame, value: str = "value", defaults: Mapping[str, str] = WEATHER_DEFAULTS) -> DataFrame:
    """Nested weather API answer to the flat snapshot layout, with default tags where none were sent."""
    schema = T.StructType(
        schemas.WEATHER_RESPONSE.fields + [T.StructField(name, T.StringType()) for name in defaults]
    )
    flat = parse_json(responses, schema, value)
    return flat.select(
        F.col("current.time").alias("ts"),
        F.col("current.temperature_2m").alias("temperature_c"),
        F.col("current.relative_humidity_2m").alias("humidity_pct"),
        F.col("current.wind_speed_10m").alias("wind_speed_kmh"),
        F.col("current.wind_direction_10m").alias("wind_direction_deg"),
        F.col("current.weather_code").alias("weather_code"),
        *[F.coalesce(F.col(name), F.lit(value)).alias(name) for name, value in defaults.items()],
    )


def accepted(df: DataFrame, status: str = "status_code") -> DataFrame:
    return df.filter(F.col(status) == 200)


def rejected(df: DataFrame, status: str = "status_code") -> DataFrame:
    """Complement of :func:`accepted`; a missing status is a reject."""
    return df.filter(F.coalesce(F.col(status) != 200, F.lit(True)))


def alert_route(source: Column, routes: Mapping[str, str] = ALERT_ROUTES, other: str = ALERT_ROUTE_OTHER) -> Column:
    """Landing kind of an alert from its source text."""
    name = F.lower(F.trim(F.coalesce(source, F.lit(""))))
    pairs = [F.lit(item) for pair in routes.items() for item in pair]
    return F.coalesce(F.create_map(*pairs)[name], F.lit(other))


def landing_kind(topic: Column, source: Column) -> Column:
    return F.when(topic == "datos_crudos", "ships").when(topic == "alertas_globales", alert_route(source))


def flat_line(text: Column, fields: Column) -> Column:
    """A JSON object on one line with the fields of a struct at its end; any other text stays as it came."""
    line = F.regexp_replace(F.regexp_replace(text, r"[\r\n]+", " "), r"\s+$", "")
    whole = F.get_json_object(text, "$")
    with_fields = F.concat(F.substring(line, 1, F.length(line) - 1), F.lit(","), F.substring(F.to_json(fields), 2, 1 << 20))
    return F.when(whole.startswith("{") & (whole != "{}") & line.endswith("}"), with_fields).otherwise(line)


def add_lineage(df: DataFrame, at: Column | None = None, host: str | None = None) -> DataFrame:
    """Ingestion columns; partition and offset come from the message when the source has them."""
    has = set(df.columns)
    return df.withColumns(
        {
            "_ingestion_ts": (at if at is not None else F.current_timestamp()).cast("string"),
            "_ingestion_host": F.lit(host).cast("string"),
            "_ingestion_partition": (F.col("partition") if "partition" in has else F.lit(None)).cast("int"),
            "_ingestion_offset": (F.col("offset") if "offset" in has else F.lit(None)).cast("long"),
        }
    )
