"""Port weather: enrichment with route context, operational fact, delay per port."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborline.functions.bands import weather_delay_hours, weather_risk_level
from harborline.functions.ranking import first_per
from harborline.session import as_array, per_key, small
from harborline.sources.master import PORT_STOCK_DEFAULT

OPERATIONAL_COLUMNS = [
    "operational_ts", "kdd_phase", "port_id", "port_ref", "origin_port", "route_id", "warehouse_id", "warehouse",
    "event_ts", "temperature_c", "humidity_pct", "wind_speed_kmh", "severity", "weather_risk_level",
    "port_operational_status", "weather_delay_hours_estimate", "recommended_action", "operational_severity",
]


def route_context(routes: DataFrame, ports: DataFrame, warehouses: DataFrame, port_stock: DataFrame) -> DataFrame:
    """Every route with its destination port, every warehouse, and the port's stock levels."""
    stock, reorder = PORT_STOCK_DEFAULT
    warehouse_list = as_array(
        warehouses.select("warehouse_id", F.col("warehouse_name").alias("warehouse")), "warehouse_id"
    )
    return (
        routes.join(small(ports.select("port_id", "port_name")), F.col("dest_port") == F.col("port_name"), "left")
        .join(small(port_stock), "port_name", "left")
        .withColumn("_w", F.explode(warehouse_list))
        .select(
            F.col("port_name").alias("port_ref"), "origin_port", "route_id", "_w.warehouse",
            F.coalesce("stock_on_hand", F.lit(stock)).alias("stock_on_hand"),
            F.coalesce("reorder_point", F.lit(reorder)).alias("reorder_point"),
            "port_id", "_w.warehouse_id", "sea_hours_estimate", "inland_hours_estimate",
        )
    )


def enrich_weather(weather: DataFrame, context: DataFrame, enriched_at: Column) -> DataFrame:
    """One row per observation and route into that port; ports without a route keep a null context."""
    severity = F.col("severity")
    return weather.join(small(context), "port_ref", "left").withColumns(
        {
            "weather_risk_level": weather_risk_level(severity),
            "port_operational_status": F.when(F.col("stock_on_hand").isNull(), "SIN_CONTEXTO")
            .when(F.col("stock_on_hand") <= F.col("reorder_point"), "STOCK_CRITICO")
            .when(severity >= 3, "METEO_VIGILANCIA")
            .otherwise("OPERATIVO"),
            "weather_delay_hours_estimate": weather_delay_hours(severity),
            "enriched_at": enriched_at,
        }
    )


def operational_fact(enriched: DataFrame, operational_ts: Column) -> DataFrame:
    """Recommended action and severity per observation and route."""
    level, status = F.col("weather_risk_level"), F.col("port_operational_status")
    return enriched.withColumns(
        {
            "recommended_action": F.when(
                (level == "MEDIO") & (status == "METEO_VIGILANCIA"),
                "reprogramar ventana portuaria y avisar a operacion terrestre",
            )
            .when(status == "STOCK_CRITICO", "priorizar stock alternativo y escalado logistico")
            .otherwise("seguimiento normal de la ruta"),
            "operational_severity": F.when(level == "ALTO", 5)
            .when(status == "METEO_VIGILANCIA", 4)
            .when(level == "MEDIO", 3)
            .otherwise(2),
            "kdd_phase": F.lit("interpretacion_y_accion"),
            "operational_ts": operational_ts,
        }
    )


def latest_by_port(weather: DataFrame, ports: DataFrame, tie: str = "event_id") -> DataFrame:
    """Newest observation of every known port, at most one row per port of the master table.

    Reducing before the route join keeps a busy port from being joined, shuffled or ranked row by row.
    """
    newest = first_per(weather, ["port_ref"], [F.col("event_ts").desc_nulls_last(), F.col(tie).desc()])
    known = per_key(ports.select(F.col("port_name").alias("port_ref")), newest, "port_ref")
    return known.filter(F.col("event_ts").isNotNull())


def latest_operational(weather: DataFrame, context: DataFrame, ports: DataFrame, as_of: Column) -> DataFrame:
    """Operational fact of the newest observation per port: one row per route (and port)."""
    return operational_fact(enrich_weather(latest_by_port(weather, ports), context, as_of), as_of)


def newest_by_route(operational: DataFrame) -> DataFrame:
    """Newest fact row per route and port, from the full fact table; rows without a route are left out."""
    routed = operational.filter(F.col("route_id").isNotNull())
    rest = ["temperature_c", "wind_speed_kmh", "humidity_pct", "severity"]
    return first_per(
        routed, ["route_id", "port_ref"], [F.col("event_ts").desc_nulls_last(), *[F.col(c).desc_nulls_last() for c in rest]]
    )
