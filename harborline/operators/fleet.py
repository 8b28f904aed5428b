"""Vessel state: latest rows, voyage figures, arrival tables, positions and incident what-ifs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborline.functions.bands import label
from harborline.functions.calendar import add_hours, minute_text
from harborline.functions.columns import where_given
from harborline.functions.geo import bearing_degrees, eta_progress, manhattan_degrees, point_on_path
from harborline.functions.ranking import last_seen
from harborline.session import per_key, small
from harborline.sources.master import INCIDENT_HOURS, SHIP_NAMES

# Fixed values.
IN_TRANSIT_DEGREES = 0.35
COVER_MARGIN_HOURS = 96.0

STATE_COLUMNS = [
    "ship_id", "event_ts", "route_id", "origin_port", "dest_port", "warehouse", "lat", "lon", "speed_kn", "heading",
    "stock_on_hand", "reorder_point",
]


def latest_positions(ships: DataFrame, ts: str = "ts", tie: Sequence[str] = ("event_id",)) -> DataFrame:
    return last_seen(ships, ["ship_id"], ts, tie)


def vehicle_state(latest: DataFrame, updated_at: Column, ts: str = "ts") -> DataFrame:
    """Latest row per ship in the layout of the serving table."""
    return latest.withColumnRenamed(ts, "event_ts").select(*STATE_COLUMNS, updated_at.alias("updated_at"))


def eta_hours(stock: Column) -> Column:
    return F.round(F.greatest(F.lit(0.0), F.lit(405.0) - stock * F.lit(0.4)) + F.lit(12.0), 1)


def with_voyage(latest: DataFrame, routes: DataFrame, names: Mapping[str, str] = SHIP_NAMES) -> DataFrame:
    """Arrival estimate, voyage days and ship name for latest rows."""
    dim = small(routes.select("route_id", "sea_hours_estimate", "inland_hours_estimate", "maritime_cost_eur"))
    return (
        latest.join(dim, "route_id", "left")
        .withColumn("eta_hours_estimate", eta_hours(F.col("stock_on_hand")))
        .withColumn("voyage_days_total", F.round(F.col("sea_hours_estimate") / F.lit(24.0), 1))
        .withColumn("voyage_days_remaining", F.round(F.col("eta_hours_estimate") / F.lit(24.0), 1))
        .withColumn("voyage_days_elapsed", F.round(F.col("voyage_days_total") - F.col("voyage_days_remaining"), 1))
        .withColumn("ship_name", label(F.col("ship_id"), names))
    )


def with_eta_dates(voyages: DataFrame, as_of: Column) -> DataFrame:
    """Arrival and departure as minute text, ``N/A`` when unknown."""
    return voyages.withColumns(
        {
            "eta_fecha": F.coalesce(minute_text(add_hours(as_of, F.col("eta_hours_estimate"))), F.lit("N/A")),
            "fecha_salida_origen": F.coalesce(
                minute_text(add_hours(as_of, F.col("voyage_days_elapsed") * F.lit(-24.0))), F.lit("N/A")
            ),
        }
    )


def with_tooltip(voyages: DataFrame) -> DataFrame:
    return voyages.withColumn(
        "tooltip_text",
        F.format_string("Barco: %s\nOrigen: %s\nDestino: %s\nETA: %s", "ship_id", "origin_port", "dest_port", "eta_fecha"),
    )


def _ends(ships: DataFrame, ports: DataFrame) -> DataFrame:
    """Coordinates of both ports of each row."""
    def side(name: str) -> DataFrame:
        return small(ports.select(
            F.col("port_name").alias(f"{name}_port"), F.col("lat").alias(f"{name}_lat"), F.col("lon").alias(f"{name}_lon")
        ))
    return ships.join(side("origin"), "origin_port", "left").join(side("dest"), "dest_port", "left")


def with_ports(ships: DataFrame, ports: DataFrame) -> DataFrame:
    return _ends(ships, ports)


def in_transit(ships: DataFrame, ports: DataFrame, ship_id: str | None = None, dest_port: str | None = None) -> DataFrame:
    """Ships outside the harbour area of both ports."""
    rows = _ends(where_given(ships, ship_id=ship_id, dest_port=dest_port), ports)
    here = (F.col("lat"), F.col("lon"))
    return (
        rows.withColumn("distance_to_origin", manhattan_degrees(*here, F.col("origin_lat"), F.col("origin_lon")))
        .withColumn("distance_to_dest", manhattan_degrees(*here, F.col("dest_lat"), F.col("dest_lon")))
        .filter((F.col("distance_to_origin") > IN_TRANSIT_DEGREES) & (F.col("distance_to_dest") > IN_TRANSIT_DEGREES))
    )


def with_bearing(ships: DataFrame, ports: DataFrame) -> DataFrame:
    """Bearing from origin to destination port."""
    return _ends(ships, ports).withColumn(
        "bearing",
        F.round(bearing_degrees(F.col("origin_lat"), F.col("origin_lon"), F.col("dest_lat"), F.col("dest_lon")), 1),
    )


def route_paths(waypoints: DataFrame) -> DataFrame:
    """One ordered point array per route (ten points at most per route in the master data)."""
    points = F.sort_array(F.collect_list(F.struct("seq", "lat", "lon")))
    return waypoints.groupBy("route_id").agg(points.alias("path"))


def snapped_positions(voyages: DataFrame, waypoints: DataFrame, routes: DataFrame) -> DataFrame:
    """Positions moved onto the sea corridor by voyage progress; routes without a path keep theirs."""
    paths = per_key(routes.select("route_id"), route_paths(waypoints), "route_id")
    progress = eta_progress(F.col("eta_hours_estimate"), F.col("voyage_days_total"))
    return (
        voyages.join(paths, "route_id", "left")
        .withColumn("progress", progress)
        .withColumn("_at", point_on_path(F.col("path"), F.col("progress")))
        .withColumn("lat", F.coalesce("_at.lat", "lat"))
        .withColumn("lon", F.coalesce("_at.lon", "lon"))
        .drop("path", "_at")
    )


def incident_hours(active: Sequence[str], hours: Mapping[str, int] = INCIDENT_HOURS) -> float:
    return float(sum(hours[name] for name in active))


def delay_by_port(operational: DataFrame, ports: DataFrame) -> DataFrame:
    """Delay of the newest observation per port, for rows that already hold one observation per port."""
    delay = operational.groupBy(F.col("port_ref").alias("dest_port")).agg(
        F.max("weather_delay_hours_estimate").alias("weather_delay")
    )
    return per_key(ports.select(F.col("port_name").alias("dest_port")), delay, "dest_port")


def eta_table(voyages: DataFrame, delays: DataFrame, air: DataFrame, as_of: Column, incidents: Sequence[str] = (),
              ship_id: str | None = None, dest_port: str | None = None) -> DataFrame:
    """Original and recalculated arrival per ship, with an air flag. ``air`` has one row per ship."""
    base = F.coalesce("eta_hours_estimate", F.lit(0.0))
    recalculated = F.greatest(
        F.lit(0.0), base + F.lit(incident_hours(incidents)) + F.coalesce("weather_delay", F.lit(0.0))
    )
    risky = F.col("stock_break_risk").isNotNull() & (F.col("stock_break_risk") != "COBERTURA_OK")
    needs_air = F.coalesce(F.col("recommended_mode") == "AEREO_CAMION", F.lit(False)) | risky
    return (
        with_eta_dates(where_given(voyages, ship_id=ship_id, dest_port=dest_port), as_of)
        .join(delays, "dest_port", "left")
        .join(air.select("ship_id", "recommended_mode", "stock_break_risk"), "ship_id", "left")
        .select(
            "ship_name", "ship_id", "origin_port", "dest_port", "lat", "lon", "fecha_salida_origen", "voyage_days_total",
            minute_text(add_hours(as_of, base)).alias("eta_original"),
            minute_text(add_hours(as_of, recalculated)).alias("eta_recalculated"),
            F.coalesce("maritime_cost_eur", F.lit(0.0)).alias("maritime_cost_eur"),
            needs_air.alias("needs_air"),
            F.when(needs_air, "Riesgo de rotura").otherwise("Cobertura OK").alias("status"),
        )
    )


def incident_scenarios(hours: Mapping[str, int] = INCIDENT_HOURS) -> Column:
    """Every subset of the incidents as an array of ``scenario, extra_hours`` (2^6 fixed entries)."""
    names = list(hours)
    subsets = [c for size in range(len(names) + 1) for c in combinations(names, size)]
    return F.array(*[
        F.struct(F.lit(" + ".join(s)).alias("scenario"), F.lit(float(sum(hours[n] for n in s))).alias("extra_hours"))
        for s in subsets
    ])


def simulate_incidents(voyages: DataFrame, air: DataFrame, scenarios: Column | None = None) -> DataFrame:
    """Effect of every incident combination on every ship: margin, cover and mode."""
    chosen = scenarios if scenarios is not None else incident_scenarios()
    recovery = air.select(
        "ship_id", "ship_remaining_hours", "hours_until_stock_break", "air_total_eta_hours", "air_total_cost_eur"
    )
    cover = F.when(F.col("margin_hours") < COVER_MARGIN_HOURS, "NO CUBRE").otherwise("CUBRE")
    return (
        voyages.select("ship_id", "origin_port", "dest_port", "eta_hours_estimate")
        .join(recovery, "ship_id")
        .withColumn("base_eta", F.coalesce("ship_remaining_hours", "eta_hours_estimate", F.lit(0.0)))
        .withColumn("hours_until_stock_break", F.coalesce("hours_until_stock_break", F.lit(0.0)))
        .withColumn("_s", F.explode(chosen))
        .select("*", "_s.scenario", "_s.extra_hours")
        .withColumn("recalculated_eta", F.round(F.col("base_eta") + F.col("extra_hours"), 1))
        .withColumn("margin_hours", F.round(F.col("hours_until_stock_break") - F.col("recalculated_eta"), 1))
        .withColumn("cover_status", cover)
        .select(
            "ship_id", "origin_port", "dest_port", "scenario", "base_eta", "extra_hours", "recalculated_eta",
            "hours_until_stock_break", "margin_hours", "cover_status",
            F.when(F.col("cover_status") == "NO CUBRE", "AEREO_CAMION").otherwise("MARITIMO").alias("recommended_mode"),
            F.coalesce("air_total_eta_hours", F.lit(0.0)).alias("air_eta"),
            F.coalesce("air_total_cost_eur", F.lit(0.0)).alias("air_cost"),
        )
    )
