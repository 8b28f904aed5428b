"""Sea against air and truck: options per ship, verdicts, contingency lists and cost rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborline.functions.bands import mode_label, severity_class
from harborline.functions.calendar import add_hours, minute_text
from harborline.functions.columns import existing, route_name
from harborline.functions.geo import geo_km
from harborline.functions.ranking import first_per, row_index
from harborline.operators.fleet import with_ports
from harborline.session import as_array, per_key, small

# Fixed values.
TRUCK_SPEED_KMH = 68.0
TRUCK_COST_PER_KM_EUR = 1.45
PORT_HANDLING_HOURS = 6.0
AIR_HANDLING_HOURS = 4.0
HOURLY_DEMAND_UNITS = 1.6
AIR_MIN_TIME_SAVED_HOURS = 24
AIR_MAX_COST_EUR = 18000
RUPTURE_DAYS = 4
PLANNED_FLIGHT_HOURS = 15.0
HIGH_CONTINGENCY_COST_EUR = 15000
REASON_AIR = "El barco llega tarde para cubrir stock y la opcion aerea evita rotura con mejor ETA"
REASON_SEA = "La ruta maritima sigue siendo viable con menor coste total"

RECOVERY_COLUMNS = [
    "decision_ts", "ship_id", "route_id", "origin_port", "dest_port", "warehouse", "air_option_id", "air_dest_city",
    "weather_risk_level", "port_operational_status", "weather_severity", "graph_risk_level", "graph_recommendation",
    "stock_on_hand", "reorder_point", "hours_until_stock_break", "ship_remaining_hours", "air_total_eta_hours",
    "time_saved_hours", "air_total_cost_eur", "truck_cost_eur", "stock_break_risk", "recommended_mode",
    "ia_recommendation", "reason_summary",
]


def ship_context(latest: DataFrame, routes: DataFrame, ports: DataFrame, warehouses: DataFrame,
                 weather_by_route: DataFrame, alert_by_port: DataFrame, default_delay: float | None = None) -> DataFrame:
    """Latest row per ship with route, weather, alert, remaining time and time to stock break.

    ``weather_by_route`` holds one row per (route, port) and ``alert_by_port`` one per port, so no join
    here multiplies ships. Every joined side is bounded by a master table.
    """
    weather = per_key(
        routes.select("route_id", F.col("dest_port")),
        weather_by_route.select(
            "route_id", F.col("port_ref").alias("dest_port"), "weather_risk_level", "port_operational_status",
            "weather_delay_hours_estimate", F.col("severity").alias("weather_event_severity"),
        ),
        ["route_id", "dest_port"],
    )
    alerts = alert_by_port.select(
        F.col("via_port").alias("dest_port"), F.col("risk_level").alias("graph_risk_level"),
        F.col("severity").alias("alert_severity"), F.col("recommendation").alias("graph_recommendation"),
    )
    # Restating the bound keeps the hint after the projection above.
    alerts = per_key(ports.select(F.col("port_name").alias("dest_port")), alerts, "dest_port")
    known = warehouses.select(F.col("warehouse_name").alias("_known")).distinct()
    delay = F.col("weather_delay_hours_estimate")
    if default_delay is not None:
        delay = F.coalesce(delay, F.lit(default_delay))
    dest = (F.col("dest_lat"), F.col("dest_lon"))
    total = F.round(geo_km(F.col("origin_lat"), F.col("origin_lon"), *dest), 2)
    remaining = F.round(geo_km(F.col("lat"), F.col("lon"), *dest), 2)
    ratio = F.when(F.col("total_route_distance_km") <= 0.0, F.lit(1.0)).otherwise(
        F.try_divide("remaining_route_distance_km", "total_route_distance_km")
    )
    return (
        with_ports(
            latest.join(small(routes.select("route_id", "sea_hours_estimate", "inland_hours_estimate")), "route_id", "left"),
            ports,
        )
        .join(small(known), F.col("warehouse") == F.col("_known"), "left")
        .withColumn("warehouse", F.col("_known"))
        .drop("_known")
        .join(weather, ["route_id", "dest_port"], "left")
        .join(alerts, "dest_port", "left")
        .withColumn("total_route_distance_km", total)
        .withColumn("remaining_route_distance_km", remaining)
        .withColumn("remaining_ratio", ratio)
        .withColumn(
            "ship_remaining_hours",
            F.round(F.col("sea_hours_estimate") * F.col("remaining_ratio") + F.col("inland_hours_estimate")
                    + delay + F.lit(PORT_HANDLING_HOURS), 1),
        )
        .withColumn(
            "hours_until_stock_break",
            F.round((F.col("stock_on_hand") - F.col("reorder_point")) / F.lit(HOURLY_DEMAND_UNITS), 1),
        )
        .withColumn("weather_severity", F.coalesce("weather_event_severity", "alert_severity"))
        .withColumn(
            "stock_break_risk",
            F.when(F.col("hours_until_stock_break") <= 0, "ROTURA_INMINENTE")
            .when(F.col("ship_remaining_hours") > F.col("hours_until_stock_break"), "ROTURA_PROBABLE")
            .otherwise("COBERTURA_OK"),
        )
        .withColumn(
            "ia_recommendation",
            F.when((F.col("weather_severity") >= 4) | (F.col("weather_risk_level") == "ALTO")
                   | (F.col("stock_break_risk") != "COBERTURA_OK"), "evaluar_aereo_urgente")
            .otherwise("mantener_maritimo"),
        )
    )


def priced_corridors(corridors: DataFrame, airports: DataFrame | None = None) -> DataFrame:
    """Corridors with truck leg and totals; with ``airports`` also the port city they start from."""
    truck_eta = F.round(F.col("truck_km_to_warehouse") / F.lit(TRUCK_SPEED_KMH), 1)
    truck_cost = F.round(F.col("truck_km_to_warehouse") * F.lit(TRUCK_COST_PER_KM_EUR), 2)
    rows = corridors.select(
        F.col("air_recovery_id").alias("air_option_id"), "origin_airport", F.col("dest_city").alias("air_dest_city"),
        truck_cost.alias("truck_cost_eur"),
        F.round(F.col("air_eta_hours") + truck_eta + F.lit(AIR_HANDLING_HOURS), 1).alias("air_total_eta_hours"),
        F.round(F.col("air_cost_eur") + truck_cost, 2).alias("air_total_cost_eur"),
    )
    if airports is None:
        return rows.withColumn("origin_city", F.lit(None).cast("string"))
    cities = small(airports.select(F.col("airport_name").alias("origin_airport"), F.col("city_name").alias("origin_city")))
    return rows.join(cities, "origin_airport", "left")


def _saved_hours(eta: Column) -> Column:
    return F.round(F.col("ship_remaining_hours") - eta, 1)


def _mode(eta: Column) -> Column:
    wins = (
        (F.col("ia_recommendation") == "evaluar_aereo_urgente")
        & (_saved_hours(eta) > 0.0)
        & (eta <= F.col("hours_until_stock_break"))
    )
    return F.when(wins, "AEREO_CAMION").otherwise("MARITIMO")


def _finish(rows: DataFrame, as_of: Column) -> DataFrame:
    eta = F.col("air_total_eta_hours")
    return (
        rows.withColumn("time_saved_hours", _saved_hours(eta))
        .withColumn("recommended_mode", _mode(eta))
        .withColumn("reason_summary",
                    F.when(F.col("recommended_mode") == "AEREO_CAMION", REASON_AIR).otherwise(REASON_SEA))
        .withColumn("decision_ts", as_of)
    )


def air_option_rows(context: DataFrame, corridors: DataFrame, as_of: Column) -> DataFrame:
    """Every corridor for every ship. The corridor list is fixed and travels as one array value."""
    rows = context.withColumn("_c", F.explode(as_array(corridors))).select("*", "_c.*").drop("_c")
    return _finish(rows, as_of).select(*RECOVERY_COLUMNS)


def best_air_options(context: DataFrame, corridors: DataFrame, as_of: Column, prefer_air: bool = False,
                     match_origin: bool = False) -> DataFrame:
    """Best corridor per ship: mode, then cost, then arrival, then id.

    By default sea comes before air, so air is chosen only when every corridor qualifies;
    ``prefer_air`` reverses that. ``match_origin`` considers only corridors from the ship's origin city.
    The choice is a minimum over an array on the ship's own row: no fan-out, no second shuffle.
    """
    first_mode = "AEREO_CAMION" if prefer_air else "MARITIMO"
    columns = ["air_option_id", "air_dest_city", "truck_cost_eur"]

    def ranked(option: Column) -> Column:
        eta = option["air_total_eta_hours"]
        return F.struct(
            F.when(_mode(eta) == first_mode, 0).otherwise(1).alias("mode_rank"),
            option["air_total_cost_eur"].alias("air_total_cost_eur"),
            eta.alias("air_total_eta_hours"),
            *[option[c].alias(c) for c in columns],
        )

    options = F.col("_options")
    if match_origin:
        options = F.filter(options, lambda o: o["origin_city"] == F.col("origin_port"))
    chosen = (
        context.withColumn("_options", as_array(corridors))
        .withColumn("_best", F.array_min(F.transform(options, ranked)))
        .drop("_options")
        .select("*", *[F.col(f"_best.{c}") for c in [*columns, "air_total_cost_eur", "air_total_eta_hours"]])
    )
    return _finish(chosen, as_of).select(*RECOVERY_COLUMNS)


def estimated_options(voyages: DataFrame) -> DataFrame:
    """Rough air options from the arrival estimate, for use while the option table is empty.

    The cost grows with the ship's position in id order, taken from a distributed row index.
    """
    eta = F.when(F.coalesce("eta_hours_estimate", F.lit(0.0)) == 0.0, 240.0).otherwise(F.col("eta_hours_estimate"))
    stock = F.coalesce("stock_on_hand", F.lit(0))
    reorder = F.coalesce("reorder_point", F.lit(0))
    is_critical = stock <= reorder
    air_eta = F.greatest(F.lit(24.0), F.round(eta * F.lit(0.35), 1))
    # Only the columns in use are sorted and checkpointed.
    slim = voyages.select("ship_id", "origin_port", "dest_port", "stock_on_hand", "reorder_point", "eta_hours_estimate")
    return row_index(slim, ["ship_id"]).select(
        "ship_id",
        F.coalesce("origin_port", F.lit("Shanghai")).alias("origin_port"),
        F.coalesce("dest_port", F.lit("N/A")).alias("dest_port"),
        eta.alias("ship_remaining_hours"),
        air_eta.alias("air_total_eta_hours"),
        F.greatest(F.lit(0.0), F.round(eta - air_eta, 1)).alias("time_saved_hours"),
        (F.lit(12000.0) + F.col("row_index") * F.lit(850.0)).alias("air_total_cost_eur"),
        F.when(is_critical, "AEREO_CAMION").otherwise("MARITIMO").alias("recommended_mode"),
        F.when(is_critical, "ROTURA_STOCK").otherwise("COBERTURA_OK").alias("stock_break_risk"),
        F.greatest(F.lit(48.0), F.round(reorder * F.lit(3.0), 1)).alias("hours_until_stock_break"),
    )


def options_or_estimate(options: DataFrame, voyages: DataFrame) -> DataFrame:
    return estimated_options(voyages) if options.isEmpty() else options


def best_by_port(options: DataFrame, ports: DataFrame) -> DataFrame:
    """The option with the most hours saved per destination port, at most one row per known port."""
    best = first_per(options, ["dest_port"], [F.col("time_saved_hours").desc_nulls_last(), F.col("ship_id")])
    return per_key(ports.select(F.col("port_name").alias("dest_port")), best, "dest_port").filter(
        F.col("ship_id").isNotNull()
    )


def sea_air_overcost(corridors: DataFrame, routes: DataFrame, traffic: DataFrame | None = None) -> DataFrame:
    """Corridors next to the sea routes into the same city, with the extra cost of flying.

    ``traffic`` (``route_id, ships_on_route``) adds how many ships sail the route now.
    """
    sea = routes.select("route_id", F.col("dest_port").alias("dest_city"), "maritime_cost_eur")
    rows = corridors.join(small(sea), "dest_city", "left").select(
        "air_recovery_id", "origin_airport", "dest_city", "air_eta_hours", "air_cost_eur", "truck_km_to_warehouse",
        "route_id", "maritime_cost_eur",
        F.round(F.col("air_cost_eur") - F.col("maritime_cost_eur"), 2).alias("air_overcost_eur"),
    )
    if traffic is None:
        return rows
    return rows.join(per_key(routes.select("route_id"), traffic, "route_id"), "route_id", "left").withColumn(
        "ships_on_route", F.coalesce("ships_on_route", F.lit(0))
    )


def air_route_choices(corridors: DataFrame) -> DataFrame:
    """Distinct air routes that have a price."""
    return corridors.select("origin_airport", "dest_city", "air_cost_eur", "air_eta_hours").distinct().dropna(subset=["air_cost_eur"])


def air_contingency(coverage: DataFrame, best_air: DataFrame) -> DataFrame:
    """Uncovered orders whose inbound port has an air option."""
    options = best_air.select(
        F.col("dest_port").alias("inbound_port"), "air_dest_city", F.col("air_total_cost_eur").alias("option_cost")
    )
    return (
        coverage.filter(F.col("cover_status") == "NO CUBRE")
        .join(options, "inbound_port")
        .select(
            "article_ref", "order_id",
            F.format_string("Shanghai -> %s + camion Valladolid", F.col("air_dest_city")).alias("air_alternative"),
            minute_text(F.col("arrival_valladolid")).alias("arrival_valladolid"),
            F.round("option_cost", 2).alias("air_overcost_eur"),
            "customer_city", "industrial_week", "cover_status",
        )
    )


def flight_verdicts(flights: DataFrame, as_of: Column, rupture_days: int = RUPTURE_DAYS) -> DataFrame:
    """Verdict per flight: optimal when it beats the stock rupture at the lowest cost of all flights."""
    rupture = add_hours(as_of, F.lit(float(rupture_days * 24)))
    arrives = add_hours(as_of, F.col("flight_eta_hours")) < rupture
    return (
        flights.withColumn("min_flight_cost", flights.agg(F.min("flight_cost_eur")).scalar())
        .withColumn("stock_rupture_date", minute_text(rupture))
        .withColumn(
            "recommendation",
            F.when(arrives & (F.col("flight_cost_eur") == F.col("min_flight_cost")), "ÓPTIMA")
            .when(arrives, "VIABLE")
            .otherwise("NO LLEGA"),
        )
        .drop("min_flight_cost")
    )


def _listed_flights(context: DataFrame, flights: DataFrame, as_of: Column) -> DataFrame:
    """Articles with their rupture time and the flight list, cheapest first, as one array value per row."""
    return context.select(
        "article_ref", add_hours(as_of, F.coalesce("hours_to_stockout", F.lit(0.0))).alias("_rupture"),
        as_array(flights, "flight_cost_eur", "flight_eta_hours", "flight_number").alias("_flights"),
    )


def article_flights(context: DataFrame, flights: DataFrame, as_of: Column) -> DataFrame:
    """Verdict on every flight of the list for every article, against the article's own rupture time.

    ``context`` has ``hours_to_stockout`` per article; without that figure the article counts as out of stock. A
    flight that lands before the rupture is optimal when no flight of the list costs less, late ones included.
    """
    arrives = add_hours(as_of, F.col("_f.flight_eta_hours")) < F.col("_rupture")
    cheapest = F.col("_f.flight_cost_eur") == F.col("_lowest")
    return (
        _listed_flights(context, flights, as_of)
        .withColumn("_lowest", F.element_at("_flights", 1)["flight_cost_eur"])
        .withColumn("_f", F.explode("_flights"))
        .select(
            "article_ref", "_f.flight_number", "_f.airport", "_f.flight_cost_eur", "_f.flight_eta_hours",
            minute_text(F.col("_rupture")).alias("stock_rupture_date"),
            F.when(arrives & cheapest, "ÓPTIMA").when(arrives, "VIABLE").otherwise("NO LLEGA").alias("recommendation"),
        )
    )


def article_best_flight(context: DataFrame, flights: DataFrame, as_of: Column) -> DataFrame:
    """The cheapest flight that lands before the article's rupture, the fastest of equals; nulls where none does."""
    in_time = F.filter("_flights", lambda f: add_hours(as_of, f["flight_eta_hours"]) < F.col("_rupture"))
    return _listed_flights(context, flights, as_of).withColumn("_f", F.get(in_time, F.lit(0))).select(
        "article_ref", minute_text(F.col("_rupture")).alias("stock_rupture_date"), "_f.flight_number", "_f.airport",
        "_f.flight_cost_eur", "_f.flight_eta_hours", F.size(in_time).alias("flights_in_time"),
    )


def cheapest_viable(verdicts: DataFrame) -> DataFrame:
    """The best flight that arrives in time."""
    viable = verdicts.filter(F.col("recommendation") != "NO LLEGA")
    return viable.orderBy("flight_cost_eur", "flight_eta_hours").limit(1)


def last_mile(flights: DataFrame, options: DataFrame) -> DataFrame:
    """Every flight with every truck option of the fixed list; the cheapest is marked."""
    trucks = as_array(options, "truck_cost_eur", "option")
    cheapest = F.element_at("_trucks", 1)["option"]
    return (
        flights.withColumn("_trucks", trucks)
        .withColumn("_cheapest", cheapest)
        .withColumn("_t", F.explode("_trucks"))
        .select(
            "ship_id", "air_option_id", "_t.option",
            F.round(F.col("flight_cost_eur") + F.col("_t.truck_cost_eur"), 2).alias("total_cost_eur"),
            F.round(F.col("flight_eta_hours") + F.col("_t.truck_hours"), 1).alias("total_eta_hours"),
            (F.col("_t.option") == F.col("_cheapest")).alias("is_cheapest"),
        )
        .withColumn("high_cost", F.col("total_cost_eur") > HIGH_CONTINGENCY_COST_EUR)
    )


def truck_plan(flights: DataFrame, trucks: DataFrame) -> DataFrame:
    """Planning table: flight cost plus truck cost per haulier, fixed flight time, cheapest haulier marked."""
    fleet = as_array(trucks, "truck_cost_eur", "carrier", "license_plate")
    return (
        flights.withColumn("_trucks", fleet)
        .withColumn("_first", F.element_at("_trucks", 1)["license_plate"])
        .withColumn("_t", F.explode("_trucks"))
        .select(
            "ship_id", "air_option_id", "_t.route", "_t.carrier", "_t.license_plate",
            F.round(F.col("flight_cost_eur") + F.col("_t.truck_cost_eur"), 2).alias("total_cost_eur"),
            F.round(F.col("_t.truck_eta_hours") + F.lit(PLANNED_FLIGHT_HOURS), 1).alias("total_eta_hours"),
            (F.col("_t.license_plate") == F.col("_first")).alias("is_cheapest"),
        )
    )


def executive_air_rule(voyages: DataFrame, air: DataFrame) -> DataFrame:
    """One row: hours saved by air on average, mean air cost, and whether the rule recommends air."""
    sea_eta = voyages.agg(F.avg("eta_hours_estimate")).scalar()
    return (
        air.agg(F.avg("air_total_eta_hours").alias("_eta"), F.avg("air_total_cost_eur").alias("_cost"))
        .withColumn("air_time_saved_hours", F.greatest(F.round(sea_eta - F.col("_eta"), 1), F.lit(0.0)))
        .withColumn("air_investment_eur", F.round("_cost", 0))
        .select(
            "air_time_saved_hours", "air_investment_eur",
            ((F.col("air_time_saved_hours") >= AIR_MIN_TIME_SAVED_HOURS)
             & (F.col("air_investment_eur") <= AIR_MAX_COST_EUR)).alias("air_recommended"),
        )
    )


def decision_table(options: DataFrame) -> DataFrame:
    """Sea against air per ship, without rows that lack the compared figures."""
    wanted = ["ship_id", "origin_port", "dest_port", "ship_remaining_hours", "air_total_eta_hours", "time_saved_hours",
              "air_total_cost_eur", "recommended_mode"]
    return existing(options, wanted).dropna(subset=["time_saved_hours", "air_total_cost_eur"]).withColumn(
        "mode_label", mode_label(F.col("recommended_mode"))
    )


def route_map(routes: DataFrame, ports: DataFrame, alerts: DataFrame) -> DataFrame:
    """Routes with both port positions and the alert severity of the destination (1 without alert)."""
    by_dest = alerts.select(F.col("via_port").alias("dest_port"), "severity", "risk_level")
    severity = F.coalesce("severity", F.lit(1))
    return (
        with_ports(routes.select("route_id", "origin_port", "dest_port", "maritime_cost_eur"), ports)
        .join(by_dest, "dest_port", "left")
        .withColumn("severity", severity)
        .withColumn("color_class", severity_class(F.col("severity")))
    )


def corridor_pairs(ports: DataFrame, pairs: DataFrame, hub: str = "Valladolid", hub_lat: float = 41.6528,
                   hub_lon: float = -4.7246) -> DataFrame:
    """Lines from every origin hub to every destination port (``route``) and to the warehouse (``deviation``).

    Pairs come from the two short port lists; the counts come from the positions.
    """
    dests = ports.filter(F.col("port_type") == "port").select("port_name", "lat", "lon")
    name = route_name(F.col("port_name"), F.col("_d.port_name"))
    deviation = F.col("_d.port_name") == hub
    targets = F.concat(
        as_array(dests), F.array(F.struct(F.lit(hub).alias("port_name"), F.lit(hub_lat).alias("lat"), F.lit(hub_lon).alias("lon")))
    )
    lines = (
        ports.filter(F.col("port_type") == "origin_hub")
        .withColumn("_d", F.explode(targets))
        .select(
            F.col("port_name").alias("origin_port"), F.col("_d.port_name").alias("dest_port"),
            F.col("lat").alias("origin_lat"), F.col("lon").alias("origin_lon"),
            F.col("_d.lat").alias("dest_lat"), F.col("_d.lon").alias("dest_lon"),
            F.when(deviation, F.concat(F.lit("Desvío "), name)).otherwise(name).alias("route_name"),
            F.when(deviation, "deviation").otherwise("route").alias("line_kind"),
        )
    )
    sailed = pairs.select("origin_port", "dest_port", "positions")
    return lines.join(sailed, ["origin_port", "dest_port"], "left").withColumn(
        "positions", F.coalesce("positions", F.lit(0))
    )
