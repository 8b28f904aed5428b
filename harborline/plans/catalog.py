"""Every query of the library, runnable on a folder of test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harborline.functions.bands import node_state
from harborline.functions.columns import pseudo_stock
from harborline.operators import alerts, contingency, fleet, graph, kpis, models, network, outcomes, quality, staging, stock
from harborline.operators.weather import OPERATIONAL_COLUMNS
from harborline.plans import adapters, microbatch
from harborline.plans.domain import FLEET_AS_OF, ORDERS_AS_OF, Domain
from harborline.session import cut_lineage, shared_dir
from harborline.sources.readers import message_stream, recent_rows
from harborline.sources.tables import appended, replace_rows
from harborline.sources.writers import append_serving_rows
from harborline.streaming import queries as streams
from harborline.streaming import state, windows

SOURCE_TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages",
    "benchmark", "labels", "conversations",
]
START_NODE = "NATION_0"

_REGISTRY: dict[str, Callable[[Domain], DataFrame]] = {}


def query(build: Callable[[Domain], DataFrame]) -> Callable[[Domain], DataFrame]:
    _REGISTRY[build.__name__] = build
    return build


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(build: Callable[[Domain], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, folder: build(Domain(spark, folder))

    return {name: bind(build) for name, build in _REGISTRY.items()}


def _ntz(*names: str) -> dict:
    return {name: F.col(name).cast("timestamp_ntz") for name in names}


def _rounded(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    return df.withColumns({name: F.round(name, digits) for name in names})


# ---- Staging and data quality --------------------------------------------------------------------


def _feed(d: Domain, topic: str, deliveries: int = 1) -> DataFrame:
    return adapters.raw_lines(d.table("events"), deliveries).filter(F.col("topic") == topic)


@query
def stg_events_parsed(d: Domain) -> DataFrame:
    return staging.ship_events(_feed(d, "datos_crudos")).select(
        "ship_id", "route_id", "origin_port", "dest_port", "lat", "lon", "speed_kn", "heading",
        F.col("event_ts").cast("timestamp_ntz").alias("event_ts"),
    )


@query
def stg_ships_dedup(d: Domain) -> DataFrame:
    lines = _feed(d, "datos_crudos", deliveries=2)
    return staging.stage_ships(staging.parse_json(lines, staging.schemas.SHIP_POSITION)).withColumns(_ntz("ts_utc")).drop(
        "stock_on_hand"
    )


@query
def stg_alerts_routed(d: Domain) -> DataFrame:
    lines = _feed(d, "alertas_globales", deliveries=2)
    parsed = staging.parse_json(lines, staging.schemas.GLOBAL_ALERT, keep=["topic"])
    kind = staging.landing_kind(F.col("topic"), F.col("source"))
    return staging.stage_alerts(parsed).withColumn("kind", kind).withColumns(_ntz("ts_utc")).drop("topic")


@query
def weather_reshaped(d: Domain) -> DataFrame:
    lines = adapters.raw_lines(d.table("events")).filter(F.col("feed") == "weather")
    return staging.stage_weather(staging.reshape_weather(lines), d.fleet_as_of).withColumns(_ntz("event_ts"))


@query
def contract_violations(d: Domain) -> DataFrame:
    ships = staging.parse_json(_feed(d, "datos_crudos"), staging.schemas.SHIP_POSITION)
    notices = staging.parse_json(_feed(d, "alertas_globales"), staging.schemas.GLOBAL_ALERT)
    return (
        quality.violations(ships, quality.ship_contract()).withColumn("topic", F.lit("datos_crudos"))
        .unionByName(quality.violations(notices, quality.alert_contract()).withColumn("topic", F.lit("alertas_globales")))
    )


@query
def table_counts(d: Domain) -> DataFrame:
    return quality.row_counts({name: d.table(name) for name in SOURCE_TABLES})


# ---- Weather -------------------------------------------------------------------------------------


@query
def weather_severity(d: Domain) -> DataFrame:
    return d.weather.groupBy("port_ref", "severity").agg(
        F.count("*").alias("observations"), F.round(F.avg("wind_speed_kmh"), 6).alias("avg_wind_kmh")
    )


@query
def weather_enriched(d: Domain) -> DataFrame:
    return d.enriched


@query
def weather_operational_fact(d: Domain) -> DataFrame:
    return d.operational.select("event_id", *OPERATIONAL_COLUMNS)


@query
def weather_top20(d: Domain) -> DataFrame:
    """Newest twenty operational rows."""
    return d.operational.select("event_id", *OPERATIONAL_COLUMNS).orderBy(
        F.col("event_ts").desc(), F.col("event_id").desc(), "route_id"
    ).limit(20)


# ---- Fleet ---------------------------------------------------------------------------------------


@query
def latest_vehicle_state(d: Domain) -> DataFrame:
    return _rounded(fleet.vehicle_state(d.latest, d.fleet_as_of), "lat", "lon")


@query
def ships_latest_voyage(d: Domain) -> DataFrame:
    return _rounded(fleet.with_eta_dates(d.voyages, d.fleet_as_of), "lat", "lon").drop("event_id", "inland_hours_estimate")


@query
def ship_eta_table(d: Domain) -> DataFrame:
    d.keep("latest", "sailed_pairs", "latest_operational")
    delays = fleet.delay_by_port(d.latest_operational, d.ports)
    return _rounded(
        fleet.eta_table(d.voyages, delays, d.best_air, d.fleet_as_of, incidents=["Huelga", "Tormenta"]), "lat", "lon"
    )


@query
def ships_in_transit(d: Domain) -> DataFrame:
    rows = fleet.with_tooltip(fleet.with_eta_dates(fleet.in_transit(d.voyages, d.ports), d.fleet_as_of))
    return _rounded(
        rows.select("ship_id", "origin_port", "dest_port", "lat", "lon", "distance_to_origin", "distance_to_dest", "tooltip_text"),
        "lat", "lon", "distance_to_origin", "distance_to_dest",
    )


@query
def ship_positions_interpolated(d: Domain) -> DataFrame:
    return _rounded(
        fleet.snapped_positions(d.voyages, d.dim("dim_waypoints"), d.routes)
        .select("ship_id", "route_id", "lat", "lon", "progress"), "lat", "lon", "progress",
    )


@query
def ship_bearing(d: Domain) -> DataFrame:
    return fleet.with_bearing(d.latest, d.ports).select("ship_id", "origin_port", "dest_port", "bearing")


@query
def ship_scenarios(d: Domain) -> DataFrame:
    return fleet.simulate_incidents(d.voyages, d.best_air)


@query
def stock_hash_snapshot(d: Domain) -> DataFrame:
    return d.ships.select("ship_id").distinct().withColumn("stock_on_hand", pseudo_stock(F.col("ship_id")))


@query
def ships_by_dest_metrics(d: Domain) -> DataFrame:
    return kpis.destination_metrics(d.ships)


# ---- Network -------------------------------------------------------------------------------------


@query
def graph_edges(d: Domain) -> DataFrame:
    return _rounded(d.network_edges, "weight")


@query
def graph_vertices(d: Domain) -> DataFrame:
    return d.network_vertices


@query
def graph_degree(d: Domain) -> DataFrame:
    return graph.centrality(d.network_edges, d.network_vertices)


@query
def trade_centrality(d: Domain) -> DataFrame:
    """Degree of every node of the trade network."""
    rows = graph.centrality(d.trade_edges, d.trade_nodes)
    return rows.withColumn("state", node_state(F.col("criticality_level")))


@query
def graph_hops(d: Domain) -> DataFrame:
    return graph.hops(d.trade_edges, d.trade_nodes, START_NODE)


@query
def graph_landmark_hops(d: Domain) -> DataFrame:
    """Distances to two landmarks in long form."""
    rows = graph.landmark_hops(d.trade_edges, d.trade_nodes, [START_NODE, "NATION_7"], direction="to")
    return rows.select("node_id", F.explode("distances").alias("landmark", "hops"))


@query
def graph_route_times(d: Domain) -> DataFrame:
    """Fastest time from Shanghai over sea, inland and customer links."""
    edges = network.network_edges(d.sea_edges, extra=network.customer_links(d.dim("dim_customer_links")))
    return _rounded(graph.cheapest_paths(edges, "Shanghai"), "cost")


@query
def graph_top_nodes(d: Domain) -> DataFrame:
    return graph.top_nodes(graph.centrality(d.trade_edges, d.trade_nodes))


@query
def graph_shortest_time(d: Domain) -> DataFrame:
    return _rounded(graph.cheapest_paths(d.trade_edges, START_NODE), "cost")


@query
def graph_safest(d: Domain) -> DataFrame:
    edges = graph.with_risk_path_cost(d.trade_edges, F.col("weight") / F.lit(1000.0), F.col("risk"), risk_weight=0.75)
    return _rounded(graph.cheapest_paths(edges, START_NODE, "safety_cost"), "cost")


@query
def graph_route_nodes(d: Domain) -> DataFrame:
    """Every stop of the fastest route to every node."""
    routes = graph.route_nodes(graph.cheapest_paths(d.trade_edges, START_NODE))
    return routes.select("node_id", F.posexplode("route").alias("stop", "place"))


@query
def graph_time_against_risk(d: Domain) -> DataFrame:
    """All times and risks from Shanghai that no other route beats in both: sea legs, inland legs and customer links."""
    inland = network.network_edges(d.sea_edges, extra=network.customer_links(d.dim("dim_customer_links"))).join(
        d.sea_edges.select("src", "dst"), ["src", "dst"], "left_anti").withColumn("risk", F.lit(0.0))
    # A faster ship takes more risk: two offers for every sea leg.
    calm = d.sea_edges.withColumn("risk", F.lit(1.0))
    fast = d.sea_edges.select("src", "dst", (F.col("weight") * F.lit(0.75)).alias("weight"), F.lit(2.5).alias("risk"))
    return _rounded(graph.pareto_paths(calm.unionByName(fast).unionByName(inland), "Shanghai"), "first", "second")


@query
def graph_dynamic_weights(d: Domain) -> DataFrame:
    weight = network.dynamic_weight(F.col("weight") / F.lit(24.0), F.lit(1.0) - F.col("risk"), F.lit(8.0))
    return d.trade_edges.select("src", "dst", F.round(weight, 6).alias("dynamic_weight"))


@query
def graph_components(d: Domain) -> DataFrame:
    heads = d.table("orders")
    return graph.components(adapters.consignment_edges(heads), adapters.consignment_nodes(heads, d.table("customer")))


@query
def graph_pagerank(d: Domain) -> DataFrame:
    ranks = graph.pagerank(d.trade_edges, d.trade_nodes)
    return ranks.withColumn("pagerank", F.round("pagerank", 8))


@query
def route_risk(d: Domain) -> DataFrame:
    return _rounded(d.route_risk, "time_shanghai_to_via_hours", "estimated_total_hours", "risk_score")


# ---- Alerts --------------------------------------------------------------------------------------


@query
def alerts_by_region(d: Domain) -> DataFrame:
    return alerts.by_region(d.alerts)


@query
def alert_type_mix(d: Domain) -> DataFrame:
    return alerts.mix(d.alerts.select(F.col("text").alias("alert_type")), "alert_type")


@query
def fact_alerts(d: Domain) -> DataFrame:
    return _rounded(d.fact_alerts, "risk_score", "estimated_total_hours")


@query
def alerts_top20(d: Domain) -> DataFrame:
    return _rounded(alerts.top_alerts(d.fact_alerts), "risk_score", "estimated_total_hours")


@query
def critical_alerts(d: Domain) -> DataFrame:
    return _rounded(alerts.critical(d.fact_alerts), "risk_score", "estimated_total_hours")


@query
def alerts_risk_stock_summary(d: Domain) -> DataFrame:
    return alerts.by_risk_and_stock(d.fact_alerts)


@query
def risk_summary(d: Domain) -> DataFrame:
    d.keep("sailed_pairs")
    return alerts.risk_summary(d.fact_alerts, d.operational)


@query
def route_alert_outbox(d: Domain) -> DataFrame:
    return _rounded(alerts.route_outbox(d.fact_alerts, d.fleet_as_of).drop("alert_id"), "risk_score")


@query
def route_alerts(d: Domain) -> DataFrame:
    """The serving table of route alerts after two runs of one batch."""
    rows, out = alerts.route_alerts(d.fact_alerts, d.ports, d.fleet_as_of), _run_folder(d, "route_alerts")
    for _ in range(2):
        append_serving_rows(rows, "route_alerts", f"{out}/table", "run", d.fleet_as_of)
    return _rounded(appended(d.spark, f"{out}/table"), "risk_score").withColumns(_ntz("created_at"))


@query
def critical_reference_outbox(d: Domain) -> DataFrame:
    return alerts.critical_reference_outbox(d.articles)


@query
def daily_summary(d: Domain) -> DataFrame:
    return alerts.daily_summary(d.latest, d.fact_alerts, d.fleet_as_of)


@query
def recent_alerts(d: Domain) -> DataFrame:
    """Alerts of the last 48 hours."""
    return recent_rows(d.alerts, "ts", d.fleet_as_of, hours=48)


# ---- Contingency ---------------------------------------------------------------------------------


@query
def air_recovery_options(d: Domain) -> DataFrame:
    return d.best_air


@query
def air_recovery_prefer_air(d: Domain) -> DataFrame:
    return contingency.best_air_options(d.air_context, d.corridors, d.fleet_as_of, prefer_air=True, match_origin=True)


@query
def air_option_rows(d: Domain) -> DataFrame:
    return contingency.air_option_rows(d.air_context, d.corridors, d.fleet_as_of)


@query
def air_recovery_top20(d: Domain) -> DataFrame:
    return d.best_air.orderBy(F.col("time_saved_hours").desc_nulls_last(), "ship_id").limit(20)


@query
def air_routes_overcost(d: Domain) -> DataFrame:
    traffic = d.latest.groupBy("route_id").agg(F.count("*").alias("ships_on_route"))
    return contingency.sea_air_overcost(d.dim("dim_air_recovery"), d.routes, traffic)


@query
def air_recovery_estimate(d: Domain) -> DataFrame:
    return contingency.estimated_options(d.voyages)


@query
def air_contingency_orders(d: Domain) -> DataFrame:
    return contingency.air_contingency(d.coverage, d.best_air_by_port)


def _flights(d: Domain) -> DataFrame:
    return contingency.air_option_rows(d.air_context, d.corridors, d.fleet_as_of).select(
        "ship_id", "air_option_id", F.col("air_total_cost_eur").alias("flight_cost_eur"),
        F.col("air_total_eta_hours").alias("flight_eta_hours"),
    )


@query
def flight_verdict(d: Domain) -> DataFrame:
    return contingency.flight_verdicts(_flights(d), d.fleet_as_of)


@query
def article_flight_verdicts(d: Domain) -> DataFrame:
    """Every flight of the list against the rupture of every article."""
    return contingency.article_flights(d.stock_context, d.dim("dim_flights"), d.orders_as_of)


@query
def article_best_flight(d: Domain) -> DataFrame:
    return contingency.article_best_flight(d.stock_context, d.dim("dim_flights"), d.orders_as_of)


@query
def best_flight(d: Domain) -> DataFrame:
    flights = _flights(d)
    return contingency.cheapest_viable(contingency.flight_verdicts(flights, d.fleet_as_of)).select(
        "flight_cost_eur", "flight_eta_hours", "recommendation"
    )


@query
def last_mile_options(d: Domain) -> DataFrame:
    return contingency.last_mile(_flights(d), d.dim("dim_last_mile"))


@query
def truck_plan(d: Domain) -> DataFrame:
    return contingency.truck_plan(_flights(d), d.dim("dim_trucks"))


@query
def executive_air_rule(d: Domain) -> DataFrame:
    return contingency.executive_air_rule(d.voyages, d.best_air)


@query
def sea_air_decisions(d: Domain) -> DataFrame:
    return contingency.decision_table(d.best_air)


@query
def route_map(d: Domain) -> DataFrame:
    return contingency.route_map(d.routes, d.ports, d.worst_alerts)


@query
def corridor_pairs(d: Domain) -> DataFrame:
    return contingency.corridor_pairs(d.ports, d.sailed_pairs)


# ---- Stock and orders ----------------------------------------------------------------------------


@query
def stock_context(d: Domain) -> DataFrame:
    return d.stock_context.drop("unit_volume_m3", "unit_weight_kg", "lead_time_days", "order_lines")


@query
def stock_table(d: Domain) -> DataFrame:
    return stock.stock_table(d.stock_context)


@query
def stock_table_douai_iw20(d: Domain) -> DataFrame:
    """Stock table with the orders of one customer and week."""
    return stock.stock_table(stock.stock_context(d.articles, stock.order_totals(stock.orders_for(d.orders, "Douai", "IW20"))))


@query
def stock_by_family(d: Domain) -> DataFrame:
    return stock.stock_by_family(d.articles)


@query
def warehouse_capacity(d: Domain) -> DataFrame:
    return stock.warehouse_capacity(d.articles)


@query
def orders_coverage(d: Domain) -> DataFrame:
    return d.coverage.drop("ordered_pieces")


@query
def stock_horizon(d: Domain) -> DataFrame:
    return d.horizon


@query
def stock_horizon_mode(d: Domain) -> DataFrame:
    return stock.horizon_mode(d.horizon)


@query
def stock_horizon_worst(d: Domain) -> DataFrame:
    return stock.horizon_mode(d.horizon, mode="worst")


@query
def scheduled_stock_horizon(d: Domain) -> DataFrame:
    """The horizon as the scheduled run writes it, from its own tables of articles, orders and recovery options."""
    out = _run_folder(d, "scheduled_stock_horizon")
    run = microbatch.Run(d.spark, f"{out}/raw", f"{out}/tables", ORDERS_AS_OF)
    plan = adapters.article_plan(d.table("lineitem"), d.table("orders"))
    inputs = {
        "dim_articles_valladolid": d.articles, "fact_customer_orders_douai": d.orders, "fact_article_gantt": plan,
        "fact_air_recovery_options": d.best_air, "dim_ports": d.ports, "dim_flights": d.dim("dim_flights"),
    }
    for name, rows in inputs.items():
        replace_rows(rows, run.path(name))
    microbatch.order_facts(run)
    return run.read("fact_stock_horizon")


@query
def stock_rupture_timeline(d: Domain) -> DataFrame:
    return stock.rupture_timeline(d.stock_context, d.best_air_by_port, d.orders_as_of)


@query
def article_gantt(d: Domain) -> DataFrame:
    return stock.article_plan(adapters.article_plan(d.table("lineitem"), d.table("orders")))


@query
def weekly_demand(d: Domain) -> DataFrame:
    return stock.weekly_demand(d.orders, customer_city="Douai")


@query
def distinct_weeks(d: Domain) -> DataFrame:
    return stock.distinct_values(d.orders, "industrial_week")


@query
def demand_projection(d: Domain) -> DataFrame:
    return stock.demand_projection(d.articles)


@query
def embarkation_list(d: Domain) -> DataFrame:
    return stock.embarkation_list(d.articles)


@query
def embarkation_totals(d: Domain) -> DataFrame:
    return stock.embarkation_totals(stock.embarkation_list(d.articles))


# ---- Indicators ----------------------------------------------------------------------------------


@query
def control_tower_kpis(d: Domain) -> DataFrame:
    d.keep("latest", "sailed_pairs")
    return kpis.control_tower(d.stock_context, d.voyages, d.orders, d.best_air)


@query
def executive_kpis(d: Domain) -> DataFrame:
    d.keep("sailed_pairs")
    return kpis.executive(d.voyages, d.fact_alerts, d.articles)


@query
def otif_by_customer(d: Domain) -> DataFrame:
    return kpis.otif_by_customer(d.orders)


# ---- Windows and streams -------------------------------------------------------------------------

_SHIP_FIGURES = ["avg_speed", "speed_std", "avg_lat", "avg_lon"]
_ALERT_FIGURES = ["avg_severity", "avg_confidence"]


def _ship_windows(d: Domain) -> DataFrame:
    return windows.ship_metrics(d.ships.withColumnRenamed("ts", "event_ts"))


def _alert_windows(d: Domain) -> DataFrame:
    return windows.alert_metrics(d.alerts.withColumnRenamed("ts", "event_ts"))


@query
def windowed_ship_metrics(d: Domain) -> DataFrame:
    return _rounded(_ship_windows(d), *_SHIP_FIGURES, digits=9)


@query
def windowed_alert_metrics(d: Domain) -> DataFrame:
    return _rounded(_alert_windows(d), *_ALERT_FIGURES, digits=9)


@query
def window_risk_class(d: Domain) -> DataFrame:
    return _rounded(windows.window_risk(_ship_windows(d), _alert_windows(d)), "severity_avg", "speed_std")


def _event_stream(d: Domain) -> DataFrame:
    """The events table as a file stream."""
    schema = d.table("events").schema
    return message_stream(d.spark, d.folder, "parquet", schema=schema, options={"pathGlobFilter": "events.parquet"})


def _run_folder(d: Domain, name: str) -> str:
    return f"{shared_dir(d.spark)}/harborline/{name}-{uuid.uuid4().hex}"


@query
def stream_ship_metrics(d: Domain) -> DataFrame:
    """Closed windows only: a stream never emits windows its watermark has not passed."""
    out = _run_folder(d, "stream_ship_metrics")
    ships = adapters.ships(_event_stream(d)).withColumnRenamed("ts", "event_ts")
    streams.ship_metrics_query(ships, f"{out}/table", streams.checkpoint_path(out, "ships")).awaitTermination()
    rows = d.spark.read.parquet(f"{out}/table").drop("processed_at", "batch")
    return _rounded(rows, *_SHIP_FIGURES, digits=9).withColumns(_ntz("window_start", "window_end"))


@query
def stream_alert_metrics(d: Domain) -> DataFrame:
    out = _run_folder(d, "stream_alert_metrics")
    notices = adapters.alerts(_event_stream(d)).withColumnRenamed("ts", "event_ts")
    streams.alert_metrics_query(notices, f"{out}/table", streams.checkpoint_path(out, "alerts")).awaitTermination()
    rows = d.spark.read.parquet(f"{out}/table").drop("processed_at", "batch")
    return _rounded(rows, *_ALERT_FIGURES, digits=9).withColumns(_ntz("window_start", "window_end"))


@query
def stream_weather_fact(d: Domain) -> DataFrame:
    out = _run_folder(d, "stream_weather_fact")
    snapshots = adapters.weather(_event_stream(d))
    streams.weather_fact_query(
        snapshots, d.route_context, f"{out}/fact", streams.checkpoint_path(out, "weather")
    ).awaitTermination()
    return d.spark.read.parquet(f"{out}/fact").select("event_id", *OPERATIONAL_COLUMNS).drop("operational_ts")


@query
def stream_latest_state(d: Domain) -> DataFrame:
    out = _run_folder(d, "stream_latest_state")
    ships = adapters.ships(_event_stream(d)).withColumnRenamed("ts", "event_ts")
    streams.latest_state_query(ships, f"{out}/state", streams.checkpoint_path(out, "state"), ["event_id"]).awaitTermination()
    return _rounded(streams.read_state(d.spark, f"{out}/state"), "lat", "lon").drop("event_id")


@query
def stream_window_risk(d: Domain) -> DataFrame:
    """Risk of closed windows, from a stream of positions and a stream of alerts."""
    out = _run_folder(d, "stream_window_risk")
    ships = adapters.ships(_event_stream(d)).withColumnRenamed("ts", "event_ts")
    notices = adapters.alerts(_event_stream(d)).withColumnRenamed("ts", "event_ts")
    streams.window_risk_query(ships, notices, f"{out}/table", streams.checkpoint_path(out, "risk")).awaitTermination()
    rows = _rounded(appended(d.spark, f"{out}/table"), "severity_avg", "speed_std")
    return rows.withColumns(_ntz("window_start", "window_end"))


@query
def stream_keyed_state(d: Domain) -> DataFrame:
    """The latest row per ship as keyed state: files out of order with repeated rows, several batches, and a new checkpoint half way."""
    out, order = _run_folder(d, "stream_keyed_state"), ["event_ts", "event_id"]
    events = d.table("events")
    half = F.pmod(F.xxhash64("event_id"), F.lit(2))
    for part, rows in enumerate((events.filter(half == 0), events.filter((half == 1) | (F.col("event_id") % 10 == 0)))):
        rows.repartition(3, "event_id").write.parquet(f"{out}/in{part}")
        found = message_stream(d.spark, f"{out}/in{part}", "parquet", schema=events.schema, per_trigger=1)
        ships = adapters.ships(found).withColumnRenamed("ts", "event_ts")
        checkpoint = streams.checkpoint_path(out, "state", part + 1)
        state.newest_rows_query(ships, f"{out}/state", checkpoint, ["ship_id"], order).awaitTermination()
    return _rounded(state.read_newest(d.spark, f"{out}/state", ["ship_id"], order), "lat", "lon").drop("event_id")


@query
def landed_ships_incremental(d: Domain) -> DataFrame:
    """Positions staged in two runs: the first finds the first half of the landed files, the second reads the other half only."""
    out = _run_folder(d, "landed_ships_incremental")
    events = d.table("events")
    run = microbatch.Run(d.spark, f"{out}/raw", f"{out}/tables", FLEET_AS_OF, landed=True, incremental=True)
    for part in (0, 1):
        events.filter(F.col("event_id") % 2 == part).write.mode("append").parquet(f"{out}/in")
        feed = message_stream(d.spark, f"{out}/in", "parquet", schema=events.schema)
        rows = streams.landing_rows(adapters.raw_lines(feed, deliveries=2))
        checkpoint = streams.checkpoint_path(out, "landing")
        streams.landing_query(rows, f"{out}/raw", checkpoint, streams.MICRO_BATCH, by=("kind", "dt")).awaitTermination()
        microbatch.raw_to_staging(run)
    return run.read("stg_ships").drop("stock_on_hand", *staging.schemas.LINEAGE.names).withColumns(_ntz("ts_utc"))


@query
def stream_raw_landing(d: Domain) -> DataFrame:
    """Land the raw topics as files, then count messages per kind and day from the files."""
    out = _run_folder(d, "stream_raw_landing")
    rows = streams.landing_rows(adapters.raw_lines(_event_stream(d)))
    streams.landing_query(
        rows, f"{out}/raw", streams.checkpoint_path(out, "landing"), streams.MICRO_BATCH, by=("kind", "dt")
    ).awaitTermination()
    landed = d.spark.read.schema("value string, kind string, dt string").text(f"{out}/raw")
    return landed.groupBy("kind", "dt").agg(F.count("*").alias("messages"))


@query
def landed_ships_staged(d: Domain) -> DataFrame:
    """Positions by way of landed files: a stream lands the raw topics, a scheduled run stages the files."""
    out = _run_folder(d, "landed_ships_staged")
    rows = streams.landing_rows(adapters.raw_lines(_event_stream(d), deliveries=2))
    streams.landing_query(
        rows, f"{out}/raw", streams.checkpoint_path(out, "landing"), streams.MICRO_BATCH, by=("kind", "dt")
    ).awaitTermination()
    run = microbatch.Run(d.spark, f"{out}/raw", f"{out}/tables", FLEET_AS_OF, landed=True)
    microbatch.raw_to_staging(run)
    staged = run.read("stg_ships").drop("stock_on_hand", *staging.schemas.LINEAGE.names)
    return staged.withColumns(_ntz("ts_utc"))


# ---- Models --------------------------------------------------------------------------------------


def _model_rows(d: Domain) -> DataFrame:
    return cut_lineage(models.eta_features(d.air_context, d.latest_operational, d.routes))


@query
def ml_eta_regression(d: Domain) -> DataFrame:
    _, predicted = models.fit_eta(_model_rows(d))
    return models.eta_comparison(predicted)


@query
def ml_eta_metrics(d: Domain) -> DataFrame:
    _, predicted = models.fit_eta(_model_rows(d))
    return models.regression_metrics(predicted)


@query
def ml_rupture_forest(d: Domain) -> DataFrame:
    model, predicted = models.fit_rupture(_model_rows(d))
    importance = models.feature_importance(model, models.RUPTURE_FEATURES, d.spark)
    return (
        models.classification_metrics(predicted).withColumnRenamed("metric", "name")
        .unionByName(importance.select(F.concat(F.lit("importance_"), "feature").alias("name"), F.col("importance").alias("value")))
    )


@query
def ml_port_kmeans(d: Domain) -> DataFrame:
    _, clustered = models.fit_ports(models.port_features(d.latest, d.weather))
    return clustered.select("port_name", *models.PORT_FEATURES, "cluster_name")


def _known(d: Domain) -> DataFrame:
    return outcomes.known_at(d.ships, d.weather, d.ports)


@query
def ml_outcome_rows(d: Domain) -> DataFrame:
    """Model rows: what was known at every fix, and the ship's next arrival after it."""
    return outcomes.with_outcomes(_known(d))


@query
def ml_arrival_errors(d: Domain) -> DataFrame:
    """Held-out errors of the arrival regression beside two naive predictors."""
    fitted = outcomes.fit_arrival(cut_lineage(outcomes.with_outcomes(_known(d))))
    if fitted is None:
        raise ValueError("no fix with a later arrival to fit on")
    return outcomes.held_out_errors(fitted[1])


@query
def ml_predictions(d: Domain) -> DataFrame:
    """The serving table of predictions: one row per ship."""
    return outcomes.predictions(_known(d), d.fleet_as_of).withColumns(_ntz("created_at"))
