"""The scheduled run: raw files to staging, dimensions, facts, network metrics, latest state, bundle.

Every stage reads tables and writes tables, so a failed stage can be run again on its own. Tables are
Parquet folders under ``base``; with a database name they are also catalog tables.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harborline import schemas
from harborline.functions.calendar import moment
from harborline.operators import alerts, contingency, fleet, graph, network, outcomes, staging, stock, weather
from harborline.plans import incremental
from harborline.sources import tables, writers
from harborline.sources.master import TABLE_NAMES, master
from harborline.sources.readers import json_lines, landed_lines


@dataclass(frozen=True)
class Run:
    """Where a run reads and writes, and the time it counts as now."""

    spark: SparkSession
    raw: str
    base: str
    as_of: str
    version: int = 0
    database: str | None = None
    raw_glob: str = "*/*/*/*/*.jsonl"
    landed: bool = False  # whether a landing stream wrote ``raw``, in folders by kind
    incremental: bool = False  # whether staging reads only files that came since the last run

    def path(self, name: str) -> str:
        return f"{self.base}/{name}"

    def read(self, name: str) -> DataFrame:
        """The last complete rows of a table."""
        if self.incremental and name in incremental.STAGED:
            return incremental.staged_table(self, name).read()
        rows = tables.read_latest_version(self.spark, self.path(name))
        if rows is None:
            raise FileNotFoundError(f"no complete version of {name} under {self.base}")
        return rows

    def write(self, df: DataFrame, name: str) -> None:
        """Replace a table; a stage that fails leaves the last good rows."""
        if self.database:
            writers.overwrite_table(df, f"{self.database}.{name}", self.path(name))
        else:
            tables.replace_rows(df, self.path(name))

    def raw_lines(self, kind: str, schema) -> DataFrame:
        schema = schemas.with_lineage(schema)
        if self.landed:
            return landed_lines(self.spark, self.raw, kind, schema)
        return json_lines(self.spark, f"{self.raw}/{kind}/{self.raw_glob}", schema)


def dimensions(run: Run) -> None:
    for name in TABLE_NAMES:
        run.write(master(run.spark, name).coalesce(1), name)


def raw_to_staging(run: Run) -> None:
    if run.incremental:
        incremental.raw_to_staging(run)
        return
    run.write(staging.stage_ships(run.raw_lines("ships", schemas.SHIP_POSITION)), "stg_ships")
    for kind in ("clima", "noticias"):
        run.write(staging.stage_alerts(run.raw_lines(kind, schemas.GLOBAL_ALERT)), f"stg_alerts_{kind}")


def weather_staging(run: Run, snapshots: DataFrame) -> None:
    run.write(staging.stage_weather(snapshots, moment(run.as_of)), "stg_weather_open_meteo")


def weather_facts(run: Run) -> None:
    now = moment(run.as_of)
    context = weather.route_context(*[run.read(n) for n in ("dim_routes", "dim_ports", "dim_warehouse", "dim_port_stock")])
    run.write(weather.enrich_weather(run.read("stg_weather_open_meteo"), context, now), "dim_ports_routes_weather")
    run.write(weather.operational_fact(run.read("dim_ports_routes_weather"), now).select(*weather.OPERATIONAL_COLUMNS),
              "fact_weather_operational")


def network_facts(run: Run, landmark: str = "Shanghai") -> None:
    pairs = network.sailed_pairs(run.read("stg_ships"))
    sea = network.sea_edges(pairs, run.read("dim_ports"))
    risk = network.mean_severity(run.read("stg_alerts_clima"), run.read("stg_alerts_noticias"))
    edges, nodes = network.network_edges(sea), network.network_vertices(pairs)
    run.write(network.route_risk(sea, risk), "fact_route_risk")
    run.write(graph.hops(edges, nodes, landmark).withColumnRenamed("hops", f"hops_from_{landmark.lower()}"), "fact_graph_hops")
    run.write(graph.centrality(edges, nodes), "fact_graph_centrality")


def alert_facts(run: Run) -> None:
    stock = alerts.stock_by_destination(run.read("stg_ships"))
    run.write(alerts.score_alerts(run.read("fact_route_risk"), stock, moment(run.as_of)), "fact_alerts")


def latest_rows(run: Run) -> DataFrame:
    return fleet.latest_positions(run.read("stg_ships"), ts="ts_utc", tie=["ts"])


def recovery_facts(run: Run) -> None:
    ports = run.read("dim_ports")
    # Newest weather row per route and port, at most one per row of the route table.
    newest = weather.newest_by_route(run.read("fact_weather_operational"))
    context = contingency.ship_context(
        latest_rows(run), run.read("dim_routes"), ports, run.read("dim_warehouse"), newest,
        alerts.worst_by_port(run.read("fact_alerts"), ports),
    )
    corridors = contingency.priced_corridors(run.read("dim_air_recovery"), run.read("dim_airports"))
    run.write(contingency.best_air_options(context, corridors, moment(run.as_of)), "fact_air_recovery_options")


def latest_state(run: Run) -> None:
    state = fleet.vehicle_state(latest_rows(run).drop("ts"), moment(run.as_of), ts="ts_utc")
    run.write(writers.conform(state, "vehicle_latest_state"), "vehicle_latest_state")


def order_facts(run: Run) -> None:
    """Stock left after orders, coverage of every order, the ten-week horizon, the transport plan and a flight per article."""
    now, articles, orders = moment(run.as_of), run.read("dim_articles_valladolid"), run.read("fact_customer_orders_douai")
    run.write(stock.stock_context(articles, stock.order_totals(orders)), "fact_stock_context")
    context = run.read("fact_stock_context")
    by_port = contingency.best_by_port(run.read("fact_air_recovery_options"), run.read("dim_ports"))
    run.write(stock.orders_coverage(orders, context, by_port, now), "fact_orders_coverage")
    run.write(stock.stock_horizon(articles, run.read("fact_orders_coverage")), "fact_stock_horizon")
    run.write(stock.article_plan(run.read("fact_article_gantt")), "fact_article_plan")
    run.write(contingency.article_best_flight(context, run.read("dim_flights"), now), "fact_article_flights")


def serving_facts(run: Run) -> None:
    """Route alerts and model predictions of this run, appended to their serving tables; the same run again adds nothing twice."""
    now, token = moment(run.as_of), "".join(c for c in run.as_of if c.isdigit())
    worst = alerts.route_alerts(run.read("fact_alerts"), run.read("dim_ports"), now)
    writers.append_serving_rows(worst, "route_alerts", run.path("route_alerts"), token, now)
    ships = run.read("stg_ships").drop("ts").withColumnRenamed("ts_utc", "ts")
    fixes = ships.withColumn("event_id", F.xxhash64("ship_id", "ts"))
    known = outcomes.known_at(fixes, run.read("stg_weather_open_meteo"), run.read("dim_ports"))
    writers.append_serving_rows(outcomes.predictions(known, now), "ml_predictions", run.path("ml_predictions"), token, now)


def bundle_sections(run: Run) -> dict[str, Callable[[], DataFrame]]:
    """The named results of the serving layer, ordered and cut the way readers expect them."""
    def ordered(name: str, *order, limit: int | None = None) -> Callable[[], DataFrame]:
        def build() -> DataFrame:
            rows = run.read(name).orderBy(*order)
            return rows.limit(limit) if limit else rows
        return build

    def ships() -> DataFrame:
        return fleet.with_voyage(latest_rows(run), run.read("dim_routes")).orderBy("ship_id")

    def air_routes() -> DataFrame:
        return contingency.sea_air_overcost(run.read("dim_air_recovery"), run.read("dim_routes")).orderBy("origin_airport", "dest_city")

    return {
        "dim_ports": ordered("dim_ports", "port_name"),
        "dim_routes": ordered("dim_routes", "route_id"),
        "ships_latest": ships,
        "stock_valladolid": ordered("dim_articles_valladolid", "article_ref"),
        "customer_orders_douai": ordered("fact_customer_orders_douai", "industrial_week", "article_ref"),
        "article_gantt": ordered("fact_article_gantt", "industrial_week", "article_ref", "start_date"),
        "fact_alerts": lambda: alerts.top_alerts(run.read("fact_alerts")),
        "fact_weather_operational": ordered("fact_weather_operational", F.col("event_ts").desc(), limit=20),
        "fact_air_recovery_options": ordered("fact_air_recovery_options", F.col("time_saved_hours").desc_nulls_last(), "ship_id", limit=20),
        "air_routes": air_routes,
        "stock_horizon": ordered("fact_stock_horizon", "article_ref", "industrial_week"),
        "orders_coverage": ordered("fact_orders_coverage", "industrial_week", "order_id"),
        "article_flights": ordered("fact_article_flights", "article_ref"),
        "graph_centrality": lambda: graph.top_nodes(run.read("fact_graph_centrality")),
    }


def serve_bundle(run: Run) -> DataFrame:
    return writers.write_bundle(run.spark, bundle_sections(run), run.path("bundle"), run.version)


def run_all(run: Run, snapshots: DataFrame) -> DataFrame:
    """All stages in dependency order; returns the status of the bundle sections."""
    if run.database:
        writers.create_database(run.spark, run.database)
    raw_to_staging(run)
    dimensions(run)
    weather_staging(run, snapshots)
    weather_facts(run)
    network_facts(run)
    alert_facts(run)
    recovery_facts(run)
    latest_state(run)
    order_facts(run)
    serving_facts(run)
    return serve_bundle(run)
