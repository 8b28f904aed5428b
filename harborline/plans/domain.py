"""The derived tables of one run, built lazily from a folder of test tables."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from harborline.functions.calendar import moment
from harborline.operators import alerts as alert_ops
from harborline.operators import contingency, fleet, network, stock, weather as weather_ops
from harborline.plans import adapters
from harborline.session import cut_lineage, written
from harborline.sources.master import master

FLEET_AS_OF = "2024-02-01 00:00:00"
ORDERS_AS_OF = "1998-04-01 00:00:00"


class Domain:
    """Named frames of the supply-chain model. Nothing runs until a frame is used in an action."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder
        self.fleet_as_of, self.orders_as_of = moment(FLEET_AS_OF), moment(ORDERS_AS_OF)
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        """A source table; its footer is read once per run."""
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._tables[name]

    def dim(self, name: str) -> DataFrame:
        return master(self.spark, name)

    def keep(self, *names: str) -> Domain:
        """Write the named tables once, for a query that reaches them in several ways."""
        for name in names:
            setattr(self, name, written(getattr(self, name)))
        return self

    # Source views.

    @cached_property
    def ships(self) -> DataFrame:
        return adapters.ships(self.table("events"))

    @cached_property
    def alerts(self) -> DataFrame:
        return adapters.alerts(self.table("events"))

    @cached_property
    def weather(self) -> DataFrame:
        return adapters.weather(self.table("events"))

    @cached_property
    def articles(self) -> DataFrame:
        return adapters.articles(self.table("part"))

    @cached_property
    def orders(self) -> DataFrame:
        return adapters.customer_orders(self.table("lineitem"), self.table("orders"))

    @cached_property
    def trade_edges(self) -> DataFrame:
        names = ("lineitem", "orders", "supplier", "customer", "nation")
        return adapters.transport_edges(*[self.table(n) for n in names])

    @cached_property
    def trade_nodes(self) -> DataFrame:
        return adapters.transport_nodes(*[self.table(n) for n in ("supplier", "customer", "nation")])

    # Master data in frequent use.

    @cached_property
    def ports(self) -> DataFrame:
        return self.dim("dim_ports")

    @cached_property
    def routes(self) -> DataFrame:
        return self.dim("dim_routes")

    @cached_property
    def corridors(self) -> DataFrame:
        return contingency.priced_corridors(self.dim("dim_air_recovery"), self.dim("dim_airports"))

    # Derived tables.

    @cached_property
    def latest(self) -> DataFrame:
        return fleet.latest_positions(self.ships)

    @cached_property
    def voyages(self) -> DataFrame:
        return fleet.with_voyage(self.latest, self.routes)

    @cached_property
    def route_context(self) -> DataFrame:
        return weather_ops.route_context(
            self.routes, self.ports, self.dim("dim_warehouse"), self.dim("dim_port_stock")
        )

    @cached_property
    def enriched(self) -> DataFrame:
        return weather_ops.enrich_weather(self.weather, self.route_context, self.fleet_as_of)

    @cached_property
    def operational(self) -> DataFrame:
        return weather_ops.operational_fact(self.enriched, self.fleet_as_of)

    @cached_property
    def latest_operational(self) -> DataFrame:
        return weather_ops.latest_operational(self.weather, self.route_context, self.ports, self.fleet_as_of)

    @cached_property
    def sailed_pairs(self) -> DataFrame:
        return network.sailed_pairs(self.ships)

    @cached_property
    def sea_edges(self) -> DataFrame:
        return network.sea_edges(self.sailed_pairs, self.ports)

    @cached_property
    def network_edges(self) -> DataFrame:
        return network.network_edges(self.sea_edges)

    @cached_property
    def network_vertices(self) -> DataFrame:
        return network.network_vertices(self.sailed_pairs)

    @cached_property
    def route_risk(self) -> DataFrame:
        return network.route_risk(self.sea_edges, network.mean_severity(self.alerts))

    @cached_property
    def fact_alerts(self) -> DataFrame:
        stock_by_port = alert_ops.stock_by_destination(self.sailed_pairs)
        return alert_ops.score_alerts(self.route_risk, stock_by_port, self.fleet_as_of)

    @cached_property
    def worst_alerts(self) -> DataFrame:
        return alert_ops.worst_by_port(self.fact_alerts, self.ports)

    @cached_property
    def air_context(self) -> DataFrame:
        return contingency.ship_context(
            self.latest, self.routes, self.ports, self.dim("dim_warehouse"), self.latest_operational, self.worst_alerts
        )

    @cached_property
    def best_air(self) -> DataFrame:
        return contingency.best_air_options(self.air_context, self.corridors, self.fleet_as_of)

    @cached_property
    def best_air_by_port(self) -> DataFrame:
        return contingency.best_by_port(self.best_air, self.ports)

    @cached_property
    def stock_context(self) -> DataFrame:
        return stock.stock_context(self.articles, stock.order_totals(self.orders))

    @cached_property
    def written_context(self) -> DataFrame:
        """The stock context as stored rows, for results that read it several times."""
        return written(self.stock_context)

    @cached_property
    def coverage(self) -> DataFrame:
        return stock.orders_coverage(self.orders, self.written_context, cut_lineage(self.best_air_by_port), self.orders_as_of)

    @cached_property
    def horizon(self) -> DataFrame:
        return stock.stock_horizon(self.articles, self.coverage)
