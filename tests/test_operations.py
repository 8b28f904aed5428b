"""Values worked out by hand from the rules, on the sample voyages and the master data."""

import pytest
from pyspark.sql import functions as F

from harborline.functions.calendar import moment
from harborline.operators import alerts, contingency, fleet, graph, kpis, network, stock, weather
from harborline.sources.master import INCIDENT_HOURS, master
from tests.conftest import SAMPLE_SEVERITIES


def as_of():
    return moment("2026-03-27 00:00:00")


@pytest.fixture(scope="module")
def dims(spark):
    return {n: master(spark, n) for n in (
        "dim_ports", "dim_routes", "dim_warehouse", "dim_port_stock", "dim_air_recovery", "dim_airports",
        "dim_articles_valladolid", "fact_customer_orders_douai", "fact_article_gantt", "dim_flights")}


@pytest.fixture(scope="module")
def alert_sets(spark):
    return [spark.createDataFrame([(v,) for v in values], "severity int") for values in SAMPLE_SEVERITIES.values()]


@pytest.fixture(scope="module")
def net(sample_ships, dims):
    pairs = network.sailed_pairs(sample_ships)
    sea = network.sea_edges(pairs, dims["dim_ports"])
    return pairs, sea, network.network_edges(sea), network.network_vertices(pairs)


@pytest.fixture(scope="module")
def fact_alerts(net, alert_sets):
    pairs, sea, _, _ = net
    risk = network.route_risk(sea, network.mean_severity(*alert_sets))
    return risk, alerts.score_alerts(risk, alerts.stock_by_destination(pairs), as_of())


def test_network_has_six_nodes_and_nine_edges(net):
    _, _, edges, vertices = net
    assert (vertices.count(), edges.count()) == (6, 9)


def test_sea_hours_match_the_route_table(net):
    weights = {(r.src, r.dst): r.weight for r in net[1].collect()}
    assert weights["Shanghai", "Algeciras"] == pytest.approx(391.54, abs=0.01)


def test_degrees(net):
    _, _, edges, vertices = net
    rows = {r.node_id: (r.degree, r.criticality_level) for r in graph.centrality(edges, vertices).collect()}
    assert rows == {n: (3, "NODO_CRITICO") for n in ("Shanghai", "Yokohama", "Algeciras", "Valencia", "Barcelona", "Valladolid")}


def test_hops_both_directions(net):
    _, _, edges, vertices = net
    away = {r.node_id: r.hops for r in graph.hops(edges, vertices, "Shanghai").collect()}
    assert away == {"Shanghai": 0, "Algeciras": 1, "Valencia": 1, "Barcelona": 1, "Valladolid": 2, "Yokohama": None}
    towards = {r.node_id: r.hops for r in graph.hops(edges, vertices, "Shanghai", direction="to").collect()}
    assert {n for n, h in towards.items() if h is not None} == {"Shanghai"}


def test_route_risk(fact_alerts):
    rows = {(r.origin_port, r.via_port): r for r in fact_alerts[0].collect()}
    row = rows["Shanghai", "Algeciras"]
    assert row.risk_score == 2.75 and row.risk_level == "MEDIO"
    assert row.estimated_total_hours == pytest.approx(399.54, abs=0.01)


def test_no_alerts_means_zero_risk(spark, net):
    empty = spark.createDataFrame([], "severity int")
    assert {r.risk_score for r in network.route_risk(net[1], network.mean_severity(empty)).collect()} == {0.0}


def test_alert_scores(fact_alerts):
    rows = {r.via_port: r for r in fact_alerts[1].collect()}
    assert (rows["Algeciras"].stock_status, rows["Algeciras"].severity) == ("CRITICO", 4)
    assert rows["Algeciras"].recommendation.startswith("seguir plan de contingencia")
    assert {rows[p].severity for p in ("Valencia", "Barcelona")} == {2}


def test_alert_outputs(fact_alerts, sample_ships):
    _, scored = fact_alerts
    out = alerts.route_outbox(scored, as_of())
    assert {(r.dest_port, r.severity_label, r.subject) for r in out.collect()} == {
        ("Algeciras", "ALTO", "[ALERTA ALTO] Riesgo en ruta Algeciras")}
    assert out.select("alert_id").distinct().count() == out.count() == 2
    day = alerts.daily_summary(sample_ships, scored, as_of()).first()
    assert (day.total_ships_tracked, day.total_alerts, day.critical_routes, day.avg_risk_score) == (6, 6, "Algeciras", 2.75)
    top = [(r.severity, r.via_port) for r in alerts.top_alerts(scored, 3).collect()]
    assert top == [(4, "Algeciras"), (4, "Algeciras"), (2, "Barcelona")]


def test_mix_keeps_the_null_group(spark):
    df = spark.createDataFrame([("a",), (None,), (None,)], "status string")
    assert {(r.status, r["count"]) for r in alerts.mix(df, "status").collect()} == {("a", 1), (None, 2)}


@pytest.fixture(scope="module")
def weather_rows(spark):
    rows = [(1, "2026-03-26 10:00:00", "Algeciras", 36.0), (2, "2026-03-26 11:00:00", "Algeciras", 10.0), (3, "2026-03-26 11:00:00", "Valencia", 55.0),
            (4, "2026-03-26 11:00:00", "Vigo", 25.0)]
    df = spark.createDataFrame(rows, "event_id long, ts string, port_ref string, wind_speed_kmh double")
    from harborline.functions.bands import wind_severity
    return df.select("event_id", F.col("ts").cast("timestamp_ntz").alias("event_ts"), "port_ref", "wind_speed_kmh",
                     F.lit(18.0).alias("temperature_c"), F.lit(70).alias("humidity_pct"), wind_severity(F.col("wind_speed_kmh")).alias("severity"))


@pytest.fixture(scope="module")
def context(dims):
    return weather.route_context(dims["dim_routes"], dims["dim_ports"], dims["dim_warehouse"], dims["dim_port_stock"])


def test_weather_enrichment(weather_rows, context):
    fact = weather.operational_fact(weather.enrich_weather(weather_rows, context, as_of()), as_of())
    rows = {}
    for r in fact.collect():
        rows.setdefault(r.event_id, []).append(r)
    assert {k: len(v) for k, v in rows.items()} == {1: 2, 2: 2, 3: 2, 4: 1}
    watch = rows[1][0]
    assert (watch.weather_risk_level, watch.port_operational_status, watch.weather_delay_hours_estimate, watch.operational_severity) == (
        "MEDIO", "METEO_VIGILANCIA", 6.0, 4)
    assert watch.recommended_action.startswith("reprogramar ventana")
    storm = rows[3][0]
    assert (storm.weather_risk_level, storm.operational_severity, storm.recommended_action) == ("ALTO", 5, "seguimiento normal de la ruta")
    assert (rows[4][0].port_operational_status, rows[4][0].route_id) == ("SIN_CONTEXTO", None)


def test_latest_operational_has_one_row_per_route(weather_rows, context, dims):
    rows = weather.latest_operational(weather_rows, context, dims["dim_ports"], as_of()).collect()
    assert {(r.port_ref, r.event_ts.hour) for r in rows} == {("Algeciras", 11), ("Valencia", 11)} and len(rows) == 4


@pytest.fixture(scope="module")
def air(sample_ships, dims, weather_rows, context, fact_alerts):
    ships = sample_ships.withColumn("event_id", F.lit(1))
    latest = fleet.latest_positions(ships, ts="ts_utc")
    by_route = weather.latest_operational(weather_rows, context, dims["dim_ports"], as_of())
    worst = alerts.worst_by_port(fact_alerts[1], dims["dim_ports"])
    ctx = contingency.ship_context(latest, dims["dim_routes"], dims["dim_ports"], dims["dim_warehouse"], by_route, worst)
    return latest, ctx


def test_corridor_prices(dims):
    rows = {r.air_option_id: r for r in contingency.priced_corridors(dims["dim_air_recovery"]).collect()}
    assert {k.removeprefix("AIRREC-"): v.air_total_eta_hours for k, v in rows.items()} == {
        "PVG-MAD": 24.3, "PVG-BCN": 30.1, "PVG-VLC": 25.8, "HND-MAD": 25.3, "HND-BCN": 31.1, "HND-VLC": 26.8}
    vlc = rows["AIRREC-PVG-VLC"]
    assert (vlc.truck_cost_eur, vlc.air_total_cost_eur) == (522.0, 17672.0)


def test_air_recovery(air, dims):
    _, ctx = air
    corridors = contingency.priced_corridors(dims["dim_air_recovery"], dims["dim_airports"])
    best = {r.ship_id: r for r in contingency.best_air_options(ctx, corridors, as_of()).collect()}
    assert len(best) == 6
    assert (best["ship-001"].hours_until_stock_break, best["ship-001"].stock_break_risk) == (-11.9, "ROTURA_INMINENTE")
    assert best["ship-004"].hours_until_stock_break == 18.1
    assert {r.air_option_id for r in best.values()} == {"AIRREC-PVG-VLC"}
    # Barcelona has no weather: no delay, no remaining hours, hence no rupture forecast.
    assert best["ship-003"].ship_remaining_hours is None and best["ship-003"].stock_break_risk == "COBERTURA_OK"
    # Stock 93 gives 39.4 h, longer than every corridor takes: air wins in both orders.
    assert best["ship-002"].recommended_mode == "AEREO_CAMION"
    matched = {r.ship_id: r for r in contingency.best_air_options(ctx, corridors, as_of(), prefer_air=True, match_origin=True).collect()}
    assert matched["ship-005"].air_option_id == "AIRREC-HND-VLC"


def test_default_delay_option(air, dims, weather_rows, context, fact_alerts):
    latest, _ = air
    by_route = weather.latest_operational(weather_rows, context, dims["dim_ports"], as_of())
    worst = alerts.worst_by_port(fact_alerts[1], dims["dim_ports"])
    ctx = contingency.ship_context(latest, dims["dim_routes"], dims["dim_ports"], dims["dim_warehouse"], by_route, worst, default_delay=0.0)
    assert ctx.filter(F.col("ship_remaining_hours").isNull()).count() == 0


def test_best_option_equals_ranking_of_all_rows(air, dims):
    _, ctx = air
    corridors = contingency.priced_corridors(dims["dim_air_recovery"])
    rows = contingency.air_option_rows(ctx, corridors, as_of()).collect()
    best = {r.ship_id: r.air_option_id for r in contingency.best_air_options(ctx, corridors, as_of()).collect()}
    for ship in best:
        mine = [r for r in rows if r.ship_id == ship]
        assert len(mine) == 6
        first = min(mine, key=lambda r: (r.recommended_mode != "MARITIMO", r.air_total_cost_eur, r.air_total_eta_hours, r.air_option_id))
        assert best[ship] == first.air_option_id


def test_estimate_when_no_options_exist(spark, air, dims):
    latest, ctx = air
    voyages = fleet.with_voyage(latest, dims["dim_routes"])
    rows = contingency.estimated_options(voyages).orderBy("ship_id").collect()
    assert [r.air_total_cost_eur for r in rows] == [12000.0 + 850 * i for i in range(6)]
    assert rows[0].recommended_mode == "AEREO_CAMION" and rows[0].stock_break_risk == "ROTURA_STOCK"
    assert rows[0].hours_until_stock_break == 90.0
    empty = spark.createDataFrame([], "ship_id string")
    assert contingency.options_or_estimate(empty, voyages).count() == 6


def test_incident_what_if(spark):
    voyages = spark.createDataFrame([("s", "Shanghai", "Valencia", 100.0)], "ship_id string, origin_port string, dest_port string, eta_hours_estimate double")
    options = spark.createDataFrame([("s", 100.0, 700.0, 25.0, 17000.0)],
                                    "ship_id string, ship_remaining_hours double, hours_until_stock_break double, air_total_eta_hours double, air_total_cost_eur double")
    rows = {r.scenario: r for r in fleet.simulate_incidents(voyages, options).collect()}
    assert len(rows) == 64 and rows[""].recalculated_eta == 100.0
    everything = rows[" + ".join(INCIDENT_HOURS)]
    assert (everything.recalculated_eta, everything.margin_hours, everything.cover_status) == (676.0, 24.0, "NO CUBRE")
    assert rows["Huelga"].cover_status == "CUBRE"


def test_voyage_days(air, dims):
    row = fleet.with_voyage(air[0], dims["dim_routes"]).filter("ship_id = 'ship-001'").first()
    assert row.ship_name == "MSC Gulsun"
    # 405 - 0.4 * 11 + 12
    assert (row.eta_hours_estimate, row.voyage_days_total, row.voyage_days_remaining, row.voyage_days_elapsed) == (412.6, 16.3, 17.2, -0.9)


def test_harbour_area_is_not_transit(spark, dims):
    rows = [("in", "Shanghai", "Valencia", 31.23, 121.47), ("at sea", "Shanghai", "Valencia", 10.0, 80.0), ("out", "Shanghai", "Valencia", 39.45, -0.3)]
    df = spark.createDataFrame(rows, "ship_id string, origin_port string, dest_port string, lat double, lon double")
    assert [r.ship_id for r in fleet.in_transit(df, dims["dim_ports"]).collect()] == ["at sea"]


def test_traffic_light(dims):
    rows = {r.article_ref: r for r in stock.stock_context(dims["dim_articles_valladolid"], stock.order_totals(dims["fact_customer_orders_douai"])).collect()}
    ecu = rows["1000002087"]
    assert (ecu.available_after_orders, ecu.stock_status, ecu.hours_to_stockout) == (18, "ROJO", 39.3)


def test_embarkation(dims):
    items = stock.embarkation_list(dims["dim_articles_valladolid"])
    assert [(r.article_ref, r.quantity_to_fly) for r in items.collect()] == [("1000002087", 69)]
    assert stock.embarkation_totals(items).first().total_weight_kg == 34.5


def test_flight_verdicts(dims):
    verdicts = contingency.flight_verdicts(dims["dim_flights"], as_of())
    assert {r.flight_number: r.recommendation for r in verdicts.collect()} == {
        "AF9632": "VIABLE", "LH8440": "VIABLE", "QR8115": "VIABLE", "DHL4567": "ÓPTIMA"}
    assert contingency.cheapest_viable(verdicts).first().flight_number == "DHL4567"
    late = contingency.flight_verdicts(dims["dim_flights"], as_of(), rupture_days=0)
    assert {r.recommendation for r in late.collect()} == {"NO LLEGA"}


def test_air_overcost(dims):
    rows = contingency.sea_air_overcost(dims["dim_air_recovery"], dims["dim_routes"]).collect()
    assert len(rows) == 10
    assert {r.air_overcost_eur for r in rows if r.dest_city == "Madrid"} == {None}
    assert 17150.0 - 4000.0 in {r.air_overcost_eur for r in rows}


def test_air_route_choices(dims):
    assert contingency.air_route_choices(dims["dim_air_recovery"]).count() == 6


def test_customer_links_extend_the_network(spark, net):
    from harborline.sources.master import master as table
    edges = network.network_edges(net[1], extra=network.customer_links(table(spark, "dim_customer_links")))
    rows = {r.node_id: r for r in graph.cheapest_paths(edges, "Shanghai").collect()}
    assert rows["Douai"].hops == 3 and rows["Douai"].cost == pytest.approx(391.54 + 8 + 60, abs=0.01)
    assert rows["Douai"].previous == "Valladolid" and rows["Valladolid"].previous == "Algeciras"


def test_dynamic_weight_units(spark):
    df = spark.range(1).select(
        network.dynamic_weight(F.lit(16.0), F.lit(0.5), F.lit(12.0)).alias("days"),
        network.dynamic_weight(F.lit(16.0), F.lit(0.5), F.lit(12.0), literal_units=True).alias("bare"),
        network.dynamic_weight(F.lit(16.0), F.lit(0.0), F.lit(12.0)).alias("unreliable")).first()
    assert (df.days, df.bare, df.unreliable) == (18.5, 30.0, None)


def test_gantt_filter(dims):
    rows = stock.article_plan(dims["fact_article_gantt"], "IW14").collect()
    assert len(rows) == 6 and {r.duration_days for r in rows if r.task_name == "Recepcion maritima"} == {7}


def test_weekly_demand_keeps_empty_weeks(dims):
    rows = {r.industrial_week: r.ordered_pieces for r in stock.weekly_demand(dims["fact_customer_orders_douai"], "Douai").collect()}
    assert rows == {"IW14": 426, "IW15": 440, "IW16": 100, "IW17": 0}


def test_otif(dims):
    rows = {r.customer_city: (r.otif_pct, r.status) for r in kpis.otif_by_customer(dims["fact_customer_orders_douai"]).collect()}
    assert rows == {"Douai": (80.0, "RIESGO"), "Cleon": (50.0, "RIESGO")}


def test_no_orders_gives_full_service(spark, dims):
    orders = dims["fact_customer_orders_douai"].filter("false")
    options = spark.createDataFrame([], "ship_id string, time_saved_hours double, recommended_mode string")
    voyages = spark.createDataFrame([], "eta_hours_estimate double")
    row = kpis.control_tower(stock.stock_context(dims["dim_articles_valladolid"], stock.order_totals(orders)), voyages, orders, options).first()
    assert (row.otif, row.best_mode, row.eta_avg, row.critical_refs) == (100.0, "N/A", 0.0, 1)


def test_article_flights_use_each_articles_own_rupture(spark, dims):
    context = spark.createDataFrame([("now", 0.0), ("soon", 15.0), ("later", 300.0), ("unknown", None)], "article_ref string, hours_to_stockout double")
    rows = contingency.article_flights(context, dims["dim_flights"], as_of()).collect()
    verdicts = {(r.article_ref, r.flight_number): r.recommendation for r in rows}
    assert len(rows) == 16 and {v for (a, _), v in verdicts.items() if a in ("now", "unknown")} == {"NO LLEGA"}
    # The cheapest flight lands too late for this article, so none of the others is optimal.
    assert {f: v for (a, f), v in verdicts.items() if a == "soon"} == {
        "AF9632": "VIABLE", "LH8440": "NO LLEGA", "QR8115": "NO LLEGA", "DHL4567": "NO LLEGA"}
    assert verdicts["later", "DHL4567"] == "ÓPTIMA"
    best = {r.article_ref: (r.flight_number, r.flights_in_time)
            for r in contingency.article_best_flight(context, dims["dim_flights"], as_of()).collect()}
    assert best == {"now": (None, 0), "soon": ("AF9632", 1), "later": ("DHL4567", 4), "unknown": (None, 0)}


def test_route_alerts_hold_one_row_per_port(spark, dims):
    rows = [("Shanghai", "Valencia", 4.5, "ALTO", 90.0, 5), ("Yokohama", "Valencia", 4.5, "ALTO", 95.0, 5),
            ("Shanghai", "Algeciras", 1.0, "BAJO", 90.0, 2)]
    facts = spark.createDataFrame(rows, "origin_port string, via_port string, risk_score double, risk_level string, estimated_total_hours double, severity int")
    found = alerts.route_alerts(facts.withColumn("recommendation", F.lit("x")), dims["dim_ports"], as_of()).collect()
    assert [(r.dest_port, r.severity, r.email_sent) for r in found] == [("Valencia", 5, False)]
