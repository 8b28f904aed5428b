"""Master data: ports, routes, warehouse, articles, orders, plans, airports and option lists.

Every table is a local relation (built from Arrow), so the optimizer knows its exact size and
broadcasts it on its own.
"""

from __future__ import annotations

import datetime as dt

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

_S, _D, _L, _I, _DATE = pa.string(), pa.float64(), pa.int64(), pa.int32(), pa.date32()

# ---- Fixed values: master rows, as given, in natural order -------------------------------------

PORTS = [
    ("PORT-ALG", "Algeciras", "ES", "Estrecho de Gibraltar", 36.1270, -5.4530, "port"),
    ("PORT-VLC", "Valencia", "ES", "Costa Mediterranea", 39.4580, -0.3170, "port"),
    ("PORT-BCN", "Barcelona", "ES", "Costa Mediterranea", 41.3520, 2.1730, "port"),
    ("PORT-SHA", "Shanghai", "CN", "Asia Pacifico", 31.2304, 121.4737, "origin_hub"),
    ("PORT-YOK", "Yokohama", "JP", "Asia Pacifico", 35.4437, 139.6380, "origin_hub"),
]

ROUTES = [
    ("route-shanghai-algeciras", "Shanghai", "Algeciras", "maritime", 391.54, 8.0, 4500.0),
    ("route-shanghai-valencia", "Shanghai", "Valencia", "maritime", 403.15, 8.0, 4000.0),
    ("route-shanghai-barcelona", "Shanghai", "Barcelona", "maritime", 413.60, 8.0, 3100.0),
    ("route-yokohama-algeciras", "Yokohama", "Algeciras", "maritime", 402.25, 8.0, 6500.0),
    ("route-yokohama-valencia", "Yokohama", "Valencia", "maritime", 410.75, 8.0, 6000.0),
    ("route-yokohama-barcelona", "Yokohama", "Barcelona", "maritime", 420.10, 8.0, 5500.0),
]

WAREHOUSES = [("WH-VLL", "Valladolid", "ES", "Castilla y Leon", "cross_dock", 41.6520, -4.7240)]

SKUS = [("SKU-SEA-001", "Carga maritima general", "standard", "contenedor 40ft", "active")]

ARTICLES = [
    ("1000001023", "Modulo ABS delantero", "componentes coche", 18, 42, 756, 420, 2, "Valladolid", "Algeciras"),
    ("1000002087", "Centralita motor ECU", "electronica coche", 6, 11, 66, 90, 4, "Valladolid", "Valencia"),
    ("1000003154", "Juego de sensores radar", "asistencia conduccion", 10, 16, 160, 120, 2, "Valladolid", "Barcelona"),
    ("1000004278", "Bomba de combustible", "powertrain", 12, 35, 480, 240, 4, "Valladolid", "Algeciras"),
    ("1000005311", "Modulo airbag lateral", "seguridad pasiva", 16, 18, 288, 130, 3, "Valladolid", "Valencia"),
    ("1000006422", "Cableado de puerta", "electrico interior", 20, 25, 500, 180, 4, "Valladolid", "Barcelona"),
    ("1000007533", "Sensor de angulo volante", "direccion", 14, 9, 150, 80, 3, "Valladolid", "Algeciras"),
    ("1000008644", "Modulo de climatizacion HVAC", "confort", 8, 7, 90, 50, 3, "Valladolid", "Valencia"),
    ("1000009755", "Motor limpia parabrisas", "electromecanico", 10, 22, 220, 110, 3, "Valladolid", "Barcelona"),
    ("1000010866", "Camara ADAS frontal", "vision inteligente", 6, 6, 60, 32, 3, "Valladolid", "Algeciras"),
]

CUSTOMER_ORDERS = [
    ("ORD-DOU-001", "1000001023", "Douai", "FR", "IW14", "2026-04-01", "2026-04-08", 9, 378, "sea_committed"),
    ("ORD-DOU-002", "1000002087", "Douai", "FR", "IW14", "2026-04-02", "2026-04-05", 8, 48, "risk_stock"),
    ("ORD-DOU-003", "1000003154", "Douai", "FR", "IW15", "2026-04-06", "2026-04-11", 7, 112, "sea_committed"),
    ("ORD-DOU-004", "1000004278", "Douai", "FR", "IW15", "2026-04-07", "2026-04-12", 12, 144, "sea_committed"),
    ("ORD-DOU-005", "1000005311", "Douai", "FR", "IW15", "2026-04-07", "2026-04-10", 4, 64, "sea_committed"),
    ("ORD-DOU-006", "1000006422", "Douai", "FR", "IW15", "2026-04-08", "2026-04-11", 6, 120, "sea_committed"),
    ("ORD-DOU-007", "1000007533", "Douai", "FR", "IW16", "2026-04-11", "2026-04-13", 2, 28, "sea_committed"),
    ("ORD-DOU-008", "1000008644", "Douai", "FR", "IW16", "2026-04-12", "2026-04-14", 2, 16, "sea_committed"),
    ("ORD-DOU-009", "1000009755", "Douai", "FR", "IW16", "2026-04-13", "2026-04-15", 5, 50, "sea_committed"),
    ("ORD-DOU-010", "1000010866", "Douai", "FR", "IW16", "2026-04-13", "2026-04-15", 1, 6, "risk_stock"),
    ("ORD-CLE-011", "1000001023", "Cleon", "FR", "IW16", "2026-04-14", "2026-04-16", 4, 72, "sea_committed"),
    ("ORD-CLE-012", "1000005311", "Cleon", "FR", "IW16", "2026-04-14", "2026-04-16", 3, 48, "risk_stock"),
    ("ORD-CLE-013", "1000009755", "Cleon", "FR", "IW17", "2026-04-17", "2026-04-19", 6, 60, "sea_committed"),
    ("ORD-CLE-014", "1000010866", "Cleon", "FR", "IW17", "2026-04-18", "2026-04-20", 2, 12, "risk_stock"),
]

ARTICLE_PLAN = [
    ("1000001023", "Recepcion maritima", "2026-03-31", "2026-04-07", "IW14", "sea"),
    ("1000001023", "Preparacion almacen", "2026-04-07", "2026-04-08", "IW14", "warehouse"),
    ("1000001023", "Envio a cliente Douai", "2026-04-08", "2026-04-10", "IW14", "truck"),
    ("1000002087", "Alternativa aerea Shanghai-Madrid", "2026-04-01", "2026-04-02", "IW14", "air"),
    ("1000002087", "Camion Madrid-Valladolid", "2026-04-02", "2026-04-03", "IW14", "truck"),
    ("1000002087", "Expedicion Valladolid-Douai", "2026-04-03", "2026-04-05", "IW14", "truck"),
    ("1000003154", "Recepcion maritima", "2026-04-05", "2026-04-10", "IW15", "sea"),
    ("1000003154", "Entrega cliente Douai", "2026-04-10", "2026-04-11", "IW15", "truck"),
    ("1000004278", "Recepcion maritima", "2026-04-06", "2026-04-11", "IW15", "sea"),
    ("1000004278", "Entrega cliente Douai", "2026-04-11", "2026-04-12", "IW15", "truck"),
    ("1000005311", "Recepcion maritima", "2026-04-07", "2026-04-10", "IW15", "sea"),
    ("1000005311", "Entrega cliente Douai", "2026-04-10", "2026-04-11", "IW15", "truck"),
    ("1000006422", "Recepcion maritima", "2026-04-08", "2026-04-10", "IW15", "sea"),
    ("1000006422", "Entrega cliente Douai", "2026-04-10", "2026-04-11", "IW15", "truck"),
    ("1000007533", "Recepcion maritima", "2026-04-10", "2026-04-12", "IW16", "sea"),
    ("1000007533", "Entrega cliente Douai", "2026-04-12", "2026-04-13", "IW16", "truck"),
    ("1000008644", "Recepcion maritima", "2026-04-11", "2026-04-13", "IW16", "sea"),
    ("1000008644", "Entrega cliente Douai", "2026-04-13", "2026-04-14", "IW16", "truck"),
    ("1000009755", "Recepcion maritima", "2026-04-11", "2026-04-14", "IW16", "sea"),
    ("1000009755", "Entrega cliente Douai", "2026-04-14", "2026-04-15", "IW16", "truck"),
    ("1000010866", "Alternativa aerea Shanghai-Madrid", "2026-04-12", "2026-04-13", "IW16", "air"),
    ("1000010866", "Camion Madrid-Valladolid", "2026-04-13", "2026-04-13", "IW16", "truck"),
    ("1000010866", "Expedicion Valladolid-Douai", "2026-04-14", "2026-04-15", "IW16", "truck"),
]

AIRPORTS = [
    ("AIR-PVG", "Shanghai Pudong", "Shanghai", "CN", 31.1443, 121.8083, "origin_air_hub"),
    ("AIR-HND", "Tokyo Haneda", "Yokohama", "JP", 35.5494, 139.7798, "origin_air_hub"),
    ("AIR-MAD", "Adolfo Suarez Madrid-Barajas", "Madrid", "ES", 40.4893, -3.5676, "destination_airport"),
    ("AIR-BCN", "Barcelona-El Prat", "Barcelona", "ES", 41.2974, 2.0833, "destination_airport"),
    ("AIR-VLC", "Valencia Airport", "Valencia", "ES", 39.4893, -0.4816, "destination_airport"),
]

AIR_CORRIDORS = [
    ("AIRREC-PVG-MAD", "Shanghai Pudong", "Madrid", 17.0, 18400.0, 1.00, 225.0),
    ("AIRREC-PVG-BCN", "Shanghai Pudong", "Barcelona", 16.0, 17600.0, 0.95, 690.0),
    ("AIRREC-PVG-VLC", "Shanghai Pudong", "Valencia", 16.5, 17150.0, 0.93, 360.0),
    ("AIRREC-HND-MAD", "Tokyo Haneda", "Madrid", 18.0, 19150.0, 1.03, 225.0),
    ("AIRREC-HND-BCN", "Tokyo Haneda", "Barcelona", 17.0, 18300.0, 0.97, 690.0),
    ("AIRREC-HND-VLC", "Tokyo Haneda", "Valencia", 17.5, 17850.0, 0.96, 360.0),
]

# Points of the sea corridors in sailing order, port to port.
SEA_CORRIDORS = {
    "route-shanghai-algeciras": [
        (31.2304, 121.4737), (22.0, 118.0), (13.0, 103.0), (6.0, 80.0), (12.0, 56.0),
        (18.0, 44.0), (12.0, 32.0), (20.0, 4.0), (36.127, -5.453),
    ],
    "route-shanghai-valencia": [
        (31.2304, 121.4737), (22.0, 118.0), (13.0, 103.0), (6.0, 80.0), (12.0, 56.0),
        (18.0, 44.0), (12.0, 32.0), (20.0, 2.0), (39.458, -0.317),
    ],
    "route-shanghai-barcelona": [
        (31.2304, 121.4737), (22.0, 118.0), (13.0, 103.0), (6.0, 80.0), (12.0, 56.0),
        (18.0, 44.0), (12.0, 32.0), (20.0, 5.0), (41.352, 2.173),
    ],
    "route-yokohama-algeciras": [
        (35.4437, 139.638), (30.0, 132.0), (18.0, 118.0), (8.0, 92.0), (6.0, 78.0),
        (12.0, 56.0), (18.0, 44.0), (12.0, 32.0), (20.0, 4.0), (36.127, -5.453),
    ],
    "route-yokohama-valencia": [
        (35.4437, 139.638), (30.0, 132.0), (18.0, 118.0), (8.0, 92.0), (6.0, 78.0),
        (12.0, 56.0), (18.0, 44.0), (12.0, 32.0), (20.0, 2.0), (39.458, -0.317),
    ],
    "route-yokohama-barcelona": [
        (35.4437, 139.638), (30.0, 132.0), (18.0, 118.0), (8.0, 92.0), (6.0, 78.0),
        (12.0, 56.0), (18.0, 44.0), (12.0, 32.0), (20.0, 5.0), (41.352, 2.173),
    ],
}

SHIP_NAMES = {
    "ship-001": "MSC Gulsun",
    "ship-002": "CMA CGM Jacques Saade",
    "ship-003": "Ever Golden",
    "ship-004": "ONE Apus",
    "ship-005": "Maersk Eindhoven",
    "ship-006": "Ever Given",
    "ship-007": "HMM Algeciras",
    "ship-008": "Madrid Maersk",
    "ship-009": "CMA CGM Marco Polo",
    "ship-010": "MSC Irina",
}

INCIDENT_HOURS = {
    "Huelga": 72,
    "Tormenta": 96,
    "Problemas geopoliticos": 120,
    "Piratas": 144,
    "Problemas tecnicos del barco": 60,
    "Huelga de operaciones portuarias": 84,
}

# Stock and reorder level the weather rules assume per port; ports not listed use the default.
PORT_STOCK = [("Algeciras", 120, 80), ("Valencia", 140, 90)]
PORT_STOCK_DEFAULT = (135, 85)

FLIGHTS = [
    ("Madrid-Barajas (MAD)", "Air France Cargo", "AF9632", 45000.0, 14.5),
    ("Barcelona-El Prat (BCN)", "Lufthansa Cargo", "LH8440", 42000.0, 15.2),
    ("Valencia (VLC)", "Qatar Airways Cargo", "QR8115", 38000.0, 16.0),
    ("Zaragoza (ZAZ)", "DHL Air", "DHL4567", 35000.0, 17.5),
]

TRUCKS = [
    ("Madrid (MAD) -> Valladolid", "Transports López", "1234-BCD", 850.0, 2.5),
    ("Madrid (MAD) -> Valladolid", "Transports Martínez", "5678-EFG", 780.0, 3.0),
    ("Barcelona (BCN) -> Valladolid", "Transports López", "9012-HIJ", 1100.0, 4.5),
    ("Barcelona (BCN) -> Valladolid", "Transports González", "3456-KLM", 950.0, 5.0),
    ("Valencia (VLC) -> Valladolid", "Transports López", "7890-NOP", 920.0, 3.8),
    ("Valencia (VLC) -> Valladolid", "Express Delivery", "2345-QRS", 850.0, 4.2),
]

LAST_MILE = [("Exprés 24h", 850.0, 24.0), ("Económico 48h", 450.0, 48.0), ("Compartido 72h", 280.0, 72.0)]

# Links from the warehouse to the customers, in days by truck.
CUSTOMER_LINKS = [("Valladolid", "Douai", 2.5), ("Valladolid", "Cleon", 2.8)]

# ---- End of fixed values ------------------------------------------------------------------------


def waypoint_rows() -> list[tuple[str, int, float, float]]:
    """Numbered points of every route."""
    return [(route_id, seq, lat, lon) for route_id, points in SEA_CORRIDORS.items() for seq, (lat, lon) in enumerate(points)]


_TABLES: dict[str, tuple[list[tuple[str, pa.DataType]], object]] = {
    "dim_ports": (
        [("port_id", _S), ("port_name", _S), ("country_code", _S), ("macro_region", _S), ("lat", _D), ("lon", _D),
         ("port_type", _S)], PORTS),
    "dim_routes": (
        [("route_id", _S), ("origin_port", _S), ("dest_port", _S), ("route_mode", _S), ("sea_hours_estimate", _D),
         ("inland_hours_estimate", _D), ("maritime_cost_eur", _D)], ROUTES),
    "dim_warehouse": (
        [("warehouse_id", _S), ("warehouse_name", _S), ("country_code", _S), ("region_name", _S),
         ("warehouse_type", _S), ("lat", _D), ("lon", _D)], WAREHOUSES),
    "dim_skus": ([("sku_id", _S), ("sku_name", _S), ("sku_family", _S), ("packaging", _S), ("status", _S)], SKUS),
    "dim_airports": (
        [("airport_id", _S), ("airport_name", _S), ("city_name", _S), ("country_code", _S), ("lat", _D), ("lon", _D),
         ("airport_type", _S)], AIRPORTS),
    "dim_air_recovery": (
        [("air_recovery_id", _S), ("origin_airport", _S), ("dest_city", _S), ("air_eta_hours", _D),
         ("air_cost_eur", _D), ("air_co2_factor", _D), ("truck_km_to_warehouse", _D)], AIR_CORRIDORS),
    "dim_articles_valladolid": (
        [("article_ref", _S), ("article_name", _S), ("article_family", _S), ("pieces_per_pack", _L),
         ("daily_consumption_avg", _L), ("total_stock_pieces", _L), ("safety_stock_min", _L),
         ("total_stock_packs", _L), ("warehouse_name", _S), ("inbound_port", _S)], ARTICLES),
    "fact_customer_orders_douai": (
        [("order_id", _S), ("article_ref", _S), ("customer_city", _S), ("customer_country", _S),
         ("industrial_week", _S), ("planned_dispatch_date", _DATE), ("planned_delivery_date", _DATE),
         ("ordered_packs", _L), ("ordered_pieces", _L), ("order_status", _S)], CUSTOMER_ORDERS),
    "fact_article_gantt": (
        [("article_ref", _S), ("task_name", _S), ("start_date", _DATE), ("end_date", _DATE), ("industrial_week", _S),
         ("transport_mode", _S)], ARTICLE_PLAN),
    "dim_waypoints": ([("route_id", _S), ("seq", _I), ("lat", _D), ("lon", _D)], waypoint_rows),
    "dim_incidents": ([("incident", _S), ("extra_hours", _I)], list(INCIDENT_HOURS.items())),
    "dim_port_stock": ([("port_name", _S), ("stock_on_hand", _I), ("reorder_point", _I)], PORT_STOCK),
    "dim_flights": (
        [("airport", _S), ("airline", _S), ("flight_number", _S), ("flight_cost_eur", _D), ("flight_eta_hours", _D)],
        FLIGHTS),
    "dim_trucks": (
        [("route", _S), ("carrier", _S), ("license_plate", _S), ("truck_cost_eur", _D), ("truck_eta_hours", _D)],
        TRUCKS),
    "dim_customer_links": ([("src", _S), ("dst", _S), ("days", _D)], CUSTOMER_LINKS),
    "dim_last_mile": ([("option", _S), ("truck_cost_eur", _D), ("truck_hours", _D)], LAST_MILE),
}

TABLE_NAMES = list(_TABLES)


def _cell(value: object, kind: pa.DataType) -> object:
    return dt.date.fromisoformat(value) if kind == _DATE and isinstance(value, str) else value


def master(spark: SparkSession, name: str) -> DataFrame:
    """One master table as a local relation with declared types."""
    fields, rows = _TABLES[name]
    rows = rows() if callable(rows) else rows
    columns = [pa.array([_cell(row[i], kind) for row in rows], type=kind) for i, (_, kind) in enumerate(fields)]
    return spark.createDataFrame(pa.Table.from_arrays(columns, names=[column for column, _ in fields]))


def all_masters(spark: SparkSession) -> dict[str, DataFrame]:
    return {name: master(spark, name) for name in TABLE_NAMES}
