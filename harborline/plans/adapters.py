"""Domain-shaped views over the generic test tables.

Each function takes the tables it needs and covers every row of them. The views stand in for the staged
tables of a real deployment.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborline.functions.bands import wind_severity
from harborline.functions.calendar import industrial_week
from harborline.sources.master import PORTS

_PORT_AT = {name: (lat, lon) for _, name, _, _, lat, lon, _ in PORTS}


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def _pick(value: Column, *choices: object) -> Column:
    """Choice by position; the last one is the default."""
    chain = F
    for place, choice in enumerate(choices[:-1]):
        chain = chain.when(value == place, F.lit(choice))
    return chain.otherwise(F.lit(choices[-1]))


def _ship_id() -> Column:
    number = F.col("user_id").cast("string")
    return F.concat(F.lit("ship-"), F.lpad(number, F.greatest(F.length(number), F.lit(3)), "0"))


def ships(events: DataFrame) -> DataFrame:
    """Positions: every event is a fix of the vessel ``user_id``, ``k`` per cent along its route."""
    parity, third = F.col("user_id") % 2, F.col("user_id") % 3
    share = F.col("k") / F.lit(100.0)

    def along(axis: int) -> Column:
        start = _pick(parity, _PORT_AT["Shanghai"][axis], _PORT_AT["Yokohama"][axis])
        end = _pick(third, *[_PORT_AT[p][axis] for p in ("Algeciras", "Valencia", "Barcelona")])
        return start + (end - start) * share

    origin = _pick(parity, "Shanghai", "Yokohama")
    dest = _pick(third, "Algeciras", "Valencia", "Barcelona")
    return events.withColumn("k", _k()).select(
        "event_id", "ts", _ship_id().alias("ship_id"),
        F.concat_ws("-", F.lit("route"), F.lower(origin), F.lower(dest)).alias("route_id"),
        origin.alias("origin_port"), dest.alias("dest_port"),
        along(0).alias("lat"), along(1).alias("lon"),
        (F.lit(12) + F.col("k") % 9).cast("double").alias("speed_kn"),
        ((F.col("event_id") * 37) % 360).cast("double").alias("heading"),
        # A value of the row, not a literal: joins on it stay equality joins.
        F.when(F.col("user_id").isNotNull(), "Valladolid").alias("warehouse"),
        (F.col("user_id") * 53 % 100).cast("int").alias("stock_on_hand"),
        F.lit(30).alias("reorder_point"),
    )


def alerts(events: DataFrame) -> DataFrame:
    """Alerts: error and signup events."""
    return events.filter(F.col("event_type").isin("error", "signup")).withColumn("k", _k()).select(
        "event_id", "ts",
        F.when(F.col("event_id") % 5 < 3, "clima").otherwise("noticias").alias("source"),
        (F.lit(1) + F.col("k") % 5).cast("int").alias("severity"),
        _pick(F.col("k") % 3, "Suez", "Mar de China", "Estrecho de Gibraltar").alias("region"),
        F.col("event_type").alias("text"),
        ((F.lit(60) + F.col("k") % 39) / F.lit(100.0)).alias("confidence"),
    )


def weather(events: DataFrame) -> DataFrame:
    """Weather observations: view events, one of four ports each, one of them without a route."""
    rows = events.filter(F.col("event_type") == "view").withColumn("k", _k())
    wind = (F.floor("value").cast("int") % 70).cast("double")
    return rows.select(
        "event_id", F.col("ts").alias("event_ts"),
        _pick(F.col("event_id") % 4, "Algeciras", "Valencia", "Barcelona", "Vigo").alias("port_ref"),
        wind.alias("wind_speed_kmh"), (F.col("k") % 35).cast("double").alias("temperature_c"),
        (F.lit(40) + F.col("k") % 60).cast("int").alias("humidity_pct"),
        wind_severity(wind).alias("severity"),
    )


def articles(part: DataFrame) -> DataFrame:
    """Articles: one per part, with stock figures derived from its key."""
    key, size = F.col("p_partkey"), F.col("p_size").cast("long")
    return part.select(
        key.cast("string").alias("article_ref"), F.col("p_name").alias("article_name"),
        F.col("p_brand").alias("article_family"), size.alias("pieces_per_pack"),
        (F.lit(1) + key % 40).alias("daily_consumption_avg"),
        ((key * 7919) % 2000).alias("total_stock_pieces"), ((key * 104729) % 500).alias("safety_stock_min"),
        _pick(key % 3, "Algeciras", "Valencia", "Barcelona").alias("inbound_port"),
        (F.lit(6) + (key % 6) * 2).alias("lead_time_days"),
        (size / F.lit(1000.0)).alias("unit_volume_m3"), (size / F.lit(10.0)).alias("unit_weight_kg"),
    )


def customer_orders(lines: DataFrame, heads: DataFrame) -> DataFrame:
    """Customer orders: one per order line."""
    return lines.join(heads, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("order_id"),
        F.col("l_partkey").cast("string").alias("article_ref"),
        F.when(F.col("o_custkey") % 2 == 0, "Douai").otherwise("Cleon").alias("customer_city"),
        industrial_week(F.col("o_orderdate")).alias("industrial_week"),
        F.to_date("o_orderdate").alias("planned_dispatch_date"), F.to_date("l_shipdate").alias("planned_delivery_date"),
        F.col("l_quantity").cast("long").alias("ordered_pieces"),
        F.when(F.col("o_orderstatus") == "F", "sea_committed").otherwise("risk_stock").alias("order_status"),
    )


def article_plan(lines: DataFrame, heads: DataFrame) -> DataFrame:
    """Transport plan: one task per order line, from order date to ship date."""
    mode = F.when(F.col("l_returnflag") == "A", "air").when(F.col("l_returnflag") == "N", "sea").otherwise("truck")
    return lines.join(heads, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_partkey").cast("string").alias("article_ref"),
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("task_name"),
        F.col("o_orderdate").alias("start_date"), F.col("l_shipdate").alias("end_date"),
        industrial_week(F.col("o_orderdate")).alias("industrial_week"), mode.alias("transport_mode"),
    )


def transport_edges(lines: DataFrame, heads: DataFrame, suppliers: DataFrame, customers: DataFrame, nations: DataFrame) -> DataFrame:
    """Network over all trade: nation to supplier, supplier to customer (one edge per trading pair),
    customer to nation. ``weight`` is the mean quantity in hours, ``risk`` the share of returns."""
    trade = (
        lines.join(heads, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("l_suppkey", "o_custkey")
        .agg(F.round(F.avg("l_quantity"), 6).alias("weight"),
             F.round(F.avg(F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0)), 6).alias("risk"))
        .select(_node("S", F.col("l_suppkey")).alias("src"), _node("C", F.col("o_custkey")).alias("dst"), "weight", "risk")
    )
    fixed = [F.lit(8.0).alias("weight"), F.lit(0.0).alias("risk")]
    inbound = suppliers.join(nations, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("n_name").alias("src"), _node("S", F.col("s_suppkey")).alias("dst"), *fixed
    )
    outbound = customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select(
        _node("C", F.col("c_custkey")).alias("src"), F.col("n_name").alias("dst"), *fixed
    )
    return trade.unionByName(inbound).unionByName(outbound)


def _node(prefix: str, key: Column) -> Column:
    return F.concat(F.lit(prefix), key.cast("string"))


def transport_nodes(suppliers: DataFrame, customers: DataFrame, nations: DataFrame) -> DataFrame:
    """All nations, suppliers and customers, with or without trade."""
    def nodes(df: DataFrame, name: Column, kind: str) -> DataFrame:
        return df.select(name.alias("id"), F.lit(kind).alias("type"))

    return (
        nodes(nations, F.col("n_name"), "nation")
        .unionByName(nodes(suppliers, _node("S", F.col("s_suppkey")), "supplier"))
        .unionByName(nodes(customers, _node("C", F.col("c_custkey")), "customer"))
    )


def consignment_edges(heads: DataFrame) -> DataFrame:
    """Customer to order links, for grouping consignments that belong together."""
    return heads.select(_node("C", F.col("o_custkey")).alias("src"), _node("O", F.col("o_orderkey")).alias("dst"))


def consignment_nodes(heads: DataFrame, customers: DataFrame) -> DataFrame:
    return customers.select(_node("C", F.col("c_custkey")).alias("id")).unionByName(
        heads.select(_node("O", F.col("o_orderkey")).alias("id"))
    )


# ---- Raw feeds -----------------------------------------------------------------------------------

# Kinds of message on the mixed topic, by event type.
SHIP_TYPES = ("click", "purchase")
ALERT_TYPES = ("error", "signup")


def raw_lines(events: DataFrame, deliveries: int = 1) -> DataFrame:
    """The mixed raw topic as JSON text, with the faults a feed has.

    Click and purchase events are positions, error and signup events alerts, view events weather
    answers that also reach the ship topic. A value under 5 is a line cut off in transit, a value
    from 200 up carries an unreadable time, and positions at ``k = 0`` miss the latitude. ``deliveries``
    above one repeats every message, as an at-least-once feed may.
    """
    events = events.withColumn("k", _k())
    ts = F.when(F.col("value") >= 200, "sin hora").otherwise(F.col("ts").cast("string"))
    is_ship, is_alert = F.col("event_type").isin(*SHIP_TYPES), F.col("event_type").isin(*ALERT_TYPES)
    parity, third = F.col("user_id") % 2, F.col("user_id") % 3
    origin = _pick(parity, "Shanghai", "Yokohama")
    dest = _pick(third, "Algeciras", "Valencia", "Barcelona")
    ship = F.to_json(F.struct(
        F.lit("ship_position").alias("event_type"), ts.alias("ts"), _ship_id().alias("ship_id"),
        F.concat_ws("-", F.lit("route"), F.lower(origin), F.lower(dest)).alias("route_id"),
        origin.alias("origin_port"), dest.alias("dest_port"),
        F.when(F.col("k") != 0, F.lit(10.0) + F.col("k") / 4.0).alias("lat"),
        (F.lit(100.0) - F.col("k")).alias("lon"),
        (F.lit(12) + F.col("k") % 9).cast("double").alias("speed_kn"),
        ((F.col("event_id") * 37) % 400).cast("double").alias("heading"),
    ))
    alert = F.to_json(F.struct(
        F.lit("global_alert").alias("event_type"), ts.alias("ts"),
        _pick(F.col("k") % 4, " CLIMA ", "clima", "noticias", "otro").alias("source"),
        (F.col("k") % 7).cast("int").alias("severity"),
        _pick(F.col("k") % 3, "Suez", "Mar de China", "Estrecho de Gibraltar").alias("region"),
        F.concat_ws(" ", F.col("event_type"), F.col("user_id").cast("string")).alias("text"),
        ((F.lit(60) + F.col("k") % 50) / F.lit(100.0)).alias("confidence"),
    ))
    answer = F.to_json(F.struct(F.struct(
        ts.alias("time"), (F.col("k") % 35).cast("double").alias("temperature_2m"),
        (F.lit(40) + F.col("k") % 60).alias("relative_humidity_2m"),
        (F.floor("value").cast("int") % 70).cast("double").alias("wind_speed_10m"),
        (F.col("k") * 3).alias("wind_direction_10m"), (F.col("k") % 4).alias("weather_code"),
    ).alias("current")))
    text = F.when(is_ship, ship).when(is_alert, alert).otherwise(answer)
    cut = F.when(F.col("value") < 5, F.substring(text, 1, 30)).otherwise(text)
    lines = events.select(
        "event_id", F.when(is_alert, "alertas_globales").otherwise("datos_crudos").alias("topic"),
        F.when(is_ship, "ship").when(is_alert, "alert").otherwise("weather").alias("feed"), cut.alias("value"),
    )
    if deliveries > 1:
        lines = lines.withColumn("_n", F.explode(F.sequence(F.lit(1), F.lit(deliveries)))).drop("_n")
    return lines
