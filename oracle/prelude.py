"""Common table expressions for the oracle SQL: master rows and domain views, in DuckDB SQL."""

from __future__ import annotations

from harborline.sources import master as m

FLEET = "timestamp '2024-02-01 00:00:00'"
ORDERS = "timestamp '1998-04-01 00:00:00'"


def _literal(value: object) -> str:
    if isinstance(value, float):
        return f"{value!r}::double"
    if isinstance(value, int):
        return str(value)
    return "'" + str(value).replace("'", "''") + "'"


def _values(rows, columns: str) -> str:
    text = ", ".join("(" + ", ".join(_literal(v) for v in row) + ")" for row in rows)
    return f"select * from (values {text}) t({columns})"


# name -> (names it needs, SQL)
CTES: dict[str, tuple[list[str], str]] = {
    "ports": ([], _values(m.PORTS, "port_id, port_name, country_code, macro_region, lat, lon, port_type")),
    "routes": ([], _values(
        m.ROUTES, "route_id, origin_port, dest_port, route_mode, sea_hours_estimate, inland_hours_estimate, maritime_cost_eur")),
    "warehouse": ([], _values(
        m.WAREHOUSES, "warehouse_id, warehouse_name, country_code, region_name, warehouse_type, lat, lon")),
    "airports": ([], _values(m.AIRPORTS, "airport_id, airport_name, city_name, country_code, lat, lon, airport_type")),
    "corridors": ([], _values(
        m.AIR_CORRIDORS,
        "air_recovery_id, origin_airport, dest_city, air_eta_hours, air_cost_eur, air_co2_factor, truck_km_to_warehouse")),
    "waypoints": ([], _values(m.waypoint_rows(), "route_id, seq, lat, lon")),
    "incidents": ([], _values(
        [(i, n, h) for i, (n, h) in enumerate(m.INCIDENT_HOURS.items())], "pos, incident, extra_hours")),
    "trucks": ([], _values(m.TRUCKS, "route, carrier, license_plate, truck_cost_eur, truck_eta_hours")),
    "last_mile": ([], _values(m.LAST_MILE, '"option", truck_cost_eur, truck_hours')),
    "flight_list": ([], _values(m.FLIGHTS, "airport, airline, flight_number, flight_cost_eur, flight_eta_hours")),
    "ship_names": ([], _values(list(m.SHIP_NAMES.items()), "ship_id, ship_name")),

    "ev": ([], "select *, cast(json_extract_string(props, '$.k') as int) as k from events"),
    "ship_geo": (["ev"], """
        select *, 'ship-' || lpad(cast(user_id as varchar), greatest(length(cast(user_id as varchar)), 3)::int, '0') as ship_id,
          case when user_id % 2 = 0 then 'Shanghai' else 'Yokohama' end as origin_port,
          case user_id % 3 when 0 then 'Algeciras' when 1 then 'Valencia' else 'Barcelona' end as dest_port,
          case when user_id % 2 = 0 then 31.2304::double else 35.4437::double end as olat,
          case when user_id % 2 = 0 then 121.4737::double else 139.6380::double end as olon,
          case user_id % 3 when 0 then 36.1270::double when 1 then 39.4580::double else 41.3520::double end as dlat,
          case user_id % 3 when 0 then -5.4530::double when 1 then -0.3170::double else 2.1730::double end as dlon
        from ev"""),
    "ships": (["ship_geo"], """
        select event_id, ts, ship_id, 'route-' || lower(origin_port) || '-' || lower(dest_port) as route_id, origin_port, dest_port,
          olat + (dlat - olat) * (k / 100.0::double) as lat, olon + (dlon - olon) * (k / 100.0::double) as lon,
          cast(12 + k % 9 as double) as speed_kn, cast((event_id * 37) % 360 as double) as heading,
          'Valladolid' as warehouse, cast(user_id * 53 % 100 as int) as stock_on_hand, 30 as reorder_point
        from ship_geo"""),
    "alerts": (["ev"], """
        select event_id, ts, case when event_id % 5 < 3 then 'clima' else 'noticias' end as source,
          cast(1 + k % 5 as int) as severity,
          case k % 3 when 0 then 'Suez' when 1 then 'Mar de China' else 'Estrecho de Gibraltar' end as region,
          event_type as text, (60 + k % 39) / 100.0::double as confidence
        from ev where event_type in ('error', 'signup')"""),
    "weather": (["ev"], """
        select *, case when wind_speed_kmh >= 50 then 4 when wind_speed_kmh >= 35 then 3 when wind_speed_kmh >= 20 then 2
            else 1 end as severity
        from (select event_id, ts as event_ts,
            case event_id % 4 when 0 then 'Algeciras' when 1 then 'Valencia' when 2 then 'Barcelona' else 'Vigo' end as port_ref,
            cast(cast(floor(value) as int) % 70 as double) as wind_speed_kmh, cast(k % 35 as double) as temperature_c,
            cast(40 + k % 60 as int) as humidity_pct
          from ev where event_type = 'view')"""),
    "articles": ([], """
        select cast(p_partkey as varchar) as article_ref, p_name as article_name, p_brand as article_family,
          cast(p_size as bigint) as pieces_per_pack, 1 + p_partkey % 40 as daily_consumption_avg,
          (p_partkey * 7919) % 2000 as total_stock_pieces, (p_partkey * 104729) % 500 as safety_stock_min,
          case p_partkey % 3 when 0 then 'Algeciras' when 1 then 'Valencia' else 'Barcelona' end as inbound_port,
          6 + (p_partkey % 6) * 2 as lead_time_days, p_size / 1000.0::double as unit_volume_m3, p_size / 10.0::double as unit_weight_kg
        from part"""),
    "customer_orders": ([], """
        select cast(l_orderkey as varchar) || '-' || cast(l_linenumber as varchar) as order_id, cast(l_partkey as varchar) as article_ref,
          case when o_custkey % 2 = 0 then 'Douai' else 'Cleon' end as customer_city,
          'IW' || lpad(cast(weekofyear(o_orderdate) as varchar), 2, '0') as industrial_week,
          cast(o_orderdate as date) as planned_dispatch_date, cast(l_shipdate as date) as planned_delivery_date,
          cast(l_quantity as bigint) as ordered_pieces, case when o_orderstatus = 'F' then 'sea_committed' else 'risk_stock' end as order_status
        from lineitem join orders on l_orderkey = o_orderkey"""),

    "latest": (["ships"], """
        select * exclude (rn) from (select *, row_number() over (partition by ship_id order by ts desc, event_id desc) as rn from ships)
        where rn = 1"""),
    "voyages": (["latest", "routes", "ship_names"], f"""
        select *, round(voyage_days_total - voyage_days_remaining, 1) as voyage_days_elapsed
        from (select *, round(sea_hours_estimate / 24.0::double, 1) as voyage_days_total,
            round(eta_hours_estimate / 24.0::double, 1) as voyage_days_remaining
          from (select l.*, r.sea_hours_estimate, r.inland_hours_estimate, r.maritime_cost_eur,
              round(greatest(0.0::double, 405.0::double - l.stock_on_hand * 0.4::double) + 12.0::double, 1) as eta_hours_estimate,
              coalesce(n.ship_name, l.ship_id) as ship_name
            from latest l left join routes r on r.route_id = l.route_id left join ship_names n on n.ship_id = l.ship_id))"""),
    "eta_dates": (["voyages"], f"""
        select *, coalesce(strftime({FLEET} + to_seconds(cast(round(eta_hours_estimate * 3600) as bigint)), '%Y-%m-%d %H:%M'), 'N/A') as eta_fecha,
          coalesce(strftime({FLEET} - to_seconds(cast(round(voyage_days_elapsed * 24 * 3600) as bigint)), '%Y-%m-%d %H:%M'), 'N/A') as fecha_salida_origen
        from voyages"""),
    "route_context": (["routes", "ports", "warehouse"], """
        select p.port_name as port_ref, r.origin_port, r.route_id, w.warehouse_name as warehouse,
          case p.port_name when 'Algeciras' then 120 when 'Valencia' then 140 else 135 end as stock_on_hand,
          case p.port_name when 'Algeciras' then 80 when 'Valencia' then 90 else 85 end as reorder_point,
          p.port_id, w.warehouse_id, r.sea_hours_estimate, r.inland_hours_estimate
        from routes r left join ports p on r.dest_port = p.port_name cross join warehouse w"""),
    "enriched": (["weather", "route_context"], f"""
        select w.*, c.* exclude (port_ref),
          case when severity >= 4 then 'ALTO' when severity >= 2 then 'MEDIO' else 'BAJO' end as weather_risk_level,
          case when stock_on_hand is null then 'SIN_CONTEXTO' when stock_on_hand <= reorder_point then 'STOCK_CRITICO'
            when severity >= 3 then 'METEO_VIGILANCIA' else 'OPERATIVO' end as port_operational_status,
          case when severity >= 4 then 10.0::double when severity >= 3 then 6.0::double when severity >= 2 then 3.0::double
            else 1.0::double end as weather_delay_hours_estimate,
          {FLEET} as enriched_at
        from weather w left join route_context c on c.port_ref = w.port_ref"""),
    "operational": (["enriched"], f"""
        select event_id, {FLEET} as operational_ts, 'interpretacion_y_accion' as kdd_phase, port_id, port_ref, origin_port, route_id,
          warehouse_id, warehouse, event_ts, temperature_c, humidity_pct, wind_speed_kmh, severity, weather_risk_level,
          port_operational_status, weather_delay_hours_estimate,
          case when weather_risk_level = 'MEDIO' and port_operational_status = 'METEO_VIGILANCIA'
              then 'reprogramar ventana portuaria y avisar a operacion terrestre'
            when port_operational_status = 'STOCK_CRITICO' then 'priorizar stock alternativo y escalado logistico'
            else 'seguimiento normal de la ruta' end as recommended_action,
          case when weather_risk_level = 'ALTO' then 5 when port_operational_status = 'METEO_VIGILANCIA' then 4
            when weather_risk_level = 'MEDIO' then 3 else 2 end as operational_severity
        from enriched"""),
    "newest_weather": (["operational"], """
        select * exclude (rn) from (select *, row_number() over (partition by route_id, port_ref order by event_ts desc, event_id desc) as rn
          from operational where route_id is not null) where rn = 1"""),
    "sea_edges": (["ships", "ports"], """
        select s.origin_port as src, s.dest_port as dst,
          sqrt(power((d.lat - o.lat) * 111.32::double, 2) + power((d.lon - o.lon) * 111.32::double, 2)) / (s.v * 1.852::double) as weight
        from (select origin_port, dest_port, avg(speed_kn) as v from ships group by all) s
        join ports o on o.port_name = s.origin_port join ports d on d.port_name = s.dest_port"""),
    "net_edges": (["sea_edges"], """
        select src, dst, weight from sea_edges
        union all select distinct dst, 'Valladolid', 8.0::double from sea_edges"""),
    "net_nodes": (["ships"], """
        select id, case when id = 'Valladolid' then 'warehouse' else 'port' end as type
        from (select origin_port as id from ships union select dest_port from ships union select 'Valladolid')"""),
    "risk": (["sea_edges", "alerts"], """
        select *, case when risk_score >= 4.0 then 'ALTO' when risk_score >= 2.5 then 'MEDIO' else 'BAJO' end as risk_level
        from (select src as origin_port, dst as via_port, weight as time_shanghai_to_via_hours, 8.0::double as time_via_to_valladolid_hours,
            weight + 8.0::double as estimated_total_hours, (select coalesce(avg(severity), 0.0::double) from alerts) as risk_score
          from sea_edges)"""),
    "fact_alerts": (["risk", "ships"], f"""
        select {FLEET} as alert_ts, 'operativa_graph_stock' as source, origin_port, via_port, risk_score, risk_level, estimated_total_hours,
          stock_on_hand_min, reorder_point, stock_status,
          case when risk_level = 'ALTO' and stock_status = 'CRITICO' then 'activar vuelo urgente: priorizar redistribucion/transferencia'
            when stock_status = 'CRITICO' then 'seguir plan de contingencia: replanificar rutas y priorizar stock alternativo'
            else 'seguimiento normal: sin accion urgente' end as recommendation,
          case when stock_status = 'CRITICO' then case risk_level when 'ALTO' then 5 when 'MEDIO' then 4 when 'BAJO' then 3 else 1 end
            when risk_level = 'ALTO' then 3 when risk_level = 'MEDIO' then 2 else 1 end as severity
        from (select *, case when stock_on_hand_min is null or reorder_point is null then 'SIN_DATOS'
              when stock_on_hand_min <= reorder_point then 'CRITICO' else 'OK' end as stock_status
          from risk left join (select dest_port as via_port, min(stock_on_hand) as stock_on_hand_min, min(reorder_point) as reorder_point
            from ships group by dest_port) using (via_port))"""),
    "worst_alerts": (["fact_alerts"], """
        select * exclude (rn) from (select *, row_number() over (partition by via_port
            order by severity desc, estimated_total_hours desc, origin_port) as rn from fact_alerts) where rn = 1"""),
    "priced": (["corridors", "airports"], """
        select *, round(air_eta_hours + truck_eta_hours + 4.0::double, 1) as air_total_eta_hours,
          round(air_cost_eur + truck_cost_eur, 2) as air_total_cost_eur
        from (select c.*, a.city_name as origin_city, round(truck_km_to_warehouse / 68.0::double, 1) as truck_eta_hours,
            round(truck_km_to_warehouse * 1.45::double, 2) as truck_cost_eur
          from corridors c left join airports a on a.airport_name = c.origin_airport)"""),
    "air_context": (["latest", "routes", "ports", "warehouse", "newest_weather", "worst_alerts"], """
        select *, case when hours_until_stock_break <= 0 then 'ROTURA_INMINENTE'
            when ship_remaining_hours > hours_until_stock_break then 'ROTURA_PROBABLE' else 'COBERTURA_OK' end as stock_break_risk
        from (select *, round(sea_hours_estimate * (case when total_km <= 0 then 1.0::double else remaining_km / total_km end)
              + inland_hours_estimate + weather_delay_hours_estimate + 6.0::double, 1) as ship_remaining_hours
          from (select s.ship_id, s.route_id, s.origin_port, s.dest_port, w.warehouse_name as warehouse, s.stock_on_hand, s.reorder_point,
              r.sea_hours_estimate, r.inland_hours_estimate,
              round(6371.0::double * sqrt((d.lat - o.lat) * (d.lat - o.lat) + (d.lon - o.lon) * (d.lon - o.lon)), 2) as total_km,
              round(6371.0::double * sqrt((d.lat - s.lat) * (d.lat - s.lat) + (d.lon - s.lon) * (d.lon - s.lon)), 2) as remaining_km,
              round((s.stock_on_hand - s.reorder_point) / 1.6::double, 1) as hours_until_stock_break,
              wo.weather_risk_level, wo.port_operational_status, wo.weather_delay_hours_estimate,
              coalesce(wo.severity, fa.severity) as weather_severity, fa.risk_level as graph_risk_level,
              fa.recommendation as graph_recommendation
            from latest s left join routes r on r.route_id = s.route_id left join ports o on o.port_name = s.origin_port
            left join ports d on d.port_name = s.dest_port left join warehouse w on w.warehouse_name = s.warehouse
            left join newest_weather wo on wo.route_id = s.route_id and wo.port_ref = s.dest_port
            left join worst_alerts fa on fa.via_port = s.dest_port))"""),
    "air_rows": (["air_context", "priced"], f"""
        select {FLEET} as decision_ts, * replace (case when recommended then 'AEREO_CAMION' else 'MARITIMO' end as recommended),
          case when recommended then 'El barco llega tarde para cubrir stock y la opcion aerea evita rotura con mejor ETA'
            else 'La ruta maritima sigue siendo viable con menor coste total' end as reason_summary
        from (select *, ia_recommendation = 'evaluar_aereo_urgente' and coalesce(time_saved_hours > 0, false)
              and air_total_eta_hours <= hours_until_stock_break as recommended
          from (select c.*, p.air_recovery_id as air_option_id, p.dest_city as air_dest_city, p.truck_cost_eur, p.air_total_eta_hours,
              p.air_total_cost_eur, p.origin_city, round(c.ship_remaining_hours - p.air_total_eta_hours, 1) as time_saved_hours,
              case when weather_severity >= 4 or weather_risk_level = 'ALTO' or stock_break_risk <> 'COBERTURA_OK'
                then 'evaluar_aereo_urgente' else 'mantener_maritimo' end as ia_recommendation
            from air_context c cross join priced p))"""),
    "air_options": (["air_rows"], """
        select decision_ts, ship_id, route_id, origin_port, dest_port, warehouse, air_option_id, air_dest_city, weather_risk_level,
          port_operational_status, weather_severity, graph_risk_level, graph_recommendation, stock_on_hand, reorder_point,
          hours_until_stock_break, ship_remaining_hours, air_total_eta_hours, time_saved_hours, air_total_cost_eur, truck_cost_eur,
          stock_break_risk, recommended as recommended_mode, ia_recommendation, reason_summary, origin_city
        from air_rows"""),
    "best_air": (["air_options"], """
        select * exclude (rn, origin_city) from (select *, row_number() over (partition by ship_id
            order by recommended_mode desc, air_total_cost_eur, air_total_eta_hours, air_option_id) as rn from air_options) where rn = 1"""),
    "best_by_port": (["best_air"], """
        select * exclude (rn) from (select *, row_number() over (partition by dest_port
            order by time_saved_hours desc nulls last, ship_id) as rn from best_air) where rn = 1"""),
    "stock_ctx": (["articles", "customer_orders"], """
        select *, case when available_after_orders <= safety_stock_min then 'ROJO'
            when available_after_orders <= safety_stock_min + 2 * daily_consumption_avg then 'NARANJA' else 'VERDE' end as stock_status,
          case when daily_consumption_avg > 0
            then round(greatest(0, available_after_orders) / daily_consumption_avg::double * 24, 1) else 0.0::double end as hours_to_stockout
        from (select a.*, cast(coalesce(o.n, 0) as bigint) as ordered_pieces,
            cast(a.total_stock_pieces - coalesce(o.n, 0) as bigint) as available_after_orders
          from articles a left join (select article_ref, sum(ordered_pieces) as n from customer_orders group by 1) o using (article_ref))"""),
    "coverage": (["customer_orders", "stock_ctx", "best_by_port"], f"""
        select order_id, article_ref, customer_city, industrial_week, needed_date_client, arrival_valladolid, margin_days,
          case when margin_days >= 4 then 'CUBRE' else 'NO CUBRE' end as cover_status, recommended_mode, air_total_cost_eur, inbound_port
        from (select *, round((epoch(needed_date_client) - epoch(arrival_valladolid)) / 86400.0::double, 1) as margin_days
          from (select o.order_id, o.article_ref, o.customer_city, o.industrial_week, cast(o.planned_delivery_date as timestamp) as needed_date_client,
              {ORDERS} + to_seconds(cast(round(3600 * case when s.stock_status = 'ROJO'
                  then coalesce(b.air_total_eta_hours, b.ship_remaining_hours, 240.0::double)
                  else coalesce(b.ship_remaining_hours, 240.0::double) end) as bigint)) as arrival_valladolid,
              coalesce(b.recommended_mode, 'MARITIMO') as recommended_mode, coalesce(b.air_total_cost_eur, 0.0::double) as air_total_cost_eur,
              s.inbound_port
            from customer_orders o join stock_ctx s using (article_ref) left join best_by_port b on b.dest_port = s.inbound_port))"""),
    "weeks": ([], "select 'IW' || w as industrial_week, w - 13 as pos from range(14, 24) t(w)"),
    "flows": (["articles", "weeks", "customer_orders", "coverage"], """
        select a.article_ref, w.industrial_week, w.pos, a.total_stock_pieces, a.safety_stock_min,
          a.daily_consumption_avg * 7 as weekly,
          cast(coalesce(c.n, 0) * a.pieces_per_pack as bigint) as inbound,
          cast(coalesce(o.n, a.daily_consumption_avg * 7) as bigint) as outbound
        from articles a cross join weeks w
        left join (select article_ref, industrial_week, sum(ordered_pieces) as n from customer_orders group by 1, 2) o
          on o.article_ref = a.article_ref and o.industrial_week = w.industrial_week
        left join (select article_ref, industrial_week, count(*) as n from coverage
            where 'IW' || lpad(cast(weekofyear(arrival_valladolid) as varchar), 2, '0') = industrial_week group by 1, 2) c
          on c.article_ref = a.article_ref and c.industrial_week = w.industrial_week"""),
    # The stock recurrence is stepped week by week here, unlike the closed form under test.
    "steps": (["flows"], """
        select article_ref, total_stock_pieces as s0,
          list_transform(range(1, 11), lambda n: list_reduce(
            list_prepend(total_stock_pieces, changes[1:n]), lambda s, c: greatest(0, s + c))) as stocks
        from (select article_ref, any_value(total_stock_pieces) as total_stock_pieces, list(inbound - outbound order by pos) as changes
          from flows group by article_ref)"""),
    "horizon": (["flows", "steps"], """
        select f.article_ref, f.industrial_week, f.total_stock_pieces as initial_stock, f.inbound, f.outbound,
          cast(s.stocks[f.pos] as bigint) as projected_stock,
          case when s.stocks[f.pos] <= f.safety_stock_min then 'NO CUBRE'
            when s.stocks[f.pos] <= f.safety_stock_min + f.weekly then 'ALERTA' else 'CUBRE' end as cover_status
        from flows f join steps s using (article_ref)"""),
    "article_flights": (["stock_ctx", "flight_list"], f"""
        select article_ref, flight_number, airport, flight_cost_eur, flight_eta_hours, strftime(rupture, '%Y-%m-%d %H:%M') as stock_rupture_date,
          {ORDERS} + to_seconds(cast(round(flight_eta_hours * 3600) as bigint)) < rupture as in_time
        from (select article_ref, {ORDERS} + to_seconds(cast(round(hours_to_stockout * 3600) as bigint)) as rupture from stock_ctx)
        cross join flight_list"""),
    "known_at": (["ships", "ports", "weather"], """
        select event_id, ship_id, route_id, dest_port, ts, remaining_km, remaining_share, speed_kn,
          round(remaining_km / (speed_kn * 1.852::double), 6) as planned_hours, coalesce(w.wind_speed_kmh, 0.0::double) as wind_speed_kmh,
          coalesce(w.severity, 1) as weather_severity, w.port_ref is not null as has_weather
        from (select s.*, round(left_km, 6) as remaining_km, round(left_km / whole_km, 6) as remaining_share
          from (select s.*, sqrt(power((d.lat - s.lat) * 111.32::double, 2) + power((d.lon - s.lon) * 111.32::double, 2)) as left_km,
              sqrt(power((d.lat - o.lat) * 111.32::double, 2) + power((d.lon - o.lon) * 111.32::double, 2)) as whole_km
            from ships s left join ports o on o.port_name = s.origin_port left join ports d on d.port_name = s.dest_port) s) f
        asof left join (select port_ref, event_ts, wind_speed_kmh, severity from weather
            qualify row_number() over (partition by port_ref, event_ts order by severity desc, wind_speed_kmh desc) = 1) w
          on w.port_ref = f.dest_port and f.ts >= w.event_ts"""),
    "trade_edges": ([], """
        select 'S' || l_suppkey as src, 'C' || o_custkey as dst, round(avg(l_quantity), 6) as weight,
          round(avg(case when l_returnflag = 'R' then 1.0::double else 0.0::double end), 6) as risk
        from lineitem join orders on l_orderkey = o_orderkey group by l_suppkey, o_custkey
        union all select n_name, 'S' || s_suppkey, 8.0::double, 0.0::double from supplier join nation on s_nationkey = n_nationkey
        union all select 'C' || c_custkey, n_name, 8.0::double, 0.0::double from customer join nation on c_nationkey = n_nationkey"""),
    "trade_nodes": ([], """
        select n_name as id, 'nation' as type from nation
        union all select 'S' || s_suppkey, 'supplier' from supplier union all select 'C' || c_custkey, 'customer' from customer"""),
    "ship_windows": (["ships"], """
        select time_bucket(interval '15 minutes', ts) as window_start, time_bucket(interval '15 minutes', ts) + interval '15 minutes' as window_end,
          dest_port, route_id, avg(speed_kn) as avg_speed, stddev_samp(speed_kn) as speed_std, count(*) as ship_count,
          avg(lat) as avg_lat, avg(lon) as avg_lon
        from ships group by all"""),
    "alert_windows": (["alerts"], """
        select time_bucket(interval '15 minutes', ts) as window_start, time_bucket(interval '15 minutes', ts) + interval '15 minutes' as window_end,
          region, source, avg(severity) as avg_severity, avg(confidence) as avg_confidence, count(*) as alert_count
        from alerts group by all"""),
    # Raw topic with the feed faults: value < 5 is cut off, value >= 200 has no readable time.
    "raw": (["ship_geo"], """
        select *, case when event_type in ('click', 'purchase') then 'ship' when event_type in ('error', 'signup') then 'alert'
            else 'weather' end as feed,
          value < 5 as cut, case when value >= 200 then 'sin hora' else cast(ts as varchar) end as ts_text,
          case when value >= 200 then null else ts end as ts_ok,
          case when k <> 0 then 10.0::double + k / 4.0::double end as r_lat, 100.0::double - k as r_lon,
          cast(12 + k % 9 as double) as r_speed, cast((event_id * 37) % 400 as double) as r_heading,
          case k % 4 when 0 then ' CLIMA ' when 1 then 'clima' when 2 then 'noticias' else 'otro' end as a_source,
          cast(k % 7 as int) as a_severity,
          case k % 3 when 0 then 'Suez' when 1 then 'Mar de China' else 'Estrecho de Gibraltar' end as a_region,
          event_type || ' ' || cast(user_id as varchar) as a_text, (60 + k % 50) / 100.0::double as a_confidence
        from ship_geo"""),
}


def with_ctes(body: str, *names: str, recursive: str = "") -> str:
    """Full statement: the named expressions with everything they need, in order, then the body.

    A body may begin with a comma to add expressions of its own.
    """
    ordered: list[str] = []

    def add(name: str) -> None:
        if name in ordered:
            return
        for needed in CTES[name][0]:
            add(needed)
        ordered.append(name)

    for name in names:
        add(name)
    parts = [f"{name} as ({CTES[name][1].strip()})" for name in ordered]
    if recursive:
        parts.append(recursive)
    head = f"with {'recursive ' if recursive else ''}" + ",\n".join(parts)
    return f"{head}\n{body.strip()}"
