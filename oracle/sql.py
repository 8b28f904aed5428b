"""Oracle SQL per query: an independent statement of each result, for DuckDB on the same tables."""

from __future__ import annotations

from oracle.prelude import FLEET, ORDERS, with_ctes

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages",
    "benchmark", "labels", "conversations",
]
OPERATIONAL = (
    "event_id, operational_ts, kdd_phase, port_id, port_ref, origin_port, route_id, warehouse_id, warehouse, event_ts, temperature_c, "
    "humidity_pct, wind_speed_kmh, severity, weather_risk_level, port_operational_status, weather_delay_hours_estimate, "
    "recommended_action, operational_severity"
)
ALERT_ROUNDED = "select * replace (round(risk_score, 6) as risk_score, round(estimated_total_hours, 6) as estimated_total_hours) from fact_alerts"


def _minute(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%d %H:%M')"


def _later(base: str, hours: str) -> str:
    return f"{base} + to_seconds(cast(round(({hours}) * 3600) as bigint))"


def _staging() -> dict[str, str]:
    ship_rules = {
        "missing_event_type": "bad", "missing_ts": "bad", "missing_ship_id": "bad", "missing_route_id": "bad",
        "missing_origin_port": "bad", "missing_dest_port": "bad", "missing_lat": "bad or k = 0", "missing_lon": "bad",
        "missing_speed_kn": "bad", "missing_heading": "bad", "wrong_event_type": "false",
        "heading_out_of_range": "not bad and r_heading > 360",
    }
    alert_rules = {
        "missing_event_type": "bad", "missing_ts": "bad", "missing_source": "bad", "missing_severity": "bad",
        "missing_region": "bad", "missing_text": "bad", "missing_confidence": "bad", "wrong_event_type": "false",
        "severity_out_of_range": "not bad and (a_severity < 1 or a_severity > 5)",
        "confidence_out_of_range": "not bad and (a_confidence < 0 or a_confidence > 1)",
        "unknown_source": "not bad and a_source not in ('clima', 'noticias')",
    }

    def counted(topic: str, where: str, bad: str, rules: dict[str, str]) -> str:
        return " union all ".join(
            f"select '{rule}' as rule, count(*) filter (where {test}) as violations, count(*) as checked, '{topic}' as topic "
            f"from (select *, {bad} as bad from raw where {where})" for rule, test in rules.items()
        )

    return {
        "stg_events_parsed": with_ctes("""
            select ship_id, 'route-' || lower(origin_port) || '-' || lower(dest_port) as route_id, origin_port, dest_port,
              r_lat as lat, r_lon as lon, r_speed as speed_kn, r_heading as heading, ts as event_ts
            from raw where feed = 'ship' and not cut and ts_ok is not null""", "raw"),
        "stg_ships_dedup": with_ctes("""
            select * exclude (rn) from (
              select 'ship_position' as event_type, ts_text as ts, ship_id,
                'route-' || lower(origin_port) || '-' || lower(dest_port) as route_id, origin_port, dest_port, r_lat as lat, r_lon as lon,
                r_speed as speed_kn, r_heading as heading, ts_ok as ts_utc, 'Valladolid' as warehouse, 'SKU-SEA-001' as sku,
                30 as reorder_point,
                row_number() over (partition by ship_id, ts_text order by origin_port, dest_port, r_lat, r_lon, r_speed, r_heading) as rn
              from raw where feed = 'ship' and not cut and r_lat is not null) where rn = 1""", "raw"),
        "stg_alerts_routed": with_ctes("""
            select * exclude (rn), case when lower(trim(source)) = 'clima' then 'clima' else 'noticias' end as kind from (
              select 'global_alert' as event_type, ts_text as ts, a_source as source, a_severity as severity, a_region as region, a_text as text,
                a_confidence as confidence, ts_ok as ts_utc,
                row_number() over (partition by ts_text, a_region, a_text order by a_source, a_severity, a_confidence) as rn
              from raw where feed = 'alert' and not cut) where rn = 1""", "raw"),
        "weather_reshaped": with_ctes(f"""
            select * exclude (rn), case when wind_speed_kmh >= 50 then 4 when wind_speed_kmh >= 35 then 3 when wind_speed_kmh >= 20 then 2
                else 1 end as severity, {FLEET} as ingested_at from (
              select ts_text as ts, cast(k % 35 as double) as temperature_c, cast(40 + k % 60 as int) as humidity_pct,
                cast(cast(floor(value) as int) % 70 as double) as wind_speed_kmh, cast(k * 3 as int) as wind_direction_deg,
                cast(k % 4 as int) as weather_code, 'weather_snapshot' as event_type, 'open_meteo' as source,
                'Estrecho de Gibraltar' as region, 'Algeciras' as port_ref, ts_ok as event_ts,
                row_number() over (partition by ts_text order by cast(k % 35 as double), 40 + k % 60, cast(floor(value) as int) % 70, k * 3, k % 4) as rn
              from raw where feed = 'weather' and not cut) where rn = 1""", "raw"),
        "contract_violations": with_ctes(
            counted("datos_crudos", "feed <> 'alert'", "cut or feed = 'weather'", ship_rules) + " union all "
            + counted("alertas_globales", "feed = 'alert'", "cut", alert_rules), "raw"),
        "table_counts": " union all ".join(f"select '{t}' as table_name, count(*) as row_count from {t}" for t in TABLES),
        "weather_severity": with_ctes(
            "select port_ref, severity, count(*) as observations, round(avg(wind_speed_kmh), 6) as avg_wind_kmh from weather group by all",
            "weather"),
        "weather_enriched": with_ctes("select * from enriched", "enriched"),
        "weather_operational_fact": with_ctes(f"select {OPERATIONAL} from operational", "operational"),
        "weather_top20": with_ctes(
            f"select {OPERATIONAL} from operational order by event_ts desc, event_id desc, route_id nulls first limit 20", "operational"),
    }


def _fleet() -> dict[str, str]:
    xy = "round(lat, 6) as lat, round(lon, 6) as lon"
    return {
        "latest_vehicle_state": with_ctes(f"""
            select ship_id, ts as event_ts, route_id, origin_port, dest_port, warehouse, {xy}, speed_kn, heading, stock_on_hand,
              reorder_point, {FLEET} as updated_at from latest""", "latest"),
        "ships_latest_voyage": with_ctes(
            "select * exclude (event_id, inland_hours_estimate) replace (round(lat, 6) as lat, round(lon, 6) as lon) from eta_dates",
            "eta_dates"),
        "ship_eta_table": with_ctes(f"""
            select ship_name, v.ship_id, v.origin_port, v.dest_port, {xy}, fecha_salida_origen, voyage_days_total,
              {_minute(_later(FLEET, "coalesce(eta_hours_estimate, 0)"))} as eta_original,
              {_minute(_later(FLEET, "greatest(0, coalesce(eta_hours_estimate, 0) + 168 + coalesce(delay, 0))"))} as eta_recalculated,
              coalesce(maritime_cost_eur, 0.0::double) as maritime_cost_eur,
              coalesce(b.recommended_mode = 'AEREO_CAMION', false) or coalesce(b.stock_break_risk <> 'COBERTURA_OK', false) as needs_air,
              case when coalesce(b.recommended_mode = 'AEREO_CAMION', false) or coalesce(b.stock_break_risk <> 'COBERTURA_OK', false)
                then 'Riesgo de rotura' else 'Cobertura OK' end as status
            from eta_dates v left join best_air b on b.ship_id = v.ship_id
            left join (select port_ref, max(weather_delay_hours_estimate) as delay from newest_weather group by 1) w on w.port_ref = v.dest_port
            """, "eta_dates", "best_air", "newest_weather"),
        "ships_in_transit": with_ctes("""
            select ship_id, origin_port, dest_port, round(lat, 6) as lat, round(lon, 6) as lon, round(d_o, 6) as distance_to_origin,
              round(d_d, 6) as distance_to_dest,
              'Barco: ' || ship_id || chr(10) || 'Origen: ' || origin_port || chr(10) || 'Destino: ' || dest_port || chr(10) || 'ETA: ' || eta_fecha as tooltip_text
            from (select v.*, abs(v.lat - o.lat) + abs(v.lon - o.lon) as d_o, abs(v.lat - d.lat) + abs(v.lon - d.lon) as d_d
              from eta_dates v left join ports o on o.port_name = v.origin_port left join ports d on d.port_name = v.dest_port)
            where d_o > 0.35 and d_d > 0.35""", "eta_dates", "ports"),
        "ship_positions_interpolated": with_ctes("""
            select p.ship_id, p.route_id, round(a.lat + (b.lat - a.lat) * (p.progress * n - seg), 6) as lat,
              round(a.lon + (b.lon - a.lon) * (p.progress * n - seg), 6) as lon, round(p.progress, 6) as progress
            from (select *, least(cast(floor(progress * n) as int), n - 1) as seg
              from (select v.ship_id, v.route_id, c.n, case when v.voyage_days_total > 0
                    then greatest(0.0::double, least(1.0::double, 1.0::double - v.eta_hours_estimate / (v.voyage_days_total * 24.0::double)))
                    else 0.5::double end as progress
                from voyages v join (select route_id, cast(count(*) - 1 as int) as n from waypoints group by 1) c on c.route_id = v.route_id)) p
            join waypoints a on a.route_id = p.route_id and a.seq = p.seg join waypoints b on b.route_id = p.route_id and b.seq = p.seg + 1
            """, "voyages", "waypoints"),
        "ship_bearing": with_ctes("""
            select l.ship_id, l.origin_port, l.dest_port,
              round(fmod(degrees(atan2(d.lon - o.lon, d.lat - o.lat)) + 360.0::double, 360.0::double), 1) as bearing
            from latest l join ports o on o.port_name = l.origin_port join ports d on d.port_name = l.dest_port""", "latest", "ports"),
        "ship_scenarios": with_ctes("""
            , sc as (select coalesce(string_agg(i.incident, ' + ' order by i.pos), '') as scenario,
                cast(coalesce(sum(i.extra_hours), 0) as double) as extra_hours
              from range(0, 64) m(mask) left join incidents i on (m.mask >> i.pos) & 1 = 1 group by m.mask),
            runs as (select v.ship_id, v.origin_port, v.dest_port, sc.scenario,
                coalesce(b.ship_remaining_hours, v.eta_hours_estimate, 0.0::double) as base_eta, sc.extra_hours,
                coalesce(b.hours_until_stock_break, 0.0::double) as hours_until_stock_break, coalesce(b.air_total_eta_hours, 0.0::double) as air_eta,
                coalesce(b.air_total_cost_eur, 0.0::double) as air_cost
              from voyages v join best_air b on b.ship_id = v.ship_id cross join sc),
            margins as (select *, round(hours_until_stock_break - round(base_eta + extra_hours, 1), 1) as margin_hours,
                round(base_eta + extra_hours, 1) as recalculated_eta from runs)
            select *, case when margin_hours < 96 then 'NO CUBRE' else 'CUBRE' end as cover_status,
              case when margin_hours < 96 then 'AEREO_CAMION' else 'MARITIMO' end as recommended_mode
            from margins""", "voyages", "best_air", "incidents"),
        "ships_by_dest_metrics": with_ctes("""
            select dest_port, count(*) as total_ships, round(avg(speed_kn), 6) as avg_speed, round(avg(lat), 6) as avg_lat,
              round(avg(lon), 6) as avg_lon from ships group by 1""", "ships"),
    }


def _network() -> dict[str, str]:
    costs = """
            select sp.node_id, round(label.cost, 6) as cost, label.hops as hops, previous
            from sp left join prev on prev.node_id = sp.node_id"""

    def cheapest(cost: str, body: str = costs, more: str = "") -> str:
        return with_ctes(body, "trade_edges", recursive=f"""
            links as materialized (select src, dst, {cost} as cost from trade_edges),
            sp(node_id, label) using key (node_id) as (
              select 'NATION_0', {{'cost': 0.0::double, 'hops': 0}}
              union
              select l.dst, min({{'cost': sp.label.cost + l.cost, 'hops': sp.label.hops + 1}})
              from sp join links l on l.src = sp.node_id left join recurring.sp known on known.node_id = l.dst
              where known.node_id is null or {{'cost': sp.label.cost + l.cost, 'hops': sp.label.hops + 1}} < known.label group by l.dst),
            prev as (select e.node_id, min(l.src) as previous from links l join sp s on s.node_id = l.src join sp e on e.node_id = l.dst
              where s.label.cost + l.cost = e.label.cost and s.label.hops + 1 = e.label.hops group by 1){more}""")

    return {
        "graph_edges": with_ctes("select src, dst, round(weight, 6) as weight from net_edges", "net_edges"),
        "graph_vertices": with_ctes("select id, type from net_nodes", "net_nodes"),
        "graph_degree": with_ctes("""
            select node_id, type as node_type, count(*) as degree, case when count(*) >= 2 then 'NODO_CRITICO' else 'NODO_NORMAL' end as criticality_level
            from (select src as node_id from net_edges union all select dst from net_edges) left join net_nodes on id = node_id group by 1, 2
            """, "net_edges", "net_nodes"),
        "trade_centrality": with_ctes("""
            select node_id, type as node_type, count(*) as degree, case when count(*) >= 2 then 'NODO_CRITICO' else 'NODO_NORMAL' end as criticality_level,
              case when count(*) >= 2 then 'Congestionado' else 'Fluido' end as state
            from (select src as node_id from trade_edges union all select dst from trade_edges) left join trade_nodes on id = node_id group by 1, 2
            """, "trade_edges", "trade_nodes"),
        "graph_hops": with_ctes(
            "select id as node_id, type as node_type, hops from trade_nodes left join h on h.node_id = id", "trade_edges", "trade_nodes",
            recursive="""h(node_id, hops) using key (node_id) as (
              select 'NATION_0', 0
              union
              select e.dst, min(h.hops) + 1 from h join trade_edges e on e.src = h.node_id
              left join recurring.h known on known.node_id = e.dst where known.node_id is null group by e.dst)"""),
        "graph_landmark_hops": with_ctes(
            "select node_id, landmark, hops from h", "trade_edges", recursive="""h(node_id, landmark, hops) using key (node_id, landmark) as (
              select * from (values ('NATION_0', 'NATION_0', 0), ('NATION_7', 'NATION_7', 0)) t(node_id, landmark, hops)
              union
              select e.src, h.landmark, min(h.hops) + 1 from h join trade_edges e on e.dst = h.node_id
              left join recurring.h known on known.node_id = e.src and known.landmark = h.landmark where known.node_id is null
              group by e.src, h.landmark)"""),
        "graph_route_times": with_ctes("""
            select 'Shanghai' as node_id, 0.0::double as cost, 0 as hops, null as previous
            union all select dst, round(weight, 6), 1, 'Shanghai' from sea_edges where src = 'Shanghai'
            union all select 'Valladolid', round(min(weight) + 8, 6), 2, arg_min(dst, weight) from sea_edges where src = 'Shanghai'
            union all select l.dst, round(min(weight) + 8 + l.hours, 6), 3, 'Valladolid'
              from sea_edges, (values ('Douai', 60.0::double), ('Cleon', 67.2::double)) l(dst, hours) where src = 'Shanghai' group by l.dst, l.hours
            """, "sea_edges"),
        "graph_top_nodes": with_ctes("""
            select node_id, type as node_type, count(*) as degree, case when count(*) >= 2 then 'NODO_CRITICO' else 'NODO_NORMAL' end as criticality_level
            from (select src as node_id from trade_edges union all select dst from trade_edges) left join trade_nodes on id = node_id group by 1, 2
            order by degree desc, node_id limit 20""", "trade_edges", "trade_nodes"),
        "graph_shortest_time": cheapest("weight"),
        "graph_safest": cheapest("risk * 0.75::double + weight / 1000.0::double * 0.25::double"),
        "graph_route_nodes": cheapest(
            "weight", "select node_id, cast(max(back) over (partition by node_id) - back as int) as stop, place from walk", """,
            walk(node_id, place, back) as (
              select node_id, node_id, 0 from sp
              union all
              select w.node_id, p.previous, w.back + 1 from walk w join prev p on p.node_id = w.place)"""),
        "graph_time_against_risk": with_ctes("""
            , legs as (select dst, weight as t, 1.0::double as r from sea_edges where src = 'Shanghai'
              union all select dst, weight * 0.75::double, 2.5::double from sea_edges where src = 'Shanghai'),
            sums as (
              select 'Shanghai' as node_id, 0.0::double as t, 0.0::double as r union all select * from legs
              union all select 'Valladolid', t + 8, r from legs
              union all select l.dst, t + 8 + l.hours, r from legs, (values ('Douai', 60.0::double), ('Cleon', 67.2::double)) l(dst, hours)),
            labels as (select distinct node_id, round(t, 9) as t, round(r, 9) as r from sums)
            select node_id, round(t, 6) as first, round(r, 6) as second from labels a
            where not exists (select 1 from labels b where b.node_id = a.node_id and b.t <= a.t and b.r <= a.r and (b.t < a.t or b.r < a.r))
            """, "sea_edges"),
        "graph_dynamic_weights": with_ctes("""
            select src, dst, round(weight / 24.0::double + case when 1.0::double - risk = 0 then null else 1.0::double / (1.0::double - risk) end
              + 8.0::double / 24.0::double, 6) as dynamic_weight from trade_edges""", "trade_edges"),
        "graph_components": """
            select 'C' || c_custkey as node_id, 'C' || c_custkey as component from customer
            union all select 'O' || o_orderkey, 'C' || o_custkey from orders""",
        "graph_pagerank": with_ctes(
            "select id as node_id, round(r, 8) as pagerank from pr where i = (select max(i) from pr)", "trade_edges", "trade_nodes", recursive="""
            nodes as materialized (select id from trade_nodes),
            n as materialized (select count(*)::double as n from nodes),
            outs as materialized (select src, count(*)::double as links from trade_edges group by 1),
            shares as materialized (select e.src, e.dst, count(*) / any_value(o.links) as share from trade_edges e join outs o using (src) group by 1, 2),
            pr(i, id, r, change) as (
              select 0, id, 1.0::double / (select n from n), 1.0::double from nodes
              union all
              select i, id, r, sum(abs(r - old)) over () from (
                select p.i + 1 as i, p.id, p.r as old, 0.15::double / (select n from n) + 0.85::double * (coalesce(x.got, 0)
                  + (sum(case when o.src is null then p.r else 0 end) over ()) / (select n from n)) as r
                from pr p left join outs o on o.src = p.id
                left join (select dst, sum(r * share) as got from shares join pr on pr.id = src group by 1) x on x.dst = p.id
                where p.change > 1e-9))"""),
        "route_risk": with_ctes("""
            select * replace (round(time_shanghai_to_via_hours, 6) as time_shanghai_to_via_hours,
              round(estimated_total_hours, 6) as estimated_total_hours, round(risk_score, 6) as risk_score) from risk""", "risk"),
    }


def _alerts() -> dict[str, str]:
    return {
        "route_alerts": with_ctes(f"""
            select sha256(via_port || chr(31) || '2024-02-01 00:00:00') as alert_id, via_port as dest_port, risk_level, round(risk_score, 6) as risk_score,
              severity, recommendation, false as email_sent, {FLEET} as created_at
            from worst_alerts where severity >= 3""", "worst_alerts"),
        "alerts_by_region": with_ctes("select region, source, count(*) as alerts from alerts group by all", "alerts"),
        "alert_type_mix": with_ctes("select text as alert_type, count(*) as count from alerts group by 1", "alerts"),
        "fact_alerts": with_ctes(ALERT_ROUNDED, "fact_alerts"),
        "alerts_top20": with_ctes(ALERT_ROUNDED + " order by severity desc, via_port, origin_port limit 20", "fact_alerts"),
        "critical_alerts": with_ctes(ALERT_ROUNDED + " where severity >= 4", "fact_alerts"),
        "alerts_risk_stock_summary": with_ctes("""
            select risk_level, stock_status, count(*) as count, round(avg(risk_score), 6) as avg_risk_score, round(avg(severity), 6) as avg_severity
            from fact_alerts group by 1, 2""", "fact_alerts"),
        "risk_summary": with_ctes("""
            select count(*) filter (where severity >= 4) as critical, count(*) filter (where severity >= 2) as medium,
              (select round(coalesce(avg(weather_delay_hours_estimate), 0), 6) from operational) as avg_delay from fact_alerts
            """, "fact_alerts", "operational"),
        "route_alert_outbox": with_ctes(f"""
            select origin_port, via_port as dest_port, risk_level, round(risk_score, 6) as risk_score, severity, recommendation, name as severity_label,
              '[ALERTA ' || name || '] Riesgo en ruta ' || via_port as subject, false as email_sent, {FLEET} as created_at
            from (select *, case severity when 3 then 'MEDIO' when 4 then 'ALTO' when 5 then 'CRITICO' else 'DESCONOCIDO' end as name
              from fact_alerts) where severity >= 3""", "fact_alerts"),
        "critical_reference_outbox": with_ctes("""
            select article_ref, article_name, total_stock_pieces, safety_stock_min, 'CRÍTICO' as stock_status, 'critical' as row_class
            from articles where total_stock_pieces <= safety_stock_min""", "articles"),
        "daily_summary": with_ctes(f"""
            select count(*) as total_alerts,
              coalesce((select string_agg(p, ', ' order by p) from (select distinct via_port as p from fact_alerts where severity >= 4)), '') as critical_routes,
              round(avg(risk_score), 2) as avg_risk_score, (select count(*) from latest) as total_ships_tracked,
              cast({FLEET} as date) as summary_date from fact_alerts""", "fact_alerts", "latest"),
        "recent_alerts": with_ctes(f"select * from alerts where ts >= {FLEET} - interval 48 hours", "alerts"),
    }


def _contingency() -> dict[str, str]:
    order = "air_total_cost_eur, air_total_eta_hours, air_option_id"
    flights = "(select ship_id, air_option_id, air_total_cost_eur as cost, air_total_eta_hours as eta from air_options)"
    verdicts = f"""
        select ship_id, air_option_id, cost as flight_cost_eur, eta as flight_eta_hours, {_minute(FLEET + " + interval 4 days")} as stock_rupture_date,
          case when {_later(FLEET, "eta")} >= {FLEET} + interval 4 days then 'NO LLEGA'
            when cost = (select min(cost) from {flights}) then 'ÓPTIMA' else 'VIABLE' end as recommendation
        from {flights}"""
    return {
        "air_recovery_options": with_ctes("select * from best_air", "best_air"),
        "air_recovery_prefer_air": with_ctes(f"""
            select * exclude (rn, origin_city) from (select *, row_number() over (partition by ship_id
              order by recommended_mode = 'AEREO_CAMION' desc, {order}) as rn from air_options where origin_city = origin_port) where rn = 1
            """, "air_options"),
        "air_option_rows": with_ctes("select * exclude (origin_city) from air_options", "air_options"),
        "air_recovery_top20": with_ctes("select * from best_air order by time_saved_hours desc nulls last, ship_id limit 20", "best_air"),
        "air_routes_overcost": with_ctes("""
            select r.route_id, c.air_recovery_id, c.origin_airport, c.dest_city, c.air_eta_hours, c.air_cost_eur, c.truck_km_to_warehouse,
              r.maritime_cost_eur, round(c.air_cost_eur - r.maritime_cost_eur, 2) as air_overcost_eur, coalesce(n.n, 0) as ships_on_route
            from corridors c left join routes r on r.dest_port = c.dest_city
            left join (select route_id, count(*) as n from latest group by 1) n on n.route_id = r.route_id""", "corridors", "routes", "latest"),
        "air_recovery_estimate": with_ctes("""
            select ship_id, origin_port, dest_port, eta as ship_remaining_hours, air_eta as air_total_eta_hours,
              greatest(0.0::double, round(eta - air_eta, 1)) as time_saved_hours, 12000.0::double + idx * 850.0::double as air_total_cost_eur,
              case when stock_on_hand <= reorder_point then 'AEREO_CAMION' else 'MARITIMO' end as recommended_mode,
              case when stock_on_hand <= reorder_point then 'ROTURA_STOCK' else 'COBERTURA_OK' end as stock_break_risk,
              greatest(48.0::double, round(reorder_point * 3.0::double, 1)) as hours_until_stock_break
            from (select *, eta_hours_estimate as eta, greatest(24.0::double, round(eta_hours_estimate * 0.35::double, 1)) as air_eta,
                row_number() over (order by ship_id) - 1 as idx from voyages)""", "voyages"),
        "air_contingency_orders": with_ctes(f"""
            select c.article_ref, c.order_id, 'Shanghai -> ' || b.air_dest_city || ' + camion Valladolid' as air_alternative,
              {_minute("c.arrival_valladolid")} as arrival_valladolid, round(b.air_total_cost_eur, 2) as air_overcost_eur, c.customer_city,
              c.industrial_week, c.cover_status
            from coverage c join best_by_port b on b.dest_port = c.inbound_port where c.cover_status = 'NO CUBRE'""", "coverage", "best_by_port"),
        "flight_verdict": with_ctes(verdicts, "air_options"),
        "best_flight": with_ctes(
            f"select flight_cost_eur, flight_eta_hours, recommendation from ({verdicts}) where recommendation <> 'NO LLEGA' "
            "order by flight_cost_eur, flight_eta_hours limit 1", "air_options"),
        "article_flight_verdicts": with_ctes("""
            select * exclude (in_time), case when not in_time then 'NO LLEGA'
              when flight_cost_eur = (select min(flight_cost_eur) from flight_list) then 'ÓPTIMA' else 'VIABLE' end as recommendation
            from article_flights""", "article_flights"),
        "article_best_flight": with_ctes("""
            select a.article_ref, a.stock_rupture_date, f.flight_number, f.airport, f.flight_cost_eur, f.flight_eta_hours, a.flights_in_time
            from (select article_ref, any_value(stock_rupture_date) as stock_rupture_date, cast(count(*) filter (where in_time) as int) as flights_in_time
              from article_flights group by 1) a
            left join (select * from article_flights where in_time
              qualify row_number() over (partition by article_ref order by flight_cost_eur, flight_eta_hours, flight_number) = 1) f using (article_ref)
            """, "article_flights"),
        "last_mile_options": with_ctes(f"""
            select ship_id, air_option_id, "option", round(cost + truck_cost_eur, 2) as total_cost_eur, round(eta + truck_hours, 1) as total_eta_hours,
              truck_cost_eur = (select min(truck_cost_eur) from last_mile) as is_cheapest, round(cost + truck_cost_eur, 2) > 15000 as high_cost
            from {flights} cross join last_mile""", "air_options", "last_mile"),
        "truck_plan": with_ctes(f"""
            select ship_id, air_option_id, route, carrier, license_plate, round(cost + truck_cost_eur, 2) as total_cost_eur,
              round(truck_eta_hours + 15.0::double, 1) as total_eta_hours, truck_cost_eur = (select min(truck_cost_eur) from trucks) as is_cheapest
            from {flights} cross join trucks""", "air_options", "trucks"),
        "executive_air_rule": with_ctes("""
            select saved as air_time_saved_hours, cost as air_investment_eur, saved >= 24 and cost <= 18000 as air_recommended
            from (select greatest(round((select avg(eta_hours_estimate) from voyages) - avg(air_total_eta_hours), 1), 0.0::double) as saved,
              round(avg(air_total_cost_eur), 0) as cost from best_air)""", "voyages", "best_air"),
        "sea_air_decisions": with_ctes("""
            select ship_id, origin_port, dest_port, ship_remaining_hours, air_total_eta_hours, time_saved_hours, air_total_cost_eur, recommended_mode,
              case when recommended_mode = 'AEREO_CAMION' then 'AEREO' else 'MARITIMO' end as mode_label
            from best_air where time_saved_hours is not null and air_total_cost_eur is not null""", "best_air"),
        "route_map": with_ctes("""
            select r.dest_port, r.origin_port, r.route_id, r.maritime_cost_eur, o.lat as origin_lat, o.lon as origin_lon, d.lat as dest_lat,
              d.lon as dest_lon, coalesce(a.severity, 1) as severity, a.risk_level,
              case when coalesce(a.severity, 1) >= 4 then 'critical' when coalesce(a.severity, 1) >= 3 then 'warning' else 'normal' end as color_class
            from routes r left join ports o on o.port_name = r.origin_port left join ports d on d.port_name = r.dest_port
            left join worst_alerts a on a.via_port = r.dest_port""", "routes", "ports", "worst_alerts"),
        "corridor_pairs": with_ctes("""
            select o.port_name as origin_port, d.name as dest_port, o.lat as origin_lat, o.lon as origin_lon, d.lat as dest_lat, d.lon as dest_lon,
              d.prefix || o.port_name || ' -> ' || d.name as route_name, d.line_kind, coalesce(n.n, 0) as positions
            from ports o cross join (select port_name as name, lat, lon, '' as prefix, 'route' as line_kind from ports where port_type = 'port'
              union all select 'Valladolid', 41.6528::double, -4.7246::double, 'Desvío ', 'deviation') d
            left join (select origin_port, dest_port, count(*) as n from ships group by 1, 2) n on n.origin_port = o.port_name and n.dest_port = d.name
            where o.port_type = 'origin_hub'""", "ports", "ships"),
    }


def _stock() -> dict[str, str]:
    table = """select stock_status, article_ref, article_name, pieces_per_pack, 0 as total_stock_packs, total_stock_pieces, safety_stock_min,
          ordered_pieces, available_after_orders, round(total_stock_pieces * unit_volume_m3, 6) as volume_m3,
          round(total_stock_pieces * unit_weight_kg, 6) as weight_kg from """
    status = """select article_ref, coalesce({pick}, 'CUBRE') as worst_status, count(*) filter (where cover_status <> 'CUBRE') as weeks_at_risk,
          case when count(*) filter (where cover_status <> 'CUBRE') = 0 then 'Maritimo' else 'Aereo' end as transport_mode from horizon group by 1"""
    fly = """select article_ref, article_name, greatest(0, cast(trunc(safety_stock_min * 1.5::double - total_stock_pieces) as bigint)) as quantity_to_fly,
          total_stock_pieces, safety_stock_min, pieces_per_pack from articles where total_stock_pieces <= safety_stock_min * 1.2::double"""
    flown = f"""select article_ref, article_name, quantity_to_fly, total_stock_pieces, safety_stock_min,
          round(quantity_to_fly / pieces_per_pack::double * 0.02::double, 6) as volume_estimate_m3, quantity_to_fly * 0.5::double as weight_estimate_kg
        from ({fly})"""
    return {
        "stock_context": with_ctes("select * exclude (unit_volume_m3, unit_weight_kg, lead_time_days) from stock_ctx", "stock_ctx"),
        "stock_table": with_ctes(table + "stock_ctx", "stock_ctx"),
        "stock_table_douai_iw20": with_ctes(table + """
            (select *, case when available_after_orders <= safety_stock_min then 'ROJO'
                when available_after_orders <= safety_stock_min + 2 * daily_consumption_avg then 'NARANJA' else 'VERDE' end as stock_status
             from (select a.*, cast(coalesce(o.n, 0) as bigint) as ordered_pieces,
                 cast(total_stock_pieces - coalesce(o.n, 0) as bigint) as available_after_orders
               from articles a left join (select article_ref, sum(ordered_pieces) as n from customer_orders
                 where customer_city = 'Douai' and industrial_week = 'IW20' group by 1) o using (article_ref)))""", "articles", "customer_orders"),
        "stock_by_family": with_ctes("""
            select article_family, cast(sum(total_stock_pieces) as bigint) as total_stock_pieces, cast(sum(safety_stock_min) as bigint) as safety_stock_min,
              sum(total_stock_pieces) <= sum(safety_stock_min) as below_safety from articles group by 1""", "articles"),
        "warehouse_capacity": with_ctes("""
            select *, round(greatest(0.0::double, 100.0::double - capacity_used_pct), 2) as capacity_free_pct
            from (select cast(sum(total_stock_pieces) as bigint) as current_stock, round(sum(total_stock_pieces * unit_volume_m3), 2) as total_volume_m3,
              round(sum(total_stock_pieces * unit_weight_kg), 2) as total_weight_kg,
              round(cast(sum(total_stock_pieces) as double) * 100.0::double / 10000, 2) as capacity_used_pct from articles)""", "articles"),
        "orders_coverage": with_ctes("select * from coverage", "coverage"),
        "stock_horizon": with_ctes("select * from horizon", "horizon"),
        "scheduled_stock_horizon": with_ctes("select * from horizon", "horizon"),
        "stock_horizon_mode": with_ctes(
            status.format(pick="arg_min(cover_status, industrial_week) filter (where cover_status <> 'CUBRE')"), "horizon"),
        "stock_horizon_worst": with_ctes(
            status.format(pick="case when bool_or(cover_status = 'NO CUBRE') then 'NO CUBRE' when bool_or(cover_status = 'ALERTA') then 'ALERTA' end"),
            "horizon"),
        "stock_rupture_timeline": with_ctes(f"""
            select article_ref, 'Cobertura stock Valladolid' as task_name, {ORDERS} as start_date, {_later(ORDERS, "hours_to_stockout")} as end_date,
              'Stock window' as industrial_week, 'stock' as transport_mode from stock_ctx
            union all
            select article_ref, 'Llegada maritima estimada', {ORDERS}, {_later(ORDERS, "coalesce(b.ship_remaining_hours, 240.0::double)")}, 'Sea ETA', 'sea_eta'
            from stock_ctx s left join best_by_port b on b.dest_port = s.inbound_port""", "stock_ctx", "best_by_port"),
        "article_gantt": """
            select cast(l_partkey as varchar) as article_ref, cast(l_orderkey as varchar) || '-' || cast(l_linenumber as varchar) as task_name,
              cast(o_orderdate as date) as start_date, cast(l_shipdate as date) as end_date,
              'IW' || lpad(cast(weekofyear(o_orderdate) as varchar), 2, '0') as industrial_week,
              case l_returnflag when 'A' then 'air' when 'N' then 'sea' else 'truck' end as transport_mode,
              cast(date_diff('day', cast(o_orderdate as date), cast(l_shipdate as date)) as int) as duration_days
            from lineitem join orders on l_orderkey = o_orderkey""",
        "weekly_demand": with_ctes("""
            select w.industrial_week, cast(coalesce(sum(o.ordered_pieces), 0) as bigint) as ordered_pieces
            from (select distinct industrial_week from customer_orders) w
            left join customer_orders o on o.industrial_week = w.industrial_week and o.customer_city = 'Douai' group by 1""", "customer_orders"),
        "distinct_weeks": with_ctes("select distinct industrial_week from customer_orders", "customer_orders"),
        "demand_projection": with_ctes("""
            , t as (select cast(sum(total_stock_pieces) as double) as t,
                greatest(count(*) filter (where total_stock_pieces <= safety_stock_min), 1)::double as r from articles),
            p as (select cast(w as int) as week, t * (0.11::double + w * 0.012::double) as d, t - w * t * (0.075::double + r * 0.004::double) as c
              from t, range(1, 11) x(w))
            select week, 'Demanda' as series, round(greatest(d, 20.0::double), 0) as value from p
            union all select week, 'Cobertura', round(greatest(c, 10.0::double), 0) from p""", "articles"),
        "embarkation_list": with_ctes(flown, "articles"),
        "embarkation_totals": with_ctes(f"""
            select count(*) as critical_articles, round(sum(weight_estimate_kg), 2) as total_weight_kg, round(sum(volume_estimate_m3), 2) as total_volume_m3
            from ({flown})""", "articles"),
    }


def _indicators() -> dict[str, str]:
    closed = "where window_end <= (select max(date_trunc('milliseconds', ts)) from {source}) - interval 15 minutes"
    ship = "select * replace (round(avg_speed, 9) as avg_speed, round(speed_std, 9) as speed_std, round(avg_lat, 9) as avg_lat, round(avg_lon, 9) as avg_lon) from ship_windows "
    alert = "select * replace (round(avg_severity, 9) as avg_severity, round(avg_confidence, 9) as avg_confidence) from alert_windows "
    risk = """
            select window_start, window_end, dest_port, route_id, round(severity_avg, 6) as severity_avg, round(speed_std, 6) as speed_std, ship_count,
              case when score >= 3.5 then 'CRITICO' when score >= 2.0 then 'ALTO' when score >= 1.0 then 'MEDIO' else 'BAJO' end as risk_class
            from (select s.*, coalesce(a.severity_avg, 0) as severity_avg,
                0.7::double * round(coalesce(a.severity_avg, 0), 6) + 0.3::double * (coalesce(round(s.speed_std, 6), 0.0::double) / 10.0::double) as score
              from ship_windows s left join (select time_bucket(interval '15 minutes', ts) as window_start, avg(severity) as severity_avg
                from alerts group by 1) a on a.window_start = s.window_start)"""
    return {
        "control_tower_kpis": with_ctes("""
            select round(avg(round(available_after_orders / daily_consumption_avg::double, 1)), 1) as doh,
              round(avg(case when total_stock_pieces = 0 then null else safety_stock_min / total_stock_pieces::double end) * 100, 1) as security_level,
              count(*) filter (where available_after_orders <= safety_stock_min) as critical_refs,
              (select round(avg(eta_hours_estimate), 1) from voyages) as eta_avg,
              (select round(avg(case when order_status = 'sea_committed' then 1.0::double else 0.0::double end) * 100, 1) from customer_orders) as otif,
              (select round(avg(time_saved_hours), 1) from best_air) as avg_time_saved,
              (select recommended_mode from best_air order by time_saved_hours desc nulls last, ship_id limit 1) as best_mode
            from stock_ctx""", "stock_ctx", "voyages", "customer_orders", "best_air"),
        "executive_kpis": with_ctes("""
            select count(*) filter (where total_stock_pieces <= safety_stock_min) as references_at_risk, round(avg(lead_time_days), 1) as lead_time_avg,
              (select count(*) from latest) as fleet_size, (select count(*) from fact_alerts where severity >= 4) as critical_alerts
            from articles""", "articles", "latest", "fact_alerts"),
        "otif_by_customer": with_ctes("""
            select *, 95.0::double as target_pct, case when otif_pct >= 95 then 'OPTIMO' else 'RIESGO' end as status
            from (select customer_city, round(avg(case when order_status = 'sea_committed' then 1.0::double else 0.0::double end) * 100, 1) as otif_pct,
              count(*) as orders from customer_orders group by 1)""", "customer_orders"),
        "ml_outcome_rows": with_ctes("""
            select f.*, round((epoch_us(a.ts) - epoch_us(f.ts)) / 3.6e9::double, 6) as hours_to_arrival,
              round((epoch_us(a.ts) - epoch_us(f.ts)) / 3.6e9::double, 6) > f.planned_hours as late
            from (select * from known_at where remaining_share > 0.05) f
            asof left join (select ship_id, ts from known_at where remaining_share <= 0.05) a on a.ship_id = f.ship_id and f.ts < a.ts
            """, "known_at"),
        "windowed_ship_metrics": with_ctes(ship, "ship_windows"),
        "windowed_alert_metrics": with_ctes(alert, "alert_windows"),
        "window_risk_class": with_ctes(risk, "ship_windows", "alerts"),
        "stream_window_risk": with_ctes(risk + closed.format(source="alerts"), "ship_windows", "alerts"),
        "stream_ship_metrics": with_ctes(ship + closed.format(source="ships"), "ship_windows", "ships"),
        "stream_alert_metrics": with_ctes(alert + closed.format(source="alerts"), "alert_windows", "alerts"),
        "stream_weather_fact": with_ctes(f"select {OPERATIONAL.replace('operational_ts, ', '')} from operational", "operational"),
        "stream_latest_state": with_ctes("""
            select ship_id, ts as event_ts, route_id, origin_port, dest_port, warehouse, round(lat, 6) as lat, round(lon, 6) as lon, speed_kn, heading,
              stock_on_hand, reorder_point from latest""", "latest"),
        "stream_keyed_state": with_ctes("""
            select ship_id, ts as event_ts, route_id, origin_port, dest_port, warehouse, round(lat, 6) as lat, round(lon, 6) as lon, speed_kn, heading,
              stock_on_hand, reorder_point from latest""", "latest"),
        "landed_ships_staged": _staging()["stg_ships_dedup"],
        "landed_ships_incremental": _staging()["stg_ships_dedup"],
        "stream_raw_landing": with_ctes("""
            select kind, dt, count(*) as messages
            from (select case when feed <> 'alert' then 'ships' when not cut and lower(trim(a_source)) = 'clima' then 'clima' else 'noticias' end as kind,
              case when cut or feed = 'weather' or ts_ok is null then 'unknown' else strftime(ts_ok, '%Y-%m-%d') end as dt from raw)
            group by 1, 2""", "raw"),
    }


def all_sql() -> dict[str, str]:
    return {**_staging(), **_fleet(), **_network(), **_alerts(), **_contingency(), **_stock(), **_indicators()}
