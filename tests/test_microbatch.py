"""The scheduled run end to end on the sample voyages."""

import json

import pytest

from harborline import schemas
from harborline.operators import staging
from harborline.plans import microbatch
from harborline.sources.writers import read_bundle_section
from tests.conftest import SAMPLE_POSITIONS, as_lines

ALERTS = {
    "clima": [("18:42", 3, "Estrecho de Gibraltar", "Viento moderado"), ("18:47", 2, "Costa Mediterranea", "Oleaje moderado")],
    "noticias": [("18:43", 4, "Estrecho de Gibraltar", "Congestion puntual"), ("18:48", 2, "Costa Mediterranea", "Retrasos menores")],
}


@pytest.fixture(scope="module")
def finished(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("run")

    def land(kind, events):
        folder = root / f"raw/{kind}/2026/03/26/1840"
        folder.mkdir(parents=True)
        (folder / "part.jsonl").write_text("".join(json.dumps(e) + "\n" for e in events))

    land("ships", [*SAMPLE_POSITIONS, SAMPLE_POSITIONS[0]])
    for kind, rows in ALERTS.items():
        land(kind, [{"event_type": "x", "ts": f"2026-03-26T{t}:00", "source": "s", "severity": s, "region": r, "text": x, "confidence": 0.8}
                    for t, s, r, x in rows])
    weather = as_lines(spark, *[
        {"ts": "2026-03-26T18:00:00", "temperature_c": 18.0, "humidity_pct": 70, "wind_speed_kmh": wind, "port_ref": port, "source": "open_meteo",
         "event_type": "weather_snapshot"} for port, wind in [("Algeciras", 38.0), ("Valencia", 12.0), ("Barcelona", 22.0)]])
    run = microbatch.Run(spark, f"{root}/raw", f"{root}/base", "2026-03-27 00:00:00", version=1)
    status = microbatch.run_all(run, staging.parse_json(weather, schemas.WEATHER_SNAPSHOT))
    return run, {r.section: r.status for r in status.collect()}


def test_all_sections_are_filled(finished):
    assert len(finished[1]) == 14 and set(finished[1].values()) == {"ok"}


def test_tables(finished):
    run, _ = finished
    counts = {n: run.read(n).count() for n in (
        "stg_ships", "stg_alerts_clima", "stg_alerts_noticias", "fact_weather_operational", "fact_route_risk", "fact_alerts",
        "fact_graph_hops", "fact_graph_centrality", "fact_air_recovery_options", "vehicle_latest_state")}
    assert counts == {"stg_ships": 6, "stg_alerts_clima": 2, "stg_alerts_noticias": 2, "fact_weather_operational": 6, "fact_route_risk": 6,
                      "fact_alerts": 6, "fact_graph_hops": 6, "fact_graph_centrality": 6, "fact_air_recovery_options": 6, "vehicle_latest_state": 6}
    hops = {r.node_id: r.hops_from_shanghai for r in run.read("fact_graph_hops").collect()}
    assert hops["Valladolid"] == 2 and hops["Yokohama"] is None


def test_columns_of_the_published_tables(finished):
    run, _ = finished
    assert len(run.read("fact_weather_operational").columns) == 18
    assert len(run.read("fact_air_recovery_options").columns) == 25
    assert run.read("vehicle_latest_state").columns == schemas.VEHICLE_LATEST_STATE.names


def test_bundle_reads_back(spark, finished):
    run, _ = finished
    ships = read_bundle_section(spark, run.path("bundle"), "ships_latest").collect()
    assert [s.ship_name for s in ships] == [
        "MSC Gulsun", "CMA CGM Jacques Saade", "Ever Golden", "ONE Apus", "Maersk Eindhoven", "Ever Given"]


def test_a_stage_can_run_again(finished):
    run, _ = finished
    before = run.read("fact_alerts").orderBy("origin_port", "via_port").collect()
    microbatch.alert_facts(run)
    assert run.read("fact_alerts").orderBy("origin_port", "via_port").collect() == before
