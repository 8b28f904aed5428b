import json
import uuid

import pytest
from pyspark.sql import functions as F

from harborline import schemas
from harborline.operators import staging
from harborline.sources.readers import message_stream
from harborline.sources.tables import complete_versions, read_latest_version
from harborline.streaming import queries, windows
from tests.conftest import as_lines, position


def write_batch(folder, name, events):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"{name}.txt").write_text("".join(json.dumps(e) + "\n" for e in events))


def ships_stream(spark, folder):
    return staging.ship_events(message_stream(spark, str(folder), "text", per_trigger=1))


def at(minute, ship="ship-001", speed=10.0, hour=10, **more):
    return position(ship=ship, ts=f"2026-03-26T{hour:02d}:{minute:02d}:00", speed=speed, **more)


@pytest.fixture
def run(spark, tmp_path):
    inbox, out = tmp_path / "in", str(tmp_path / "out")

    def go():
        query = queries.ship_metrics_query(ships_stream(spark, inbox), f"{out}/table", queries.checkpoint_path(out, "ships"))
        query.awaitTermination()
        return spark.read.parquet(f"{out}/table")

    return inbox, go


def keyed(df):
    rows = df.withColumn("speed_std", F.round("speed_std", 9)).collect()
    return {(r.window_start.strftime("%H:%M"), r.dest_port): (r.ship_count, r.avg_speed, r.speed_std) for r in rows}


def test_closed_windows_only_then_the_rest_after_restart(run):
    inbox, go = run
    write_batch(inbox, "a", [at(1, speed=10.0), at(2, ship="ship-002", speed=14.0), at(20), at(50)])
    first = keyed(go())
    # The watermark stands at 10:35, so 10:00 and 10:15 are closed and 10:45 is still open.
    assert set(first) == {("10:00", "Algeciras"), ("10:15", "Algeciras")}
    assert first["10:00", "Algeciras"][:2] == (2, 12.0) and first["10:15", "Algeciras"][2] is None
    write_batch(inbox, "b", [at(30, hour=11)])
    second = keyed(go())
    assert set(second) == set(first) | {("10:45", "Algeciras")}
    assert keyed(go()) == second


def test_late_rows_are_dropped(run):
    inbox, go = run
    write_batch(inbox, "a", [at(1), at(59)])
    go()
    write_batch(inbox, "b", [at(2, speed=99.0), at(59, hour=12)])
    rows = keyed(go())
    assert rows["10:00", "Algeciras"][:2] == (1, 10.0)


def test_stream_equals_batch_for_closed_windows(spark, run):
    inbox, go = run
    events = [at(m, ship=f"ship-{m:03d}", speed=float(m % 7), dest=d) for m in range(0, 60) for d in ("Algeciras", "Valencia")]
    write_batch(inbox, "a", events)
    write_batch(inbox, "b", [at(0, hour=13)])
    batch = keyed(windows.ship_metrics(staging.ship_events(as_lines(spark, *events))))
    assert keyed(go()) == batch and len(batch) == 8


def test_mixed_topic_is_filtered(spark, tmp_path):
    write_batch(tmp_path / "in", "a", [at(1), {"current": {"time": "x"}}, {"event_type": "global_alert", "ts": "2026-03-26T10:00:00"}])
    out = str(tmp_path / "out")
    seen = []
    queries.start_batches(ships_stream(spark, tmp_path / "in"), lambda df, i: seen.append(df.count()), queries.checkpoint_path(out, "x")).awaitTermination()
    assert seen == [1]


def test_alert_windows(spark):
    lines = as_lines(spark, *[
        {"event_type": "global_alert", "ts": f"2026-03-26T10:{m:02d}:00", "source": "clima", "severity": s, "region": "Suez", "text": "t", "confidence": 0.5}
        for m, s in [(1, 2), (14, 4), (15, 5)]])
    rows = windows.alert_metrics(staging.alert_events(lines)).orderBy("window_start").collect()
    assert [(r.avg_severity, r.alert_count) for r in rows] == [(3.0, 2), (5.0, 1)]


def test_window_risk_weights_alerts(spark):
    ships = spark.createDataFrame([("w", "w2", "Algeciras", "r", 10.0, 2)], "window_start string, window_end string, dest_port string, route_id string, speed_std double, ship_count long")
    alerts = spark.createDataFrame([("w", 5.0, 3), ("w", 1.0, 1)], "window_start string, avg_severity double, alert_count long")
    row = windows.window_risk(ships, alerts).first()
    assert (row.severity_avg, row.risk_class) == (4.0, "ALTO")


def test_latest_state_merge_order_and_replay(spark, tmp_path):
    base, inbox = str(tmp_path / "state"), tmp_path / "in"
    write_batch(inbox, "a", [at(10), at(5), at(7, ship="ship-002")])

    def go():
        queries.latest_state_query(ships_stream(spark, inbox), base, queries.checkpoint_path(base, "state")).awaitTermination()
        return {r.ship_id: r.event_ts.minute for r in queries.read_state(spark, base).collect()}

    assert go() == {"ship-001": 10, "ship-002": 7}
    write_batch(inbox, "b", [at(9), at(30, ship="ship-002"), at(1, ship="ship-003")])
    assert go() == {"ship-001": 10, "ship-002": 30, "ship-003": 1}
    versions = complete_versions(spark, base)
    # A replayed batch rewrites its own version with the same rows.
    batch = staging.ship_events(as_lines(spark, at(9), at(30, ship="ship-002"), at(1, ship="ship-003")))
    from harborline.sources.writers import upsert_latest
    upsert_latest(batch, base, versions[-1], ["ship_id"], "event_ts")
    assert complete_versions(spark, base) == versions and go() == {"ship-001": 10, "ship-002": 30, "ship-003": 1}
    assert read_latest_version(spark, base, before=versions[-1]).count() == 2


def test_landing_partitions_and_exactly_once(spark, tmp_path):
    inbox, out = tmp_path / "in", str(tmp_path / "raw")
    alert = {"event_type": "global_alert", "ts": "2026-03-26T10:05:30", "source": " CLIMA ", "region": "Suez"}
    write_batch(inbox, "a", [at(5), alert, dict(alert, source="x"), {"no": "time"}])

    def go():
        lines = message_stream(spark, str(inbox), "text")
        topic = F.when(F.get_json_object("value", "$.event_type") == "global_alert", "alertas_globales").otherwise("datos_crudos")
        rows = queries.landing_rows(lines.withColumn("topic", topic), host="h")
        queries.landing_query(rows, out, queries.checkpoint_path(str(tmp_path), "landing"), queries.MICRO_BATCH).awaitTermination()
        return spark.read.schema("value string, kind string, dt string, hhmm string").text(out)

    rows = sorted((r.kind, r.dt, r.hhmm) for r in go().collect())
    assert rows == [("clima", "2026-03-26", "1005"), ("noticias", "2026-03-26", "1005"), ("ships", "2026-03-26", "1005"), ("ships", "unknown", "unknown")]
    assert go().count() == 4
    landed = staging.parse_json(go().filter("kind = 'ships' and dt = '2026-03-26'"), schemas.SHIP_POSITION)
    assert landed.first().ship_id == "ship-001"


def test_landed_files_feed_the_scheduled_run(spark, tmp_path):
    from harborline.plans import microbatch

    inbox, out = tmp_path / "in", str(tmp_path / "raw")
    write_batch(inbox, "a", [at(5), at(7), at(7, ship="ship-002"), {"no": "time"}, {}])
    (inbox / "b.json").write_text('{"event_type": "ship_position", "ts": "2026-03-26T10:0\n not json }\n')
    rows = queries.landing_rows(message_stream(spark, str(inbox), "text").withColumn("topic", F.lit("datos_crudos")), host="h")
    queries.landing_query(rows, out, queries.checkpoint_path(str(tmp_path), "landing"), queries.MICRO_BATCH).awaitTermination()
    assert spark.read.text(out).count() == 7
    run = microbatch.Run(spark, out, str(tmp_path / "base"), "2026-03-27 00:00:00", landed=True)
    microbatch.raw_to_staging(run)
    staged = run.read("stg_ships").collect()
    assert sorted(r.ship_id for r in staged) == ["ship-001", "ship-001", "ship-002"]
    assert {r._ingestion_host for r in staged} == {"h"}
    assert run.read("stg_alerts_clima").count() == 0


def test_stream_joined_with_static_context(spark, tmp_path):
    from harborline.operators import weather
    from harborline.sources.master import master

    context = weather.route_context(*[master(spark, n) for n in ("dim_routes", "dim_ports", "dim_warehouse", "dim_port_stock")])
    write_batch(tmp_path / "in", "a", [{"ts": "2026-03-26T10:00:00", "wind_speed_kmh": 51.0, "port_ref": "Valencia"}])
    lines = message_stream(spark, str(tmp_path / "in"), "text")
    snapshots = staging.parse_json(lines, schemas.WEATHER_SNAPSHOT).withColumns(
        {"severity": staging.wind_severity(F.col("wind_speed_kmh")), "event_ts": F.col("ts").cast("timestamp")})
    out = str(tmp_path / "fact")
    queries.weather_fact_query(snapshots, context, out, queries.checkpoint_path(str(tmp_path), "w")).awaitTermination()
    rows = spark.read.parquet(out).collect()
    assert {(r.route_id, r.operational_severity) for r in rows} == {("route-shanghai-valencia", 5), ("route-yokohama-valencia", 5)}


def test_two_queries_run_together(spark, tmp_path):
    write_batch(tmp_path / "in", "a", [at(1)])
    started = [
        queries.start_batches(ships_stream(spark, tmp_path / "in"), lambda df, i: None, queries.checkpoint_path(str(tmp_path), n))
        for n in ("one", "two")
    ]
    queries.run_together(spark, started)
    assert not any(q.isActive for q in started)


def test_a_failing_query_stops_the_other(spark, tmp_path):
    write_batch(tmp_path / "in", "a", [at(1)])

    def broken(df, batch_id):
        raise RuntimeError("no store")

    base = str(tmp_path / uuid.uuid4().hex)
    steady = queries.start_batches(ships_stream(spark, tmp_path / "in"), lambda df, i: None, queries.checkpoint_path(base, "ok"), {"processingTime": "1 second"})
    failing = queries.start_batches(ships_stream(spark, tmp_path / "in"), broken, queries.checkpoint_path(base, "bad"))
    with pytest.raises(Exception, match="no store"):
        queries.run_together(spark, [steady, failing])
    assert not steady.isActive


def test_a_new_checkpoint_keeps_what_was_written_before(spark, tmp_path):
    from harborline.sources.tables import complete_versions, read_latest_version, version_for

    base = str(tmp_path / "out")
    for version, (ship, hour) in enumerate((("s1", 10), ("s9", 20)), start=1):
        inbox = tmp_path / f"in{version}"
        lines = [position(ship, f"2026-03-26T{hour + h:02d}:05:00") for h in range(3)]
        inbox.mkdir()
        (inbox / "a.json").write_text("\n".join(json.dumps(p) for p in lines))
        for _ in range(2):
            ships = ships_stream(spark, inbox)
            queries.ship_metrics_query(ships, f"{base}/table", queries.checkpoint_path(base, "ships", version)).awaitTermination()
            queries.latest_state_query(ships, f"{base}/state", queries.checkpoint_path(base, "state", version)).awaitTermination()
    hours = {r.window_start.hour for r in spark.read.parquet(f"{base}/table").collect()}
    assert {10, 11} <= hours and {20, 21} <= hours
    assert {r.ship_id for r in read_latest_version(spark, f"{base}/state").collect()} == {"s1", "s9"}
    versions = complete_versions(spark, f"{base}/state")
    assert version_for(spark, f"{base}/state", "state-v2-0") == versions[-1]


def test_windows_without_alerts_stay(spark):
    ships = spark.sql("select timestamp'2026-01-01 00:00' window_start, timestamp'2026-01-01 00:15' window_end, 'a' dest_port, 'r' route_id, 0.0D speed_std, 1L ship_count")
    alerts = spark.sql("select timestamp'2026-01-01 01:00' window_start, 2.0D avg_severity, 1L alert_count")
    row = windows.window_risk(ships, alerts).first()
    assert row.severity_avg == 0 and row.risk_class == "BAJO"
