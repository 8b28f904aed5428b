from pyspark.sql import functions as F

from harborline import schemas
from harborline.functions.calendar import moment
from harborline.operators import quality, staging
from harborline.sources.readers import json_lines, messages
from tests.conftest import as_lines, position


def parsed(spark, *objects):
    return staging.parse_json(as_lines(spark, *objects), schemas.SHIP_POSITION)


def test_bad_line_becomes_nulls(spark):
    rows = parsed(spark, "{broken", position()).collect()
    assert [r.ship_id for r in rows] == [None, "ship-001"]


def test_required_fields_and_duplicates(spark):
    late = position(ts="2026-03-26T19:00:00")
    frames = parsed(
        spark, position(), position(), position(lat=99.0), late, position(ship=None), position(lat=None), "{broken",
        {"event_type": "weather_snapshot", "ts": "2026-03-26T18:40:00", "ship_id": "x", "lat": 1.0, "lon": 1.0},
    )
    staged = staging.stage_ships(frames)
    assert sorted((r.ship_id, r.ts, r.lat) for r in staged.collect()) == [
        ("ship-001", "2026-03-26T18:40:00", 15.2), ("ship-001", "2026-03-26T19:00:00", 15.2),
    ]
    again = staging.stage_ships(staged.select(*frames.columns))
    assert again.count() == staged.count()


def test_stock_context_columns(spark):
    row = staging.stage_ships(parsed(spark, position())).first()
    assert (row.warehouse, row.sku, row.reorder_point, row.stock_on_hand) == ("Valladolid", "SKU-SEA-001", 30, 11)


def test_unreadable_time_is_null_in_staging_and_dropped_in_the_stream_form(spark):
    bad = position(ts="mañana")
    assert staging.stage_ships(parsed(spark, bad)).first().ts_utc is None
    assert staging.ship_events(as_lines(spark, bad, position())).count() == 1


def test_alert_routing(spark):
    sources = [" CLIMA ", "clima", "noticias", "open_meteo", None, ""]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(sources)], "i int, source string")
    kinds = [r[0] for r in df.orderBy("i").select(staging.alert_route(F.col("source"))).collect()]
    assert kinds == ["clima", "clima", "noticias", "noticias", "noticias", "noticias"]
    wider = {"clima": "clima", "open_meteo": "clima"}
    assert df.filter("i = 3").select(staging.alert_route(F.col("source"), wider)).first()[0] == "clima"


def test_weather_reshape_and_defaults(spark):
    answer = {"current": {"time": "2026-03-26T18:40", "temperature_2m": 18.5, "relative_humidity_2m": 70, "wind_speed_10m": 36.0,
                          "wind_direction_10m": 250, "weather_code": 3}}
    named = dict(answer, port_ref="Valencia")
    rows = staging.stage_weather(staging.reshape_weather(as_lines(spark, answer, named)), moment("2026-03-27")).collect()
    assert sorted((r.port_ref, r.severity, r.source, r.humidity_pct) for r in rows) == [
        ("Algeciras", 3, "open_meteo", 70), ("Valencia", 3, "open_meteo", 70),
    ]


def test_status_split_is_complete(spark):
    df = spark.createDataFrame([(1, 200), (2, 500), (3, None)], "id int, status_code int")
    assert [r.id for r in staging.accepted(df).collect()] == [1]
    assert sorted(r.id for r in staging.rejected(df).collect()) == [2, 3]


def test_lineage_columns(spark):
    df = spark.createDataFrame([("x", 3, 17)], "value string, partition int, offset long")
    row = staging.add_lineage(df, moment("2026-01-01"), host="node-1").first()
    assert (row._ingestion_host, row._ingestion_partition, row._ingestion_offset) == ("node-1", 3, 17)
    assert staging.add_lineage(df.select("value")).first()._ingestion_partition is None


def test_contract_report_and_rejects(spark):
    frames = parsed(spark, position(), position(heading=400.0), position(ship=None), "{broken")
    report = {r.rule: r.violations for r in quality.violations(frames, quality.ship_contract()).collect()}
    assert (report["heading_out_of_range"], report["missing_ship_id"], report["missing_ts"]) == (1, 2, 1)
    good, bad = quality.split_by_contract(frames, quality.ship_contract())
    assert (good.count(), bad.count()) == (1, 3)


def test_schema_check(spark):
    actual = spark.createDataFrame([(1, "x")], "a int, b string").schema
    expected = spark.createDataFrame([(1, 2)], "a long, c int").schema
    status = {r.column_name: r.status for r in quality.schema_check(spark, actual, expected).collect()}
    assert status == {"a": "type_differs", "b": "extra", "c": "missing"}


def test_landing_glob_read_keeps_lineage(spark, tmp_path):
    folder = tmp_path / "ships/2026/03/26/1840"
    folder.mkdir(parents=True)
    line = '{"event_type":"ship_position","ship_id":"s","ts":"2026-03-26T18:40:00","_ingestion_offset":5}'
    (folder / "a.jsonl").write_text(line + "\n{oops\n")
    df = json_lines(spark, f"{tmp_path}/ships/*/*/*/*/*.jsonl", schemas.with_lineage(schemas.SHIP_POSITION), keep_file=True)
    rows = df.collect()
    assert len(rows) == 2 and sorted(r._ingestion_offset or 0 for r in rows) == [0, 5]
    assert all(r.source_file.endswith("a.jsonl") for r in rows)
    assert messages(spark, str(folder), fmt="text").count() == 2


def test_text_is_parsed_once(spark):
    frames = staging.require(staging.of_type(parsed(spark, position()), "ship_position"), ["ship_id", "lat"])
    plan = frames._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1
