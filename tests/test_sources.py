import datetime as dt

import pytest
from pyspark.sql import functions as F

from harborline.functions.calendar import moment
from harborline.operators import fleet, quality
from harborline.session import as_array, fits_broadcast, per_key, small
from harborline.sources import readers, tables, writers
from harborline.sources.master import TABLE_NAMES, all_masters, master, waypoint_rows


def test_master_sizes_and_types(spark):
    counts = {n: df.count() for n, df in all_masters(spark).items()}
    assert [counts[n] for n in ("dim_ports", "dim_routes", "dim_warehouse", "dim_skus", "dim_articles_valladolid",
                                "fact_customer_orders_douai", "fact_article_gantt", "dim_airports", "dim_air_recovery")] == [5, 6, 1, 1, 10, 14, 23, 5, 6]
    assert set(counts) == set(TABLE_NAMES)
    assert master(spark, "fact_customer_orders_douai").schema["planned_delivery_date"].dataType.typeName() == "date"
    per_route = {}
    for route, seq, *_ in waypoint_rows():
        per_route[route] = seq + 1
    assert sorted(per_route.values()) == [9, 9, 9, 10, 10, 10]


def test_broadcast_only_within_the_checked_size(spark, sf_dir):
    ports = master(spark, "dim_ports")
    assert fits_broadcast(ports) and not fits_broadcast(ports, limit=10)
    assert "broadcast" in small(ports)._jdf.queryExecution().analyzed().toString().lower()
    assert "broadcast" not in small(ports, limit=10)._jdf.queryExecution().analyzed().toString().lower()
    big = spark.range(10_000_000).withColumn("x", F.col("id") * 2)
    assert not fits_broadcast(big)
    with pytest.raises(ValueError):
        as_array(big)


def test_per_key_keeps_the_rows_of_the_dimension(spark):
    ports = master(spark, "dim_ports").select("port_name")
    reduced = spark.createDataFrame([("Valencia", 1), ("Elsewhere", 2)], "port_name string, n int")
    assert {(r.port_name, r.n) for r in per_key(ports, reduced, "port_name").collect() if r.n} == {("Valencia", 1)}
    assert per_key(ports, reduced, "port_name").count() == 5


@pytest.fixture(scope="module")
def database(spark, tmp_path_factory):
    name = "harborline_test"
    writers.create_database(spark, name)
    base = tmp_path_factory.mktemp("tables")
    for table in ("dim_ports", "dim_routes"):
        writers.write_dimension(master(spark, table), f"{name}.{table}", f"{base}/{table}")
    yield name, base
    spark.sql(f"DROP DATABASE {name} CASCADE")


def test_tables_and_named_results(spark, database):
    name, base = database
    assert readers.named_result(spark, "ports", name, ["port_name"], limit=2).columns == ["port_name"]
    assert readers.named_result(spark, "routes", name).count() == 6
    assert {r.tableName for r in writers.list_tables(spark, name).collect()} >= {"dim_ports", "dim_routes"}
    assert name in {r[0] for r in writers.list_databases(spark).collect()}
    assert len(list((base / "dim_ports").glob("version=*/*.parquet"))) == 1
    counts = {r.table_name: r.row_count for r in quality.catalog_counts(spark, name, ["dim_ports", "dim_missing"]).collect()}
    assert counts == {"dim_ports": 5, "dim_missing": None}


def test_overwrite_replaces_rows_and_prunes_by_partition(spark, database, tmp_path):
    name, _ = database
    df = spark.createDataFrame([("a", 1), ("b", 2)], "dt string, v int")
    for rows in (df, df.filter("v = 2")):
        writers.overwrite_table(rows, f"{name}.events", str(tmp_path / "events"), partition_by=["dt"])
    assert [tuple(r) for r in spark.table(f"{name}.events").select("dt", "v").collect()] == [("b", 2)]
    plan = spark.table(f"{name}.events").filter("dt = 'b'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan


def test_tsv_export_writes_null_as_empty(spark, tmp_path):
    df = spark.createDataFrame([("s1", None, 1.5)], "ship_id string, route_id string, lat double")
    writers.export_tsv(df, str(tmp_path / "tsv"))
    text = "".join(p.read_text() for p in (tmp_path / "tsv").glob("*.csv"))
    assert text == "s1\t\t1.5\n"


def test_keyed_messages(spark):
    df = spark.createDataFrame([("s1", 1.5)], "ship_id string, lat double")
    row = writers.publish_events(df, "ship_id", "datos_crudos").first()
    assert (row.key, row.value, row.topic) == ("s1", '{"ship_id":"s1","lat":1.5}', "datos_crudos")


def test_serving_rows_and_recent_query(spark, tmp_path):
    path = str(tmp_path / "route_alerts")
    df = spark.createDataFrame([("Algeciras", "MEDIO", 2.75, 4, "plan", False)],
                               "dest_port string, risk_level string, risk_score double, severity int, recommendation string, email_sent boolean")
    for day in ("2026-03-25", "2026-03-27"):
        writers.append_serving_rows(df, "route_alerts", path, day, F.lit(day).cast("timestamp"))
        writers.append_serving_rows(df, "route_alerts", path, day, F.lit(day).cast("timestamp"))
    rows = tables.appended(spark, path)
    assert rows.count() == 2 and rows.select("alert_id").distinct().count() == 2
    recent = readers.recent_rows(rows, "created_at", F.lit("2026-03-27 12:00:00").cast("timestamp"), hours=24).collect()
    assert [r.created_at for r in recent] == [dt.datetime(2026, 3, 27)]


def test_vehicle_state_layout(spark, sample_ships):
    ships = sample_ships.withColumn("event_id", F.lit(1))
    state = fleet.vehicle_state(fleet.latest_positions(ships, "ts_utc").drop("ts"), moment("2026-03-27"), ts="ts_utc")
    assert state.columns == [f for f in writers.SERVING_TABLES["vehicle_latest_state"].names]
    assert writers.conform(state, "vehicle_latest_state").count() == 6


def test_old_versions_are_dropped(spark, tmp_path):
    base = str(tmp_path / "state")
    rows = spark.createDataFrame([("s", 1)], "ship_id string, event_ts int")
    for version in range(4):
        writers.upsert_latest(rows.withColumn("event_ts", F.lit(version)), base, version, ["ship_id"], "event_ts")
    tables.drop_old_versions(spark, base, keep=2)
    assert tables.complete_versions(spark, base) == [2, 3]
    assert tables.read_latest_version(spark, base).first().event_ts == 3


def test_bundle_reports_errors_and_keeps_the_last_good_version(spark, tmp_path):
    base = str(tmp_path / "bundle")
    ships = spark.createDataFrame([("s", dt.datetime(2026, 3, 27, 1, 2, 3))], "ship_id string, ts timestamp").withColumn(
        "cost", F.lit("1.50").cast("decimal(5,2)"))

    def broken():
        return spark.table("no_such_table")

    first = writers.write_bundle(spark, {"ships_latest": lambda: ships, "fact_alerts": broken}, base, 1)
    status = {r.section: (r.status, r.error is not None) for r in first.collect()}
    assert status == {"ships_latest": ("ok", False), "fact_alerts": ("error", True)}
    writers.write_bundle(spark, {"ships_latest": lambda: ships.limit(0), "dim_ports": lambda: master(spark, "dim_ports")}, base, 2)
    row = writers.read_bundle_section(spark, base, "ships_latest").first()
    assert (row.ship_id, row.cost) == ("s", 1.5) and row.ts.startswith("2026-03-27T01:02:03")
