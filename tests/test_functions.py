import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from harborline.functions import bands, calendar, columns, geo
from harborline.functions.skew import lookup
from harborline.functions.ranking import drop_repeats, first_per, row_index
from harborline.sources.master import master, waypoint_rows


def column(spark, values, kind, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("x"))).collect()]


def test_wind_severity(spark):
    got = column(spark, [19.9, 20.0, 35.0, 50.0, None], "double", bands.wind_severity)
    assert got == [1, 2, 3, 4, 1]


def test_delay_by_severity(spark):
    assert column(spark, [1, 2, 3, 4], "int", bands.weather_delay_hours) == [1.0, 3.0, 6.0, 10.0]


def test_risk_class(spark):
    df = spark.createDataFrame([(4.0, 10.0), (5.0, 10.0), (1.0, None)], "s double, d double")
    assert [r[0] for r in df.select(bands.risk_class(F.col("s"), F.col("d"))).collect()] == ["ALTO", "CRITICO", "BAJO"]


def test_unknown_code_keeps_itself(spark):
    assert column(spark, ["a", "z"], "string", lambda c: bands.label(c, {"a": "Alpha"})) == ["Alpha", "z"]


def test_uncovered_pattern(spark):
    values = ["NO CUBRE", "CUBRE", "ROTURA_PROBABLE", "ALERTA"]
    assert column(spark, values, "string", bands.is_uncovered) == [True, False, True, False]


def test_pseudo_stock_values(spark):
    ids = [f"ship-{i:03d}" for i in range(1, 11)]
    assert column(spark, ids, "string", columns.pseudo_stock) == [11, 93, 95, 59, 56, 84, 4, 18, 5, 51]


def test_industrial_week_is_iso(spark):
    days = [dt.date(2026, 4, 1), dt.date(2027, 1, 1)]
    assert column(spark, days, "date", calendar.industrial_week) == ["IW14", "IW53"]


def test_event_time_never_fails(spark):
    got = column(spark, ["2026-03-26T18:40:00", "2026-04-13T10:30:00+00:00", "nope", None], "string", calendar.event_time)
    assert [g is None for g in got] == [False, False, True, True]


def test_number_or_zero(spark):
    assert column(spark, ["3.5", "x", None], "string", columns.number_or_zero) == [3.5, 0.0, 0.0]


def test_transit_hours_at_zero_speed(spark):
    assert column(spark, [0.0, 10.0], "double", lambda v: geo.transit_hours(F.lit(185.2), v))[0] is None


def test_haversine_quarter_of_the_equator(spark):
    km = spark.range(1).select(geo.geo_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(90.0), "haversine")).first()[0]
    assert km == pytest.approx(10007.5, abs=0.1)
    with pytest.raises(ValueError):
        geo.geo_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(0.0), "other")


def test_bearing(spark):
    df = spark.range(1).select(
        geo.bearing_degrees(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(5.0)).alias("east"),
        geo.bearing_degrees(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(-5.0)).alias("west"),
    ).first()
    assert (df.east, df.west) == (90.0, 270.0)


def test_point_on_path_against_a_plain_loop(spark):
    points = {}
    for route, _, lat, lon in waypoint_rows():
        points.setdefault(route, []).append((lat, lon))

    def plain(path, p):
        p = max(0.0, min(1.0, p))
        n = len(path) - 1
        seg = min(int(p * n), n - 1)
        t = p * n - seg
        (a, b), (c, d) = path[seg], path[seg + 1]
        return a + (c - a) * t, b + (d - b) * t

    shares = [-0.5, 0.0, 0.11, 0.5, 0.999, 1.0, 1.5]
    waypoints = master(spark, "dim_waypoints")
    paths = waypoints.groupBy("route_id").agg(F.sort_array(F.collect_list(F.struct("seq", "lat", "lon"))).alias("path"))
    rows = paths.withColumn("p", F.explode(F.array(*[F.lit(s) for s in shares]))).withColumn(
        "at", geo.point_on_path(F.col("path"), F.col("p"))
    )
    for row in rows.collect():
        lat, lon = plain(points[row.route_id], row.p)
        assert row["at"].lat == pytest.approx(lat, abs=1e-6) and row["at"].lon == pytest.approx(lon, abs=1e-6)


def test_optional_filters(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    assert columns.where_given(df, k=None).count() == 2
    assert columns.where_given(df, k="Todos").count() == 2
    assert columns.where_given(df, k="a").count() == 1
    assert columns.where_given(df, v=[1, 2]).count() == 2


def test_missing_columns(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert columns.existing(df, ["b", "zz", "a"]).columns == ["b", "a"]
    assert df.select(columns.first_available(df, ["x", "b"], 9)).first()[0] == 2
    assert df.select(columns.first_available(df, ["x"], 9)).first()[0] == 9


def test_shorten(spark):
    assert column(spark, ["abc", "x" * 130], "string", columns.shorten) == ["abc", "x" * 120 + "..."]


def test_row_index_is_the_global_position(spark):
    keys = [f"k{n:05d}" for n in range(3000)]
    random.Random(1).shuffle(keys)
    df = spark.createDataFrame([(k,) for k in keys], "k string").repartition(7)
    got = {r.k: r.row_index for r in row_index(df, ["k"]).collect()}
    assert got == {k: i for i, k in enumerate(sorted(keys))}


def test_first_per_reduces_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    best = first_per(df, ["k"], [F.col("v").desc()])
    assert {(r.k, r.v) for r in best.collect()} == {(0, 999), (1, 997), (2, 998)}
    plan = best._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_drop_repeats_does_not_depend_on_arrival(spark):
    rows = [("a", 1, "x"), ("a", 1, "b"), ("a", 1, None), ("b", 2, None)]
    one = drop_repeats(spark.createDataFrame(rows, "k string, n int, v string"), ["k", "n"])
    two = drop_repeats(spark.createDataFrame(rows[::-1], "k string, n int, v string").repartition(4), ["k", "n"])
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect())) == [("a", 1, "b"), ("b", 2, None)]


def test_lookup_with_a_hot_key(spark):
    """One key holds most rows; every row finds its table row once and the hot rows spread over tasks."""
    big = spark.range(6000).select(F.when(F.col("id") % 3 != 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 50).cast("string"))).alias("k"), "id")
    counts = big.groupBy("k").agg(F.count("*").alias("rows")).withColumn("name", F.upper("k")).filter("k <> 'k1'")
    joined = lookup(big, counts, "k", "rows", ["id"], max_hot=4)
    plain = big.join(counts.drop("rows"), "k").select("k", "id", "name")
    assert joined.columns == ["k", "id", "name"]
    assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, plain.collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = lookup(big, counts, "k", "rows", ["id"], max_hot=4).withColumn("task", F.spark_partition_id())
        assert placed.select("k", "task").distinct().filter("k = 'hot'").count() > 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
