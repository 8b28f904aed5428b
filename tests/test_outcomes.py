"""As-of lookups, labels from later arrivals, and the serving rows made from them."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from harborline import schemas
from harborline.functions.asof import nearest
from harborline.functions.calendar import moment
from harborline.operators import outcomes
from harborline.sources import writers
from harborline.sources.master import master

DAY = dt.datetime(2026, 3, 1)
SCHEMA = "n long, key string, at timestamp_ntz, value long"


def found(spark, rows, events, later, slot="DAY"):
    result = nearest(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(events, SCHEMA), ["key"], "at", ["value"], "hit", later, slot)
    return {r.n: r.hit and (r.hit.at, r.hit.value) for r in result.collect()}, result


def brute(rows, events, later):
    def hit(key, at):
        if key is None or at is None:
            return None
        near = [(e[2], e[3]) for e in events if e[1] == key and e[2] is not None and (e[2] > at if later else e[2] <= at)]
        return (min(near) if later else max(near)) if near else None
    return {n: hit(key, at) for n, key, at, _ in rows}


times = st.one_of(st.none(), st.integers(0, 60 * 24 * 6).map(lambda m: DAY + dt.timedelta(minutes=m * 37 % 8640)))
cells = st.lists(st.tuples(st.sampled_from(["a", "b", None]), times, st.integers(0, 3)), max_size=25)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=cells, events=cells, later=st.booleans())
def test_nearest_equals_brute_force(spark, rows, events, later):
    rows, events = [(i, *r) for i, r in enumerate(rows)], [(i, *e) for i, e in enumerate(events)]
    for slot in ("DAY", "HOUR"):
        assert found(spark, rows, events, later, slot)[0] == brute(rows, events, later)


def test_later_is_strict_and_earlier_is_not(spark):
    rows, events = [(1, "a", DAY, 0)], [(2, "a", DAY, 7), (3, "a", DAY + dt.timedelta(days=40), 8)]
    assert found(spark, rows, events, True)[0] == {1: (DAY + dt.timedelta(days=40), 8)}
    assert found(spark, rows, events, False)[0] == {1: (DAY, 7)}


def test_nearest_needs_no_join_on_ranges_and_no_window_over_a_whole_key(spark):
    _, result = found(spark, [(1, "a", DAY, 0)], [(2, "a", DAY, 7)], True)
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    # Rows are dealt by key and slot; only one row per key and slot is dealt by key alone.
    assert "hashpartitioning(key" in plan and "_slot" in plan.split("hashpartitioning(key", 1)[1].split(")", 1)[0]


def fixes(spark, ships=40, arrivals=True):
    """Ships on one route at 20 knots; every later fix is nearer, the last one in port if ``arrivals``."""
    ports = {r.port_name: r for r in master(spark, "dim_ports").collect()}
    a, b = ports["Shanghai"], ports["Valencia"]
    rows = []
    for s in range(ships):
        for step in range(6 if arrivals else 5):
            share = step / 5
            rows.append((s * 10 + step, f"ship-{s}", "r", "Shanghai", "Valencia", a.lat + (b.lat - a.lat) * share,
                         a.lon + (b.lon - a.lon) * share, 10.0 + s % 7, DAY + dt.timedelta(hours=(step * 60 * (17 - (s % 7)) / 10))))
    return spark.createDataFrame(
        rows, "event_id long, ship_id string, route_id string, origin_port string, dest_port string, lat double, lon double, speed_kn double, ts timestamp_ntz")


@pytest.fixture(scope="module")
def weather(spark):
    rows = [("Valencia", DAY + dt.timedelta(hours=30), 55.0, 4), ("Valencia", DAY + dt.timedelta(hours=30), 12.0, 1)]
    return spark.createDataFrame(rows, "port_ref string, event_ts timestamp_ntz, wind_speed_kmh double, severity int")


def test_features_know_nothing_of_the_future(spark, weather):
    known = outcomes.known_at(fixes(spark, 1), weather, master(spark, "dim_ports")).orderBy("ts").collect()
    assert [(r.has_weather, r.weather_severity) for r in known] == [(False, 1)] + [(True, 4)] * 5
    assert known[0].remaining_share == 1.0 and known[-1].remaining_share == 0.0


def test_labels_come_from_the_next_arrival(spark, weather):
    rows = outcomes.with_outcomes(outcomes.known_at(fixes(spark, 1), weather, master(spark, "dim_ports"))).orderBy("ts").collect()
    assert [r.hours_to_arrival for r in rows] == pytest.approx([510.0, 408.0, 306.0, 204.0, 102.0])
    assert all(r.late == (r.hours_to_arrival > r.planned_hours) for r in rows)


def test_ships_that_have_not_arrived_have_no_label(spark, weather):
    rows = outcomes.with_outcomes(outcomes.known_at(fixes(spark, 2, arrivals=False), weather, master(spark, "dim_ports")))
    assert rows.count() == 10 and rows.filter("hours_to_arrival is not null or late is not null").count() == 0


def test_model_beats_both_naive_predictors(spark, weather):
    known = outcomes.known_at(fixes(spark), weather, master(spark, "dim_ports"))
    _, predicted = outcomes.fit_arrival(outcomes.with_outcomes(known))
    errors = {r.predictor: r.rmse for r in outcomes.held_out_errors(predicted).collect()}
    assert errors["model"] < errors["naive_mean"] and errors["model"] < errors["naive_plan"]


def test_predictions_are_serving_rows(spark, weather):
    known = outcomes.known_at(fixes(spark), weather, master(spark, "dim_ports"))
    rows = outcomes.predictions(known, moment("2026-03-27 00:00:00"))
    assert rows.schema.names == schemas.ML_PREDICTIONS.names
    values = rows.collect()
    assert len(values) == 40 == len({r.prediction_id for r in values}) and {r.model_used for r in values} == {"arrival_regression"}
    assert all(0.0 <= r.confidence <= 1.0 and r.predicted_delay_hours is not None for r in values)


def test_nothing_to_fit_gives_no_predictions(spark, weather):
    known = outcomes.known_at(fixes(spark, 2, arrivals=False), weather, master(spark, "dim_ports"))
    assert outcomes.predictions(known, moment("2026-03-27 00:00:00")).count() == 0


def test_rows_are_counted_while_written(spark, tmp_path):
    for name, df in {"some": spark.range(1000).repartition(7), "none": spark.range(10).filter("id < 0")}.items():
        assert writers.write_counted(df, lambda d: d.write.json(f"{tmp_path}/{name}")) == (1000 if name == "some" else 0)
    empty = spark.createDataFrame([], "a int")
    assert writers.write_counted(empty, lambda d: d.write.json(f"{tmp_path}/empty")) == 0
    limited = spark.range(100).orderBy(F.desc("id")).limit(20)
    assert writers.write_counted(limited, lambda d: d.write.json(f"{tmp_path}/limited")) == 20
