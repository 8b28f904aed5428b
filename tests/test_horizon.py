"""The closed form of the clamped stock against a plain loop, and the horizon built on it."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from harborline.functions.calendar import moment, week_names
from harborline.operators import stock
from harborline.sources.master import master


def loop(start, changes):
    value, out = start, []
    for change in changes:
        value = max(0, value + change)
        out.append(value)
    return out


series = st.tuples(st.integers(0, 500), st.lists(st.integers(-300, 300), min_size=1, max_size=10))


@given(st.lists(series, min_size=1, max_size=30))
@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_closed_form_equals_loop(spark, cases):
    rows = [(i, start, w, c) for i, (start, changes) in enumerate(cases) for w, c in enumerate(changes)]
    df = spark.createDataFrame(rows, "k int, s0 long, w int, c long")
    got = {}
    for r in stock.clamped_running_sum(df, F.col("s0"), F.col("c"), ["k"], "w", "s").orderBy("k", "w").collect():
        got.setdefault(r.k, []).append(r.s)
    assert got == {i: loop(start, changes) for i, (start, changes) in enumerate(cases)}


def test_known_series(spark):
    df = spark.createDataFrame([(1, 250, w, c) for w, c in enumerate([-179, 3, -22, -60])], "k int, s0 long, w int, c long")
    rows = stock.clamped_running_sum(df, F.col("s0"), F.col("c"), ["k"], "w", "s").orderBy("w").collect()
    assert [r.s for r in rows] == [71, 74, 52, 0]


def test_horizon_against_a_plain_loop(spark):
    articles, orders = master(spark, "dim_articles_valladolid"), master(spark, "fact_customer_orders_douai")
    best = spark.createDataFrame(
        [("Algeciras", "s1", 200.0, 25.8, 17672.0, "MARITIMO"), ("Valencia", "s2", 100.0, 25.8, 17672.0, "AEREO_CAMION")],
        "dest_port string, ship_id string, ship_remaining_hours double, air_total_eta_hours double, air_total_cost_eur double, recommended_mode string",
    )
    as_of = moment("2026-04-01 00:00:00")
    coverage = stock.orders_coverage(orders, stock.stock_context(articles, stock.order_totals(orders)), best, as_of)
    horizon = stock.stock_horizon(articles, coverage)
    got = {(r.article_ref, r.industrial_week): r for r in horizon.collect()}
    assert len(got) == 100

    demand, arrivals = {}, {}
    for o in orders.collect():
        demand[o.article_ref, o.industrial_week] = demand.get((o.article_ref, o.industrial_week), 0) + o.ordered_pieces
    for c in coverage.collect():
        week = f"IW{c.arrival_valladolid.isocalendar().week:02d}"
        if week == c.industrial_week:
            arrivals[c.article_ref, week] = arrivals.get((c.article_ref, week), 0) + 1
    assert arrivals
    for a in articles.collect():
        value = a.total_stock_pieces
        first = "CUBRE"
        for week in week_names():
            key = (a.article_ref, week)
            value = max(0, value + arrivals.get(key, 0) * a.pieces_per_pack - demand.get(key, 7 * a.daily_consumption_avg))
            status = "NO CUBRE" if value <= a.safety_stock_min else "ALERTA" if value <= a.safety_stock_min + 7 * a.daily_consumption_avg else "CUBRE"
            assert (got[key].projected_stock, got[key].cover_status) == (value, status)
            first = status if first == "CUBRE" else first
        mode = stock.horizon_mode(horizon.filter(F.col("article_ref") == a.article_ref)).first()
        assert mode.worst_status == first and (mode.transport_mode == "Maritimo") == (first == "CUBRE")


def test_worst_mode_differs_from_first(spark):
    rows = [("a", "IW14", "ALERTA"), ("a", "IW15", "NO CUBRE"), ("b", "IW14", "CUBRE")]
    df = spark.createDataFrame(rows, "article_ref string, industrial_week string, cover_status string")
    first = {r.article_ref: r.worst_status for r in stock.horizon_mode(df).collect()}
    worst = {r.article_ref: r.worst_status for r in stock.horizon_mode(df, "worst").collect()}
    assert first == {"a": "ALERTA", "b": "CUBRE"} and worst == {"a": "NO CUBRE", "b": "CUBRE"}
