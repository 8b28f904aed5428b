"""Article stock, order coverage and the ten-week horizon."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harborline.functions.bands import cover_band, stock_light
from harborline.functions.calendar import add_hours, days_between, industrial_week, week_names
from harborline.functions.columns import first_available, where_given
from harborline.functions.skew import lookup

# Fixed values.
WAREHOUSE_CAPACITY_PIECES = 10_000
DEFAULT_SHIP_ETA_HOURS = 240.0
COVER_MARGIN_DAYS = 4.0


def orders_for(orders: DataFrame, customer_city: str | None = None, industrial_week: str | None = None) -> DataFrame:
    return where_given(orders, customer_city=customer_city, industrial_week=industrial_week)


def order_totals(orders: DataFrame) -> DataFrame:
    """Ordered pieces and number of orders per article."""
    return orders.groupBy("article_ref").agg(
        F.sum("ordered_pieces").alias("ordered_pieces"), F.count("*").alias("order_lines")
    )


def stock_context(articles: DataFrame, totals: DataFrame) -> DataFrame:
    """Stock left after orders, traffic light and hours to stock-out per article."""
    available, daily = F.col("available_after_orders"), F.col("daily_consumption_avg")
    hours = F.round(F.try_divide(F.greatest(F.lit(0), available), daily) * F.lit(24), 1)
    return (
        articles.join(totals, "article_ref", "left")
        .withColumn("ordered_pieces", F.coalesce("ordered_pieces", F.lit(0)))
        .withColumn("order_lines", F.coalesce("order_lines", F.lit(0)))
        .withColumn("available_after_orders", F.col("total_stock_pieces") - F.col("ordered_pieces"))
        .withColumn("stock_status", stock_light(available, F.col("safety_stock_min"), daily))
        .withColumn("hours_to_stockout", F.when(daily > 0, hours).otherwise(0.0))
    )


def stock_table(context: DataFrame) -> DataFrame:
    """Stock with volume and weight; both are zero when the unit figures are not known."""
    pieces = F.col("total_stock_pieces")
    return context.select(
        "stock_status", "article_ref", "article_name", "pieces_per_pack",
        first_available(context, ["total_stock_packs"], 0).alias("total_stock_packs"),
        "total_stock_pieces", "safety_stock_min", "ordered_pieces", "available_after_orders",
        F.round(pieces * first_available(context, ["unit_volume_m3"], 0.0), 6).alias("volume_m3"),
        F.round(pieces * first_available(context, ["unit_weight_kg"], 0.0), 6).alias("weight_kg"),
    )


def stock_by_family(articles: DataFrame) -> DataFrame:
    return (
        articles.groupBy("article_family")
        .agg(F.sum("total_stock_pieces").alias("total_stock_pieces"), F.sum("safety_stock_min").alias("safety_stock_min"))
        .withColumn("below_safety", F.col("total_stock_pieces") <= F.col("safety_stock_min"))
    )


def warehouse_capacity(articles: DataFrame, capacity: int = WAREHOUSE_CAPACITY_PIECES) -> DataFrame:
    """One row: pieces, share of capacity used and free, volume and weight."""
    pieces = F.col("total_stock_pieces")
    used = F.round(F.col("current_stock") * F.lit(100.0) / F.lit(capacity), 2)
    return (
        articles.agg(
            F.coalesce(F.sum(pieces), F.lit(0)).alias("current_stock"),
            F.round(F.sum(pieces * first_available(articles, ["unit_volume_m3"], 0.0)), 2).alias("total_volume_m3"),
            F.round(F.sum(pieces * first_available(articles, ["unit_weight_kg"], 0.0)), 2).alias("total_weight_kg"),
        )
        .withColumn("capacity_used_pct", used)
        .withColumn("capacity_free_pct", F.round(F.greatest(F.lit(0.0), F.lit(100.0) - used), 2))
    )


def orders_coverage(orders: DataFrame, context: DataFrame, best_air: DataFrame, as_of: Column) -> DataFrame:
    """Arrival against delivery date per order; orders of unknown articles are left out.

    The port options are at most one row per port. Orders meet their article through a skew-safe lookup,
    since one article may hold a large share of all orders.
    """
    options = best_air.select(
        F.col("dest_port").alias("inbound_port"), "ship_remaining_hours", "air_total_eta_hours", "air_total_cost_eur",
        "recommended_mode",
    )
    ship_eta = F.coalesce("ship_remaining_hours", F.lit(DEFAULT_SHIP_ETA_HOURS))
    air_eta = F.coalesce(F.col("air_total_eta_hours"), ship_eta)
    per_article = context.join(options, "inbound_port", "left").select(
        "article_ref", "inbound_port",
        add_hours(as_of, F.when(F.col("stock_status") == "ROJO", air_eta).otherwise(ship_eta)).alias("arrival_valladolid"),
        F.coalesce("recommended_mode", F.lit("MARITIMO")).alias("recommended_mode"),
        F.coalesce("air_total_cost_eur", F.lit(0.0)).alias("air_total_cost_eur"),
        "order_lines",
    )
    needed = F.col("planned_delivery_date").cast("timestamp_ntz")
    return (
        lookup(orders, per_article, "article_ref", "order_lines", spread_by=["order_id"])
        .withColumn("margin_days", days_between(F.col("arrival_valladolid"), needed))
        .select(
            "order_id", "article_ref", "customer_city", "industrial_week",
            needed.alias("needed_date_client"), "arrival_valladolid", "margin_days",
            F.when(F.col("margin_days") >= COVER_MARGIN_DAYS, "CUBRE").otherwise("NO CUBRE").alias("cover_status"),
            "recommended_mode", "air_total_cost_eur", "inbound_port", "ordered_pieces",
        )
    )


def clamped_running_sum(df: DataFrame, start: Column, change: Column, keys: Sequence[str], order: str, name: str) -> DataFrame:
    """Add ``S = max(0, S_before + change)`` starting from ``start``, without a row loop.

    With ``P = start + running sum of change``, the clamped value is ``P - min(0, lowest P so far)``.
    Both windows share one partitioning and order, so the rows are shuffled and sorted once.
    """
    so_far = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    lowest = F.least(F.lit(0), F.min("_running").over(so_far))
    return (
        df.withColumn("_running", start + F.sum(change).over(so_far))
        .withColumn(name, F.col("_running") - lowest)
        .drop("_running")
    )


def stock_horizon(articles: DataFrame, coverage: DataFrame, weeks: Sequence[str] | None = None) -> DataFrame:
    """Projected stock per article and week, never below zero.

    One pass over the covered orders sums demand and arrivals to one row per article and week before they
    meet the calendar, so a window never holds more rows per article than there are weeks.
    """
    weeks = list(weeks or week_names())
    keys = ["article_ref", "industrial_week"]
    in_horizon = F.col("industrial_week").isin(*weeks)
    arrives_now = industrial_week(F.col("arrival_valladolid")) == F.col("industrial_week")
    moved = coverage.filter(in_horizon).groupBy(*keys).agg(
        F.sum("ordered_pieces").alias("ordered"), F.count_if(arrives_now).alias("arrivals")
    )

    weekly = F.col("daily_consumption_avg") * F.lit(7)
    calendar = F.explode(F.array(*[F.lit(w) for w in weeks]))
    spine = articles.select(
        "article_ref", "pieces_per_pack", "total_stock_pieces", "safety_stock_min", weekly.alias("weekly_consumption"),
        calendar.alias("industrial_week"),
    )
    flows = (
        spine.join(moved, keys, "left")
        .withColumn("inbound", F.coalesce("arrivals", F.lit(0)) * F.col("pieces_per_pack"))
        .withColumn("outbound", F.coalesce("ordered", "weekly_consumption"))
    )
    projected = clamped_running_sum(
        flows, F.col("total_stock_pieces"), F.col("inbound") - F.col("outbound"), ["article_ref"], "industrial_week",
        "projected_stock",
    )
    return projected.select(
        "article_ref", "industrial_week", F.col("total_stock_pieces").alias("initial_stock"), "inbound", "outbound",
        "projected_stock",
        cover_band(F.col("projected_stock"), F.col("safety_stock_min"), F.col("weekly_consumption")).alias("cover_status"),
    )


def horizon_mode(horizon: DataFrame, mode: str = "first") -> DataFrame:
    """Status and transport mode per article over its weeks: the first uncovered status, or the worst."""
    uncovered = F.col("cover_status") != "CUBRE"
    order = F.col("industrial_week") if mode == "first" else F.when(F.col("cover_status") == "NO CUBRE", 0).otherwise(1)
    pick = F.min(F.when(uncovered, F.struct(order.alias("at"), F.col("cover_status").alias("status"))))
    status = F.coalesce(F.col("pick.status"), F.lit("CUBRE"))
    return (
        horizon.groupBy("article_ref")
        .agg(pick.alias("pick"), F.count_if(uncovered).alias("weeks_at_risk"))
        .select("article_ref", status.alias("worst_status"), "weeks_at_risk",
                F.when(status == "CUBRE", "Maritimo").otherwise("Aereo").alias("transport_mode"))
    )


def rupture_timeline(context: DataFrame, best_air: DataFrame, as_of: Column) -> DataFrame:
    """Two bars per article: stock window and estimated sea arrival. One pass, both bars per row."""
    sea = best_air.select(F.col("dest_port").alias("inbound_port"), "ship_remaining_hours")

    def bar(task: str, week: str, mode: str, hours: Column) -> Column:
        return F.struct(
            F.lit(task).alias("task_name"), as_of.alias("start_date"), add_hours(as_of, hours).alias("end_date"),
            F.lit(week).alias("industrial_week"), F.lit(mode).alias("transport_mode"),
        )

    bars = F.array(
        bar("Cobertura stock Valladolid", "Stock window", "stock", F.coalesce("hours_to_stockout", F.lit(0.0))),
        bar("Llegada maritima estimada", "Sea ETA", "sea_eta",
            F.coalesce("ship_remaining_hours", F.lit(DEFAULT_SHIP_ETA_HOURS))),
    )
    return context.join(sea, "inbound_port", "left").select("article_ref", F.explode(bars).alias("b")).select(
        "article_ref", "b.*"
    )


def article_plan(plan: DataFrame, industrial_week: str | None = None) -> DataFrame:
    rows = where_given(plan, industrial_week=industrial_week)
    start, end = F.to_date("start_date"), F.to_date("end_date")
    return rows.withColumns({"start_date": start, "end_date": end, "duration_days": F.datediff(end, start)})


def distinct_values(df: DataFrame, column: str, limit: int | None = None) -> DataFrame:
    """Sorted values of a column for a filter list."""
    values = df.select(column).dropna().distinct().orderBy(column)
    return values.limit(limit) if limit else values


def weekly_demand(orders: DataFrame, customer_city: str | None = None, first_weeks: int | None = None) -> DataFrame:
    """Pieces per week of the calendar, or of its first weeks; a week without orders shows zero.

    The calendar holds every week of all customers, so a filter on one customer keeps empty weeks.
    """
    pieces = F.col("ordered_pieces")
    if customer_city is not None:
        pieces = F.when(F.col("customer_city") == customer_city, pieces)
    demand = (
        orders.filter(F.col("industrial_week").isNotNull()).groupBy("industrial_week")
        .agg(F.coalesce(F.sum(pieces), F.lit(0)).alias("ordered_pieces")).orderBy("industrial_week")
    )
    return demand.limit(first_weeks) if first_weeks else demand


def demand_projection(articles: DataFrame, weeks: int = 10) -> DataFrame:
    """Demand and coverage over the coming weeks in long form: ``week, series, value``."""
    totals = articles.agg(
        F.sum("total_stock_pieces").cast("double").alias("total"),
        F.greatest(F.count_if(F.col("total_stock_pieces") <= F.col("safety_stock_min")), F.lit(1)).alias("at_risk"),
    )
    week = F.col("week")
    demand = F.greatest(F.col("total") * (F.lit(0.11) + week * F.lit(0.012)), F.lit(20.0))
    coverage = F.greatest(
        F.col("total") - week * F.col("total") * (F.lit(0.075) + F.col("at_risk") * F.lit(0.004)), F.lit(10.0)
    )
    wide = totals.withColumn("week", F.explode(F.sequence(F.lit(1), F.lit(weeks)))).select(
        "week", F.round(demand, 0).alias("Demanda"), F.round(coverage, 0).alias("Cobertura")
    )
    return wide.unpivot(["week"], ["Demanda", "Cobertura"], "series", "value")


def embarkation_list(articles: DataFrame) -> DataFrame:
    """Articles to fly, lowest stock first: near or below safety stock, with quantity, volume and weight."""
    stock, safety, quantity = F.col("total_stock_pieces"), F.col("safety_stock_min"), F.col("quantity_to_fly")
    return (
        articles.filter(stock <= safety * F.lit(1.2))
        .withColumn("quantity_to_fly", F.greatest(F.lit(0).cast("long"), (safety * F.lit(1.5) - stock).cast("long")))
        .select(
            "article_ref", "article_name", "quantity_to_fly", "total_stock_pieces", "safety_stock_min",
            F.round(F.try_divide(quantity, F.col("pieces_per_pack")) * F.lit(0.02), 6).alias("volume_estimate_m3"),
            (quantity * F.lit(0.5)).alias("weight_estimate_kg"),
        )
        .orderBy("total_stock_pieces", "article_ref")
    )


def embarkation_totals(items: DataFrame) -> DataFrame:
    return items.agg(
        F.count("*").alias("critical_articles"),
        F.round(F.sum("weight_estimate_kg"), 2).alias("total_weight_kg"),
        F.round(F.sum("volume_estimate_m3"), 2).alias("total_volume_m3"),
    )
