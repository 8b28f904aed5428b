"""One-row indicators and service levels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values.
OTIF_TARGET_PCT = 95.0


def control_tower(stock: DataFrame, voyages: DataFrame, orders: DataFrame, air: DataFrame) -> DataFrame:
    """One row for the control tower; ``stock`` is the stock context after orders.

    Each source is reduced on its own to one row and the rows meet as scalars, so there is no join.
    """
    eta = voyages.agg(F.round(F.avg("eta_hours_estimate"), 1)).scalar()
    on_time = F.avg(F.when(F.col("order_status") == "sea_committed", 1.0).otherwise(0.0))
    otif = orders.agg(F.round(on_time * 100, 1)).scalar()
    saved = air.agg(F.round(F.avg("time_saved_hours"), 1)).scalar()
    # Most hours saved first, then the smaller ship id; rows without a figure come last.
    saved_most = F.struct(F.coalesce(-F.col("time_saved_hours"), F.lit(float("inf"))), F.col("ship_id"))
    best = air.agg(F.min_by("recommended_mode", saved_most)).scalar()
    days = F.round(F.try_divide("available_after_orders", "daily_consumption_avg"), 1)
    return (
        stock.agg(
            F.round(F.avg(days), 1).alias("doh"),
            F.round(F.avg(F.try_divide("safety_stock_min", "total_stock_pieces")) * 100, 1).alias("security_level"),
            F.count_if(F.col("available_after_orders") <= F.col("safety_stock_min")).alias("critical_refs"),
        )
        .withColumns(
            {
                "doh": F.coalesce("doh", F.lit(0.0)),
                "security_level": F.coalesce("security_level", F.lit(0.0)),
                "eta_avg": F.coalesce(eta, F.lit(0.0)),
                "otif": F.coalesce(otif, F.lit(100.0)),
                "avg_time_saved": F.coalesce(saved, F.lit(0.0)),
                "best_mode": F.coalesce(best, F.lit("N/A")),
            }
        )
    )


def executive(voyages: DataFrame, alerts: DataFrame, articles: DataFrame) -> DataFrame:
    """One row: fleet size, critical alerts, references at risk, mean lead time."""
    fleet = voyages.agg(F.count("*")).scalar()
    critical = alerts.agg(F.count_if(F.col("severity") >= 4)).scalar()
    return articles.agg(
        F.count_if(F.col("total_stock_pieces") <= F.col("safety_stock_min")).alias("references_at_risk"),
        F.coalesce(F.round(F.avg("lead_time_days"), 1), F.lit(0.0)).alias("lead_time_avg"),
    ).withColumns({"fleet_size": fleet, "critical_alerts": critical})


def otif_by_customer(orders: DataFrame, target: float = OTIF_TARGET_PCT) -> DataFrame:
    """On-time share per customer against the target."""
    share = F.avg(F.when(F.col("order_status") == "sea_committed", 1.0).otherwise(0.0)) * 100
    return (
        orders.groupBy("customer_city")
        .agg(F.round(share, 1).alias("otif_pct"), F.count("*").alias("orders"))
        .withColumn("target_pct", F.lit(target))
        .withColumn("status", F.when(F.col("otif_pct") >= target, "OPTIMO").otherwise("RIESGO"))
    )


def destination_metrics(ships: DataFrame) -> DataFrame:
    """Positions, mean speed and mean coordinates per destination port."""
    return ships.groupBy("dest_port").agg(
        F.count("*").alias("total_ships"),
        F.round(F.avg("speed_kn"), 6).alias("avg_speed"),
        F.round(F.avg("lat"), 6).alias("avg_lat"),
        F.round(F.avg("lon"), 6).alias("avg_lon"),
    )
