"""Transport network built from positions, and route risk."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborline.functions.bands import route_risk_level
from harborline.functions.geo import planar_km, transit_hours
from harborline.session import small

# Fixed values.
HUB = "Valladolid"
INLAND_HOURS = 8.0


def mean_severity(*alert_sets: DataFrame) -> Column:
    """Average severity over all alert sets (weather, news) as a scalar, 0.0 without alerts."""
    all_alerts = reduce(DataFrame.unionByName, [alerts.select("severity") for alerts in alert_sets])
    return F.coalesce(all_alerts.agg(F.avg("severity")).scalar(), F.lit(0.0))


def sailed_pairs(ships: DataFrame) -> DataFrame:
    """Per port pair: mean speed and lowest stock figures, in one pass over the positions.

    Edges, alerts and traffic all start from these few rows.
    """
    return ships.groupBy("origin_port", "dest_port").agg(
        F.avg("speed_kn").alias("avg_speed_kn"),
        F.min("stock_on_hand").alias("stock_on_hand"),
        F.min("reorder_point").alias("reorder_point"),
        F.count("*").alias("positions"),
    )


def sea_edges(pairs: DataFrame, ports: DataFrame) -> DataFrame:
    """``src, dst, weight`` (hours) per sailed port pair, from the mean speed of its positions."""
    src = small(ports.select(F.col("port_name").alias("origin_port"), F.col("lat").alias("olat"), F.col("lon").alias("olon")))
    dst = small(ports.select(F.col("port_name").alias("dest_port"), F.col("lat").alias("dlat"), F.col("lon").alias("dlon")))
    km = planar_km(F.col("olat"), F.col("olon"), F.col("dlat"), F.col("dlon"))
    return (
        pairs.join(src, "origin_port")
        .join(dst, "dest_port")
        .select(F.col("origin_port").alias("src"), F.col("dest_port").alias("dst"),
                transit_hours(km, F.col("avg_speed_kn")).alias("weight"))
    )


def network_edges(sea: DataFrame, hub: str = HUB, inland_hours: float = INLAND_HOURS,
                  extra: DataFrame | None = None) -> DataFrame:
    """Sea edges, one inland edge per arrival port, and optional further links (hub to customers)."""
    inland = sea.select(F.col("dst").alias("src")).distinct().select(
        "src", F.lit(hub).alias("dst"), F.lit(inland_hours).alias("weight")
    )
    edges = sea.unionByName(inland)
    return edges.unionByName(extra) if extra is not None else edges


def network_vertices(pairs: DataFrame, hub: str = HUB) -> DataFrame:
    """Ports seen as origin or destination, plus the hub."""
    seen = pairs.select(F.explode(F.array("origin_port", "dest_port")).alias("id"))
    with_hub = seen.unionByName(seen.sparkSession.range(1).select(F.lit(hub).alias("id"))).distinct()
    return with_hub.filter(F.col("id").isNotNull()).withColumn(
        "type", F.when(F.col("id") == hub, "warehouse").otherwise("port")
    )


def route_risk(sea: DataFrame, risk_score: Column, hub: str = HUB, inland_hours: float = INLAND_HOURS) -> DataFrame:
    """One row per sea edge; a port served from two origins has two rows."""
    return (
        sea.filter(F.col("dst") != hub)
        .select(
            F.col("src").alias("origin_port"),
            F.col("dst").alias("via_port"),
            F.col("weight").alias("time_shanghai_to_via_hours"),
            F.lit(inland_hours).alias("time_via_to_valladolid_hours"),
            (F.col("weight") + F.lit(inland_hours)).alias("estimated_total_hours"),
        )
        .withColumn("risk_score", risk_score)
        .withColumn("risk_level", route_risk_level(F.col("risk_score")))
    )


def dynamic_weight(transit_days: Column, reliability: Column, customs_hours: Column, literal_units: bool = False) -> Column:
    """Transit time plus inverse reliability plus customs delay. Customs hours are converted to days;
    ``literal_units`` adds the bare numbers."""
    customs = customs_hours if literal_units else customs_hours / F.lit(24.0)
    return transit_days + F.try_divide(F.lit(1.0), reliability) + customs


def customer_links(links: DataFrame) -> DataFrame:
    """Links beyond the hub as edges in hours, for use as ``extra`` edges."""
    return links.select("src", "dst", (F.col("days") * F.lit(24.0)).alias("weight"))
