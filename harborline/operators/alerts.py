"""Alert scoring, alert reports and outbox tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborline.functions.bands import label
from harborline.functions.columns import stable_key
from harborline.functions.ranking import first_per
from harborline.session import per_key
from harborline.sources.writers import serving_rows

# Fixed values.
ALERT_SOURCE = "operativa_graph_stock"
OUTBOX_MIN_SEVERITY = 3
SEVERITY_NAMES = {3: "MEDIO", 4: "ALTO", 5: "CRITICO"}


def stock_by_destination(rows: DataFrame) -> DataFrame:
    """Lowest stock and reorder level per destination, from positions or from sailed pairs."""
    return rows.groupBy(F.col("dest_port").alias("via_port")).agg(
        F.min("stock_on_hand").alias("stock_on_hand_min"), F.min("reorder_point").alias("reorder_point")
    )


def score_alerts(route_risk: DataFrame, stock: DataFrame, alert_ts: Column) -> DataFrame:
    """Operational alert per route risk row, from route risk and the stock behind the port."""
    risk, status = F.col("risk_level"), F.col("stock_status")
    critical = status == "CRITICO"
    return (
        route_risk.join(stock, "via_port", "left")
        .withColumn(
            "stock_status",
            F.when(F.col("stock_on_hand_min").isNull() | F.col("reorder_point").isNull(), "SIN_DATOS")
            .when(F.col("stock_on_hand_min") <= F.col("reorder_point"), "CRITICO")
            .otherwise("OK"),
        )
        .withColumns(
            {
                "recommendation": F.when(
                    (risk == "ALTO") & critical, "activar vuelo urgente: priorizar redistribucion/transferencia"
                )
                .when(critical, "seguir plan de contingencia: replanificar rutas y priorizar stock alternativo")
                .otherwise("seguimiento normal: sin accion urgente"),
                "severity": F.when((risk == "ALTO") & critical, 5)
                .when(critical & (risk == "MEDIO"), 4)
                .when((critical & (risk == "BAJO")) | (risk == "ALTO"), 3)
                .when(risk == "MEDIO", 2)
                .otherwise(1),
                "alert_ts": alert_ts,
                "source": F.lit(ALERT_SOURCE),
            }
        )
        .select(
            "alert_ts", "source", "origin_port", "via_port", "risk_score", "risk_level", "estimated_total_hours",
            "stock_on_hand_min", "reorder_point", "stock_status", "recommendation", "severity",
        )
    )


def worst_by_port(alerts: DataFrame, ports: DataFrame) -> DataFrame:
    """The most severe alert per port, at most one row per known port."""
    worst = first_per(
        alerts, ["via_port"],
        [F.col("severity").desc(), F.col("estimated_total_hours").desc_nulls_last(), F.col("origin_port")],
    )
    return per_key(ports.select(F.col("port_name").alias("via_port")), worst, "via_port")


def top_alerts(alerts: DataFrame, limit: int = 20) -> DataFrame:
    return alerts.orderBy(F.col("severity").desc(), "via_port", "origin_port").limit(limit)


def by_region(alerts: DataFrame) -> DataFrame:
    """Alert count per region and source."""
    return alerts.groupBy("region", "source").agg(F.count("*").alias("alerts"))


def by_risk_and_stock(alerts: DataFrame) -> DataFrame:
    return (
        alerts.groupBy("risk_level", "stock_status")
        .agg(F.count("*").alias("count"), F.round(F.avg("risk_score"), 6).alias("avg_risk_score"),
             F.round(F.avg("severity"), 6).alias("avg_severity"))
        .orderBy(F.col("avg_risk_score").desc(), "stock_status")
    )


def mix(df: DataFrame, column: str) -> DataFrame:
    """Rows per value; the null group is kept."""
    return df.groupBy(column).agg(F.count("*").alias("count"))


def critical(alerts: DataFrame, from_severity: int = 4) -> DataFrame:
    return alerts.filter(F.col("severity") >= from_severity)


def risk_summary(alerts: DataFrame, weather: DataFrame) -> DataFrame:
    """One row: critical and medium alerts, mean weather delay."""
    delay = weather.agg(F.avg("weather_delay_hours_estimate")).scalar()
    return alerts.agg(
        F.count_if(F.col("severity") >= 4).alias("critical"), F.count_if(F.col("severity") >= 2).alias("medium")
    ).withColumn("avg_delay", F.round(F.coalesce(delay, F.lit(0.0)), 6))


def route_outbox(alerts: DataFrame, created_at: Column) -> DataFrame:
    """Messages to send for route alerts of severity 3 or more."""
    name = label(F.col("severity"), SEVERITY_NAMES, F.lit("DESCONOCIDO"))
    return alerts.filter(F.col("severity") >= OUTBOX_MIN_SEVERITY).select(
        stable_key(F.col("via_port"), F.col("origin_port"), created_at).alias("alert_id"),
        F.col("origin_port"),
        F.col("via_port").alias("dest_port"),
        "risk_level", "risk_score", "severity", "recommendation",
        name.alias("severity_label"),
        F.format_string("[ALERTA %s] Riesgo en ruta %s", name, F.col("via_port")).alias("subject"),
        F.lit(False).alias("email_sent"),
        created_at.alias("created_at"),
    )


def route_alerts(alerts: DataFrame, ports: DataFrame, created_at: Column) -> DataFrame:
    """Serving rows: the worst alert of every port, from severity 3 on, one per port and run."""
    worst = worst_by_port(alerts, ports).filter(F.col("severity") >= OUTBOX_MIN_SEVERITY)
    return serving_rows(
        worst.withColumnRenamed("via_port", "dest_port").withColumn("email_sent", F.lit(False)), "route_alerts", created_at)


def critical_reference_outbox(articles: DataFrame) -> DataFrame:
    """Articles at or below safety stock, with the class of their row in the message."""
    at_risk = F.col("total_stock_pieces") <= F.col("safety_stock_min")
    return articles.filter(at_risk).select(
        "article_ref", "article_name", "total_stock_pieces", "safety_stock_min",
        F.lit("CRÍTICO").alias("stock_status"),
        F.when(at_risk, "critical").otherwise("warning").alias("row_class"),
    )


def daily_summary(latest: DataFrame, alerts: DataFrame, day: Column) -> DataFrame:
    """One row for the day: ships tracked, alerts, critical routes (bounded by the port list), mean risk."""
    tracked = latest.agg(F.count("*")).scalar()
    return alerts.agg(
        F.count("*").alias("total_alerts"),
        F.array_join(F.sort_array(F.collect_set(F.when(F.col("severity") >= 4, F.col("via_port")))), ", ")
        .alias("critical_routes"),
        F.round(F.avg("risk_score"), 2).alias("avg_risk_score"),
    ).withColumn("total_ships_tracked", tracked).withColumn("summary_date", day.cast("date"))
