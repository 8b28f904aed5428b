"""Model rows whose labels come from what happened later, and the predictions kept for serving.

Features of a fix use only what was known at its time; the label is the ship's next arrival after it.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborline.functions.asof import hours_between, nearest
from harborline.functions.bands import band
from harborline.functions.geo import planar_km, transit_hours, unit_interval
from harborline.functions.ranking import last_seen
from harborline.operators import models
from harborline.operators.fleet import with_ports
from harborline.session import cut_lineage
from harborline.sources.writers import serving_rows

ARRIVED_SHARE = 0.05  # of the route left when a ship counts as arrived
FEATURES = ["remaining_km", "speed_kn", "planned_hours", "wind_speed_kmh", "weather_severity"]
MODEL_NAME = "arrival_regression"
DELAY_BANDS = [(72.0, "CRITICO"), (24.0, "ALTO"), (0.0, "MEDIO")]


def with_remaining(fixes: DataFrame, ports: DataFrame) -> DataFrame:
    """Kilometres and share of the route left per fix; null where a port is not known."""
    placed = with_ports(fixes, ports)
    left = planar_km(F.col("lat"), F.col("lon"), F.col("dest_lat"), F.col("dest_lon"))
    whole = planar_km(F.col("origin_lat"), F.col("origin_lon"), F.col("dest_lat"), F.col("dest_lon"))
    return placed.withColumn("remaining_km", F.round(left, 6)).withColumn(
        "remaining_share", F.round(F.try_divide(left, whole), 6))


def known_at(fixes: DataFrame, weather: DataFrame, ports: DataFrame, ts: str = "ts") -> DataFrame:
    """Features of every fix: distance, speed, hours at that speed, and the newest weather of the destination so far.

    Of observations at the same time the most severe counts. A port without earlier weather counts as calm (no wind,
    severity 1); ``has_weather`` tells the two apart.
    """
    observed = weather.select(
        F.col("port_ref").alias("dest_port"), F.col("event_ts").alias(ts), "wind_speed_kmh", "severity")
    rows = nearest(
        with_remaining(fixes, ports), observed, ["dest_port"], ts, ["severity", "wind_speed_kmh"], "_seen",
        later=False, slot="HOUR",
    )
    return rows.select(
        "event_id", "ship_id", "route_id", "dest_port", ts, "remaining_km", "remaining_share", "speed_kn",
        F.round(transit_hours(F.col("remaining_km"), F.col("speed_kn")), 6).alias("planned_hours"),
        F.coalesce("_seen.wind_speed_kmh", F.lit(0.0)).alias("wind_speed_kmh"),
        F.coalesce("_seen.severity", F.lit(1)).alias("weather_severity"),
        F.col("_seen").isNotNull().alias("has_weather"),
    )


def with_outcomes(known: DataFrame, ts: str = "ts") -> DataFrame:
    """Fixes under way with the hours to the ship's next arrival; null while it has not arrived since.

    ``late`` tells whether that took longer than the hours planned at the fix. Fixes that already count as arrived, or
    whose ports are not known, are no model rows.
    """
    arrived = F.col("remaining_share") <= ARRIVED_SHARE
    rows = nearest(
        known.filter(~arrived), known.filter(arrived), ["ship_id"], ts, ["event_id"], "_arrival", later=True)
    hours = F.round(hours_between(F.col(ts), F.col(f"_arrival.{ts}")), 6)
    return rows.withColumn("hours_to_arrival", hours).withColumn(
        "late", F.col("hours_to_arrival") > F.col("planned_hours")).drop("_arrival")


def fit_arrival(outcomes: DataFrame) -> tuple[PipelineModel, DataFrame] | None:
    """Regression of the hours to arrival, and predictions for held-out ships with two naive ones beside them.

    ``naive_mean`` is the mean of the fitted rows, ``naive_plan`` the hours planned at the fix. Nothing is fitted
    where no fix has a later arrival or all such fixes are held out.
    """
    data = models.features(outcomes, FEATURES, F.col("hours_to_arrival"), keep=["ship_id", "event_id"])
    train, test = models.split(data, ["ship_id"])
    if train.isEmpty():
        return None
    model = Pipeline(stages=[LinearRegression(maxIter=models.LINEAR_MAX_ITER)]).fit(train)
    mean = train.agg(F.avg("label")).scalar()
    return model, model.transform(test).withColumn("naive_mean", mean).withColumn("naive_plan", F.col("planned_hours"))


def held_out_errors(predicted: DataFrame) -> DataFrame:
    """Root mean square and mean absolute error per predictor, in one pass: ``predictor, rows, rmse, mae``."""
    each = F.explode(F.array(*[
        F.struct(F.lit(label).alias("predictor"), (F.col(c) - F.col("label")).alias("error"))
        for label, c in (("model", "prediction"), ("naive_mean", "naive_mean"), ("naive_plan", "naive_plan"))]))
    return predicted.select(each.alias("e")).groupBy("e.predictor").agg(
        F.count("*").alias("rows"), F.sqrt(F.avg(F.pow("e.error", F.lit(2)))).alias("rmse"),
        F.avg(F.abs("e.error")).alias("mae"))


def predictions(known: DataFrame, created_at: Column, ts: str = "ts") -> DataFrame:
    """One serving row per ship from its newest fix: predicted delay against plan, risk class and confidence.

    Confidence is the share by which the model's held-out error is below that of the mean, zero at worst. There
    are no rows where nothing could be fitted.
    """
    known = cut_lineage(known)
    fitted = fit_arrival(cut_lineage(with_outcomes(known, ts)))
    newest = last_seen(known, ["ship_id"], ts, ["event_id"])
    if fitted is None:
        rows = newest.filter("false").withColumn("prediction", F.lit(None).cast("double"))
        confidence = F.lit(0.0)
    else:
        model, predicted = fitted
        rmse = {c: F.max(F.when(F.col("predictor") == c, F.col("rmse"))) for c in ("model", "naive_mean")}
        gain = held_out_errors(predicted).agg(F.lit(1.0) - F.try_divide(rmse["model"], rmse["naive_mean"])).scalar()
        confidence = unit_interval(F.coalesce(gain, F.lit(0.0)))
        rows = model.transform(models.features(newest, FEATURES, keep=["ship_id", "dest_port"]))
    delay = F.round(F.col("prediction") - F.col("planned_hours"), 3)
    return serving_rows(
        rows.select(
            "ship_id", "dest_port", delay.alias("predicted_delay_hours"), band(delay, DELAY_BANDS, "BAJO").alias("risk_category"),
            F.lit(MODEL_NAME).alias("model_used"), F.round(confidence, 6).alias("confidence")),
        "ml_predictions", created_at)
