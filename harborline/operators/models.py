"""MLlib models: arrival regression, stock-rupture classification, port clustering, and the retrain job.

The estimators cache their own training input while they iterate; callers pass frames that are cheap to
read again (a table or a checkpoint).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator, MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborline.functions.bands import risk_label
from harborline.session import per_key

# Fixed values.
SEED = 42
LINEAR_MAX_ITER = 10
FOREST_TREES = 5
CLUSTERS = 3
CLUSTER_NAMES = ["Bajo Riesgo", "Riesgo Medio", "Alto Riesgo"]
ETA_FEATURES = ["remaining_route_distance_km", "wind_speed_kmh", "port_alert", "weather_delay_hours_estimate"]
RUPTURE_FEATURES = ["stock_on_hand", "eta_delay_hours", "wind_speed_kmh", "weather_severity", "speed_kn"]
PORT_FEATURES = ["congestion_level", "wind_speed", "temperature", "humidity"]


def features(df: DataFrame, columns: Sequence[str], target: Column | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Rows with all features (and the label) present, in one vector column."""
    doubles = [F.col(c).cast("double").alias(c) for c in columns]
    labels = [target.cast("double").alias("label")] if target is not None else []
    complete = df.select(*keep, *doubles, *labels).na.drop(subset=[*columns, *(["label"] if labels else [])])
    return VectorAssembler(inputCols=list(columns), outputCol="features").transform(complete)


def split(df: DataFrame, key: Sequence[str], test_share: float = 0.2) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by the hash of a key: the same row falls on the same side on every run."""
    bucket = F.pmod(F.xxhash64(*key), F.lit(1000)) / F.lit(1000.0)
    return df.filter(bucket >= test_share), df.filter(bucket < test_share)


def eta_features(context: DataFrame, weather: DataFrame, routes: DataFrame) -> DataFrame:
    """Per ship: what the arrival regression and the rupture classifier look at.

    ``weather`` holds one row per route and port, so the wind table is bounded by the route table.
    """
    wind = weather.select("route_id", F.col("port_ref").alias("dest_port"), "wind_speed_kmh")
    key = ["route_id", "dest_port"]
    return (
        context.join(per_key(routes.select(*key), wind, key), key, "left")
        .withColumn("wind_speed_kmh", F.coalesce("wind_speed_kmh", F.lit(0.0)))
        .withColumn("port_alert", F.when(F.col("port_operational_status") == "METEO_VIGILANCIA", 1.0).otherwise(0.0))
        .withColumn("eta_delay_hours", F.col("ship_remaining_hours") - F.col("sea_hours_estimate"))
        .withColumn("eta_days", F.col("ship_remaining_hours") / F.lit(24.0))
        .withColumn("ruptures", (F.col("stock_break_risk") == "ROTURA_INMINENTE").cast("double"))
    )


def fit_eta(rows: DataFrame, key: Sequence[str] = ("ship_id",)) -> tuple[PipelineModel, DataFrame]:
    """Regression of arrival days, and the predictions for the held-out ships."""
    data = features(rows, ETA_FEATURES, F.col("eta_days"), keep=[*key, "route_id", "sea_hours_estimate"])
    train, test = split(data, key)
    model = Pipeline(stages=[LinearRegression(maxIter=LINEAR_MAX_ITER)]).fit(train)
    predicted = model.transform(test)
    return model, predicted


def eta_comparison(predicted: DataFrame) -> DataFrame:
    """Theoretical against predicted days per ship."""
    theory = F.round(F.col("sea_hours_estimate") / F.lit(24.0), 1)
    days = F.round("prediction", 1)
    return predicted.select(
        "ship_id", "route_id", theory.alias("eta_theoretical"), days.alias("eta_predicted_ml"),
        F.round(days - theory, 1).alias("diff_days"),
    )


def regression_metrics(predicted: DataFrame) -> DataFrame:
    """``metric, value`` for a frame with ``label`` and ``prediction``."""
    evaluator = RegressionEvaluator()
    values = [(m, float(evaluator.evaluate(predicted, {evaluator.metricName: m}))) for m in ("rmse", "r2", "mae")]
    return predicted.sparkSession.createDataFrame(values, "metric string, value double")


def classification_metrics(predicted: DataFrame) -> DataFrame:
    evaluator = MulticlassClassificationEvaluator()
    values = [(m, float(evaluator.evaluate(predicted, {evaluator.metricName: m}))) for m in ("accuracy", "f1")]
    return predicted.sparkSession.createDataFrame(values, "metric string, value double")


def fit_rupture(rows: DataFrame, key: Sequence[str] = ("ship_id",), trees: int = FOREST_TREES) -> tuple[PipelineModel, DataFrame]:
    """Forest that predicts an imminent stock rupture, and the predictions for the held-out ships."""
    data = features(rows, RUPTURE_FEATURES, F.col("ruptures"), keep=list(key))
    train, test = split(data, key)
    model = Pipeline(stages=[RandomForestClassifier(numTrees=trees, seed=SEED)]).fit(train)
    return model, model.transform(test)


def feature_importance(model: PipelineModel, columns: Sequence[str], spark) -> DataFrame:
    values = model.stages[-1].featureImportances.toArray()
    return spark.createDataFrame([(c, float(v)) for c, v in zip(columns, values)], "feature string, importance double")


def port_features(latest: DataFrame, weather: DataFrame) -> DataFrame:
    """Congestion (ships bound for the port) and mean weather per port."""
    congestion = latest.groupBy(F.col("dest_port").alias("port_name")).agg(F.count("*").alias("congestion_level"))
    climate = weather.groupBy(F.col("port_ref").alias("port_name")).agg(
        F.avg("wind_speed_kmh").alias("wind_speed"), F.avg("temperature_c").alias("temperature"),
        F.avg("humidity_pct").alias("humidity"),
    )
    return climate.join(congestion, "port_name", "left").withColumn(
        "congestion_level", F.coalesce("congestion_level", F.lit(0))
    )


def fit_ports(ports: DataFrame, k: int = CLUSTERS) -> tuple[PipelineModel, DataFrame]:
    """K-means over scaled port features; clusters are named by rising congestion and wind."""
    data = features(ports, PORT_FEATURES, keep=["port_name"])
    scaler = StandardScaler(inputCol="features", outputCol="scaled", withMean=True)
    model = Pipeline(stages=[scaler, KMeans(k=k, seed=SEED, featuresCol="scaled", predictionCol="cluster")]).fit(data)
    centers = [float(c[0] + c[1]) for c in model.stages[-1].clusterCenters()]
    rank = {cluster: place for place, cluster in enumerate(sorted(range(len(centers)), key=centers.__getitem__))}
    names = [F.lit(v) for c, p in rank.items() for v in (c, CLUSTER_NAMES[min(p, len(CLUSTER_NAMES) - 1)])]
    return model, model.transform(data).withColumn("cluster_name", F.create_map(*names)[F.col("cluster")])


def silhouette(clustered: DataFrame) -> float:
    return float(ClusteringEvaluator(featuresCol="scaled", predictionCol="cluster").evaluate(clustered))


def retrain(context: DataFrame, weather: DataFrame, routes: DataFrame, path: str) -> DataFrame:
    """Monthly job: fit both per-ship models, save them, and return their metrics."""
    rows = eta_features(context, weather, routes)
    eta_model, eta_rows = fit_eta(rows)
    rupture_model, rupture_rows = fit_rupture(rows)
    eta_model.write().overwrite().save(f"{path}/eta")
    rupture_model.write().overwrite().save(f"{path}/rupture")
    return (
        regression_metrics(eta_rows).withColumn("model", F.lit("eta"))
        .unionByName(classification_metrics(rupture_rows).withColumn("model", F.lit("rupture")))
    )
