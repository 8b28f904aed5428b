import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from harborline.operators import models
from harborline.plans.domain import Domain
from harborline.session import cut_lineage


@pytest.fixture(scope="module")
def synthetic(spark):
    """Ships whose arrival days and rupture flag follow from the features."""
    n = F.col("id")
    return cut_lineage(spark.range(600).select(
        F.concat(F.lit("ship-"), n.cast("string")).alias("ship_id"), F.lit("r").alias("route_id"),
        F.lit(400.0).alias("sea_hours_estimate"), (n * 37 % 1000).cast("double").alias("remaining_route_distance_km"),
        (n * 13 % 60).cast("double").alias("wind_speed_kmh"), (n % 2).cast("double").alias("port_alert"),
        (n % 5).cast("double").alias("weather_delay_hours_estimate"), (n * 7 % 100).cast("double").alias("stock_on_hand"),
        (n % 50).cast("double").alias("eta_delay_hours"), (n % 4 + 1).alias("weather_severity"), (n % 9 + 12).cast("double").alias("speed_kn"),
    ).withColumn("eta_days", F.col("remaining_route_distance_km") * 0.02 + F.col("weather_delay_hours_estimate") + 1)
        .withColumn("ruptures", (F.col("stock_on_hand") <= 30).cast("double")))


def values(df, name="metric"):
    return {r[name]: r.value for r in df.collect()}


def test_split_is_stable_and_complete(synthetic):
    train, test = models.split(synthetic, ["ship_id"])
    again = models.split(synthetic.repartition(5), ["ship_id"])[1]
    assert train.count() + test.count() == 600 and 60 < test.count() < 180
    assert {r.ship_id for r in test.collect()} == {r.ship_id for r in again.collect()}


def test_eta_regression_recovers_a_linear_rule(synthetic):
    _, predicted = models.fit_eta(synthetic)
    found = values(models.regression_metrics(predicted))
    assert found["rmse"] < 0.01 and found["r2"] > 0.999
    row = models.eta_comparison(predicted).first()
    assert row.eta_theoretical == 16.7 and row.diff_days == pytest.approx(row.eta_predicted_ml - 16.7, abs=0.051)


def test_rupture_forest_finds_the_stock_rule(spark, synthetic):
    model, predicted = models.fit_rupture(synthetic, trees=20)
    assert values(models.classification_metrics(predicted))["accuracy"] > 0.9
    importance = {r.feature: r.importance for r in models.feature_importance(model, models.RUPTURE_FEATURES, spark).collect()}
    assert max(importance, key=importance.get) == "stock_on_hand"


def test_port_clusters_are_named_by_risk(spark):
    rows = [(f"quiet{i}", 20 + i, 10.0, 15.0, 60.0) for i in range(3)] + [(f"mid{i}", 50 + i, 30.0, 16.0, 65.0) for i in range(3)] + [
        (f"busy{i}", 90 + i, 55.0, 18.0, 70.0) for i in range(3)]
    df = spark.createDataFrame(rows, "port_name string, congestion_level long, wind_speed double, temperature double, humidity double")
    _, clustered = models.fit_ports(df)
    names = {r.port_name[:3]: r.cluster_name for r in clustered.collect()}
    assert names == {"qui": "Bajo Riesgo", "mid": "Riesgo Medio", "bus": "Alto Riesgo"}
    assert models.silhouette(clustered) > 0.5


def test_incomplete_rows_are_left_out(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 2.0)], "a double, b double")
    assert models.features(df, ["a"], F.col("b")).count() == 1


def test_retrain_saves_loadable_models(spark, sf_dir, tmp_path):
    d = Domain(spark, sf_dir)
    report = models.retrain(cut_lineage(d.air_context), d.latest_operational, d.routes, str(tmp_path))
    assert {r.model for r in report.collect()} == {"eta", "rupture"}
    assert PipelineModel.load(f"{tmp_path}/eta").stages and PipelineModel.load(f"{tmp_path}/rupture").stages
