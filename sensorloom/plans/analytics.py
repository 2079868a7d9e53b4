"""Anomalies, forecasts and clusters of air-quality measurements."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from sensorloom.operators.anomaly import isolation_forest
from sensorloom.operators.clustering import cluster_entities, cluster_profile, name_clusters
from sensorloom.operators.forecast import additive_forecast, published
from sensorloom.operators.joins import join_dim, keep_matched, to_long
from sensorloom.operators.relational import require, top_groups
from sensorloom.plans.reference_data import AIR_FEATURES
from sensorloom.session import settle
from sensorloom.sources.tables import replace_table, with_audit


def air_measures(air: DataFrame, cities: DataFrame) -> DataFrame:
    """Measurements that have an index, with the name and slug of their city."""
    named = cities.select(F.col("id").alias("ville_id"), F.col("nom").alias("ville"), F.col("slug_aqicn").alias("slug"))
    wanted = require(air, "aqi_global").select(
        "ville_id", "collecte_le", *AIR_FEATURES, "temperature", "humidite"
    )
    return join_dim(wanted, named, "ville_id").drop("ville_id")


def anomalies(measures: DataFrame, **params) -> DataFrame:
    columns = ["ville", "collecte_le", *AIR_FEATURES]
    # city and time need not be unique, so rows are drawn by a number of their own
    numbered = measures.select(*columns).withColumn("_row", F.monotonically_increasing_id())
    found = isolation_forest(numbered, ["_row"], AIR_FEATURES, **params)
    return found.select(*columns, F.col("score").cast("int").alias("score"), "est_anomalie")


def forecasts(measures: DataFrame, top: int = 5, model=additive_forecast) -> DataFrame:
    """24-hour forecasts of index and fine particles for the cities with the most measurements."""
    busiest = top_groups(measures, "ville", "aqi_global", top)
    chosen = keep_matched(measures, busiest, ["ville"])
    series = to_long(chosen, ["ville", "collecte_le"], ["aqi_global", "pm25"], "mesure", "y")
    done = published(model(series, ["ville", "mesure"], "collecte_le", "y"))
    return done.withColumnRenamed("collecte_le", "datetime_utc").select(
        "ville", "mesure", "datetime_utc", "valeur_pred", "valeur_min", "valeur_max", "type"
    )


def clusters(measures: DataFrame, **params) -> DataFrame:
    found = name_clusters(cluster_entities(measures, "ville", AIR_FEATURES, **params), "cluster_id", "aqi_global")
    names = {c: f"{'aqi' if c == 'aqi_global' else c}_moyen" for c in AIR_FEATURES}
    return cluster_profile(found, "ville", names)


def run_analytics(air: DataFrame, cities: DataFrame, target: str, at: datetime) -> dict[str, DataFrame] | None:
    """Compute and write the three result tables under ``target`` (a database, or a folder)."""
    measures = settle(air_measures(air, cities))  # three jobs read it
    if measures.isEmpty():
        return None
    results = {
        "ml_anomalies": with_audit(anomalies(measures), ["ville", "collecte_le"], at),
        "ml_predictions": with_audit(forecasts(measures), ["ville", "mesure", "datetime_utc"], at),
        "ml_clusters": with_audit(clusters(measures), ["ville"], at),
    }
    for name, df in results.items():
        replace_table(df, f"{target}/{name}" if "/" in target else f"{target}.{name}")
    return results
