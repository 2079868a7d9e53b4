"""Star schema over named silver tables: one fact, four dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from sensorloom.functions import time as ft
from sensorloom.operators.joins import bucket_left_join, left_join_latest
from sensorloom.operators.relational import project, require, where_true
from sensorloom.plans.reference_data import POLLUTANTS, POLLUTANT_SCHEMA
from sensorloom.sources.tables import literal_relation, replace_table

# fixed values: output column -> source column, by source table
FACT_AIR = {
    "station_id": "ville_id", "city_id": "ville_id", "datetime_utc": "collecte_le",
    "aqi_global": "aqi_global", "polluant_dominant": "polluant_dominant",
    "pm25": "pm25", "pm10": "pm10", "no2": "no2", "o3": "o3", "co": "co", "so2": "so2",
    "temp_aqicn": "temperature", "humidite_aqicn": "humidite",
    "pression_aqicn": "pression", "vent_aqicn": "vent",
}
FACT_WEATHER = {
    c: c
    for c in (
        "temperature", "temperature_ressentie", "temp_min", "temp_max", "pression_hpa", "humidite_pct",
        "vitesse_vent", "direction_vent", "couverture_nuages", "visibilite_m", "condition_libelle", "condition_desc",
    )
}
FACT_POLLUTION = {
    "aqi_owm": "aqi_owm", "co_owm": "co", "no": "no", "no2_owm": "no2", "o3_owm": "o3", "so2_owm": "so2",
    "pm2_5": "pm2_5", "pm10_owm": "pm10", "nh3": "nh3",
}


def dim_time(measures: DataFrame, ts: str = "collecte_le") -> DataFrame:
    """One row per distinct measurement time with its calendar parts."""
    times = require(measures, ts).select(F.col(ts).alias("datetime_utc")).distinct()
    at = F.col("datetime_utc")
    parts = {"annee": "year", "mois": "month", "jour": "day", "heure": "hour", "semaine": "week"}
    return times.select(
        at, ft.day_of(at).alias("date"), *[c.alias(n) for n, c in ft.calendar(at, parts).items()],
        ft.weekday_name(at).alias("jour_semaine"),
    )


def dim_city(cities: DataFrame) -> DataFrame:
    names = {"city_id": "id", "city_nom": "nom", "city_slug": "slug_aqicn", "latitude": "latitude", "longitude": "longitude"}
    return project(where_true(cities, "actif"), names)


def dim_station(cities: DataFrame, measures: DataFrame, tiebreak: tuple[str, ...] = ()) -> DataFrame:
    """Active cities with the station columns of their latest measurement.

    Where two measurements of a city share the latest time, ``tiebreak`` columns decide.
    """
    active = where_true(cities, "actif").withColumnRenamed("id", "ville_id")
    described = ["station_nom", "station_url", "station_timezone"]
    joined = left_join_latest(active, measures, "ville_id", "collecte_le", [*tiebreak, *described], described)
    names = {
        "station_id": "ville_id", "station_slug": "slug_aqicn", "station_nom": "nom", "latitude": "latitude",
        "longitude": "longitude", "station_nom_aqicn": "station_nom", "station_url": "station_url",
        "timezone": "station_timezone",
    }
    return project(joined, names)


def dim_pollutant(spark: SparkSession) -> DataFrame:
    return literal_relation(spark, POLLUTANTS, POLLUTANT_SCHEMA)


def fact_air_quality(air: DataFrame, weather: DataFrame, pollution: DataFrame, latest: Sequence[str] | None = None) -> DataFrame:
    """Measurements with the weather and pollution rows of the same city and hour; with ``latest`` (tie-breakers), the latest of each only."""
    keys = ["ville_id", "collecte_le"]
    joined = bucket_left_join(
        require(air, "ville_id"),
        {
            "m": weather.select(*keys, *FACT_WEATHER.values()),
            "p": pollution.select(*keys, *FACT_POLLUTION.values()),
        },
        ["ville_id"], "collecte_le", "collecte_le", latest=latest,
    )
    return project(
        joined,
        {
            **FACT_AIR,
            **{out: f"m_{c}" for out, c in FACT_WEATHER.items()},
            **{out: f"p_{c}" for out, c in FACT_POLLUTION.items()},
        },
    )


def build_star(spark: SparkSession, sources: dict[str, DataFrame], schema: str | None = None) -> dict[str, DataFrame]:
    """All five models; with ``schema`` (a database, or a folder) each is also written as a table.

    ``sources`` holds ``ville``, ``mesure_air_aqicn``, ``mesure_meteo`` and ``mesure_pollution_owm``.
    """
    air, cities = sources["mesure_air_aqicn"], sources["ville"]
    models = {
        "dim_time": dim_time(air),
        "dim_city": dim_city(cities),
        "dim_station": dim_station(cities, air),
        "dim_pollutant": dim_pollutant(spark),
        "fact_air_quality": fact_air_quality(air, sources["mesure_meteo"], sources["mesure_pollution_owm"]),
    }
    if schema is not None:
        folder = "/" in schema
        if not folder:
            spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")
        for name, df in models.items():
            replace_table(df, f"{schema}/{name}" if folder else f"{schema}.{name}")
    return models
