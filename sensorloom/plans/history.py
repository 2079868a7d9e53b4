"""Hourly history from landed feeds: parse, validate, merge, number, write."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from sensorloom.functions import time as ft, values as fv
from sensorloom.operators.aggregates import completeness_stats, extent_stats
from sensorloom.operators.joins import lookup
from sensorloom.operators.skew import skew_join
from sensorloom.operators.windows import last_wins, sequential_id
from sensorloom.plans.reference_data import (
    CITIES, CITY_SCHEMA, DOMINANCE, HISTORY_COLUMNS, INDEX_SCALE, RANGES,
)
from sensorloom.sources.delimited import write_csv
from sensorloom.sources.feeds import read_array_feed, read_metadata_feed, read_record_feed
from sensorloom.sources.tables import literal_relation


STATION_TEXTS = ("station_nom", "station_url", "station_timezone", "attributions")


def pollution_hours(records: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Validated pollution values, one row per key and hour; the last record in feed order wins.

    The dominant pollutant is taken from the values as delivered, before validation.
    """
    at = ft.epoch_to_ts(F.col("dt"))
    hourly = last_wins(records.withColumn("mesure_le", ft.bucket(at)), [key, "mesure_le"], order)
    parts = F.col("item.components")
    raw = hourly.select(
        key,
        "mesure_le",
        fv.map_code(F.col("item.main.aqi"), INDEX_SCALE).alias("aqi_global"),
        *[parts[field].alias(name) for name, (field, _) in DOMINANCE.items()],
    )
    compared = {name: fv.scale(fv.zero_if_missing(F.col(name)), f) for name, (_, f) in DOMINANCE.items()}
    named = raw.withColumn("polluant_dominant", fv.argmax_name(compared))
    return fv.clean_columns(named, {name: RANGES[name] for name in DOMINANCE})


def weather_hours(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Validated weather values, one row per key and time; the last in feed order wins."""
    names = {"temperature": "t", "humidite": "h", "pression": "p", "vent": "w"}
    hourly = last_wins(rows.filter(F.col("time").isNotNull()), [key, "time"], order)
    raw = hourly.select(key, F.col("time").alias("mesure_le"), *[F.col(k).alias(name) for name, k in names.items()])
    return fv.clean_columns(raw, {name: RANGES[kind] for name, kind in names.items()})


def merge_hours(pollution: DataFrame, weather: DataFrame, stations: DataFrame, key: str) -> DataFrame:
    """Every pollution hour with the weather of the same hour and the station of the key.

    Weather without a pollution hour adds no row; a key without a station gets empty texts.
    """
    both = skew_join(pollution, weather, [key, "mesure_le"], "left")
    return lookup(both, stations, key, {c: "" for c in STATION_TEXTS})


def build_history(spark: SparkSession, landed: str, at: datetime, multiline: bool = True) -> DataFrame:
    """The 21-column history of all cities from ``landed``/pollution, /weather and /station folders."""
    key = "ville_id"
    cities = literal_relation(spark, CITIES, CITY_SCHEMA)
    pollution = pollution_hours(
        read_record_feed(spark, f"{landed}/pollution", key, multiline=multiline), key, ["_doc", "pos"]
    )
    weather = weather_hours(
        read_array_feed(spark, f"{landed}/weather", key, multiline=multiline), key, ["_doc", "pos"]
    )
    stations = read_metadata_feed(spark, f"{landed}/station", key, cities, "id", "nom", multiline=multiline)
    merged = merge_hours(pollution, weather, stations, key).withColumn("collecte_le", ft.run_time(at))
    return sequential_id(merged, [key, "mesure_le"]).select(*HISTORY_COLUMNS)


def write_history(history: DataFrame, path: str) -> None:
    write_csv(history, path, HISTORY_COLUMNS)


def history_report(history: DataFrame, key: str = "ville_id") -> DataFrame:
    """Rows, weather completeness in percent, first and last hour of each city."""
    return history.groupBy(key).agg(*completeness_stats("temperature"), *extent_stats("mesure_le"))
