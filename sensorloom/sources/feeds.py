"""JSON feeds: record lists, parallel arrays, station metadata.

Readers take landed files; the ``..._rows`` functions work on any frame with a parsed document column.
Files are read with explicit schemas, never inferred.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sensorloom.functions import time as ft, values as fv

RECORD_SCHEMA = (
    "list array<struct<dt: bigint, main: struct<aqi: int>, "
    "components: struct<pm2_5: double, pm10: double, no2: double, o3: double, co: double, so2: double>>>"
)
ARRAY_SCHEMA = (
    "hourly struct<time: array<string>, temperature_2m: array<double>, relative_humidity_2m: array<double>, "
    "surface_pressure: array<double>, wind_speed_10m: array<double>>"
)
METADATA_SCHEMA = (
    "status string, data struct<idx: bigint, city: struct<name: string, url: string, timezone: string>, "
    "attributions: array<struct<name: string, url: string>>>"
)


def read_documents(spark: SparkSession, path: str, schema: str, key: str, multiline: bool = True) -> DataFrame:
    """JSON documents with their integer key, taken from the file name (``.../12.json`` has key 12).

    An unreadable file gives null fields, so it adds no rows downstream. ``_doc`` is the place of the file in landing
    order, by modification time and then by path.
    """
    docs = spark.read.schema(schema).option("multiLine", multiline).json(path)
    file = F.col("_metadata.file_path")
    landed = F.date_format("_metadata.file_modification_time", "yyyyMMddHHmmss.SSSSSS")
    return docs.select(
        F.regexp_extract(file, r"(\d+)\.json[^/]*$", 1).try_cast("int").alias(key), F.concat(landed, F.lit(" "), file).alias("_doc"), "*"
    )


def newest_documents(docs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One document per key: the last to land."""
    from sensorloom.operators.windows import last_wins

    return last_wins(docs, keys, ["_doc"])


def record_rows(df: DataFrame, keys: Sequence[str], items: str | Column = "list") -> DataFrame:
    """One row per list item that has a non-zero ``dt``: keys, feed position, ``dt``, the item.

    A missing or empty list gives no rows.
    """
    rows = df.select(*keys, F.posexplode(items).alias("pos", "item"))
    return rows.filter(F.col("item.dt").isNotNull() & (F.col("item.dt") != 0)).select(
        *keys, "pos", F.col("item.dt").alias("dt"), "item"
    )


def read_record_feed(spark: SparkSession, path: str, key: str, schema: str = RECORD_SCHEMA, multiline: bool = True):
    return record_rows(read_documents(spark, path, schema, key, multiline), [key, "_doc"])


def unzip_arrays(df: DataFrame, keys: Sequence[str], time: str | Column, values: dict[str, str | Column]) -> DataFrame:
    """One row per element of the time array; ``{output name: array}`` read at the same position.

    Shorter arrays are padded with null, longer ones are cut to the length of the time array.
    """
    kept = {f"_{name}": (F.col(c) if isinstance(c, str) else c) for name, c in values.items()}
    rows = df.select(*keys, *[c.alias(n) for n, c in kept.items()], F.posexplode(time).alias("pos", "time"))
    return rows.select(*keys, "pos", "time", *[F.get(n, F.col("pos")).alias(n[1:]) for n in kept])


def read_array_feed(spark: SparkSession, path: str, key: str, multiline: bool = True) -> DataFrame:
    docs = read_documents(spark, path, ARRAY_SCHEMA, key, multiline)
    values = {"t": "hourly.temperature_2m", "h": "hourly.relative_humidity_2m",
              "p": "hourly.surface_pressure", "w": "hourly.wind_speed_10m"}
    rows = unzip_arrays(docs, [key, "_doc"], "hourly.time", values)
    return rows.withColumn("time", ft.iso_ts(F.col("time")))


def metadata_rows(df: DataFrame, key: str, name: str) -> DataFrame:
    """Station columns of each entity; anything but status ``ok`` leaves them null.

    ``name`` is the column with the entity's own name, used where the station has none. Other missing texts
    of an ``ok`` document become "".
    """
    ok = F.col("status") == "ok"
    city = F.col("data.city")

    def when_ok(c: Column) -> Column:
        return F.when(ok, c)

    return df.select(
        key,
        when_ok(F.coalesce(city["name"], F.col(name))).alias("station_nom"),
        when_ok(fv.json_get(city, "url", "")).alias("station_url"),
        when_ok(F.col("data.idx")).alias("station_idx"),
        when_ok(fv.json_get(city, "timezone", "")).alias("station_timezone"),
        when_ok(
            F.coalesce(fv.struct_array_json(F.col("data.attributions"), {"name": "nom", "url": "url"}), F.lit(""))
        ).alias("attributions"),
    )


def read_metadata_feed(spark: SparkSession, path: str, key: str, cities: DataFrame, city_key: str, city_name: str, multiline: bool = True):
    """Station metadata for every listed city: its last landed document; a city without one gets nulls."""
    docs = newest_documents(read_documents(spark, path, METADATA_SCHEMA, key, multiline), [key])
    named = cities.select(F.col(city_key).alias(key), F.col(city_name).alias("_name"))
    from sensorloom.operators.joins import join_dim

    return metadata_rows(join_dim(named, docs, key, "left"), key, "_name")
