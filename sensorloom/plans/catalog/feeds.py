"""Feeds, files and tables."""

import uuid
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from sensorloom.functions import time as ft, values as fv
from sensorloom.operators.clustering import cluster_profile
from sensorloom.operators.joins import join_dim
from sensorloom.operators.relational import stack
from sensorloom.plans.catalog.registry import EVENTS, events, exact_sql, query, table
from sensorloom.plans.history import merge_hours, pollution_hours, weather_hours
from sensorloom.plans.reference_data import HISTORY_COLUMNS, POLLUTANTS, POLLUTANT_SCHEMA
from sensorloom.operators.windows import sequential_id
from sensorloom.session import new_path
from sensorloom.sources.delimited import read_csv, write_csv
from sensorloom.sources.feeds import METADATA_SCHEMA, RECORD_SCHEMA, metadata_rows, newest_documents, record_rows, unzip_arrays
from sensorloom.sources.tables import file_stats, literal_relation, read_table, replace_table, truncate_append, with_audit


@query(
    "A1 H1 H25",
    f"""
    WITH items AS (
      SELECT event_id, k, value, u.pos, CAST(floor(epoch(ts)) AS BIGINT) + u.pos * 300 AS dt
      FROM {EVENTS}, (VALUES (0), (2)) u(pos))
    SELECT event_id, CAST(pos AS INTEGER) AS pos, dt, make_timestamp(dt * 1000000) AS at,
           CASE WHEN pos = 0 THEN k % 7 END AS aqi,
           CASE WHEN pos = 0 THEN value ELSE -1 END AS pm25
    FROM items
    """,
)
def record_feed(spark, sf):
    """Each event as a landed document: a full record, one without a time, one without values."""
    dt = F.floor(ft.micros(F.col("ts")) / 1_000_000)
    parts = F.struct(F.col("value").alias("pm2_5"), F.col("k").cast("double").alias("no2"))
    full = F.struct(dt.alias("dt"), F.struct((F.col("k") % 7).alias("aqi")).alias("main"), parts.alias("components"))
    empty = F.struct(
        (dt + 600).alias("dt"),
        F.struct(F.lit(None).cast("int").alias("aqi")).alias("main"),
        F.lit(None).cast("struct<pm2_5: double, no2: double>").alias("components"),
    )
    text = F.to_json(F.struct(F.array(full, full.withField("dt", F.lit(0).cast("bigint")), empty).alias("list")))
    docs = events(spark, sf).select("event_id", F.from_json(text, RECORD_SCHEMA).alias("doc"))
    return record_rows(docs, ["event_id"], "doc.list").select(
        "event_id", "pos", "dt", ft.epoch_to_ts(F.col("dt")).alias("at"),
        fv.json_get(F.col("item"), "main.aqi").alias("aqi"),
        fv.json_get(F.col("item"), "components.pm2_5", -1.0).alias("pm25"),
    )


@query(
    "A2 H3",
    """
    SELECT vec_id, CAST(i AS INTEGER) AS pos, TIMESTAMP '2026-03-01 00:00:00' + i * INTERVAL 1 HOUR AS at,
           CAST(embedding[i + 1] AS DOUBLE) AS same,
           CASE WHEN i < len(embedding) // 2 THEN CAST(embedding[i + 1] AS DOUBLE) END AS short,
           CAST(embedding[i + 1] AS DOUBLE) AS long
    FROM embeddings, unnest(range(len(embedding))) u(i)
    """,
)
def parallel_array_feed(spark, sf):
    """Vectors as hourly readings: one array as long as the times, one shorter, one longer."""
    start = F.lit("2026-03-01 00:00:00").cast("timestamp_ntz")
    size = F.size("embedding")
    hours = F.sequence(start, start + F.make_interval(hours=size - 1), F.expr("interval 1 hour"))
    wide = F.col("embedding").cast("array<double>")
    rows = unzip_arrays(
        table(spark, sf, "embeddings"),
        ["vec_id"],
        F.transform(hours, lambda h: F.date_format(h, "yyyy-MM-dd'T'HH:mm")),
        {"same": wide, "short": F.slice(wide, F.lit(1), F.floor(size / 2).cast("int")), "long": F.concat(wide, wide)},
    )
    return rows.select("vec_id", "pos", ft.iso_ts(F.col("time")).alias("at"), "same", "short", "long")


@query(
    "A3 H25 H26",
    """
    SELECT c_custkey,
           CASE WHEN c_acctbal > 0 THEN CASE WHEN c_nationkey % 5 = 0 THEN c_name ELSE c_mktsegment END END AS station_nom,
           CASE WHEN c_acctbal > 0 THEN CASE WHEN c_nationkey % 3 = 0 THEN '' ELSE 'c/' || c_custkey END END AS station_url,
           CASE WHEN c_acctbal > 0 THEN c_custkey END AS station_idx,
           CASE WHEN c_acctbal > 0 THEN '' END AS station_timezone,
           CASE WHEN c_acctbal > 0 THEN CASE WHEN c_nationkey % 2 = 0 THEN '' ELSE
             '[{"nom": ' || to_json(c_mktsegment || ' "é"') || ', "url": ' || to_json(c_name) || '}, {"nom": "", "url": ""}]'
             END END AS attributions
    FROM customer
    """,
)
def metadata_feed(spark, sf):
    nation = F.col("c_nationkey")
    city = F.struct(
        F.when(nation % 5 != 0, F.col("c_mktsegment")).alias("name"),
        F.when(nation % 3 != 0, F.concat(F.lit("c/"), F.col("c_custkey"))).alias("url"),
    )
    source = F.struct(F.concat("c_mktsegment", F.lit(' "é"')).alias("name"), F.col("c_name").alias("url"))
    nobody = F.lit(None).cast("string")
    blank = F.struct(nobody.alias("name"), nobody.alias("url"))
    data = F.struct(
        F.col("c_custkey").alias("idx"), city.alias("city"),
        F.when(nation % 2 != 0, F.array(source, blank)).otherwise(F.array()).alias("attributions"),
    )
    text = F.to_json(F.struct(F.when(F.col("c_acctbal") > 0, "ok").otherwise("error").alias("status"), data.alias("data")))
    landed = table(spark, sf, "customer").select("c_custkey", "c_name", F.lit("2").alias("_doc"), text.alias("text"))
    # an older document of every customer, which must not count
    older = landed.withColumns({"_doc": F.lit("10 days before"), "text": F.lit('{"status": "ok", "data": {"idx": -1}}')})
    newest = newest_documents(stack(older, landed), ["c_custkey"])
    docs = newest.select("c_custkey", "c_name", F.from_json("text", METADATA_SCHEMA).alias("doc"))
    return metadata_rows(docs.select("c_custkey", "c_name", "doc.*"), "c_custkey", "c_name")


@query(
    "A4 A5",
    """
    SELECT event_id, date_trunc('second', ts) AS ts, user_id, value, CAST(k AS DOUBLE) AS whole,
           CASE WHEN event_type = 'error' THEN NULL ELSE event_type || ';"' || props || '"' END AS note
    FROM """ + EVENTS,
)
def delimited_round_trip(spark, sf):
    """Events written to delimited files and read back."""
    note = F.when(F.col("event_type") != "error", F.concat("event_type", F.lit(';"'), "props", F.lit('"')))
    out = events(spark, sf).withColumn("note", note).withColumn("whole", F.col("k").cast("double"))
    path = new_path(spark, "events_csv")
    columns = ["event_id", "ts", "user_id", "value", "whole", "note"]
    write_csv(out, path, columns)
    schema = "event_id bigint, ts string, user_id bigint, value double, whole double, note string"
    return read_csv(spark, path, schema, ts=["ts"])


@query(
    "A6 A7 B4",
    """
    SELECT l_orderkey, l_linenumber, l_extendedprice, l_shipdate FROM lineitem
    WHERE l_shipdate >= TIMESTAMP '1998-01-01' AND l_extendedprice IS NOT NULL AND l_discount > 0.02
    """,
)
def pruned_scan(spark, sf):
    """A table written once, then read with a pushed filter and four columns."""
    path = new_path(spark, "lineitem")
    replace_table(table(spark, sf, "lineitem"), path)
    return read_table(
        spark, path, ["l_orderkey", "l_linenumber", "l_extendedprice", "l_shipdate"],
        "l_shipdate >= timestamp_ntz '1998-01-01' AND l_extendedprice IS NOT NULL AND l_discount > 0.02D",
    )


@query("A13")
def table_size(spark, sf):
    """Files and bytes behind the test tables."""
    return file_stats(spark, sf)


_POLLUTANT_ROWS = ", ".join(f"('{i}', '{n}', '{u}', '{s}')" for i, n, u, s in POLLUTANTS)
# which indicator an event type stands for; one type has none
_STANDS_FOR = [("view", "pm25"), ("click", "no2"), ("purchase", "aqi_owm"), ("error", "nh3")]
_STANDS_ROWS = ", ".join(f"('{a}', '{b}')" for a, b in _STANDS_FOR)


@query(
    "A9 A10 C2",
    f"""
    SELECT e.event_id, e.value, p.polluant_nom, p.unite, p.source
    FROM events e JOIN (VALUES {_STANDS_ROWS}) s(event_type, polluant_id) USING (event_type)
    JOIN (VALUES {_POLLUTANT_ROWS}) p(polluant_id, polluant_nom, unite, source) USING (polluant_id)
    """,
)
def measured_pollutant(spark, sf):
    """Events joined to the fixed pollutant relation."""
    stands = literal_relation(spark, _STANDS_FOR, "event_type string, polluant_id string")
    pollutants = literal_relation(spark, POLLUTANTS, POLLUTANT_SCHEMA)
    known = join_dim(table(spark, sf, "events"), stands, "event_type")
    return join_dim(known, pollutants, "polluant_id").select("event_id", "value", "polluant_nom", "unite", "source")


_RAW = {
    "pm2_5": "value", "pm10": "k * 7", "no2": "CASE WHEN k % 10 <> 0 THEN value * 4 END",
    "o3": "CAST(k AS DOUBLE) / 8", "so2": "value / 16", "co": "value * 110",
}
_NAMES = {"pm25": "pm2_5", "pm10": "pm10", "no2": "no2", "o3": "o3", "so2": "so2", "co": "co"}
_LIMITS = {"pm25": 500, "pm10": 600, "no2": 2000, "o3": 500, "so2": 1000, "co": 50000}


@query(
    "A1 B12 C4 C5 D13 E5 G2 H12 H14 H16 H17 H18 H19",
    f"""
    WITH raw AS (
      SELECT event_id, user_id, ts, k % 7 AS aqi, {", ".join(f"CAST({x} AS DOUBLE) AS {c}" for c, x in _RAW.items())}
      FROM {EVENTS}),
    pollution AS (
      SELECT * FROM (SELECT *, date_trunc('hour', ts) AS h,
                            row_number() OVER (PARTITION BY user_id, date_trunc('hour', ts) ORDER BY event_id DESC) AS rn
                     FROM raw) WHERE rn = 1),
    compared AS (
      SELECT *, coalesce(pm2_5, 0) AS a, coalesce(pm10, 0) AS b, coalesce(no2, 0) AS c,
             coalesce(o3, 0) AS d, coalesce(so2, 0) AS e, coalesce(co, 0) * 0.01::DOUBLE AS f
      FROM pollution),
    weather AS (
      SELECT * FROM (SELECT user_id, k, value, date_trunc('hour', ts) AS h,
                            row_number() OVER (PARTITION BY user_id, date_trunc('hour', ts) ORDER BY event_id DESC) AS rn
                     FROM {EVENTS} WHERE event_type IN ('view', 'click')) WHERE rn = 1)
    SELECT CAST(row_number() OVER (ORDER BY p.user_id, p.h) AS BIGINT) AS id, p.user_id AS ville_id,
           '2026-06-01 00:00:00' AS collecte_le, p.h AS mesure_le,
           CASE WHEN c_acctbal > 0 THEN 'UTC' ELSE '' END AS station_timezone,
           CASE aqi WHEN 1 THEN 25 WHEN 2 THEN 75 WHEN 3 THEN 100 WHEN 4 THEN 150 WHEN 5 THEN 200 END AS aqi_global,
           {", ".join(exact_sql(f"CASE WHEN {c} BETWEEN 0 AND {_LIMITS[n]} THEN {c} END") + f" AS {n}" for n, c in _NAMES.items())},
           {exact_sql("CASE WHEN w.value - 100 BETWEEN -60 AND 60 THEN w.value - 100 END")} AS temperature,
           {exact_sql("CASE WHEN w.k + 5 BETWEEN 0 AND 100 THEN w.k + 5 END")} AS humidite,
           {exact_sql("CASE WHEN 1000 + w.k BETWEEN 870 AND 1084 THEN 1000 + w.k END")} AS pression,
           {exact_sql("CASE WHEN w.value / 8 BETWEEN 0 AND 200 THEN w.value / 8 END")} AS vent,
           CASE greatest(a, b, c, d, e, f) WHEN a THEN 'pm25' WHEN b THEN 'pm10' WHEN c THEN 'no2'
                WHEN d THEN 'o3' WHEN e THEN 'so2' ELSE 'co' END AS polluant_dominant,
           CASE WHEN c_acctbal > 0 THEN c_name ELSE '' END AS station_nom,
           CASE WHEN c_acctbal > 0 THEN c_mktsegment ELSE '' END AS station_url,
           CASE WHEN c_acctbal > 0 THEN c_custkey END AS station_idx,
           CASE WHEN c_acctbal > 0 THEN '[]' ELSE '' END AS attributions
    FROM compared p LEFT JOIN weather w ON w.user_id = p.user_id AND w.h = p.h
    LEFT JOIN customer ON c_custkey = p.user_id
    """,
)
def hourly_history(spark, sf):
    """The whole history pipeline on events: two feeds, validation, merge, stations, row numbers."""
    ev = events(spark, sf)
    parts = F.struct(*[F.expr(x).cast("double").alias(c) for c, x in _RAW.items()])
    item = F.struct(F.struct((F.col("k") % 7).alias("aqi")).alias("main"), parts.alias("components"))
    records = ev.select(
        F.col("user_id").alias("ville_id"), "event_id", F.floor(ft.micros(F.col("ts")) / 1_000_000).alias("dt"), item.alias("item")
    )
    readings = stack(ev.filter(F.col("event_type") == "view"), ev.filter(F.col("event_type") == "click")).select(
        F.col("user_id").alias("ville_id"), "event_id", ft.bucket(F.col("ts")).alias("time"),
        (F.col("value") - 100).alias("t"), (F.col("k") + 5).alias("h"),
        (F.col("k") + 1000).alias("p"), (F.col("value") / 8).alias("w"),
    )
    ok = F.col("c_acctbal") > 0
    stations = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("ville_id"),
        *[F.when(ok, c).alias(n) for n, c in {
            "station_nom": F.col("c_name"), "station_url": F.col("c_mktsegment"), "station_idx": F.col("c_custkey"),
            "station_timezone": F.lit("UTC"), "attributions": F.lit("[]"),
        }.items()],
    )
    key = "ville_id"
    pollution = pollution_hours(records, key, ["event_id"])
    weather = weather_hours(readings, key, ["event_id"])
    merged = merge_hours(pollution, weather, stations, key)
    stamped = merged.withColumn("collecte_le", ft.run_time(datetime(2026, 6, 1, tzinfo=timezone.utc)))
    return sequential_id(stamped, [key, "mesure_le"]).select(*HISTORY_COLUMNS)


@query(
    "A11",
    """
    SELECT CAST(row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS BIGINT) AS id, o_orderkey,
           TIMESTAMP '2026-06-01 08:30:00' AS cree_le
    FROM orders
    """,
)
def audited_orders(spark, sf):
    """Orders with a row number and the load time of the run."""
    at = datetime(2026, 6, 1, 10, 30, tzinfo=timezone(timedelta(hours=2)))
    return with_audit(table(spark, sf, "orders").select("o_orderdate", "o_orderkey"), ["o_orderdate", "o_orderkey"], at).select(
        "id", "o_orderkey", "cree_le"
    )


@query("A8", "SELECT CAST(s_suppkey AS INTEGER) AS s_suppkey, s_name, s_acctbal FROM supplier WHERE s_acctbal > 0")
def refilled_table(spark, sf):
    """A table filled twice; its declared types stay and only the second filling is left."""
    path, name = new_path(spark, "refilled"), f"refilled_{uuid.uuid4().hex}"
    rows = table(spark, sf, "supplier")
    schema = "s_suppkey int, s_name string, s_acctbal double"
    spark.sql(f"CREATE TABLE {name} ({schema}) USING parquet LOCATION '{path}'")
    truncate_append(rows, name, schema)
    truncate_append(rows.filter("s_acctbal > 0"), name, schema)
    filled = spark.table(name).schema
    spark.sql(f"DROP TABLE {name}")  # the files stay
    return spark.read.schema(filled).parquet(path)


@query(
    "I12",
    f"""
    SELECT c_custkey, c_nationkey AS cluster_id, c_mktsegment AS cluster_nom, {exact_sql("c_acctbal / 7")} AS solde_moyen FROM customer
    """,
)
def customer_profiles(spark, sf):
    """The published columns of given clusters."""
    given = table(spark, sf, "customer").withColumns({"cluster_id": F.col("c_nationkey"), "cluster_nom": F.col("c_mktsegment")})
    return cluster_profile(given.withColumn("part", F.col("c_acctbal") / 7), "c_custkey", {"part": "solde_moyen"})
