"""Star schema, filters, joins and set operations."""

from pyspark.sql import functions as F

from sensorloom.functions import values as fv
from sensorloom.operators.aggregates import min_rows_per
from sensorloom.operators.joins import bucket_left_join, join_dim, keep_matched, left_join_latest, lookup, to_long
from sensorloom.operators.quality import check_not_null, check_unique, run_checks
from sensorloom.operators.relational import (
    drop_if_present, drop_incomplete, project, rename_all, require, sort, stack, top_groups, where_eq, where_true,
)
from sensorloom.plans import star
from sensorloom.plans.catalog.registry import EVENTS, events, oracles, query, table
from sensorloom.plans.reference_data import POLLUTANTS
from sensorloom.session import new_path


def _bucket_sql(unit, latest=False):
    cut = f"QUALIFY row_number() OVER (PARTITION BY user_id, date_trunc('{unit}', ts) ORDER BY ts DESC, event_id DESC) = 1" if latest else ""
    return f"""
    SELECT a.event_id, a.user_id AS station_id, a.user_id AS city_id, a.ts AS datetime_utc, a.value,
           m.value AS temperature, m.event_id AS m_event, p.value AS pm10, p.event_id AS p_event
    FROM events a
    LEFT JOIN (SELECT * FROM events WHERE event_type = 'view' {cut}) m
      ON a.user_id = m.user_id AND date_trunc('{unit}', a.ts) = date_trunc('{unit}', m.ts)
    LEFT JOIN (SELECT * FROM events WHERE event_type = 'click' {cut}) p
      ON a.user_id = p.user_id AND date_trunc('{unit}', a.ts) = date_trunc('{unit}', p.ts)
    WHERE a.user_id IS NOT NULL
    """


def _bucket_join(spark, sf, unit, latest=None):
    base = table(spark, sf, "events").select("event_id", "user_id", "ts", "value")
    feed = table(spark, sf, "events").select("event_id", "user_id", "ts", "value", "event_type")
    feeds = {
        "m": drop_if_present(where_eq(feed, "event_type", "view"), "event_type", "not_there"),
        "p": drop_if_present(where_eq(feed, "event_type", "click"), "event_type"),
    }
    joined = bucket_left_join(require(base, "user_id"), feeds, ["user_id"], "ts", "ts", unit, latest=latest)
    names = {
        "event_id": "event_id", "station_id": "user_id", "city_id": "user_id", "datetime_utc": "ts", "value": "value",
        "temperature": "m_value", "m_event": "m_event_id", "pm10": "p_value", "p_event": "p_event_id",
    }
    return project(joined, names)


@query("C1 B1 B2 B4 B5 B7 H2", _bucket_sql("hour"))
def hour_fact(spark, sf):
    """Events with the views and clicks of the same user and hour."""
    return _bucket_join(spark, sf, "hour")


@query("C1 B1 B2", _bucket_sql("day"))
def day_fact(spark, sf):
    """As hour_fact by day, where several matches in a bucket multiply the rows."""
    return _bucket_join(spark, sf, "day")


@query("C1 D13", _bucket_sql("day", latest=True))
def latest_day_fact(spark, sf):
    """As day_fact with the latest view and click of a day alone, so that each event stays one row."""
    return _bucket_join(spark, sf, "day", ["event_id"])


def _measures(spark, sf):
    return events(spark, sf).withColumnsRenamed({"user_id": "ville_id", "ts": "collecte_le"})


def air_frame(spark, sf):
    value, k = F.col("value"), F.col("k").cast("double")
    return _measures(spark, sf).select(
        # some measurements have no time, for the order of missing times
        "ville_id", F.when(k != 13, F.col("collecte_le")).alias("collecte_le"), "event_id",
        value.alias("aqi_global"), F.col("event_type").alias("polluant_dominant"),
        *[(value * i).alias(c) for i, c in enumerate(("pm25", "pm10", "no2", "o3", "co", "so2"), 1)],
        *[(k * i).alias(c) for i, c in enumerate(("temperature", "humidite", "pression", "vent"), 1)],
        F.col("event_type").alias("station_nom"), F.col("props").alias("station_url"),
        F.when(k > 50, "UTC").alias("station_timezone"),
    )


def _weather(spark, sf):
    return where_eq(_measures(spark, sf), "event_type", "view").select(
        "ville_id", "collecte_le",
        *[(F.col("value") + i).alias(c) for i, c in enumerate(star.FACT_WEATHER) if not c.startswith("condition")],
        F.col("event_type").alias("condition_libelle"), F.col("props").alias("condition_desc"),
    )


def _pollution(spark, sf):
    return where_eq(_measures(spark, sf), "event_type", "click").select(
        "ville_id", "collecte_le", F.col("k").alias("aqi_owm"),
        *[(F.col("value") - i).alias(c) for i, c in enumerate(list(star.FACT_POLLUTION.values())[1:])],
    )


def city_frame(spark, sf):
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("nom"), F.col("c_mktsegment").alias("slug_aqicn"),
        F.col("c_acctbal").alias("latitude"), F.col("c_nationkey").cast("double").alias("longitude"),
        F.when(F.col("c_nationkey") != 7, F.col("c_acctbal") > 0).alias("actif"),
    )


AIR_SQL = f"""air AS (
      SELECT user_id AS ville_id, CASE WHEN k <> 13 THEN ts END AS collecte_le, event_id, value, k, event_type, props
      FROM {EVENTS})"""
CITY_SQL = """ville AS (
      SELECT c_custkey AS id, c_name AS nom, c_mktsegment AS slug, c_acctbal AS latitude,
             CAST(c_nationkey AS DOUBLE) AS longitude, CASE WHEN c_nationkey <> 7 THEN c_acctbal > 0 END AS actif
      FROM customer)"""


@query(
    "A10 D9 B4 H4 H5 H6 H7 H27",
    f"""
    WITH {AIR_SQL}
    SELECT DISTINCT collecte_le AS datetime_utc, CAST(collecte_le AS DATE) AS date,
           CAST(extract('year' FROM collecte_le) AS INTEGER) AS annee,
           CAST(extract('month' FROM collecte_le) AS INTEGER) AS mois,
           CAST(extract('day' FROM collecte_le) AS INTEGER) AS jour,
           CAST(extract('hour' FROM collecte_le) AS INTEGER) AS heure,
           CAST(extract('week' FROM collecte_le) AS INTEGER) AS semaine,
           rpad(dayname(collecte_le), 9, ' ') AS jour_semaine
    FROM air WHERE collecte_le IS NOT NULL
    """,
)
def star_dim_time(spark, sf):
    return star.dim_time(air_frame(spark, sf))


@query(
    "A10 B1 B3",
    f"""
    WITH {CITY_SQL}
    SELECT id AS city_id, nom AS city_nom, slug AS city_slug, latitude, longitude FROM ville WHERE actif = TRUE
    """,
)
def star_dim_city(spark, sf):
    return star.dim_city(city_frame(spark, sf))


@query(
    "A10 B1 B3 C3 E4 F2",
    f"""
    WITH {AIR_SQL}, {CITY_SQL}
    SELECT DISTINCT ON (v.id) v.id AS station_id, slug AS station_slug, nom AS station_nom, latitude, longitude,
           a.event_type AS station_nom_aqicn, a.props AS station_url, CASE WHEN a.k > 50 THEN 'UTC' END AS timezone
    FROM ville v LEFT JOIN air a ON v.id = a.ville_id
    WHERE v.actif = TRUE
    ORDER BY v.id, a.collecte_le DESC NULLS FIRST, a.event_id DESC
    """,
)
def star_dim_station(spark, sf):
    return star.dim_station(city_frame(spark, sf), air_frame(spark, sf), ("event_id",))


@query(
    "A10 B1 B2 C1",
    f"""
    WITH {AIR_SQL}
    SELECT a.ville_id AS station_id, a.ville_id AS city_id, a.collecte_le AS datetime_utc, a.value AS aqi_global,
           a.event_type AS polluant_dominant, a.value * 1 AS pm25, a.value * 2 AS pm10, a.value * 3 AS no2,
           a.value * 4 AS o3, a.value * 5 AS co, a.value * 6 AS so2, CAST(a.k AS DOUBLE) AS temp_aqicn,
           CAST(a.k * 2 AS DOUBLE) AS humidite_aqicn, CAST(a.k * 3 AS DOUBLE) AS pression_aqicn,
           CAST(a.k * 4 AS DOUBLE) AS vent_aqicn,
           {", ".join(f"m.value + {i} AS {c}" for i, c in enumerate(star.FACT_WEATHER) if not c.startswith("condition"))},
           m.event_type AS condition_libelle, m.props AS condition_desc,
           p.k AS aqi_owm,
           {", ".join(f"p.value - {i} AS {out}" for i, out in enumerate(list(star.FACT_POLLUTION)[1:]))}
    FROM air a
    LEFT JOIN (SELECT * FROM {EVENTS} WHERE event_type = 'view') m
      ON a.ville_id = m.user_id AND date_trunc('hour', a.collecte_le) = date_trunc('hour', m.ts)
    LEFT JOIN (SELECT * FROM {EVENTS} WHERE event_type = 'click') p
      ON a.ville_id = p.user_id AND date_trunc('hour', a.collecte_le) = date_trunc('hour', p.ts)
    WHERE a.ville_id IS NOT NULL
    """,
)
def star_fact(spark, sf):
    """The 36-column fact."""
    return star.fact_air_quality(air_frame(spark, sf), _weather(spark, sf), _pollution(spark, sf))


#: Tables of the star and a column whose sum shows that the rows are the right ones.
_STAR = {"dim_time": "heure", "dim_city": "city_id", "dim_station": "station_id", "fact_air_quality": "humidite_aqicn"}


@query(
    "A10 A7",
    f"""
    {" UNION ALL ".join(
        f"SELECT '{name}' AS name, count(*) AS n, sum({c})::DOUBLE AS total FROM ({oracles()[own]})"
        for (name, c), own in zip(_STAR.items(), ("star_dim_time", "star_dim_city", "star_dim_station", "star_fact"))
    )}
    UNION ALL SELECT 'dim_pollutant', {len(POLLUTANTS)}, NULL
    """,
)
def star_tables(spark, sf):
    """The whole star, written as five tables and read back."""
    folder = new_path(spark, "gold")
    sources = {"ville": city_frame(spark, sf), "mesure_air_aqicn": air_frame(spark, sf), "mesure_meteo": _weather(spark, sf), "mesure_pollution_owm": _pollution(spark, sf)}
    models = star.build_star(spark, sources, folder)
    totals = {name: F.sum(F.col(c).cast("double")) for name, c in _STAR.items()}
    parts = [
        spark.read.schema(df.schema).parquet(f"{folder}/{name}")
        .agg(F.lit(name).alias("name"), F.count(F.lit(1)).alias("n"), totals.get(name, F.lit(None).cast("double")).alias("total"))
        for name, df in models.items()
    ]
    return stack(*parts)


@query(
    "B6 B8",
    f"""
    SELECT ts AS ds, value AS y FROM {EVENTS} WHERE k >= 20 AND k < 80
    """,
)
def complete_pairs(spark, sf):
    """Time and value renamed by position; rows with a null or NaN value dropped."""
    k = F.col("k")
    value = F.when(k >= 80, float("nan")).when(k >= 20, F.col("value"))
    return rename_all(drop_incomplete(events(spark, sf).select("ts", value.alias("v")), ["v"]), "ds", "y")


@query(
    "B11",
    """
    SELECT event_id, user_id, event_type FROM events
    JOIN (SELECT user_id, event_type FROM events GROUP BY 1, 2 HAVING count(*) >= 14) USING (user_id, event_type)
    """,
)
def long_enough_series(spark, sf):
    df = table(spark, sf, "events").select("event_id", "user_id", "event_type")
    return min_rows_per(df, ["user_id", "event_type"], 14)


@query(
    "B12 B3",
    """
    SELECT c_custkey, c_name FROM customer
    WHERE c_acctbal > 0 AND EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')
    """,
)
def matched_customers(spark, sf):
    customers = where_true(table(spark, sf, "customer"), F.col("c_acctbal") > 0).select("c_custkey", "c_name")
    orders = where_eq(table(spark, sf, "orders"), "o_orderstatus", "F")
    return keep_matched(customers, orders.withColumnRenamed("o_custkey", "c_custkey"), ["c_custkey"])


@query(
    "C2 B1",
    """
    SELECT l_orderkey, l_linenumber, l_quantity, s_name, n_name
    FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey
    """,
)
def lines_with_supplier(spark, sf):
    suppliers = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name", "s_nationkey")
    nations = table(spark, sf, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_suppkey")
    named = join_dim(suppliers, nations, "s_nationkey")
    return join_dim(lines, named, "l_suppkey").select("l_orderkey", "l_linenumber", "l_quantity", "s_name", "n_name")


@query(
    "C3 E4 F2",
    """
    SELECT c_custkey, c_name, o_orderkey, o_totalprice FROM customer LEFT JOIN (
      SELECT DISTINCT ON (o_custkey) o_custkey, o_orderkey, o_totalprice FROM (
        SELECT *, CASE WHEN o_orderpriority <> '1-URGENT' THEN o_orderdate END AS seen FROM orders)
      ORDER BY o_custkey, seen DESC NULLS FIRST, o_orderkey DESC) o ON o_custkey = c_custkey
    """,
)
def latest_order(spark, sf):
    """Each customer with the latest order; an order without a date counts as the latest."""
    seen = F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_orderdate"))
    orders = table(spark, sf, "orders").withColumn("seen", seen).withColumnRenamed("o_custkey", "c_custkey")
    customers = table(spark, sf, "customer").select("c_custkey", "c_name")
    return left_join_latest(customers, orders, "c_custkey", "seen", ["o_orderkey"], ["o_orderkey", "o_totalprice"])


@query(
    "C5",
    """
    SELECT event_id, user_id, coalesce(c_name, 'inconnu') AS c_name, coalesce(c_mktsegment, '') AS c_mktsegment
    FROM events LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 2000) ON c_custkey = user_id
    """,
)
def events_with_defaults(spark, sf):
    dim = table(spark, sf, "customer").filter(F.col("c_acctbal") > 2000)
    dim = dim.select(F.col("c_custkey").alias("user_id"), "c_name", "c_mktsegment")
    df = table(spark, sf, "events").select("event_id", "user_id")
    return lookup(df, dim, "user_id", {"c_name": "inconnu", "c_mktsegment": ""}).select(
        "event_id", "user_id", "c_name", "c_mktsegment"
    )


@query(
    "C6",
    """
    SELECT l_orderkey, l_linenumber, measure, y FROM lineitem
    UNPIVOT (y FOR measure IN (l_quantity, l_extendedprice, l_discount, l_tax))
    """,
)
def long_measures(spark, sf):
    return to_long(
        table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    )


@query(
    "G1 B13",
    "WITH source_data AS (SELECT o_custkey AS id FROM orders UNION ALL SELECT NULL) SELECT * FROM source_data",
)
def ids_with_null(spark, sf):
    ids = table(spark, sf, "orders").select(F.col("o_custkey").alias("id"))
    return stack(ids, spark.createDataFrame([(None,)], "id bigint"))


@query("B5 B13", "SELECT o_orderstatus AS status, o_orderkey FROM orders WHERE o_orderstatus = 'F'")
def finished_orders(spark, sf):
    orders = table(spark, sf, "orders").select(F.col("o_orderstatus").alias("status"), "o_orderkey")
    return where_eq(orders, "status", "F")


@query("J1", "SELECT o_custkey AS id, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) > 1")
def repeated_ids(spark, sf):
    return check_unique(ids_with_null(spark, sf), "id")


@query(
    "J2",
    f"SELECT event_id, user_id FROM {EVENTS} WHERE k < 10",
)
def missing_values(spark, sf):
    df = events(spark, sf).withColumn("v", F.when(F.col("k") >= 10, F.col("value")))
    return check_not_null(df, "v").select("event_id", "user_id")


@query(
    "J1 J2 J3",
    """
    SELECT 'unique' AS "check", 'o_orderkey' AS "column", 0::BIGINT AS failures, TRUE AS passed
    UNION ALL SELECT 'unique', 'o_custkey', count(*), count(*) = 0 FROM
      (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(*) > 1)
    UNION ALL SELECT 'not_null', 'seen', count(*), count(*) = 0 FROM orders WHERE o_orderpriority = '1-URGENT'
    UNION ALL SELECT 'not_null', 'o_orderdate', count(*), count(*) = 0 FROM orders WHERE o_orderdate IS NULL
    """,
)
def order_checks(spark, sf):
    seen = F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_orderdate"))
    checks = [("unique", "o_orderkey"), ("unique", "o_custkey"), ("not_null", "seen"), ("not_null", "o_orderdate")]
    return run_checks(table(spark, sf, "orders").withColumn("seen", seen), checks)


@query(
    "F1 F2",
    "SELECT c_custkey, c_nationkey, c_acctbal FROM customer ORDER BY c_nationkey, c_acctbal DESC NULLS FIRST, c_custkey",
)
def sorted_customers(spark, sf):
    df = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    return sort(df, F.asc("c_nationkey"), F.col("c_acctbal").desc_nulls_first(), "c_custkey")


@query(
    "F3 D3",
    """
    SELECT o_custkey, count(o_totalprice) AS n FROM orders GROUP BY 1 ORDER BY n DESC, o_custkey LIMIT 5
    """,
)
def busiest_customers(spark, sf):
    return top_groups(table(spark, sf, "orders"), "o_custkey", "o_totalprice", 5)
