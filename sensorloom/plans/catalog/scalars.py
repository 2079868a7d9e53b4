"""Scalar expressions."""

from pyspark.sql import functions as F

from sensorloom.functions import time as ft, values as fv
from sensorloom.plans.catalog.registry import EVENTS, events, exact_sql, near, near_sql, query, table
from sensorloom.plans.reference_data import DOMINANCE, INDEX_SCALE, RANGES


@query(
    "H1 H2 H4 H5 H6 H7 H8 H9 H10 H27",
    f"""
    SELECT event_id,
           date_trunc('second', ts) AS second_of,
           date_trunc('hour', ts) AS hour_of,
           strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS hour_text,
           CAST(extract('year' FROM ts) AS INTEGER) AS annee,
           CAST(extract('month' FROM ts) AS INTEGER) AS mois,
           CAST(extract('day' FROM ts) AS INTEGER) AS jour,
           CAST(extract('hour' FROM ts) AS INTEGER) AS heure,
           CAST(extract('week' FROM ts) AS INTEGER) AS semaine,
           CAST(extract('isodow' FROM ts) - 1 AS INTEGER) AS jour_semaine,
           CAST(extract('doy' FROM ts) AS INTEGER) AS jour_annee,
           CAST(ts AS DATE) AS date,
           rpad(dayname(ts), 9, ' ') AS jour_nom,
           {near_sql("sin(2 * pi() * extract('hour' FROM ts) / 24)")} AS heure_sin,
           {near_sql("cos(2 * pi() * extract('hour' FROM ts) / 24)")} AS heure_cos,
           {near_sql("sin(2 * pi() * extract('month' FROM ts) / 12)")} AS mois_sin,
           {near_sql("cos(2 * pi() * extract('month' FROM ts) / 12)")} AS mois_cos
    FROM events
    """,
)
def calendar_parts(spark, sf):
    ts = F.col("ts")
    parts = {
        "annee": "year", "mois": "month", "jour": "day", "heure": "hour",
        "semaine": "week", "jour_semaine": "weekday", "jour_annee": "day_of_year",
    }
    hour_sin, hour_cos = ft.cyclic(F.hour(ts), 24)
    month_sin, month_cos = ft.cyclic(F.month(ts), 12)
    return table(spark, sf, "events").select(
        "event_id",
        ft.epoch_to_ts(F.floor(ft.micros(ts) / 1_000_000)).alias("second_of"),
        ft.bucket(ts).alias("hour_of"),
        ft.hour_text(ts).alias("hour_text"),
        *[c.alias(n) for n, c in ft.calendar(ts, parts).items()],
        ft.day_of(ts).alias("date"),
        ft.weekday_name(ts).alias("jour_nom"),
        near(hour_sin).alias("heure_sin"),
        near(hour_cos).alias("heure_cos"),
        near(month_sin).alias("mois_sin"),
        near(month_cos).alias("mois_cos"),
    )


@query(
    "H11 H28",
    """
    SELECT o_orderkey,
           CAST(epoch(CAST(o_orderdate AS DATE)) AS BIGINT) AS start_s,
           CAST(epoch(CAST(l.last_ship AS DATE)) + 86399 AS BIGINT) AS stop_s,
           CAST(datediff('day', CAST(o_orderdate AS DATE), CAST(l.last_ship AS DATE)) + 1 AS INTEGER) AS days
    FROM orders JOIN (SELECT l_orderkey, max(l_shipdate) AS last_ship FROM lineitem GROUP BY 1) l
      ON l_orderkey = o_orderkey
    """,
)
def order_day_bounds(spark, sf):
    shipped = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.max("l_shipdate").alias("last_ship"))
    both = table(spark, sf, "orders").join(shipped, F.col("o_orderkey") == F.col("l_orderkey"))
    first = ft.to_ts(F.date_format("o_orderdate", "yyyy-MM-dd"))
    start, stop, days = ft.day_bounds(first, F.col("last_ship"))
    return both.select("o_orderkey", start.alias("start_s"), stop.alias("stop_s"), days.alias("days"))


@query(
    "H3",
    f"""
    SELECT event_id,
           CASE WHEN k % 3 = 0 THEN date_trunc('minute', ts)
                WHEN k % 3 = 1 THEN date_trunc('second', ts) END AS parsed
    FROM {EVENTS}
    """,
)
def iso_times(spark, sf):
    k = F.col("k")
    text = (
        F.when(k % 3 == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm"))
        .when(k % 3 == 1, F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .otherwise("soon")
    )
    return events(spark, sf).select("event_id", ft.iso_ts(text).alias("parsed"))


def _range(kind):
    return "{} AND {}".format(*RANGES[kind])


@query(
    "H13 H14 H15 H16 H17",
    f"""
    WITH read AS (
      SELECT event_id, k, CASE k % 8 WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 2 THEN value WHEN 3 THEN 1000 + k
             WHEN 4 THEN NULL WHEN 5 THEN -value / 8 WHEN 6 THEN value / 8 ELSE k END AS x
      FROM {EVENTS})
    SELECT event_id, CAST(x AS DOUBLE) AS x,
           {exact_sql("CASE WHEN x BETWEEN " + _range("h") + " THEN x END")} AS humidity,
           {exact_sql("CASE WHEN x BETWEEN " + _range("t") + " THEN x END")} AS temperature,
           {exact_sql("x")} AS unchecked,
           CAST(coalesce(x, 0) AS DOUBLE) AS filled,
           {near_sql("coalesce(x, 0) * 0.01::DOUBLE")} AS scaled
    FROM read
    """,
)
def cleaned_numbers(spark, sf):
    k, value = F.col("k"), F.col("value")
    text = (
        F.when(k % 8 == 0, F.concat(value.cast("string"), F.lit("d")))
        .when(k % 8 == 1, F.lit("NaN"))
        .when(k % 8 == 2, F.concat(F.lit(" "), value.cast("string")))
        .when(k % 8 == 3, F.concat(F.lit("1_0"), F.lpad(k.cast("string"), 2, "0")))
        .when(k % 8 == 4, F.lit("inf"))
        .when(k % 8 == 5, (-value / 8).cast("string"))
        .when(k % 8 == 6, (value / 8).cast("string"))
        .otherwise(k.cast("string"))
    )
    read = events(spark, sf).select(
        "event_id", fv.to_number(text, text=True).alias("x"), *[text.alias(c) for c in ("humidity", "temperature", "unchecked")]
    )
    kinds = {"humidity": RANGES["h"], "temperature": RANGES["t"], "unchecked": (None, None)}
    filled = fv.zero_if_missing(F.col("x"))
    return fv.clean_columns(read, kinds, text=True).withColumns(
        {"filled": filled, "scaled": near(fv.scale(filled, 0.01))}
    )


@query(
    "H15",
    f"""
    SELECT l_orderkey, l_linenumber, {exact_sql("l_extendedprice / 8")} AS price,
           {exact_sql("l_extendedprice * (1 - l_discount)")} AS net,
           {exact_sql("-l_tax * l_quantity / 16", 3)} AS tax,
           {exact_sql("l_extendedprice / l_quantity", 4)} AS unit_price
    FROM lineitem
    """,
)
def rounded_prices(spark, sf):
    price, quantity = F.col("l_extendedprice"), F.col("l_quantity")
    raw = table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        (price / 8).alias("price"),
        (price * (1 - F.col("l_discount"))).alias("net"),
        (-F.col("l_tax") * quantity / 16).alias("tax"),
        (price / quantity).alias("unit_price"),
    )
    digits = {"price": 2, "net": 2, "tax": 3, "unit_price": 4}
    return fv.round_columns(raw, digits)


@query(
    "H16 H17 H18",
    """
    WITH parts AS (
      SELECT l_orderkey, l_linenumber,
             CASE WHEN l_linenumber % 3 = 0 THEN 0 ELSE l_quantity END AS pm25,
             l_quantity AS pm10, l_tax * 500 AS no2, l_discount * 400 AS o3,
             CASE WHEN l_returnflag = 'A' THEN 0 ELSE l_quantity END AS so2, l_extendedprice / 10 * 0.01 AS co
      FROM lineitem)
    SELECT l_orderkey, l_linenumber,
           CASE greatest(pm25, pm10, no2, o3, so2, co)
             WHEN pm25 THEN 'pm25' WHEN pm10 THEN 'pm10' WHEN no2 THEN 'no2'
             WHEN o3 THEN 'o3' WHEN so2 THEN 'so2' ELSE 'co' END AS dominant
    FROM parts
    """,
)
def dominant_part(spark, sf):
    quantity = F.col("l_quantity")
    raw = {
        "pm25": F.when(F.col("l_linenumber") % 3 != 0, quantity),
        "pm10": quantity,
        "no2": F.col("l_tax") * 500,
        "o3": F.col("l_discount") * 400,
        "so2": F.when(F.col("l_returnflag") != "A", quantity),
        "co": F.col("l_extendedprice") / 10,
    }
    compared = {n: fv.scale(fv.zero_if_missing(raw[n]), factor) for n, (_, factor) in DOMINANCE.items()}
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", fv.argmax_name(compared).alias("dominant")
    )


@query(
    "H19 H20 H21 H22 H23 H24 H27",
    f"""
    SELECT event_id,
           CASE k % 7 WHEN 1 THEN 25 WHEN 2 THEN 75 WHEN 3 THEN 100 WHEN 4 THEN 150 WHEN 5 THEN 200 END AS aqi,
           CASE k % 6 WHEN 0 THEN 'calme' WHEN 1 THEN 'moyen' WHEN 2 THEN 'fort'
                ELSE 'Groupe ' || CAST(k % 6 AS VARCHAR) END AS groupe,
           greatest(0::DOUBLE, {exact_sql("value - k")}) AS clamped,
           CASE WHEN value <= k THEN 'bas' ELSE 'haut' END AS side,
           k = 42 AS answer,
           {near_sql("value - k")} AS residual,
           {near_sql("CASE WHEN value <> 0 THEN abs((value - k) / value) END")} AS relative,
           CAST(user_id AS INTEGER) AS user_int
    FROM {EVENTS}
    """,
)
def labelled_values(spark, sf):
    k, value = F.col("k"), F.col("value")
    return fv.round_columns(events(spark, sf).withColumn("surplus", value - k), {"surplus": 2}).select(
        "event_id",
        fv.map_code(k % 7, INDEX_SCALE).alias("aqi"),
        fv.map_label(k % 6, {0: "calme", 1: "moyen", 2: "fort"}, "Groupe ").alias("groupe"),
        fv.clamp_min(F.col("surplus"), 0).alias("clamped"),
        fv.label_if(value <= k, "bas", "haut").alias("side"),
        fv.flag_eq(k, 42).alias("answer"),
        near(fv.residual(value, k)).alias("residual"),
        near(fv.relative_residual(value, k)).alias("relative"),
        F.col("user_id").cast("int").alias("user_int"),
    )
