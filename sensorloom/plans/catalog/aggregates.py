"""Aggregates."""

from datetime import date

from pyspark.sql import functions as F

from sensorloom.functions import time as ft
from sensorloom.operators import aggregates as agg
from sensorloom.operators.scaling import flag_top_share, standardise
from sensorloom.plans.catalog.registry import EVENTS, events, near, near_sql, query, table
from sensorloom.session import settle


@query("D1", "SELECT count(*) AS n FROM events")
def event_rows(spark, sf):
    return agg.row_count(table(spark, sf, "events"))


@query("D2", "SELECT count(DISTINCT user_id) AS n FROM events")
def distinct_users(spark, sf):
    return agg.distinct_count(table(spark, sf, "events"), "user_id")


@query(
    "D3",
    f"SELECT event_type, count(CASE WHEN k > 30 THEN value END) AS n FROM {EVENTS} GROUP BY 1",
)
def values_by_type(spark, sf):
    df = events(spark, sf).withColumn("v", F.when(F.col("k") > 30, F.col("value")))
    return agg.count_by(df, ["event_type"], "v")


_MEANS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "D4 B6 C2",
    f"""
    SELECT n_name, {", ".join(f"{near_sql(f'avg({c})')} AS {c}" for c in _MEANS)}
    FROM (SELECT l_suppkey, l_quantity, l_extendedprice, l_discount, CASE WHEN l_linenumber <> 3 THEN l_tax END AS l_tax
          FROM lineitem)
    JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey
    GROUP BY 1
    """,
)
def nation_means(spark, sf):
    """Means by nation with missing values given as NaN."""
    return nation_mean_frame(spark, sf).select("n_name", *[near(F.col(c)).alias(c) for c in _MEANS])


def nation_lines(spark, sf):
    from sensorloom.operators.joins import join_dim

    suppliers = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    nations = table(spark, sf, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name", "n_regionkey")
    lines = table(spark, sf, "lineitem").withColumn(
        "l_tax", F.when(F.col("l_linenumber") == 3, float("nan")).otherwise(F.col("l_tax"))
    )
    dim = join_dim(suppliers, nations, "s_nationkey")
    return join_dim(lines.select("l_suppkey", *_MEANS), dim, "l_suppkey")


def nation_mean_frame(spark, sf):
    from sensorloom.operators.relational import drop_incomplete

    return drop_incomplete(agg.mean_by(nation_lines(spark, sf), ["n_name"], _MEANS), _MEANS)


@query(
    "D5",
    f"""
    SELECT user_id, count(*) AS n, count(CASE WHEN k > 25 THEN value END) AS present,
           CAST(round_even(CAST(count(CASE WHEN k > 25 THEN value END) AS DOUBLE) / count(*) * 100, 0) AS BIGINT) AS pct
    FROM {EVENTS} GROUP BY 1
    """,
)
def filled_share(spark, sf):
    df = events(spark, sf).withColumn("v", F.when(F.col("k") > 25, F.col("value")))
    return agg.completeness(df, ["user_id"], "v")


@query(
    "D6",
    'SELECT user_id, min(ts) AS "first", max(ts) AS "last" FROM events GROUP BY 1',
)
def user_extent(spark, sf):
    return agg.extent(table(spark, sf, "events"), ["user_id"], "ts")


@query(
    "D7",
    f"SELECT {near_sql('quantile_cont(epoch_us(ts), 0.8)', 1)} AS cut_us FROM events",
)
def event_time_cut(spark, sf):
    cut = agg.time_quantile(table(spark, sf, "events"), "ts", 0.8)
    return spark.createDataFrame([(cut,)], "cut double").select(near(F.col("cut"), 1).alias("cut_us"))


@query(
    "D9 H7",
    "SELECT DISTINCT CAST(ts AS DATE) AS day, event_type FROM events",
)
def active_days(spark, sf):
    df = table(spark, sf, "events").withColumn("day", ft.day_of(F.col("ts")))
    return agg.distinct_rows(df, ["day", "event_type"])


@query(
    "D10",
    f"SELECT event_type, count(*) FILTER (WHERE k = 42) AS n FROM {EVENTS} GROUP BY 1",
)
def flags_by_type(spark, sf):
    return agg.count_true(events(spark, sf), F.col("k") == 42, ["event_type"])


@query("D15", f"SELECT count(CASE WHEN k >= 25 THEN props END) AS n FROM {EVENTS}")
def present_props(spark, sf):
    df = events(spark, sf).withColumn("p", F.when(F.col("k") >= 25, F.col("props")))
    return agg.count_present(df, "p")


_SPREAD = ", ".join(f"avg({c}) AS {c}_m, stddev_pop({c}) AS {c}_s" for c in _MEANS)
_SCORE = " + ".join(f"(({c} - {c}_m) / {c}_s) * (({c} - {c}_m) / {c}_s)" for c in _MEANS)


@query(
    "D11 D12",
    f"""
    WITH scored AS (
      SELECT l_orderkey, l_linenumber, {_SCORE} AS score FROM lineitem, (SELECT {_SPREAD} FROM lineitem)),
    cut AS (SELECT quantile_cont(score, 0.9) AS thr FROM scored)
    SELECT l_orderkey, l_linenumber, {near_sql("score")} AS score, score > thr AS flag FROM scored, cut
    """,
)
def outlying_lines(spark, sf):
    """Sum of squared standard scores; the tenth of the lines above the 0.9 quantile is flagged."""
    z = standardise(table(spark, sf, "lineitem"), _MEANS, "_z")
    terms = [F.col(f"{c}_z") * F.col(f"{c}_z") for c in _MEANS]
    score = terms[0] + terms[1] + terms[2] + terms[3]
    scored = settle(z.select("l_orderkey", "l_linenumber", score.alias("score")))
    return flag_top_share(scored, "score", 0.1).withColumn("score", near(F.col("score")))


@query(
    "D14",
    """
    SELECT c_custkey AS user_id, CAST(16 * 24 AS BIGINT) AS expected, count(event_id) AS actual
    FROM customer LEFT JOIN events ON user_id = c_custkey AND CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'
    GROUP BY 1
    """,
)
def hour_coverage(spark, sf):
    """Rows of every customer against 16 requested days; many have none."""
    asked = table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"))
    return agg.coverage(table(spark, sf, "events"), ["user_id"], "ts", 24, date(2024, 1, 5), date(2024, 1, 20), asked)


@query(
    "D14",
    """
    SELECT user_id, (datediff('day', CAST(min(ts) AS DATE), CAST(max(ts) AS DATE)) + 1) * 24 AS expected, count(*) AS actual
    FROM events GROUP BY 1
    """,
)
def own_coverage(spark, sf):
    """Rows of each user against the days from its own first to its own last."""
    return agg.coverage(table(spark, sf, "events"), ["user_id"], "ts")


@query(
    "D14",
    """
    WITH hours AS (SELECT unnest(generate_series(TIMESTAMP '2024-01-05 00:00:00', TIMESTAMP '2024-01-20 23:00:00', INTERVAL 1 HOUR)) AS hour),
    missing AS (
      SELECT c_custkey AS user_id, hour FROM customer, hours
      WHERE NOT EXISTS (SELECT 1 FROM events WHERE user_id = c_custkey AND date_trunc('hour', ts) = hour)),
    islands AS (SELECT *, hour - INTERVAL 1 HOUR * row_number() OVER (PARTITION BY user_id ORDER BY hour) AS island FROM missing)
    SELECT user_id, min(hour) AS from_hour, max(hour) AS to_hour, count(*) AS hours FROM islands GROUP BY user_id, island
    """,
)
def missing_hours(spark, sf):
    """Ranges of hours without events, of every customer over 16 requested days; many lack all of them."""
    asked = table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"))
    return agg.missing_hours(table(spark, sf, "events"), ["user_id"], "ts", date(2024, 1, 5), date(2024, 1, 20), asked)


_SHARES = {"q10": 0.1, "q50": 0.5, "q90": 0.9}


@query(
    "D7",
    """
    SELECT event_type, name, n, TRUE AS within FROM (SELECT event_type, count(value) AS n FROM events GROUP BY 1), (SELECT unnest(['q10', 'q50', 'q90']) AS name)
    """,
)
def sketched_quantiles(spark, sf):
    """Sketched quantiles of the value per type, and whether the rank of each, counted over all rows, errs by no more than two hundredths of
    the rows (twice the error asked for, which the sketch keeps with a confidence of 99 % only)."""
    df = table(spark, sf, "events").select("event_type", "value")
    found = agg.quantiles_by(df, ["event_type"], "value", _SHARES, accuracy=0.01)
    wanted = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(q).alias("q"), F.col(name).alias("x")) for name, q in _SHARES.items()])
    each = found.select("event_type", F.inline(wanted))
    ranks = df.join(F.broadcast(each), "event_type").groupBy("event_type", "name", "q").agg(  # a few types and three quantiles
        F.count("value").alias("n"), F.count_if(F.col("value") < F.col("x")).alias("below"), F.count_if(F.col("value") <= F.col("x")).alias("upto")
    )
    error = F.greatest(F.col("below") - F.col("q") * F.col("n"), F.col("q") * F.col("n") - F.col("upto"), F.lit(0.0)) / F.col("n")
    return ranks.select("event_type", "name", "n", (error <= 0.02).alias("within"))
