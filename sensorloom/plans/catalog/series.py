"""Windows, features, metrics and forecasts."""

from pyspark.sql import functions as F

from sensorloom.operators import windows
from sensorloom.operators.clustering import name_clusters
from sensorloom.operators.features import LAG_STEPS, TIME_FEATURES, temporal_split, ts_features
from sensorloom.operators.forecast import extend_time, published, seasonal_forecast
from sensorloom.operators.metrics import compare_predictions, regression_metrics, residual_table
from sensorloom.operators.relational import stack
from sensorloom.plans.catalog.aggregates import nation_lines
from sensorloom.plans.catalog.registry import EVENTS, events, exact_sql, near, near_sql, query, table
from sensorloom.session import settle

_BY_USER = "OVER (PARTITION BY user_id ORDER BY ts, event_id)"
_FRAME = "OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING)"


def _gappy(spark, sf):
    return events(spark, sf).select(
        "event_id", "user_id", "ts", F.when(F.col("k") != 7, F.col("value")).alias("v")
    )


@query(
    "E1",
    f"""
    SELECT event_id, {", ".join(f"lag(v, {n}) {_BY_USER} AS lag_{n}" for n in LAG_STEPS)}
    FROM (SELECT *, CASE WHEN k <> 7 THEN value END AS v FROM {EVENTS})
    """,
)
def lagged_values(spark, sf):
    names = {f"lag_{n}": n for n in LAG_STEPS}
    return windows.add_lags(_gappy(spark, sf), ["user_id"], "ts", ["event_id"], "v", names).select("event_id", *names)


@query(
    "E2 E3",
    f"""
    SELECT event_id, CASE WHEN count(v) {_FRAME} = 24 THEN {near_sql(f"avg(v) {_FRAME}")} END AS mean_24,
           CASE WHEN count(v) {_FRAME} = 24 THEN {near_sql(f"stddev_samp(v) {_FRAME}")} END AS std_24
    FROM (SELECT *, CASE WHEN k <> 7 THEN value END AS v FROM {EVENTS})
    """,
)
def trailing_values(spark, sf):
    out = {"mean_24": "mean", "std_24": "std"}
    df = windows.add_trailing(_gappy(spark, sf), ["user_id"], "ts", ["event_id"], "v", 24, out)
    return df.select("event_id", *[near(F.col(c)).alias(c) for c in out])


_STEPS = {"lag_1h": 1, "lag_2h": 2, "lag_24h": 24}


@query(
    "E1",
    f"""
    WITH rows AS (SELECT event_id, user_id, ts, CASE WHEN k <> 7 THEN value END AS v FROM {EVENTS}),
    hours AS (
      SELECT user_id, hour, v FROM (
        SELECT user_id, date_trunc('hour', ts) AS hour, v, row_number() OVER (PARTITION BY user_id, date_trunc('hour', ts) ORDER BY ts DESC, event_id DESC) AS rn
        FROM rows) WHERE rn = 1)
    SELECT event_id, {", ".join(f"{name}.v AS {name}" for name in _STEPS)} FROM rows
    {" ".join(f"LEFT JOIN hours {name} ON {name}.user_id = rows.user_id AND {name}.hour = date_trunc('hour', rows.ts) - INTERVAL {n} HOUR" for name, n in _STEPS.items())}
    """,
)
def clock_lags(spark, sf):
    """The last value of the hour that lies 1, 2 and 24 hours back; null where that hour has no events."""
    return windows.add_clock_lags(_gappy(spark, sf), ["user_id"], "ts", ["event_id"], "v", _STEPS).select("event_id", *_STEPS)


@query(
    "E1 E2 E3",
    f"""
    WITH rows AS (SELECT event_id, user_id, ts, value AS v FROM events),
    near_rows AS (
      SELECT x.event_id, y.v, date_trunc('hour', y.ts) AS hour FROM rows x JOIN rows y ON y.user_id = x.user_id
        AND date_trunc('hour', y.ts) >= date_trunc('hour', x.ts) - INTERVAL 3 HOUR AND date_trunc('hour', y.ts) < date_trunc('hour', x.ts)),
    full_rows AS (
      SELECT event_id, avg(v) AS mean, stddev_samp(v) AS std FROM near_rows WHERE v IS NOT NULL GROUP BY event_id HAVING count(DISTINCT hour) = 3)
    SELECT rows.event_id, {near_sql("mean")} AS mean_3h, {near_sql("std")} AS std_3h FROM rows LEFT JOIN full_rows USING (event_id)
    """,
)
def clock_trailing(spark, sf):
    """Mean and deviation of the three hours before an event's own; null where one of them has no value."""
    out = {"mean_3h": "mean", "std_3h": "std"}
    df = windows.add_clock_trailing(table(spark, sf, "events").withColumnRenamed("value", "v"), ["user_id"], "ts", "v", 3, out)
    return df.select("event_id", *[near(F.col(c)).alias(c) for c in out])


@query(
    "E4 F2",
    """
    SELECT DISTINCT ON (user_id) user_id, event_id, ts, value FROM (
      SELECT user_id, event_id, CASE WHEN event_type <> 'error' THEN ts END AS ts, value FROM events)
    ORDER BY user_id, ts DESC NULLS FIRST, event_id DESC
    """,
)
def latest_event(spark, sf):
    df = table(spark, sf, "events").withColumn("ts", F.when(F.col("event_type") != "error", F.col("ts")))
    return windows.latest_per_key(df, ["user_id"], "ts", ["event_id"]).select("user_id", "event_id", "ts", "value")


@query(
    "D13",
    """
    SELECT user_id, hour, event_id, value FROM (
      SELECT user_id, date_trunc('hour', ts) AS hour, event_id, value,
             row_number() OVER (PARTITION BY user_id, date_trunc('hour', ts) ORDER BY event_id DESC) AS rn FROM events)
    WHERE rn = 1
    """,
)
def last_in_hour(spark, sf):
    df = table(spark, sf, "events").withColumn("hour", F.date_trunc("hour", "ts").cast("timestamp_ntz"))
    return windows.last_wins(df, ["user_id", "hour"], ["event_id"]).select("user_id", "hour", "event_id", "value")


@query(
    "E5",
    """
    SELECT CAST(row_number() OVER (ORDER BY o_custkey, o_orderdate, o_orderkey) AS BIGINT) AS id, o_custkey, o_orderdate, o_orderkey
    FROM orders
    """,
)
def numbered_orders(spark, sf):
    df = table(spark, sf, "orders").select("o_custkey", "o_orderdate", "o_orderkey")
    return windows.sequential_id(df, ["o_custkey", "o_orderdate", "o_orderkey"])


_FEATURES = [*TIME_FEATURES, *[f"value_lag_{n}" for n in LAG_STEPS], "value_mean_24", "value_std_24", "k"]
FEATURE_SQL = f"""features AS (
      SELECT * FROM (
        SELECT event_id, user_id, ts, value, k,
               sin(2 * pi() * extract('hour' FROM ts) / 24) AS hour_sin,
               cos(2 * pi() * extract('hour' FROM ts) / 24) AS hour_cos,
               sin(2 * pi() * extract('month' FROM ts) / 12) AS month_sin,
               cos(2 * pi() * extract('month' FROM ts) / 12) AS month_cos,
               CAST(extract('isodow' FROM ts) - 1 AS INTEGER) AS weekday,
               CAST(extract('doy' FROM ts) AS INTEGER) AS day_of_year,
               {", ".join(f"lag(value, {n}) {_BY_USER} AS value_lag_{n}" for n in LAG_STEPS)},
               avg(value) {_FRAME} AS value_mean_24, stddev_samp(value) {_FRAME} AS value_std_24
        FROM (SELECT * REPLACE (CASE WHEN event_type <> 'signup' OR k < 98 THEN k END AS k) FROM {EVENTS}))
      WHERE value_lag_24 IS NOT NULL AND k IS NOT NULL),
    cut AS (SELECT quantile_cont(epoch_us(ts), 0.8) AS cut_at FROM features)"""


def feature_frame(spark, sf):
    """Features of events; ``k`` is the covariate and is missing here and there."""
    k = F.when((F.col("event_type") != "signup") | (F.col("k") < 98), F.col("k"))
    df = events(spark, sf).withColumn("k", k)
    return ts_features(df, "user_id", "ts", "value", ["event_id"], ["k"])


_ROUNDED = [c for c in _FEATURES if "sin" in c or "cos" in c or "24" in c and "lag" not in c]


@query(
    "I1 H4 H8 H9 H10 E1 E2 E3 B6",
    f"""
    WITH {FEATURE_SQL}
    SELECT event_id, user_id, ts, value,
           {", ".join(f"{near_sql(c)} AS {c}" if c in _ROUNDED else c for c in _FEATURES)}
    FROM features
    """,
)
def series_features(spark, sf):
    """The feature table: one shuffle by user serves all windows."""
    return feature_frame(spark, sf).select(
        "event_id", "user_id", "ts", "value",
        *[near(F.col(c)).alias(c) if c in _ROUNDED else F.col(c) for c in _FEATURES],
    )


@query(
    "I2 B9 D7",
    f"""
    WITH {FEATURE_SQL}
    SELECT event_id, CASE WHEN epoch_us(ts) <= cut_at THEN 'train' ELSE 'test' END AS part FROM features, cut
    """,
)
def split_features(spark, sf):
    train, test, _ = temporal_split(settle(feature_frame(spark, sf)), "ts")
    return stack(
        train.select("event_id", F.lit("train").alias("part")), test.select("event_id", F.lit("test").alias("part"))
    )


_NAIVE = {"lag_1": "value_lag_1", "lag_24": "value_lag_24", "mean_24": "value_mean_24"}


def _metric_sql(digits):
    error = "(value - predicted)"
    spread = "(var_pop(value) * count(value))"
    return f"""
           {digits(f"avg(abs({error}))")} AS mae, {digits(f"sqrt(avg({error} * {error}))")} AS rmse,
           {digits(f"avg(CASE WHEN value <> 0 THEN abs({error} / value) END) * 100")} AS mape,
           {digits(f"CASE WHEN {spread} > 0 THEN 1 - sum({error} * {error}) / {spread} END")} AS r2"""


@query(
    "I5 D8 B10 H24",
    f"""
    WITH {FEATURE_SQL},
    predicted AS (
      {" UNION ALL ".join(f"SELECT '{m}' AS model, value, {c} AS predicted FROM features, cut WHERE epoch_us(ts) > cut_at" for m, c in _NAIVE.items())})
    SELECT model, {_metric_sql(lambda x: exact_sql(x, 4))} FROM predicted GROUP BY 1
    """,
)
def naive_models(spark, sf):
    """Three naive forecasts compared on the last fifth of the time range."""
    _, test, _ = temporal_split(settle(feature_frame(spark, sf)), "ts")
    return compare_predictions(test, "value", _NAIVE)


@query(
    "D8 B10",
    f"""
    SELECT event_type, {_metric_sql(near_sql)}
    FROM (SELECT event_type, CAST(k AS DOUBLE) AS value, value AS predicted FROM {EVENTS}) GROUP BY 1
    """,
)
def metrics_by_type(spark, sf):
    """Metrics per group, with zero targets."""
    df = events(spark, sf).select("event_type", F.col("k").cast("double").alias("y"), "value")
    done = regression_metrics(df, "y", "value", ["event_type"])
    return done.select("event_type", *[near(F.col(c)).alias(c) for c in ("mae", "rmse", "mape", "r2")])


@query(
    "I6 H24",
    f"""
    WITH {FEATURE_SQL}
    SELECT ts, user_id, event_id, value AS actual, {near_sql("value_mean_24")} AS predicted,
           {near_sql("value - value_mean_24")} AS error
    FROM features, cut WHERE epoch_us(ts) > cut_at
    """,
)
def naive_residuals(spark, sf):
    _, test, _ = temporal_split(settle(feature_frame(spark, sf)), "ts")
    table_ = residual_table(test, ["ts", "user_id", "event_id"], "value", "value_mean_24")
    return table_.withColumns({c: near(F.col(c)) for c in ("predicted", "error")})


@query(
    "I9",
    """
    SELECT user_id, last + i * INTERVAL 1 HOUR AS ts
    FROM (SELECT user_id, max(ts) AS last FROM events GROUP BY 1), generate_series(1, 24) g(i)
    """,
)
def next_day_hours(spark, sf):
    return extend_time(table(spark, sf, "events"), ["user_id"], "ts")


@query(
    "E6 G3 I9 H22",
    """
    WITH ends AS (SELECT user_id, max(ts) AS last FROM events GROUP BY 1)
    SELECT user_id, ts, 'historique' AS type FROM events
    UNION ALL
    SELECT user_id, last + i * INTERVAL 1 HOUR, 'prediction' FROM ends, generate_series(1, 24) g(i)
    """,
)
def marked_history(spark, sf):
    """History and the next 24 hours, labelled against the end of each series."""
    history = table(spark, sf, "events").select("user_id", "ts")
    return windows.mark_history(stack(history, extend_time(history, ["user_id"], "ts")), history, ["user_id"], "ts")


_FIT_SQL = f"""points AS (
      SELECT event_type, ts, value AS y, epoch_us(ts) / 3.6e9 - 438288 AS t,
             extract('hour' FROM ts) AS h, extract('isodow' FROM ts) AS w
      FROM events WHERE event_type IN (SELECT event_type FROM events GROUP BY 1 HAVING count(value) >= 5)),
    trend AS (SELECT event_type, coalesce(regr_slope(y, t), 0) AS b, avg(y) AS my, avg(t) AS mt, max(ts) AS last
              FROM points GROUP BY 1),
    r1 AS (SELECT p.*, b, my, mt, y - my - b * (t - mt) AS r FROM points p JOIN trend USING (event_type)),
    r2 AS (SELECT *, avg(r) OVER (PARTITION BY event_type, h) AS sh FROM r1),
    r3 AS (SELECT *, avg(r - sh) OVER (PARTITION BY event_type, w) AS sw FROM r2),
    sd AS (SELECT event_type, stddev_samp(r - sh - sw) AS sigma FROM r3 GROUP BY 1),
    rows_ AS (
      SELECT event_type, ts, my + b * (t - mt) + sh + sw AS yhat, 'historique' AS type FROM r3
      UNION ALL
      SELECT event_type, ts, my + b * (epoch_us(ts) / 3.6e9 - 438288 - mt) + coalesce(sh, 0) + coalesce(sw, 0), 'prediction'
      FROM (SELECT *, last + i * INTERVAL 1 HOUR AS ts, extract('hour' FROM last + i * INTERVAL 1 HOUR) AS h,
                   extract('isodow' FROM last + i * INTERVAL 1 HOUR) AS w
            FROM trend, generate_series(1, 24) g(i))
      LEFT JOIN (SELECT DISTINCT ON (event_type, h) event_type, h, sh FROM r3) USING (event_type, h)
      LEFT JOIN (SELECT DISTINCT ON (event_type, w) event_type, w, sw FROM r3) USING (event_type, w))"""


@query(
    "I8 I9 G3 B11",
    f"""
    WITH {_FIT_SQL}
    SELECT event_type, ts, {near_sql("yhat")} AS yhat, {near_sql("yhat - 1.2816::DOUBLE * sigma")} AS yhat_lower,
           {near_sql("yhat + 1.2816::DOUBLE * sigma")} AS yhat_upper, type
    FROM rows_ JOIN sd USING (event_type)
    """,
)
def seasonal_values(spark, sf):
    """Trend, hour and weekday pattern, 80 % band: history and 24 hours ahead per event type."""
    done = seasonal_forecast(table(spark, sf, "events"), ["event_type"], "ts", "value")
    return done.withColumns({c: near(F.col(c)) for c in ("yhat", "yhat_lower", "yhat_upper")})


@query(
    "I8 H15 H21",
    f"""
    WITH {_FIT_SQL}
    SELECT event_type, ts, type, greatest(0::DOUBLE, {exact_sql("yhat")}) AS valeur_pred,
           greatest(0::DOUBLE, {exact_sql("yhat - 1.2816::DOUBLE * sigma")}) AS valeur_min,
           greatest(0::DOUBLE, {exact_sql("yhat + 1.2816::DOUBLE * sigma")}) AS valeur_max
    FROM rows_ JOIN sd USING (event_type)
    """,
)
def published_values(spark, sf):
    """The forecast as it is stored: rounded to 2 digits, never below 0."""
    return published(seasonal_forecast(table(spark, sf, "events"), ["event_type"], "ts", "value"))


@query(
    "I11 H20",
    """
    WITH m AS (
      SELECT n_name, n_regionkey AS cluster_id, avg(l_quantity) AS l_quantity FROM lineitem
      JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey GROUP BY 1, 2),
    levels AS (SELECT cluster_id, row_number() OVER (ORDER BY avg(l_quantity), cluster_id) - 1 AS level FROM m GROUP BY 1)
    SELECT n_name, cluster_id, CASE level WHEN 0 THEN 'Air pur' WHEN 1 THEN 'Pollution modérée'
           WHEN 2 THEN 'Pollution élevée' WHEN 3 THEN 'Pollution critique' ELSE 'Groupe ' || level END AS cluster_nom
    FROM m JOIN levels USING (cluster_id)
    """,
)
def named_regions(spark, sf):
    """Severity names for given groups: regions ranked by mean quantity."""
    means = nation_lines(spark, sf).groupBy("n_name", F.col("n_regionkey").alias("cluster_id")).agg(
        F.avg("l_quantity").alias("l_quantity")
    )
    return name_clusters(means, "cluster_id", "l_quantity").select("n_name", "cluster_id", "cluster_nom")
