"""Trained models. Where their results have no SQL form, queries compute properties over all rows that SQL can state."""

from datetime import datetime, timezone

from pyspark.sql import Window, functions as F

from sensorloom.operators.anomaly import isolation_forest
from sensorloom.operators.boosting import Boosting, fit_side_by_side
from sensorloom.operators.clustering import cluster_entities, cluster_profile, name_clusters
from sensorloom.operators.features import feature_names, temporal_split
from sensorloom.operators.forecast import FUTURE, additive_forecast, published
from sensorloom.operators.joins import keep_matched, to_long
from sensorloom.operators.metrics import regression_metrics, residual_table
from sensorloom.operators.regression import fit_forest, predict
from sensorloom.operators.relational import stack, top_groups
from sensorloom.operators.scaling import standardise
from sensorloom.plans.analytics import run_analytics
from sensorloom.plans.catalog.aggregates import _MEANS, nation_lines
from sensorloom.plans.catalog.registry import events, near, near_sql, query, table
from sensorloom.plans.catalog.relations import AIR_SQL, CITY_SQL, air_frame, city_frame
from sensorloom.plans.catalog.series import FEATURE_SQL, feature_frame
from sensorloom.plans.prediction import compare_tree_models, predict_series
from sensorloom.session import new_path, settle


@query("I3 I6 I2 B11")
def forest_prediction(spark, sf):
    """Random forest on the event features: actual, predicted, error on the last fifth."""
    return predict_series(events(spark, sf), "user_id", "ts", "value", ["k"], ["event_id"])[0]


@query("I3 I4 I5")
def tree_models(spark, sf):
    """Forest of 100 trees against boosted trees and boosted symmetric trees. A level of a tree is a job, which takes its time even over few
    rows, so the query grows 50 rounds at a rate of 0.2; the default of the library is 200 at 0.05."""
    steps = {"rounds": 50, "rate": 0.2}
    return compare_tree_models(events(spark, sf), "user_id", "ts", "value", ["k"], ["event_id"], boosted_params=steps)


@query(
    "I3 I6 D8",
    f"""
    WITH {FEATURE_SQL}
    SELECT count(*) AS n, TRUE AS inside, TRUE AS errors_add_up, TRUE AS better_than_mean FROM features, cut WHERE epoch_us(ts) > floor(cut_at)
    """,
)
def forest_properties(spark, sf):
    """What must hold for a forest on any data: predictions of the last fifth lie within the targets it was trained on, errors are
    actual less predicted, and on its own rows it errs less than their mean."""
    features = settle(feature_frame(spark, sf))
    train, test, _ = temporal_split(features, "ts")
    model = fit_forest(train, feature_names("user_id", "value", ["k"]), "value", trees=20, depth=8)
    low, high = train.agg(F.min("value"), F.max("value")).first()
    own = regression_metrics(predict(model, train), "value", "predicted").first()
    rows = residual_table(predict(model, test), ["ts", "user_id"], "value", "predicted")
    return rows.agg(
        F.count(F.lit(1)).alias("n"), F.bool_and(F.col("predicted").between(low - 1e-9, high + 1e-9)).alias("inside"),
        F.bool_and(F.abs(F.col("actual") - F.col("predicted") - F.col("error")) < 1e-9).alias("errors_add_up"),
        F.lit(own["r2"] > 0).alias("better_than_mean"),
    )


@query(
    "I7 D11",
    """
    SELECT count(*) AS n, TRUE AS in_range, TRUE AS flags_follow, TRUE AS a_tenth_at_most, TRUE AS far_lines_flagged FROM lineitem
    """,
)
def isolated_properties(spark, sf):
    """What must hold for isolation scores on any data: between 0 and 1, flags above the 0.9 quantile of all scores and nowhere else, and
    flagged rows lie further out (in standard deviations) than the others."""
    found = isolation_forest(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *_MEANS), ["l_orderkey", "l_linenumber"], _MEANS)
    z = standardise(found, _MEANS, "_z")
    far = sum((F.col(f"{c}_z") * F.col(f"{c}_z") for c in _MEANS), F.lit(0.0))
    cut = found.agg(F.percentile("outlier_score", 0.9)).first()[0]
    flag = F.col("est_anomalie")
    return z.agg(
        F.count(F.lit(1)).alias("n"), F.bool_and((F.col("outlier_score") > 0) & (F.col("outlier_score") < 1)).alias("in_range"),
        F.bool_and(flag == (F.col("outlier_score") > cut)).alias("flags_follow"), (F.count_if(flag) <= 0.1 * F.count(F.lit(1)) + 1).alias("a_tenth_at_most"),
        (F.avg(F.when(flag, far)) > F.avg(F.when(~flag, far))).alias("far_lines_flagged"),
    )


@query("I7 D11 B6")
def isolated_lines(spark, sf):
    return isolation_forest(
        table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *_MEANS), ["l_orderkey", "l_linenumber"], _MEANS
    )


@query("I8 C6 F3 B8")
def additive_values(spark, sf):
    """Additive forecast of two measures for the five users with the most events."""
    df = events(spark, sf).withColumn("k", F.col("k").cast("double"))
    chosen = keep_matched(df, top_groups(df, "user_id", "value", 5), ["user_id"])
    return published(additive_forecast(to_long(chosen, ["user_id", "ts"], ["value", "k"]), ["user_id", "measure"], "ts", "y"))


@query("I8 C6")
def additive_users(spark, sf):
    """Additive forecast of every user with enough hours, all in one job."""
    df = events(spark, sf).select("user_id", "ts", "value")
    return published(additive_forecast(df, ["user_id"], "ts", "value"))


@query(
    "I8",
    """
    SELECT user_id, count(DISTINCT ts) AS history, 24::BIGINT AS future, TRUE AS inside, TRUE AS widens
    FROM events WHERE value IS NOT NULL GROUP BY 1 HAVING count(*) >= 5
    """,
)
def additive_band(spark, sf):
    """Additive forecast of every user: its rows, whether every value lies inside its band, and whether the band of the
    future grows from hour to hour, and is nowhere narrower than that of the history."""
    done = additive_forecast(table(spark, sf, "events").select("user_id", "ts", "value"), ["user_id"], "ts", "value")
    width = F.col("yhat_upper") - F.col("yhat_lower")
    rows = done.withColumn("future", F.col("type") == FUTURE).withColumn("width", width)
    before = F.lag("width").over(Window.partitionBy("user_id").orderBy("future", "ts"))
    rows = rows.withColumn("grows", ~F.col("future") | (F.col("width") >= before - 1e-9))
    return rows.groupBy("user_id").agg(
        F.count_if(~F.col("future")).alias("history"), F.count_if("future").alias("future"),
        F.bool_and(F.col("yhat").between(F.col("yhat_lower"), F.col("yhat_upper"))).alias("inside"), F.bool_and("grows").alias("widens"),
    )


def _first_tree_sql(model: str, reg: float, symmetric: bool) -> str:
    """The first tree, two levels deep, of boosting at rate 1, from sums over the values of the features."""
    gain = f"gl * gl / (hl + {reg}) + (g - gl) * (g - gl) / (h - hl + {reg}) - g * g / (h + {reg})"
    by_node = """SELECT c.node, c.f, c.x, c.g AS gl, c.h AS hl, t.g, t.h FROM (
          SELECT v.node, v.f, v.x, sum(coalesce(own.g, 0)) OVER w AS g, sum(coalesce(own.h, 0)) OVER w AS h
          FROM (SELECT DISTINCT a.node, b.f, b.x FROM cells a, cells b) v LEFT JOIN cells own ON own.node = v.node AND own.f = v.f AND own.x = v.x
          WINDOW w AS (PARTITION BY v.node, v.f ORDER BY v.x)) c
        JOIN (SELECT node, sum(g) AS g, sum(h) AS h FROM cells WHERE f = 0 GROUP BY node) t ON t.node = c.node"""
    best = "SELECT f, x FROM gains GROUP BY f, x ORDER BY sum(gain) DESC, f, x LIMIT 1"
    lower = f"SELECT nodes.node, s.f, s.x FROM (SELECT DISTINCT node FROM gains) nodes, ({best}) s" if symmetric else (
        "SELECT node, f, x FROM (SELECT *, row_number() OVER (PARTITION BY node ORDER BY gain DESC, f, x) AS rn FROM gains) WHERE rn = 1"
    )
    value = "CASE f WHEN 0 THEN l_quantity WHEN 1 THEN l_discount ELSE l_tax END"
    return f"""
    SELECT * FROM (
      WITH r AS (
        SELECT l_quantity, l_discount, l_tax, (SELECT avg(l_extendedprice * (1 - l_discount)) FROM lineitem) - l_extendedprice * (1 - l_discount) AS grad FROM lineitem),
      root AS (
        WITH cells AS (SELECT 0 AS node, f, {value} AS x, sum(grad) AS g, count(*)::DOUBLE AS h FROM r, (SELECT unnest([0, 1, 2]) AS f) GROUP BY ALL),
        sums AS ({by_node}), gains AS (SELECT f, x, {gain} AS gain FROM sums WHERE hl > 0 AND hl < h)
        {best}),
      placed AS (SELECT r.*, CASE WHEN (CASE root.f WHEN 0 THEN l_quantity WHEN 1 THEN l_discount ELSE l_tax END) > root.x THEN 2 ELSE 1 END AS node FROM r, root),
      second AS (
        WITH cells AS (SELECT node, f, {value} AS x, sum(grad) AS g, count(*)::DOUBLE AS h FROM placed, (SELECT unnest([0, 1, 2]) AS f) GROUP BY ALL),
        sums AS ({by_node}), gains AS (SELECT node, f, x, {gain} AS gain FROM sums WHERE hl > 0 AND hl < h)
        {lower}),
      leaves AS (
        SELECT 2 * p.node + 1 + CASE WHEN (CASE s.f WHEN 0 THEN l_quantity WHEN 1 THEN l_discount ELSE l_tax END) > s.x THEN 1 ELSE 0 END AS node, grad
        FROM placed p JOIN second s ON s.node = p.node)
      SELECT '{model}' AS model, node::INTEGER AS node, ['l_quantity', 'l_discount', 'l_tax'][f + 1] AS feature, x AS highest, NULL::DOUBLE AS value
      FROM (SELECT 0 AS node, f, x FROM root UNION ALL SELECT node, f, x FROM second)
      UNION ALL SELECT '{model}', node::INTEGER, NULL, NULL, {near_sql(f"-coalesce(sum(grad), 0) / (count(grad) + {reg})", 3)}
      FROM (SELECT unnest([3, 4, 5, 6]) AS node) LEFT JOIN leaves USING (node) GROUP BY node)"""


@query("I4", _first_tree_sql("boosted", 1.0, False) + " UNION ALL " + _first_tree_sql("symmetric", 3.0, True))
def boosted_splits(spark, sf):
    """The nodes of the first tree of both kinds of boosting: splits with their highest value to the left, and the values of leaves."""
    lines = table(spark, sf, "lineitem").withColumn("revenue", F.col("l_extendedprice") * (1 - F.col("l_discount")))
    growth = {
        "boosted": Boosting(rounds=1, rate=1.0, depth=2),
        "symmetric": Boosting(rounds=1, rate=1.0, depth=2, reg=3.0, symmetric=True),
    }
    found = fit_side_by_side(lines, ["l_quantity", "l_discount", "l_tax"], "revenue", growth)
    nodes = [(name, node, feature, highest, value) for name, model in found.items() for _, node, feature, highest, value in model.nodes()]
    made = spark.createDataFrame(nodes, "model string, node int, feature string, highest double, value double")
    return made.withColumn("value", near(F.col("value"), 3))


@query("I10 I11 I12 D4 D12")
def nation_clusters(spark, sf):
    found = cluster_entities(nation_lines(spark, sf), "n_name", _MEANS)
    named = name_clusters(found, "cluster_id", "l_quantity")
    return cluster_profile(named, "n_name", {c: f"{c}_moyen" for c in _MEANS})


@query("I10", "SELECT n_name, 4::BIGINT AS clusters, TRUE AS nearest FROM nation WHERE n_nationkey IN (SELECT s_nationkey FROM supplier JOIN lineitem ON s_suppkey = l_suppkey)")
def nearest_clusters(spark, sf):
    """Whether each nation's cluster is the one whose mean of standardised values lies nearest, as it must be where k-means has settled."""
    found = cluster_entities(nation_lines(spark, sf), "n_name", _MEANS)
    z = [f"{c}_z" for c in _MEANS]
    scaled = standardise(found, _MEANS, "_z")
    centres = scaled.groupBy("cluster_id").agg(*[F.avg(c).alias(c) for c in z]).collect()  # four rows

    def square(centre):
        return sum(((F.col(c) - centre[c]) * (F.col(c) - centre[c]) for c in z), F.lit(0.0))

    nearest = F.array_min(F.array(*[F.struct(square(c).alias("d"), F.lit(c["cluster_id"]).alias("id")) for c in centres]))["id"]
    return scaled.select("n_name", F.lit(len(centres)).cast("bigint").alias("clusters"), (nearest == F.col("cluster_id")).alias("nearest"))


@query(
    "A10 I7 I8 I10",
    f"""
    WITH {AIR_SQL}, {CITY_SQL},
    m AS (SELECT v.nom AS ville, a.collecte_le FROM air a JOIN ville v ON v.id = a.ville_id WHERE a.value IS NOT NULL),
    busiest AS (SELECT ville FROM m GROUP BY 1 ORDER BY count(*) DESC, ville LIMIT 5),
    times AS (SELECT ville, count(DISTINCT collecte_le) AS c FROM m JOIN busiest USING (ville) GROUP BY 1)
    SELECT 'ml_anomalies' AS name, count(*) AS n, TRUE AS numbered FROM m
    UNION ALL SELECT 'ml_predictions', CAST(2 * sum(c + 24) AS BIGINT), TRUE FROM times
    UNION ALL SELECT 'ml_clusters', count(DISTINCT ville), TRUE FROM m
    """,
)
def analytics_tables(spark, sf):
    """Anomalies, forecasts and clusters of all measurements, written as three tables and read back: their rows, and whether these are numbered from 1."""
    folder = new_path(spark, "gold")
    made = run_analytics(air_frame(spark, sf), city_frame(spark, sf), folder, datetime(2026, 6, 1, tzinfo=timezone.utc))
    n = F.count(F.lit(1))
    whole = (F.min("id") == 1) & (F.max("id") == n) & (F.count_distinct("id") == n)
    return stack(
        *[
            spark.read.schema(df.schema).parquet(f"{folder}/{name}").agg(F.lit(name).alias("name"), n.alias("n"), whole.alias("numbered"))
            for name, df in made.items()
        ]
    )
