"""Models on hand-made data with a known structure."""

from datetime import datetime

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sensorloom.operators import anomaly, clustering, forecast
from sensorloom.operators.metrics import regression_metrics
from sensorloom.operators.scaling import flag_top_share, standardise
from sensorloom.plans import analytics, prediction


@pytest.fixture(scope="module")
def seasonal(spark):
    """Three cities, 40 days of hourly temperature with a daily wave and little noise."""
    rng = np.random.default_rng(3)
    frames = []
    for city in (1, 2, 3):
        hours = np.arange(40 * 24)
        wave = 10 + city + 6 * np.sin(2 * np.pi * hours / 24) + rng.normal(0, 0.3, len(hours))
        frames.append(pd.DataFrame({"ville_id": city, "h": hours, "temperature": wave, "vent": rng.uniform(0, 5, len(hours))}))
    df = spark.createDataFrame(pd.concat(frames))
    ts = F.timestamp_seconds(F.lit(1_772_323_200) + F.col("h") * 3600).cast("timestamp_ntz")
    return df.select(F.col("ville_id").cast("int").alias("ville_id"), ts.alias("mesure_le"), "temperature", "vent").persist()


def test_forest_beats_the_last_value(spark, seasonal):
    done = prediction.predict_series(
        seasonal, "ville_id", "mesure_le", "temperature", ["vent"], complete_first=["temperature"], trees=10, depth=6
    )
    predictions, metrics = done
    row = metrics.first()
    assert row["r2"] > 0.9 and row["mae"] < 1.0
    assert predictions.columns == ["mesure_le", "ville_id", "actual", "predicted", "error"]
    assert predictions.count() == pytest.approx(0.2 * 3 * 39 * 24, rel=0.05)
    prediction.write_predictions(predictions, "gold_ml_test.predictions", datetime(2026, 6, 1))
    table = spark.table("gold_ml_test.predictions")
    assert table.count() == predictions.count()
    assert table.filter(F.abs(F.col("temp_reelle") - F.col("temp_predite") - F.col("erreur")) > 1e-9).count() == 0


def test_too_little_data_is_not_predicted(spark, seasonal):
    assert prediction.predict_series(seasonal.limit(99), "ville_id", "mesure_le", "temperature", []) is None


def test_model_comparison(spark, seasonal):
    table = prediction.compare_tree_models(
        seasonal.withColumn("station_timezone", F.lit("UTC")), "ville_id", "mesure_le", "temperature", ["vent"],
        forest_params={"trees": 5, "depth": 5}, boosted_params={"rounds": 5, "rate": 0.5, "depth": 4},
    )
    rows = {r["model"]: r for r in table.collect()}
    assert set(rows) == {"forest", "boosted", "symmetric"} and all(r["r2"] > 0.8 for r in rows.values())
    assert all(r["mae"] == round(r["mae"], 4) for r in rows.values())


def test_metrics_of_degenerate_targets(spark):
    rows = [("zero", 0.0, 1.0), ("zero", 0.0, 2.0), ("same", 2.0, 1.0), ("same", 2.0, 3.0), ("gap", None, 1.0), ("gap", 4.0, 5.0)]
    df = spark.createDataFrame(rows, "m string, y double, p double")
    got = {r["m"]: r for r in regression_metrics(df, "y", "p", ["m"]).collect()}
    assert got["zero"]["mape"] is None and got["zero"]["r2"] is None and got["zero"]["mae"] == 1.5
    assert got["same"]["r2"] is None and got["same"]["mape"] == 50.0
    assert got["gap"]["mae"] == 1.0


@pytest.fixture(scope="module")
def cloud(spark):
    rng = np.random.default_rng(1)
    points = rng.normal(0, 1, (2000, 3))
    points[:20] = rng.uniform(8, 12, (20, 3))
    pdf = pd.DataFrame(points, columns=["a", "b", "c"])
    pdf.insert(0, "id", np.arange(len(pdf)))
    return spark.createDataFrame(pdf).persist()


def test_isolation_forest(spark, cloud):
    holed = cloud.withColumn("a", F.when(F.col("id") % 500 != 499, F.col("a")))
    found = anomaly.isolation_forest(holed, ["id"], ["a", "b", "c"], trees=50).persist()
    assert found.count() == 1996  # all complete rows
    assert found.filter("est_anomalie").count() == pytest.approx(200, abs=2)
    assert found.filter("id < 20 AND est_anomalie AND score = -1").count() == 20
    assert found.filter("(score = -1) <> est_anomalie").count() == 0
    again = anomaly.isolation_forest(holed.repartition(7), ["id"], ["a", "b", "c"], trees=50)
    scores = lambda df: {r["id"]: r["outlier_score"] for r in df.collect()}
    assert scores(found) == scores(again)


def test_isolation_forest_draws_whole_samples(spark, cloud):
    for size, trees in ((64, 10), (8, 4), (2000, 3)):
        drawn = anomaly.tree_samples(cloud, ["id"], ["a"], 2000, trees, size, 42)
        counts = drawn.groupBy("tree").agg(F.count("id").alias("n"), F.count_distinct("id").alias("d")).collect()
        assert [(r["n"], r["d"]) for r in counts] == [(size, size)] * trees


def test_any_row_of_a_large_table_can_be_drawn(spark):
    """Rows beyond any fixed pool: the rows of all trees are spread over the whole table, each tree has its own."""
    n, trees, size = 200_000, 200, 256
    drawn = anomaly.tree_samples(spark.range(n).withColumn("a", F.col("id") * 1.0), ["id"], ["a"], n, trees, size, 42)
    distinct = drawn.select("id").distinct().count()
    assert drawn.count() == trees * size and distinct > 0.7 * trees * size
    tenths = drawn.groupBy(F.floor(F.col("id") * 10 / n).alias("t")).count().collect()
    assert len(tenths) == 10 and all(0.9 < r["count"] * 10 / (trees * size) < 1.1 for r in tenths)


def test_isolation_forest_needs_rows(spark, cloud):
    assert anomaly.isolation_forest(cloud.limit(10), ["id"], ["a"]).count() == 0
    assert anomaly.isolation_forest(cloud.limit(11), ["id"], ["a", "b", "c"], trees=5).count() == 11


def test_expected_depth():
    assert anomaly.expected_depth([0, 1, 2]).tolist() == [0.0, 0.0, 1.0]
    assert anomaly.expected_depth(256) == pytest.approx(10.2448, abs=1e-3)


def test_standardise(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    assert [tuple(r) for r in standardise(df, ["a", "b"]).orderBy("a").collect()] == [(-1.0, 0.0), (1.0, 0.0)]
    flagged = flag_top_share(spark.range(100).select(F.col("id").cast("double").alias("s")), "s", 0.1)
    assert flagged.filter("flag").count() == 10


@pytest.fixture(scope="module")
def entities(spark):
    levels = {"a": 0, "b": 0, "c": 10, "d": 10, "e": 20, "f": 20, "g": 30, "h": 30}
    rows = [(k, v + d, v * 2 + d) for k, v in levels.items() for d in (0.0, 0.5)]
    return spark.createDataFrame([*rows, ("gap", None, 1.0)], "k string, x double, y double")


def test_clusters_are_named_by_severity(spark, entities):
    found = clustering.name_clusters(clustering.cluster_entities(entities, "k", ["x", "y"]), "cluster_id", "x")
    profile = clustering.cluster_profile(found, "k", {"x": "x_moyen", "y": "y_moyen"})
    names = {r["k"]: r["cluster_nom"] for r in profile.collect()}
    expected = ["Air pur", "Pollution modérée", "Pollution élevée", "Pollution critique"]
    assert [names[k] for k in "aceg"] == expected and [names[k] for k in "bdfh"] == expected
    assert "gap" not in names
    assert profile.filter("k = 'a'").first()["x_moyen"] == 0.25


def test_cluster_count_follows_the_entities(spark, entities):
    three = entities.filter("k IN ('a', 'c', 'e')")
    assert clustering.cluster_entities(three, "k", ["x", "y"], n_init=2).select("cluster_id").distinct().count() == 3
    assert clustering.cluster_entities(entities.filter("k IN ('a', 'c')"), "k", ["x", "y"]).count() == 0


@pytest.mark.parametrize("model", [forecast.seasonal_forecast, forecast.additive_forecast])
def test_forecast_follows_the_wave(spark, seasonal, model):
    done = model(seasonal, ["ville_id"], "mesure_le", "temperature").persist()
    assert done.columns == ["ville_id", "mesure_le", "yhat", "yhat_lower", "yhat_upper", "type"]
    future = done.filter("type = 'prediction'").orderBy("ville_id", "mesure_le").toPandas()
    assert len(future) == 72 and done.count() == 3 * 40 * 24 + 72
    for city, part in future.groupby("ville_id"):
        hours = 40 * 24 + np.arange(24)
        truth = 10 + city + 6 * np.sin(2 * np.pi * hours / 24)
        assert np.abs(part["yhat"].to_numpy() - truth).max() < 1.0
        assert np.allclose(part["yhat_upper"] - part["yhat"], 1.2816 * 0.3, atol=0.1)
    inside = done.filter("type = 'historique'").join(seasonal, ["ville_id", "mesure_le"])
    assert inside.filter("temperature BETWEEN yhat_lower AND yhat_upper").count() / inside.count() == pytest.approx(0.8, abs=0.05)


@pytest.mark.parametrize("model", [forecast.seasonal_forecast, forecast.additive_forecast])
def test_short_and_flat_series(spark, model):
    at = lambda h: datetime(2026, 3, 1, h)
    rows = [("short", at(h), 1.0) for h in range(4)] + [("flat", at(h), 7.0) for h in range(5)]
    rows += [("once", at(0), float(v)) for v in range(6)]
    done = model(spark.createDataFrame(rows, "s string, ts timestamp_ntz, y double"), ["s"], "ts", "y").toPandas()
    assert set(done["s"]) == {"flat", "once"}
    flat = done[done["s"] == "flat"]
    assert len(flat) == 29 and np.allclose(flat["yhat"], 7.0, atol=0.1)
    assert (done[done["s"] == "once"]["type"] == "historique").sum() == 1


def test_many_series_are_fitted_in_parts(spark, seasonal, monkeypatch):
    few = forecast.additive_fit(seasonal, ["ville_id"], "mesure_le", "temperature")
    monkeypatch.setattr(forecast, "PART_ROWS", 300)
    many = forecast.additive_fit(seasonal, ["ville_id"], "mesure_le", "temperature")
    read = lambda df: {r["ville_id"]: [r["sigma"], *r["beta"]] for r in df.collect()}
    a, b = read(few), read(many)
    assert set(a) == set(b) == {1, 2, 3}
    assert all(np.allclose(a[k], b[k], atol=1e-6) for k in a)


def test_a_series_is_solved_where_it_is_summed(spark, seasonal, monkeypatch):
    """Its rows come in many batches, and no matrix leaves the task; only those of large series do."""
    written, settle = [], forecast.settle
    monkeypatch.setattr(forecast, "settle", lambda df: written.append(settle(df)) or written[-1])
    read = lambda df: {r["ville_id"]: [r["sigma"], *r["beta"]] for r in df.collect()}
    whole = read(forecast.additive_fit(seasonal, ["ville_id"], "mesure_le", "temperature"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "70")
    try:
        batches = read(forecast.additive_fit(seasonal, ["ville_id"], "mesure_le", "temperature"))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    found = [df for df in written if "_gram" in df.columns]
    assert len(found) == 2 and all(df.count() == 3 and df.filter("_gram IS NOT NULL OR beta IS NULL").count() == 0 for df in found)
    assert set(whole) == set(batches) == {1, 2, 3} and all(np.allclose(whole[k], batches[k], atol=1e-6) for k in whole)


def test_published_values(spark):
    df = spark.createDataFrame([(-0.4, -3.0, 2.675, "prediction")], "yhat double, yhat_lower double, yhat_upper double, type string")
    assert tuple(forecast.published(df).select("valeur_pred", "valeur_min", "valeur_max").first()) == (0.0, 0.0, 2.67)


def test_seasonal_fit_matches_direct_windows(spark, sf):
    """The cell arithmetic against the textbook form over all rows."""
    df = spark.read.parquet(f"{sf}/events.parquet").select("event_type", "ts", "value")
    pdf = df.toPandas()
    done = forecast.seasonal_forecast(df, ["event_type"], "ts", "value").filter("type = 'historique'").toPandas()
    got = done.set_index(["event_type", "ts"])
    for kind, part in pdf.groupby("event_type"):
        t = part["ts"].astype("int64") / 3.6e12 if str(part["ts"].dtype) == "datetime64[ns]" else part["ts"].astype("datetime64[ns]").astype("int64") / 3.6e12
        slope, level = np.polyfit(t - t.mean(), part["value"], 1)
        trend = level + slope * (t - t.mean())
        r = part["value"] - trend
        by_hour = r.groupby(part["ts"].dt.hour).transform("mean")
        by_day = (r - by_hour).groupby(part["ts"].dt.weekday).transform("mean")
        fitted = pd.Series((trend + by_hour + by_day).to_numpy(), index=part["ts"])
        mine = got.loc[kind]
        assert np.allclose(mine["yhat"].sort_index(), fitted.sort_index())
        sigma = (r - by_hour - by_day).std()
        assert np.allclose((mine["yhat_upper"] - mine["yhat"]) / 1.2816, sigma)


def test_analytics_tables(spark, seasonal, tmp_path):
    cities = spark.createDataFrame([(i, f"v{i}", f"s{i}") for i in (1, 2, 3)], "id int, nom string, slug_aqicn string")
    air = seasonal.filter("day(mesure_le) <= 10").select(
        "ville_id", F.col("mesure_le").alias("collecte_le"), F.col("temperature").alias("aqi_global"),
        *[(F.col("temperature") * F.col("ville_id") + i).alias(c) for i, c in enumerate(("pm25", "pm10", "no2", "o3"))],
        "temperature", F.col("vent").alias("humidite"),
    )
    results = analytics.run_analytics(air, cities, str(tmp_path / "ml"), datetime(2026, 6, 1).astimezone())
    read = {n: spark.read.parquet(str(tmp_path / "ml" / n)) for n in results}
    n = air.count()
    assert read["ml_anomalies"].count() == n
    assert read["ml_anomalies"].filter("est_anomalie").count() == pytest.approx(n / 10, abs=3)
    assert read["ml_predictions"].filter("type = 'prediction'").count() == 3 * 2 * 24
    assert read["ml_predictions"].filter("valeur_pred < 0 OR valeur_min < 0").count() == 0
    assert read["ml_clusters"].count() == 3
    assert sorted(r["id"] for r in read["ml_clusters"].collect()) == [1, 2, 3]
    assert analytics.run_analytics(air.limit(0), cities, str(tmp_path / "none"), datetime(2026, 6, 1).astimezone()) is None


def test_a_series_that_cannot_be_solved_is_skipped(spark, seasonal):
    broken = seasonal.filter("ville_id = 1").withColumn("temperature", F.lit(float("inf"))).withColumn("ville_id", F.lit(99))
    both = seasonal.filter("ville_id = 2").unionByName(broken.select(*seasonal.columns))
    fit = forecast.additive_fit(both, ["ville_id"], "mesure_le", "temperature")
    assert {r["ville_id"]: r["beta"] is None for r in fit.collect()} == {2: False, 99: True}
    done = forecast.additive_forecast(both, ["ville_id"], "mesure_le", "temperature")
    assert [r["ville_id"] for r in done.select("ville_id").distinct().collect()] == [2]


def test_incomplete_rows_do_not_count_for_the_guard(spark, seasonal):
    some = seasonal.limit(100).withColumn("temperature", F.when(F.monotonically_increasing_id() < 3, F.col("temperature")))
    args = (some, "ville_id", "mesure_le", "temperature", [])
    assert prediction.predict_series(*args, complete_first=["temperature"]) is None


def test_workers_need_no_copy_of_the_package(tmp_path):
    """A job started from another folder, with the package on the driver's path alone."""
    import subprocess
    import sys

    root = __file__.rsplit("/tests/", 1)[0]
    code = f"""
import sys; sys.path.insert(0, {root!r})
from sensorloom.session import local_session
from sensorloom.operators.anomaly import isolation_forest
spark = local_session(2)
df = spark.range(300).selectExpr("id", "id * 1.0 AS a")
print("ROWS", isolation_forest(df, ["id"], ["a"], trees=3).count())
"""
    import os

    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "ROWS 300" in out.stdout, out.stderr[-2000:]
