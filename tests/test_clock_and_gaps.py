"""Lags by the clock, missing hours, sketched quantiles, one-pass checks, k-means starts, forecast bands."""

import random
from datetime import date, datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sensorloom.operators import aggregates as agg, clustering, forecast, quality
from sensorloom.operators.windows import add_clock_lags, add_clock_trailing

START = datetime(2026, 3, 1)


def hourly(seed=1, n=400):
    """(k, ts, seq, v): gaps, several rows in an hour, null values, a time before 1970 and none at all."""
    rng = random.Random(seed)
    rows = [(rng.choice("ab"), START + timedelta(minutes=rng.randrange(60 * 24 * 6)), i, rng.choice([None, 1.0, 2.0, 5.0])) for i in range(n)]
    rows += [("a", None, n, 7.0), ("a", datetime(1969, 12, 31, 23, 30), n + 1, 3.0), ("a", datetime(1970, 1, 1, 0, 10), n + 2, 4.0), ("c", START, n + 3, 1.0)]
    return rows


SCHEMA = "k string, ts timestamp_ntz, seq int, v double"


def hour_of(ts):
    return (ts - datetime(1970, 1, 1)) // timedelta(hours=1)


def brute_lags(rows, lags):
    out = {}
    for k, ts, seq, _ in rows:
        found = []
        for n in lags:
            inside = [(t, s, v) for kk, t, s, v in rows if ts and t and kk == k and hour_of(t) == hour_of(ts) - n]
            found.append(max(inside, key=lambda x: x[:2])[2] if inside else None)
        out[seq] = tuple(found)
    return out


def brute_trailing(rows, n):
    out = {}
    for k, ts, seq, _ in rows:
        inside = [(hour_of(t), v) for kk, t, _, v in rows if ts and t and kk == k and 0 < hour_of(ts) - hour_of(t) <= n and v is not None]
        full = len({h for h, _ in inside}) == n
        values = [v for _, v in inside]
        out[seq] = (np.mean(values), np.std(values, ddof=1) if len(values) > 1 else None) if full else (None, None)
    return out


@pytest.mark.parametrize("split", [{}, {"hot": "a", "block_ticks": 24}, {"hot": "ab", "block_ticks": 30}])
def test_clock_lags_against_brute_force(spark, split):
    rows = hourly()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    if "hot" in split:
        hot = df.filter(F.col("k").isin(*split["hot"])).select(F.xxhash64("k").alias("_h")).distinct().withColumn("_rows", F.lit(100).cast("long"))
        split = {**split, "hot": hot}
    lags = {"one": 1, "two": 2, "day": 24}
    got = {r["seq"]: (r["one"], r["two"], r["day"]) for r in add_clock_lags(df, ["k"], "ts", ["seq"], "v", lags, **split).collect()}
    assert got == brute_lags(rows, lags.values())
    made = add_clock_trailing(df, ["k"], "ts", "v", 3, {"mean": "mean", "std": "std"}, **split)
    want = brute_trailing(rows, 3)
    assert made.count() == len(rows)
    for r in made.collect():
        mean, std = want[r["seq"]]
        assert r["mean"] == (None if mean is None else pytest.approx(mean)) and r["std"] == (None if std is None else pytest.approx(std))


def test_a_block_holds_the_steps_looked_back_on(spark):
    df = spark.createDataFrame(hourly(), SCHEMA)
    with pytest.raises(ValueError):
        add_clock_lags(df, ["k"], "ts", ["seq"], "v", {"x": 25}, block_ticks=24)


def test_clock_lags_take_one_shuffle(spark):
    plan = add_clock_lags(spark.createDataFrame(hourly(), SCHEMA), ["k"], "ts", ["seq"], "v", {"a": 1, "b": 24}, hot={})._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


# missing hours


def brute_gaps(rows, keys, first, last):
    out = []
    for k in keys:
        own = [t for kk, t in rows if kk == k and t and first <= t.date() <= last]
        have = {t.replace(minute=0, second=0, microsecond=0) for t in own}
        hour, run = datetime(first.year, first.month, first.day), []
        while hour.date() <= last:
            if hour in have:
                out += [(k, run[0], run[-1], len(run))] if run else []
                run = []
            else:
                run.append(hour)
            hour += timedelta(hours=1)
        out += [(k, run[0], run[-1], len(run))] if run else []
    return sorted(out)


def test_missing_hours_against_a_grid(spark):
    rows = [(k, t) for k, t, _, _ in hourly(7, 250)]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz")
    first, last = date(2026, 3, 2), date(2026, 3, 5)
    asked = spark.createDataFrame([("a",), ("b",), ("none",), ("a",)], "k string")
    got = agg.missing_hours(df, ["k"], "ts", first, last, asked)
    assert sorted(map(tuple, got.collect())) == brute_gaps(rows, ["a", "b", "none"], first, last)
    listed = agg.missing_hours(df, ["k"], "ts", first, last)
    assert sorted(map(tuple, listed.collect())) == brute_gaps(rows, ["a", "b"], first, last)  # c has no row on these days
    own = [("c", START.replace(hour=h), START.replace(hour=h2), n) for h, h2, n in ((1, 23, 23),)]
    assert sorted(map(tuple, agg.missing_hours(df.filter("k = 'c'"), ["k"], "ts").collect())) == own
    with pytest.raises(ValueError):
        agg.missing_hours(df, ["k"], "ts", first, None, asked)
    assert agg.missing_hours(df.limit(0), ["k"], "ts", first, first, asked).select("hours").distinct().collect() == [(24,)]


# sketched quantiles


@pytest.mark.parametrize("accuracy", [0.05, 0.01, 0.002])
def test_sketched_rank_error(spark, accuracy):
    n = 60_000
    df = spark.range(n).select(F.when(F.col("id") % 10 == 0, None).otherwise(F.pow(F.pmod(F.xxhash64("id"), F.lit(1_000_003)), F.lit(1.5))).alias("x"))
    values = np.sort(df.toPandas()["x"].dropna().to_numpy())
    shares = [0.0, 0.01, 0.3, 0.5, 0.9, 1.0]
    for q, x in zip(shares, agg.approximate_quantile(df, "x", shares, accuracy)):
        low, high = np.searchsorted(values, x, "left") / len(values), np.searchsorted(values, x, "right") / len(values)
        assert low - 2 * accuracy <= q <= high + 2 * accuracy and x in values
    assert agg.approximate_quantile(df, "x", 0.5, accuracy) == pytest.approx(np.quantile(values, 0.5), rel=0.2)


def test_sketch_sizes():
    assert agg.sketch_size(0.0133) == pytest.approx(300, abs=20) and agg.sketch_size(1.0) == 8 and agg.sketch_size(1e-9) == 65_535


def test_quantiles_of_few_and_odd_values(spark):
    df = spark.createDataFrame([(None,), (float("nan"),)], "x double")
    assert agg.approximate_quantile(df, "x", 0.5) is None
    assert agg.approximate_quantile(df.limit(0), "x", [0.1, 0.2]) is None
    odd = spark.createDataFrame([(float("-inf"),), (3.0,), (float("inf"),), (None,), (float("nan"),)], "x double")
    assert agg.approximate_quantile(odd, "x", [0.0, 0.5, 1.0]) == [float("-inf"), 3.0, float("inf")]
    assert agg.exact_quantile(odd, "x", 0.5) == 3.0
    ends = spark.createDataFrame([(float("-inf"),), (float("inf"),)], "x double")
    assert agg.exact_quantile(ends, "x", 0.0) == float("-inf") and agg.exact_quantile(ends, "x", 1.0) == float("inf")
    by = agg.quantiles_by(spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", None), ("b", None), ("b", float("nan"))], "k string, x double"), ["k"], "x", {"m": 1.0})
    assert by.collect() == [("a", 2.0)]


def test_exact_quantile_when_the_bracket_misses(spark, monkeypatch):
    df = spark.range(5000).select(F.pmod(F.xxhash64("id"), F.lit(100_000)).cast("double").alias("x"))
    values = df.toPandas()["x"]
    monkeypatch.setattr(agg, "quantile_sketch", lambda column, accuracy: F.kll_sketch_agg_double(column, 200))
    monkeypatch.setattr(agg, "_BRACKET", -0.2)  # ends change places: whatever is wanted lies outside
    for q in (0.0, 0.05, 0.5, 0.77, 1.0):
        assert agg.exact_quantile(df, "x", q) == pytest.approx(values.quantile(q), rel=1e-12)


# checks in one pass


def scans(spark, run):
    """Rows that Python was asked for: how often the input is computed."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.range(1000, numPartitions=3).select("id", (F.col("id") % 7).alias("m"), F.when(F.col("id") > 9, F.col("id")).alias("some"))
    out = run(df.mapInArrow(count, df.schema))
    return out, seen.value


CHECKS = [("unique", "id"), ("unique", "m"), ("unique", "some"), ("not_null", "some"), ("not_null", "id")]
REPORT = {("unique", "id", 0, True), ("unique", "m", 7, False), ("unique", "some", 0, True), ("not_null", "some", 10, False), ("not_null", "id", 0, True)}


def test_all_checks_read_the_input_once(spark):
    report, rows = scans(spark, lambda df: quality.run_checks(df, CHECKS))
    assert set(map(tuple, report.collect())) == REPORT and rows == 1000
    report, rows = scans(spark, lambda df: quality.run_checks(df, CHECKS[3:]))
    assert set(map(tuple, report.collect())) == {x for x in REPORT if x[0] == "not_null"} and rows == 1000


def test_checks_while_writing(spark, tmp_path):
    path = str(tmp_path / "t")
    report, rows = scans(spark, lambda df: quality.write_checked(df, path, CHECKS))
    assert set(map(tuple, report.collect())) == REPORT and rows == 1000
    assert spark.read.parquet(path).count() == 1000


def test_checks_of_an_empty_table(spark):
    df = spark.createDataFrame([], "id long, m long, some long")
    assert all(r["passed"] and r["failures"] == 0 for r in quality.run_checks(df, CHECKS).collect())


# k-means


def blobs(spark, n=120):
    rng = np.random.default_rng(5)
    centres = np.array([[0, 0], [8, 0], [0, 8], [8, 8]])
    x = centres[np.arange(n) % 4] + rng.normal(0, 0.5, (n, 2))
    return spark.createDataFrame(pd.DataFrame({"k": [f"e{i}" for i in range(n)], "x": x[:, 0], "y": x[:, 1]})), x


def test_all_starts_at_once_are_as_good_as_each(spark):
    df, x = blobs(spark)
    centres, costs = clustering.best_centres(df, "k", ["x", "y"], 4, n_init=6)
    assert len(costs) == 6
    square = ((x[:, None] - centres[None]) ** 2).sum(axis=2)
    assert costs.min() == pytest.approx(square.min(axis=1).sum())
    for c in range(4):  # settled: every centre is the mean of its points
        assert np.allclose(centres[c], x[square.argmin(axis=1) == c].mean(axis=0))
    again, _ = clustering.best_centres(df.repartition(5), "k", ["x", "y"], 4, n_init=6)
    assert np.allclose(sorted(centres.tolist()), sorted(again.tolist()))


def test_more_clusters_than_places(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 1.0), ("c", 1.0), ("d", 2.0)], "k string, x double")
    found = clustering.cluster_entities(df, "k", ["x"], k=3, n_init=3)
    rows = {r["k"]: r["cluster_id"] for r in found.collect()}
    assert rows["a"] == rows["b"] == rows["c"] != rows["d"]


# band of the additive forecast


def simulated(spark, seed, n=30, hours=24 * 20):
    """Series whose slope changes at random times, and the hours after them."""
    rng = np.random.default_rng(seed)
    frames = []
    for k in range(n):
        bends = np.where(rng.random(hours + 24) < 25 / hours, rng.laplace(0, 0.02, hours + 24), 0.0)
        y = 50 + np.cumsum(np.cumsum(bends)) + rng.normal(0, 1.0, hours + 24)
        frames.append(pd.DataFrame({"k": k, "h": np.arange(hours + 24), "y": y}))
    df = spark.createDataFrame(pd.concat(frames))
    return df.select("k", F.timestamp_seconds(F.lit(1_772_323_200) + F.col("h") * 3600).cast("timestamp_ntz").alias("ts"), "y", "h")


def test_band_widens_and_covers(spark):
    hours = 24 * 20
    df = simulated(spark, 3, hours=hours).persist()
    done = forecast.additive_forecast(df.filter(F.col("h") < hours).drop("h"), ["k"], "ts", "y")
    rows = done.join(df.select("k", "ts", "y"), ["k", "ts"]).toPandas()
    future = rows[rows["type"] == forecast.FUTURE].sort_values(["k", "ts"])
    assert len(future) == 30 * 24
    width = (future["yhat_upper"] - future["yhat_lower"]).to_numpy().reshape(30, 24)
    assert (np.diff(width, axis=1) > 0).all()
    past = rows[rows["type"] == forecast.HISTORY]
    before = (past["yhat_upper"] - past["yhat_lower"]).groupby(past["k"]).max().to_numpy()
    assert (width[:, 0] > before).all()
    inside = future["y"].between(future["yhat_lower"], future["yhat_upper"]).mean()
    assert 0.65 < inside < 0.95
    assert 0.74 < past["y"].between(past["yhat_lower"], past["yhat_upper"]).mean() < 0.88
