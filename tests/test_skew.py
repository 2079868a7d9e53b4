"""The split plans for hot groups give the rows of the plain plans."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from sensorloom.operators import skew, windows
from sensorloom.operators.aggregates import exact_quantile
from sensorloom.operators.features import ts_features
from sensorloom.operators.joins import bucket_left_join


def rows(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


@pytest.fixture(scope="module")
def hot(spark):
    """A third of the left rows and of the right rows in one group each, null keys, and keys without partner."""
    left = spark.range(600).select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).when(F.col("id") % 50 == 1, F.lit(None)).otherwise(F.col("id") % 40).cast("bigint").alias("k"),
        F.col("id").alias("l"),
    )
    right = spark.range(150).select(
        F.when(F.col("id") % 3 == 0, F.lit(2)).when(F.col("id") % 25 == 1, F.lit(None)).otherwise(F.col("id") % 20).cast("bigint").alias("k"),
        F.col("id").alias("r"),
    )
    return left.persist(), right.persist()


def found(df, keys, least):
    groups = skew.hot_groups(df, keys, min_rows=least)
    return {r["_h"]: r["_rows"] for r in groups.collect()} if groups else {}


def test_counts_find_hot_groups(spark, hot):
    left, _ = hot
    groups = found(left, ["k"], 100)
    hashes = {r[0] for r in left.filter("k = 1").select(skew.group_hash(left, ["k"])).distinct().collect()}
    assert set(groups) == hashes
    assert next(iter(groups.values())) == left.filter("k = 1").count()
    assert skew.hot_groups(left, ["k"]) is None


def test_group_under_any_share_is_split(spark):
    """A group of 1/6000 of the rows, but over the limit: it is found and split, with equal results."""
    many = spark.range(120_000).select(F.when(F.col("id") % 6000 == 7, -1).otherwise(F.col("id")).alias("k"), F.col("id").alias("l"))
    small = many.filter("k < 0 or l % 1000 = 3").withColumnRenamed("l", "r")
    groups = skew.hot_groups(small, ["k"], min_rows=15)
    assert groups.count() == 1 and many.filter("k = -1").count() * 4096 < many.count()
    split = skew.skew_join(many, small, ["k"], "left", None, groups, share_rows=3)
    assert split.exceptAll(many.join(small, ["k"], "left")).isEmpty() and split.count() == many.join(small, ["k"], "left").count()
    hot = skew.hot_groups(many, ["k"], min_rows=15)
    lagged = windows.add_lags(many, ["k"], "l", [], "l", {"p": 1}, hot=hot, block_rows=4)
    assert rows(lagged.filter("k = -1")) == rows(windows.add_lags(many, ["k"], "l", [], "l", {"p": 1}, hot={}).filter("k = -1"))
    assert lagged.count() == many.count()


def test_left_side_is_not_searched(spark, hot, monkeypatch):
    left, right = hot
    searched = []
    monkeypatch.setattr(skew, "hot_groups", lambda df, on: searched.append(df) or None)
    monkeypatch.setattr(skew, "fits_broadcast", lambda df: False)
    for how in ("inner", "left", "left_semi", "left_anti"):
        skew.skew_join(left, right, ["k"], how)
    assert len(searched) == 1


def test_key_hash_ignores_integer_width(spark):
    wide = spark.range(5).toDF("k")
    narrow = wide.select(F.col("k").cast("int").alias("k"))
    hashes = lambda df: [r[0] for r in df.select(skew.group_hash(df, ["k"])).collect()]
    assert hashes(wide) == hashes(narrow)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("side", ["left", "right", "both"])
def test_split_join(spark, hot, how, side):
    left, right = hot
    hot_left = found(left, ["k"], 100) if side != "right" else {}
    hot_right = found(right.dropna(), ["k"], 30) if side != "left" else {}
    assert hot_left or hot_right
    split = skew.skew_join(left, right, ["k"], how, hot_left, hot_right, share_rows=8)
    assert rows(split) == rows(left.join(right, ["k"], how))


def test_split_join_with_sparse_shares(spark):
    """More shares than right rows: most copies of a left row meet nothing and must vanish."""
    left = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (3, "d")], "k bigint, l string")
    right = spark.createDataFrame([(1, "x"), (1, "y"), (3, "z")], "k bigint, r string")
    hashes = [r[0] for r in right.filter("k = 1").select(skew.group_hash(right, ["k"])).distinct().collect()]
    split = skew.skew_join(left, right, ["k"], "left", {}, {hashes[0]: 1000}, share_rows=4)
    assert rows(split) == rows(left.join(right, ["k"], "left"))


def test_copies_of_one_row_are_dealt_apart(spark):
    copies = spark.range(0, 400, 1, 8).select(F.lit(1).cast("bigint").alias("k"), F.lit("same").alias("l"))
    right = spark.createDataFrame([(1, "x"), (1, "y"), (2, "z")], "k bigint, r string")
    hot = found(copies, ["k"], 100)
    dealt = skew.deal(copies, ["k"], hot, "share", share_rows=50)
    assert dealt.select("share").distinct().count() > 1
    split = skew.skew_join(copies, right, ["k"], "left", hot, {}, share_rows=50)
    assert rows(split) == rows(copies.join(right, ["k"], "left")) and split.count() == 800


def test_numbering_splits_equal_rows(spark):
    equal = spark.range(0, 1000, 1, 8).select(F.lit(7).alias("k"))
    numbered = skew.with_position(equal, ["k"])
    assert sorted(r["_pos"] for r in numbered.collect()) == list(range(1000))


def test_chained_bucket_join_splits_hot_bucket(spark):
    ts = F.timestamp_micros(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") * 1_800_000_000)).cast("timestamp_ntz")
    base = spark.range(300).select(F.lit(1).alias("k"), ts.alias("ts"), F.col("id").alias("a"))
    feed = base.filter("a % 40 = 0").withColumnRenamed("a", "v")
    bucketed = base.withColumn("_bucket", F.date_trunc("hour", "ts").cast("timestamp_ntz"))
    hot = found(bucketed, ["k", "_bucket"], 50)
    assert len(hot) == 1
    feeds = {"m": feed, "p": feed}
    plain = bucket_left_join(base, feeds, ["k"], "ts", "ts", hot_left={}, hot_right={})
    split = bucket_left_join(base, feeds, ["k"], "ts", "ts", hot_left=hot, hot_right={}, share_rows=10)
    assert rows(split) == rows(plain)
    split = bucket_left_join(base, feeds, ["k"], "ts", "ts", hot_left={}, hot_right={"p": hot}, share_rows=10)
    assert rows(split) == rows(plain)


@pytest.fixture(scope="module")
def series(spark):
    """One series with a third of the rows, short series, missing values."""
    key = F.when(F.col("id") % 3 == 0, 0).otherwise(1 + F.col("id") % 17)
    value = F.when(F.col("id") % 23 != 5, (F.xxhash64("id") % 1000) / 10)
    ts = F.timestamp_seconds(1_700_000_000 + F.floor(F.col("id") / 2) * 900).cast("timestamp_ntz")
    return spark.range(1500).select(key.alias("k"), ts.alias("ts"), F.col("id"), value.alias("v")).persist()


@pytest.mark.parametrize("block", [24, 25, 100, 1000])
def test_split_windows(spark, series, block):
    hot = found(series, ["k"], 300)
    assert len(hot) == 1
    lags = {"l1": 1, "l24": 24}
    plain = windows.add_lags(series, ["k"], "ts", ["id"], "v", lags, hot={})
    split = windows.add_lags(series, ["k"], "ts", ["id"], "v", lags, hot=hot, block_rows=block)
    assert rows(split) == rows(plain)
    out = {"m": "mean", "s": "std"}

    def trailing(**how):
        df = windows.add_trailing(series, ["k"], "ts", ["id"], "v", 24, out, **how)
        return df.withColumns({c: F.round(c, 9) for c in out})

    assert rows(trailing(hot=hot, block_rows=block)) == rows(trailing(hot={}))


def test_split_needs_room_for_the_lookback(spark, series):
    with pytest.raises(ValueError):
        windows.add_lags(series, ["k"], "ts", ["id"], "v", {"l": 24}, hot={1: 1}, block_rows=10)


def test_windows_match_pandas(spark, series):
    pdf = series.toPandas().sort_values(["k", "ts", "id"])
    grouped = pdf.groupby("k")["v"]
    pdf["lag"] = grouped.shift(6)
    pdf["mean"] = grouped.transform(lambda x: x.shift(1).rolling(24).mean())
    pdf["std"] = grouped.transform(lambda x: x.shift(1).rolling(24).std())
    lagged = windows.add_lags(series, ["k"], "ts", ["id"], "v", {"lag": 6})
    got = windows.add_trailing(lagged, ["k"], "ts", ["id"], "v", 24, {"mean": "mean", "std": "std"}).toPandas()
    columns = ["id", "lag", "mean", "std"]
    pd.testing.assert_frame_equal(
        got.sort_values("id")[columns].reset_index(drop=True), pdf.sort_values("id")[columns].reset_index(drop=True)
    )
    assert pdf["mean"].notna().sum() > 50


def test_features_drop_short_series(spark, series):
    exact = series.filter("k = 0").orderBy("ts", "id").limit(24)
    assert ts_features(exact.fillna(1.0, ["v"]), "k", "ts", "v", ["id"]).count() == 0
    more = series.filter("k = 0").orderBy("ts", "id").limit(26)
    assert ts_features(more.fillna(1.0, ["v"]), "k", "ts", "v", ["id"]).count() == 2


def test_rows_dropped_before_or_after_the_lags(spark, series):
    after = ts_features(series, "k", "ts", "v", ["id"], lags=[1], window=2)
    before = ts_features(series, "k", "ts", "v", ["id"], lags=[1], window=2, complete_first=["v"])
    assert 0 < after.count() < before.count()


def test_sequential_id_is_the_row_number(spark, series):
    ids = [r["id"] for r in windows.sequential_id(series.drop("id").withColumn("n", F.monotonically_increasing_id()), ["k", "ts", "n"]).select("id").collect()]
    assert sorted(ids) == list(range(1, series.count() + 1))
    numbered = windows.sequential_id(series, ["k", "ts", "id"], "nr").orderBy("nr").select("k", "ts", "id").collect()
    assert [r["id"] for r in numbered] == [r["id"] for r in series.orderBy("k", "ts", "id").collect()]


@pytest.mark.parametrize("q", [0.0, 0.1, 0.5, 0.8, 0.937, 1.0])
def test_quantile_by_narrowing(spark, series, q):
    """Distinct values, ties, one value holding a third of the rows, and extremes."""
    mixed = F.when(F.col("id") % 3 == 0, 42.0).when(F.col("id") == 1, 1e12).when(F.col("id") == 2, -1e12).otherwise(F.col("v"))
    for column in ("v", "id", mixed):
        df = series.select((F.col(column) if isinstance(column, str) else column).cast("double").alias("x"))
        expected = df.toPandas()["x"].quantile(q)
        assert exact_quantile(df, "x", q) == pytest.approx(expected, rel=1e-12)


def test_quantile_of_nothing_and_of_one_value(spark):
    empty = spark.createDataFrame([], "x double")
    assert exact_quantile(empty, "x", 0.5) is None
    same = spark.createDataFrame([(3.0,)] * 5 + [(None,), (float("nan"),)], "x double")
    assert exact_quantile(same, "x", 0.3) == 3.0


@pytest.mark.parametrize("values", [
    [1.0, 2.0, float("inf")], [float("-inf"), 5.0, 6.0, 7.0], [float("inf")] * 3, [float("-inf"), float("inf")],
    [1.7e308, -1.7e308, 0.0, 1.0], [5e-324, 0.0, 1e-323, 1.0], [1.0, 1.0 + 2**-52, 1.0 + 2**-51],
])
@pytest.mark.parametrize("q", [0.0, 0.4, 0.5, 0.8, 1.0])
def test_quantile_with_extreme_values(spark, values, q):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    ordered, rank = sorted(values), q * (len(values) - 1)
    a, b = ordered[int(rank)], ordered[-int(-rank // 1)]
    assert exact_quantile(df, "x", q) == (a if a == b or rank == int(rank) else pytest.approx(a + (b - a) * (rank - int(rank)), rel=1e-12, nan_ok=True))
