"""The forest against a recursive brute force, and the same trees wherever their nodes are split."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sensorloom.operators import forest
from sensorloom.operators.boosting import binned
from sensorloom.operators.forest import RandomForest


def frame(n=600, seed=5):
    rng = np.random.default_rng(seed)
    x = pd.DataFrame({"a": rng.integers(0, 9, n).astype(float), "b": rng.normal(0, 1, n).round(2), "c": rng.integers(0, 3, n).astype(float), "k": 1.0})
    x["y"] = np.where(x["a"] > 4, 4.0, 0.0) + x["b"] * (x["c"] + 1) + rng.normal(0, 1, n)
    x["i"] = np.arange(n)
    return x


def brute(x, y, w, rows, depth):
    """Predictions of the rows by a tree over their bins."""
    mean = np.average(y[rows], weights=w[rows])
    best, found = 1e-9, None
    for f in range(len(x)):
        for cut in np.unique(x[f][rows])[:-1]:
            left, right = rows[x[f][rows] <= cut], rows[x[f][rows] > cut]
            part = lambda r: (w[r] @ y[r]) ** 2 / w[r].sum()
            gain = part(left) + part(right) - part(rows)
            if gain > best + 1e-9:
                best, found = gain, (left, right)
    if depth == 0 or found is None:
        return {int(r): mean for r in rows}
    return brute(x, y, w, found[0], depth - 1) | brute(x, y, w, found[1], depth - 1)


@pytest.mark.parametrize("depth", [3, 30])
def test_a_tree_is_that_of_brute_force(depth):
    data = frame()
    rng = np.random.default_rng(1)
    w = rng.integers(1, 4, len(data)).astype(np.uint8)
    x = binned([data[c].to_numpy() for c in "abck"], [np.unique(data[c])[:-1] for c in "abck"]).astype(np.uint8)
    y = data["y"].to_numpy()
    tree = forest.grow(x, y, w, int(x.max()) + 2, depth)
    want = brute(x, y, w.astype(float), np.arange(len(y)), depth)
    assert np.allclose(tree.value[tree.ends(x)], [want[i] for i in range(len(y))])


def test_trees_are_the_same_wherever_nodes_are_split(spark, monkeypatch):
    df = spark.createDataFrame(frame()).repartition(3)

    def run(small, group):
        monkeypatch.setattr(forest, "SMALL_ROWS", small)
        monkeypatch.setattr(forest, "GROUP_ROWS", group)
        model = RandomForest(["a", "b", "c", "k"], "y", trees=6).fit(df)
        done = model.transform(df).toPandas().set_index("i").sort_index()
        return model, done

    whole, by_rows = run(10**6, 10**6)
    parts, by_both = run(40, 1300)  # two trees at a time, the upper nodes by histograms
    assert len(whole.tops) == 1 and len(parts.tops) == 3
    assert all(len(t.feature) == 1 for t in whole.tops[0].values()) and all(len(t.feature) > 8 for group in parts.tops for t in group.values())
    assert len(by_rows) == 600 and np.allclose(by_rows["predicted"], by_both["predicted"])
    nowhere, by_histograms = run(0, 10**6)  # all nodes by histograms
    assert np.allclose(by_rows["predicted"], by_histograms["predicted"])
    assert 1 - ((by_rows["predicted"] - by_rows["y"]) ** 2).sum() / (np.var(by_rows["y"]) * 600) > 0.8


def test_a_forest_of_full_depth_over_many_rows(spark):
    """As many leaves as rows in each of 100 trees: the driver holds none of them, so this takes seconds."""
    n = 20_000
    df = spark.range(n).select(F.rand(1).alias("a"), F.rand(2).alias("b"), F.rand(3).alias("c"), F.rand(4).alias("y"), "id")
    model = RandomForest(["a", "b", "c"], "y").fit(df)
    assert sum(len(t.feature) for group in model.tops for t in group.values()) == 100
    row = model.transform(df).agg(F.count("predicted"), F.corr("y", "predicted"), F.min("predicted"), F.max("predicted")).first()
    assert row[0] == n and row[1] > 0.8 and 0 <= row[2] < row[3] <= 1


def test_draws_are_poisson_and_differ_by_tree():
    ids = np.arange(200_000)
    a, b = forest.draws(ids, 0, 42), forest.draws(ids, 1, 42)
    assert abs(a.mean() - 1) < 0.01 and abs(a.var() - 1) < 0.02 and abs((a == 0).mean() - np.exp(-1)) < 0.01
    assert abs(np.corrcoef(a, b)[0, 1]) < 0.01
    assert (a == forest.draws(ids, 0, 42)).all() and (a != forest.draws(ids, 0, 43)).any()


def test_odd_inputs(spark):
    schema = "x double, y double"
    one = RandomForest(["x"], "y", trees=1).fit(spark.createDataFrame([(1.0, 1.0), (None, 5.0), (float("nan"), 5.0), (2.0, 3.0), (9.0, None)], schema))
    got = one.transform(spark.createDataFrame([(1.0, 0.0), (None, 0.0), (2.0, 0.0), (99.0, 0.0)], schema)).collect()
    assert {r["x"]: r["predicted"] for r in got} == {1.0: pytest.approx(1.0), None: pytest.approx(5.0), 2.0: pytest.approx(3.0), 99.0: pytest.approx(3.0)}
    same = RandomForest(["x"], "y", trees=4).fit(spark.createDataFrame([(float(i), 2.0) for i in range(9)], schema))
    assert same.transform(spark.createDataFrame([(3.0, 0.0)], schema)).first()["predicted"] == pytest.approx(2.0)
    with pytest.raises(ValueError):
        RandomForest(["x"], "y").fit(spark.createDataFrame([(1.0, None)], schema))


def test_few_rows_are_split_as_many(monkeypatch):
    """Nodes of few rows, of which all ways to part the rows are scored, get the splits that sums by bin give, ties included."""
    rng = np.random.default_rng(8)
    x = np.stack([rng.integers(0, n, 900) for n in (9, 2, 30, 1)]).astype(np.uint8)
    for y in (rng.integers(0, 3, 900) * 1.0, rng.exponential(5.0, 900).round(1) - 5):
        w = rng.integers(1, 4, 900).astype(np.uint8)
        found = []
        for few in (1, 3, 8):
            monkeypatch.setattr(forest, "_FEW_ROWS", few)
            tree = forest.grow(x, y, w, 32, 30)
            found.append((len(tree.feature), tree.value[tree.ends(x)]))
        assert found[0][0] == found[1][0] == found[2][0] > 300
        assert np.allclose(found[0][1], found[1][1]) and np.allclose(found[0][1], found[2][1])


def test_a_pass_serves_all_trees(spark, monkeypatch):
    """Passes over the rows do not multiply with the groups of trees that are shuffled, and sums may be merged by tasks."""
    passes, histograms = [], forest._histograms
    monkeypatch.setattr(forest, "_histograms", lambda rows, k, width, tops, *rest: passes.append(len(tops)) or histograms(rows, k, width, tops, *rest))
    monkeypatch.setattr(forest, "SMALL_ROWS", 60)
    df = spark.createDataFrame(frame()).repartition(3)
    done = []
    for group, driver in ((10**6, forest.GROUP_ROWS), (1300, 0)):
        monkeypatch.setattr(forest, "GROUP_ROWS", group)
        monkeypatch.setattr("sensorloom.operators.boosting.DRIVER_BYTES", driver)
        passes.clear()
        model = RandomForest(["a", "b", "c", "k"], "y", trees=6, depth=5).fit(df)
        assert len(passes) <= 5 and passes[0] == 6
        done.append(model.transform(df).toPandas().set_index("i").sort_index()["predicted"])
    assert len(model.tops) == 3 and np.allclose(*done)


def test_draws_by_the_first_bits_are_those_by_all():
    z = np.random.default_rng(2).integers(0, 1 << 63, 100_000).astype(np.uint64) * np.uint64(2)
    edges = (forest._POISSON[:6] * 2.0**53).astype(np.uint64) << np.uint64(11)
    for some in (z, edges, edges - np.uint64(1 << 11), edges + np.uint64(1 << 11)):
        first = forest._BY_START[(some >> np.uint64(48)).astype(np.int64)]
        assert ((first == 255) | (first == forest._poisson(some))).all()
    assert (forest._BY_START == 255).sum() < 20
