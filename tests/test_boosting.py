"""Boosted trees against a recursive brute force on the same bins."""

import numpy as np
import pandas as pd
import pytest

from sensorloom.operators import boosting
from sensorloom.operators.boosting import Boosting


def frame(n=400, seed=4):
    rng = np.random.default_rng(seed)
    x = pd.DataFrame({"a": rng.integers(0, 12, n).astype(float), "b": rng.normal(0, 1, n).round(2), "c": rng.integers(0, 3, n).astype(float)})
    x.loc[rng.random(n) < 0.1, "a"] = np.nan
    x["y"] = np.where(x["a"].fillna(-5) > 6, 4.0, 0.0) + np.where(x["b"] > 0.3, 2.0, -1.0) * (x["c"] + 1) + rng.normal(0, 0.1, n)
    return x


def gain(g, h, gl, hl, reg):
    return gl * gl / (hl + reg) + (g - gl) ** 2 / (h - hl + reg) - g * g / (h + reg)


def brute_gains(bins, grad, rows, how, widths):
    """{(feature, cut): gain} of the splits of the given rows."""
    out = {}
    for f in range(len(bins)):
        for cut in range(widths[f]):
            left = [r for r in rows if bins[f][r] <= cut]
            if how.min_rows <= len(left) <= len(rows) - how.min_rows:
                out[f, cut] = gain(sum(grad[r] for r in rows), len(rows), sum(grad[r] for r in left), len(left), how.reg)
    return out


def brute_tree(bins, grad, how, widths):
    """{node: (feature, cut) or value} in heap order."""
    out, level = {}, {0: list(range(len(grad)))}
    for _ in range(how.depth):
        gains = {node: brute_gains(bins, grad, rows, how, widths) for node, rows in level.items()}
        if how.symmetric:
            total = {}
            for found in gains.values():
                for split, x in found.items():
                    total[split] = total.get(split, 0.0) + x
            split = max(total, key=lambda s: (total[s], [-v for v in s])) if total else None
            chosen = dict.fromkeys(level, split if split and total[split] > 1e-12 else None)
        else:
            chosen = {}
            for node, found in gains.items():
                split = max(found, key=lambda s: (found[s], [-v for v in s])) if found else None
                chosen[node] = split if split and found[split] > 1e-12 else None
        below = {}
        for node, rows in level.items():
            if chosen[node] is None:
                out[node] = -how.rate * sum(grad[r] for r in rows) / (len(rows) + how.reg) if rows else 0.0
                continue
            f, cut = out[node] = chosen[node]
            below[2 * node + 1] = [r for r in rows if bins[f][r] <= cut]
            below[2 * node + 2] = [r for r in rows if bins[f][r] > cut]
        level = below
    for node, rows in level.items():
        out[node] = -how.rate * sum(grad[r] for r in rows) / (len(rows) + how.reg) if rows else 0.0
    return out


def drop(tree, bins, row):
    node = 0
    while isinstance(tree[node], tuple):
        f, cut = tree[node]
        node = 2 * node + 1 + (bins[f][row] > cut)
    return tree[node]


@pytest.mark.parametrize("symmetric", [False, True])
def test_trees_are_those_of_brute_force(spark, symmetric, monkeypatch):
    monkeypatch.setattr(boosting, "REFRESH_ROUNDS", 2)
    data = frame()
    how = Boosting(rounds=5, rate=0.3, depth=3, reg=1.5, min_rows=2.0, symmetric=symmetric)
    model = boosting.fit_side_by_side(spark.createDataFrame(data).repartition(3), ["a", "b", "c"], "y", {"it": how}, bins=16)["it"]
    bins = boosting.binned([data[c].to_numpy() for c in "abc"], model.edges)
    widths = [int(b.max()) + 1 for b in bins]
    y, predicted = data["y"].to_numpy(), np.full(len(data), data["y"].mean())
    for tree in model.trees:
        want = brute_tree(bins, predicted - y, how, widths)
        for node, x in want.items():
            if isinstance(x, tuple):
                assert (tree.feature[node], tree.cut[node]) == x
            else:
                assert tree.feature[node] == -1 and tree.value[node] == pytest.approx(x, abs=1e-9)
        predicted = predicted + np.array([drop(want, bins, r) for r in range(len(data))])
    scored = model.transform(spark.createDataFrame(data)).toPandas()
    assert np.allclose(scored["predicted"], predicted)
    assert np.mean((predicted - y) ** 2) < 0.2 * np.var(y)


def test_side_by_side_is_as_one_by_one(spark):
    df = spark.createDataFrame(frame(300, 9))
    growth = {"deep": Boosting(rounds=4, depth=4, rate=0.5), "flat": Boosting(rounds=2, depth=1, rate=0.5), "even": Boosting(rounds=3, depth=3, symmetric=True)}
    together = boosting.fit_side_by_side(df, ["a", "b", "c"], "y", growth, bins=12)
    for name, how in growth.items():
        alone = boosting.fit_side_by_side(df, ["a", "b", "c"], "y", {"one": how}, bins=12)["one"]
        assert [n[:4] for n in alone.nodes()] == [n[:4] for n in together[name].nodes()]
        assert len(together[name].trees) == how.rounds


def test_symmetric_levels_share_a_split(spark):
    model = boosting.fit_side_by_side(spark.createDataFrame(frame()), ["a", "b", "c"], "y", {"it": Boosting(rounds=1, depth=3, symmetric=True)})["it"]
    tree = model.trees[0]
    for level in range(3):
        nodes = range(2**level - 1, 2 ** (level + 1) - 1)
        assert len({(tree.feature[n], tree.cut[n]) for n in nodes}) == 1


def test_odd_inputs(spark):
    schema = "x double, y double"
    same = boosting.fit_side_by_side(spark.createDataFrame([(1.0, 2.0)] * 5, schema), ["x"], "y", {"it": Boosting(rounds=2, depth=2)})["it"]
    assert same.transform(spark.createDataFrame([(None, 0.0), (9.0, 0.0)], schema)).select("predicted").distinct().collect() == [(2.0,)]
    gaps = spark.createDataFrame([(None, 1.0), (float("nan"), 1.0), (3.0, 5.0), (4.0, None), (5.0, float("nan"))] * 4, schema)
    model = boosting.fit_side_by_side(gaps, ["x"], "y", {"it": Boosting(rounds=1, rate=1.0, depth=1, reg=0.0)})["it"]
    assert model.nodes()[0][2:4] == ("x", float("-inf"))  # only the missing go left
    rows = {r["x"]: r["predicted"] for r in model.transform(spark.createDataFrame([(None, 0.0), (-1e9, 0.0)], schema)).collect()}
    assert rows == {None: pytest.approx(1.0), -1e9: pytest.approx(5.0)}
    with pytest.raises(ValueError):
        boosting.fit_side_by_side(gaps.where("y > 100"), ["x"], "y", {"it": Boosting()})


def test_a_pass_evaluates_few_trees(spark, monkeypatch):
    """Every level reads all rows, so the trees it has to evaluate for each of them must not pile up."""
    seen, histograms = [], boosting._histograms
    monkeypatch.setattr(boosting, "_histograms", lambda rows, k, width, grown, *rest: seen.append(len(grown[0])) or histograms(rows, k, width, grown, *rest))
    boosting.fit_side_by_side(spark.createDataFrame(frame(100)), ["a", "b", "c"], "y", {"it": Boosting(rounds=12, depth=1)}, bins=8)
    assert len(seen) == 12 and max(seen) < 5


def test_rows_are_kept_many_to_a_record(spark, monkeypatch):
    """A pass hands Python a few records, whatever the rows, and no sums by cell go through a shuffle of rows."""
    kept, settle = [], boosting.settle
    monkeypatch.setattr(boosting, "settle", lambda df, **options: kept.append(settle(df, **options)) or kept[-1])
    df = spark.range(40_000).selectExpr("rand(1) AS a", "rand(2) AS b", "rand(3) AS c", "rand(4) + rand(5) AS y").repartition(3)
    monkeypatch.setattr(boosting, "discard", lambda *frames: None)
    boosting.fit_side_by_side(df, ["a", "b", "c"], "y", {"it": Boosting(rounds=4, depth=2)})
    assert len(kept) >= 2 and all(rows.count() <= 3 + 40_000 // 10_000 for rows in kept)


def test_sums_merged_by_node_give_the_same_trees(spark, monkeypatch):
    df = spark.createDataFrame(frame(900, 3)).repartition(5)
    growth = {"deep": Boosting(rounds=4, depth=4, rate=0.5), "even": Boosting(rounds=3, depth=3, symmetric=True)}
    by_driver = boosting.fit_side_by_side(df, ["a", "b", "c"], "y", growth, bins=20)
    monkeypatch.setattr(boosting, "DRIVER_BYTES", 0)
    monkeypatch.setattr(boosting, "_CHUNK_ROWS", 37)
    by_tasks = boosting.fit_side_by_side(df, ["a", "b", "c"], "y", growth, bins=20)
    for name in growth:
        assert [n[:4] for n in by_driver[name].nodes()] == [n[:4] for n in by_tasks[name].nodes()]
        values = [[n[4] or 0.0 for n in found[name].nodes()] for found in (by_driver, by_tasks)]
        assert np.allclose(*values)


def test_more_bins_than_a_byte_holds(spark):
    df = spark.range(3000).selectExpr("CAST(id AS double) AS a", "CAST(id AS double) AS y")
    model = boosting.fit_side_by_side(df, ["a"], "y", {"it": Boosting(rounds=1, depth=9, rate=1.0, reg=0.0)}, bins=600)["it"]
    assert len(model.edges[0]) > 300 and model.transform(df).selectExpr("max(abs(predicted - y)) AS e").first()["e"] < 6
