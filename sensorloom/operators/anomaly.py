"""Isolation forest (Liu, Ting and Zhou 2008)."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from sensorloom.operators.relational import drop_incomplete
from sensorloom.operators.scaling import flag_top_share
from sensorloom.session import discard, settle

_REDRAWS = 5
_NODES = "tree int, rows int, feature array<int>, cut array<double>, low array<int>, high array<int>, depth array<double>"


def expected_depth(n) -> np.ndarray:
    """Mean path length of an unsuccessful search among ``n`` points."""
    n = np.asarray(n, dtype=float)
    big = np.maximum(n, 3.0)
    many = 2 * (np.log(big - 1) + np.euler_gamma) - 2 * (big - 1) / big
    return np.where(n > 2, many, np.where(n == 2, 1.0, 0.0))


def _grow(points: np.ndarray, limit: int, rng: np.random.Generator):
    """One isolation tree as parallel node lists; a leaf has feature -1."""
    nodes = [[-1, 0.0, 0, 0, 0.0]]
    todo = [(0, points, 0)]
    while todo:
        at, rows, depth = todo.pop()
        low, high = rows.min(axis=0), rows.max(axis=0)
        splittable = np.flatnonzero(high > low)
        if depth >= limit or len(rows) < 2 or not len(splittable):
            nodes[at][4] = depth + float(expected_depth(len(rows)))
            continue
        feature = int(rng.choice(splittable))
        cut = float(rng.uniform(low[feature], high[feature]))
        left = rows[:, feature] <= cut
        nodes[at][:4] = [feature, cut, len(nodes), len(nodes) + 1]
        todo += [(len(nodes), rows[left], depth + 1), (len(nodes) + 1, rows[~left], depth + 1)]
        nodes += [[-1, 0.0, 0, 0, 0.0], [-1, 0.0, 0, 0, 0.0]]
    return [list(column) for column in zip(*nodes)]


def _compact(tree):
    """Arrays for the walk. A leaf points at itself, so every row can take the same number of steps."""
    feature, cut, low, high, depth = (np.array(part) for part in tree[2:])
    leaf, own = feature < 0, np.arange(len(feature))
    child = np.column_stack([np.where(leaf, own, low), np.where(leaf, own, high)]).ravel()
    return np.where(leaf, 0, feature).astype(np.intp), np.where(leaf, np.inf, cut), child.astype(np.intp), depth


def _unit(*parts: Column) -> Column:
    """Repeatable number in [0, 1) from the hashed parts."""
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 31)) / F.lit(float(1 << 31))


def tree_samples(df: DataFrame, ids: Sequence[str], features: Sequence[str], n: int, trees: int, size: int, seed: int):
    """``size`` rows for each tree, drawn without replacement by hashed row id from all ``n`` rows.

    Every row may be drawn. It has one ticket per block of trees, as few blocks as keep the chance of a ticket at or below
    one; a ticket is kept by one hash and given to a tree of its block by another, so the input is read once and only
    about four times the rows that are needed are moved. The draws depend on the ids alone, not on partitions or retries.
    """
    wanted = min(float(trees), 4.0 * size * trees / n)  # tickets kept per row
    blocks = min(trees, math.ceil(wanted))
    edges = [i * trees // blocks for i in range(blocks + 1)]
    rows = df.select(*dict.fromkeys([*ids, *features])).withColumn("_id", F.xxhash64(*[F.col(c) for c in ids]))
    tickets = F.filter(
        F.sequence(F.lit(0), F.lit(blocks - 1)), lambda b: _unit(F.col("_id"), b, F.lit(seed)) < wanted / blocks
    )
    drawn = rows.withColumn("_block", F.explode(tickets))
    begin, end = (F.element_at(F.array(*map(F.lit, e)), F.col("_block") + 1) for e in (edges[:-1], edges[1:]))
    pick = F.floor(_unit(F.col("_id"), F.col("_block"), F.lit(seed + 1)) * (end - begin)).cast("int")
    drawn = drawn.withColumn("tree", begin + pick)
    drawn = drawn.withColumn("_draw", _unit(F.col("_id"), F.col("tree"), F.lit(seed + 2)))
    first = Window.partitionBy("tree").orderBy("_draw", "_id", *ids)
    return drawn.withColumn("_rank", F.row_number().over(first)).filter(F.col("_rank") <= size)


def isolation_forest(
    df: DataFrame,
    ids: Sequence[str],
    features: Sequence[str],
    trees: int = 100,
    sample_size: int = 256,
    contamination: float = 0.1,
    seed: int = 42,
    min_count: int = 11,
) -> DataFrame:
    """All complete rows with ``outlier_score``, ``score`` (-1 outlier, 1 inlier) and ``est_anomalie``.

    The input is computed once, and written; counting, drawing and scoring read that. Each tree grows in its own task from
    ``sample_size`` rows. The trees (at most ``trees`` times ``2 * sample_size - 1`` nodes) are broadcast, and scoring runs on Arrow batches. Scaling the features
    would not change the splits in law, so it is left out. Fewer than ``min_count`` rows give no rows.
    """
    spark = df.sparkSession
    complete = settle(drop_incomplete(df, features))
    n = complete.count()  # kept in the written files
    if n < min_count:
        empty = complete.limit(0).withColumn("outlier_score", F.lit(0.0))
        return empty.withColumn("est_anomalie", F.lit(False)).withColumn("score", F.lit(1))
    size = min(sample_size, n)
    limit = math.ceil(math.log2(max(size, 2)))
    names = list(features)

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        points = pdf.sort_values("_rank")[names].to_numpy(dtype=float)
        return pd.DataFrame([[tree, len(points), *_grow(points, limit, np.random.default_rng([seed, tree]))]], columns=_COLUMNS)

    for again in range(_REDRAWS):  # a tree that got too few rows is drawn anew, with all others
        sampled = tree_samples(complete, ids, names, n, trees, size, seed + 1000 * again)
        grown = sampled.groupBy("tree").applyInPandas(grow, _NODES).orderBy("tree").collect()
        if len(grown) == trees and all(t["rows"] == size for t in grown):
            break
    shared = spark.sparkContext.broadcast([_compact(tree) for tree in grown])
    usual = float(expected_depth(size))

    @F.pandas_udf("double")
    def outlier_score(*columns: pd.Series) -> pd.Series:
        points = np.column_stack([c.to_numpy(dtype=float) for c in columns])
        flat, first = points.ravel(), np.arange(len(points)) * points.shape[1]
        total = np.zeros(len(points))
        for feature, cut, child, depth in shared.value:
            at = np.zeros(len(points), dtype=np.intp)
            for _ in range(limit):
                right = flat.take(first + feature.take(at)) > cut.take(at)
                at = child.take(2 * at + right)
            total += depth.take(at)
        return pd.Series(2.0 ** (-total / len(shared.value) / usual))

    scored = settle(complete.withColumn("outlier_score", outlier_score(*names)))
    discard(complete)
    shared.destroy()
    flagged = flag_top_share(scored, "outlier_score", contamination, "est_anomalie")
    return flagged.withColumn("score", F.when(F.col("est_anomalie"), -1).otherwise(1))


_COLUMNS = ["tree", "rows", "feature", "cut", "low", "high", "depth"]
