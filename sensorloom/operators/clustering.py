"""K-means over per-entity means."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from sensorloom.functions import values as fv
from sensorloom.operators.aggregates import mean_by
from sensorloom.operators.joins import join_dim
from sensorloom.operators.relational import drop_incomplete
from sensorloom.operators.scaling import standardise
from sensorloom.session import settle

# fixed values: names of the severity levels, mildest first, and the prefix of an unnamed one
LEVEL_NAMES = {0: "Air pur", 1: "Pollution modérée", 2: "Pollution élevée", 3: "Pollution critique"}
LEVEL_PREFIX = "Groupe "


def _unit(values: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1) from 64-bit integers."""
    return ((values.astype(np.uint64) >> np.uint64(11)).astype(float) + 0.5) / float(1 << 53)


def _nearest(points: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centre and squared distance of each point (n, d), for each start of ``centres`` (starts, k, d)."""
    square = ((points[:, None, None, :] - centres[None]) ** 2).sum(axis=3)
    best = square.argmin(axis=2)
    return best, np.take_along_axis(square, best[:, :, None], axis=2)[:, :, 0]


def _points(batch: pa.RecordBatch, features: int) -> np.ndarray:
    return np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(float) for i in range(features)], axis=1)


def _drawn(points: DataFrame, features: int, starts: int, centres: np.ndarray | None, seed: int) -> np.ndarray:
    """One more centre for each start, drawn with a chance in proportion to the squared distance from its centres so far (evenly at
    first): the least of -log(u) / weight, with u hashed from the point's id, the start and the turn. One pass for all starts.
    """
    turn = 0 if centres is None else centres.shape[1]

    def draw(batches):
        least = np.full(starts, np.inf)
        at = np.zeros((starts, features))
        for batch in batches:
            x = _points(batch, features)
            ids = batch.column(features).to_numpy().astype(np.int64)
            weight = np.ones((len(x), starts)) if centres is None else _nearest(x, centres)[1]
            for s in range(starts):
                mixed = pd.util.hash_array(ids ^ np.int64((seed * 1000 + s) * 1000 + turn))
                with np.errstate(divide="ignore"):
                    race = np.where(weight[:, s] > 0, -np.log(_unit(mixed)) / weight[:, s], np.inf)
                best = int(race.argmin()) if len(race) else 0
                if len(race) and race[best] < least[s]:
                    least[s], at[s] = race[best], x[best]
        used = np.flatnonzero(np.isfinite(least))
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(least[used]), pa.array(list(at[used]), pa.list_(pa.float64()))], names=["start", "race", "at"])

    made = points.mapInArrow(draw, "start long, race double, at array<double>")
    found = {r["start"]: r["at"] for r in made.groupBy("start").agg(F.min_by("at", "race").alias("at")).collect()}  # a row per start
    # a start whose centres sit on all points has nothing left to draw
    fresh = np.array([found[s] if s in found else centres[s, 0] for s in range(starts)])[:, None]
    return fresh if centres is None else np.concatenate([centres, fresh], axis=1)


def _moved(points: DataFrame, features: int, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The means of the points nearest to each centre, and the cost of each start with the given centres: one aggregate for all starts."""
    starts, k, _ = centres.shape

    def add_up(batches):
        total = np.zeros((starts * k, features + 2))
        for batch in batches:
            x = _points(batch, features)
            best, square = _nearest(x, centres)
            for s in range(starts):
                slot = s * k + best[:, s]
                total[:, 0] += np.bincount(slot, minlength=starts * k)
                total[:, 1] += np.bincount(slot, square[:, s], starts * k)
                for f in range(features):
                    total[:, 2 + f] += np.bincount(slot, x[:, f], starts * k)
        used = np.flatnonzero(total[:, 0])
        yield pa.RecordBatch.from_arrays([pa.array(used), *[pa.array(total[used, i]) for i in range(features + 2)]], names=["slot", *names])

    names = [f"s{i}" for i in range(features + 2)]
    made = points.mapInArrow(add_up, ", ".join(["slot long", *[f"{n} double" for n in names]]))
    sums = np.zeros((starts * k, features + 2))
    for r in made.groupBy("slot").agg(*[F.sum(n).alias(n) for n in names]).collect():  # starts x k rows
        sums[r["slot"]] = [r[n] for n in names]
    sums = sums.reshape(starts, k, -1)
    full = sums[:, :, :1] > 0
    return np.where(full, sums[:, :, 2:] / np.where(full, sums[:, :, :1], 1.0), centres), sums[:, :, 1].sum(axis=1)


def best_centres(
    df: DataFrame, key: str, features: Sequence[str], k: int, n_init: int = 10, seed: int = 42, most_rounds: int = 300
) -> tuple[np.ndarray, np.ndarray]:
    """Centres (k, features) of the cheapest of ``n_init`` k-means runs, the first of equal ones, and the costs of all runs.

    All runs go at once: a pass over the rows moves the centres of every run that still moves, and the driver holds n_init x k
    centres. Starts are drawn by squared distance, seeded by the hashed key. An empty cluster keeps its centre.
    """
    d = len(features)
    points = df.select(*[F.col(c).cast("double") for c in features], F.xxhash64(key))
    centres = None
    for _ in range(k):
        centres = _drawn(points, d, n_init, centres, seed)
    costs, moving = np.full(n_init, np.inf), np.arange(n_init)
    for _ in range(most_rounds):
        moved, cost = _moved(points, d, centres[moving])
        still = np.abs(moved - centres[moving]).max(axis=(1, 2)) > 1e-12
        costs[moving], centres[moving] = cost, moved
        moving = moving[still]
        if not len(moving):
            break
    else:
        costs[moving] = _moved(points, d, centres[moving])[1]
    return centres[int(costs.argmin())], costs


def cluster_entities(
    df: DataFrame,
    key: str,
    features: Sequence[str],
    k: int = 4,
    n_init: int = 10,
    seed: int = 42,
    min_entities: int = 3,
) -> DataFrame:
    """Entity means and a cluster id: standardised k-means, the cheapest of ``n_init`` starts.

    ``k`` is lowered to the number of entities; fewer than ``min_entities`` give no rows.
    """
    means = settle(drop_incomplete(mean_by(df, [key], features), features))
    few = means.limit(max(k, min_entities)).count()
    if few < min_entities:
        return means.withColumn("cluster_id", F.lit(0)).limit(0)
    scaled = standardise(means, features, "_z")
    names = [f"{c}_z" for c in features]
    centres, _ = best_centres(scaled, key, names, min(k, few), n_init, seed)

    @F.pandas_udf("int")
    def nearest(x: pd.DataFrame) -> pd.Series:
        return pd.Series(_nearest(x.to_numpy(dtype=float), centres[None])[0][:, 0])

    return scaled.withColumn("cluster_id", nearest(F.struct(*names))).select(*means.columns, "cluster_id")


def name_clusters(
    df: DataFrame, cluster: str, order_column: str, names: dict[int, str] = LEVEL_NAMES,
    prefix: str = LEVEL_PREFIX, name: str = "cluster_nom",
) -> DataFrame:
    """Name clusters by severity: the cluster with the lowest mean of ``order_column`` gets the first name.

    K-means ids carry no order, so they are ranked first; the ranking frame has one row per cluster.
    """
    level = F.dense_rank().over(Window.orderBy("_mean", cluster)) - 1
    ranked = df.groupBy(cluster).agg(F.avg(order_column).alias("_mean")).select(cluster, level.alias("_level"))
    return (
        join_dim(df, ranked, cluster)
        .withColumn(name, fv.map_label(F.col("_level"), names, prefix))
        .drop("_level")
    )


def cluster_profile(df: DataFrame, key: str, features: dict[str, str]) -> DataFrame:
    """Entity, cluster id, cluster name and the means rounded to 2 under ``{feature: output name}``."""
    named = df.select(key, "cluster_id", "cluster_nom", *[F.col(c).alias(out) for c, out in features.items()])
    return fv.round_columns(named, dict.fromkeys(features.values(), 2))
