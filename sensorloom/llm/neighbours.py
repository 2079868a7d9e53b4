"""Approximate nearest neighbours by cosine over shifted Hilbert curves.

The vectors are normalised and projected on a few random directions per curve, each curve with directions and a shift of its own. The
projections are cut into cells by the quantiles of a bounded sample, and the cell's place on a Hilbert
curve is the row's key. Spark deals the rows of each curve into runs of consecutive keys; a query goes to the runs within a
window around its own run, each run returns its nearest rows, and the answers of all curves are merged and ranked by the exact
cosine of the original vectors.

How wide the window has to be depends on the data: vectors with few real dimensions need little, directions without any structure
most of the curve. ``calibrate`` therefore measures recall against brute force on a bounded number of queries over all rows, and takes
the smallest window that reaches the wanted recall.

Equal vectors need no search each: of one vector's rows only the ``k`` + 1 smallest ids can be among anyone's ``k`` nearest, so
only those are indexed.

Defined results: vectors that are null, zero, of another length than most, or hold null or non-finite components take no part, as rows or as
queries; null ids take no part; rows that repeat an id keep one vector per id (the first in order of components).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import settle

BITS = 4


def hilbert_keys(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place on the Hilbert curve of each row of integer ``cells`` (n x d, values below 2**bits), by Skilling's transform."""
    x = cells.astype(np.int64).T.copy()
    d = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(d):
            high = (x[i] & q) != 0
            swapped = (x[0] ^ x[i]) & p
            x[0] = np.where(high, x[0] ^ p, x[0] ^ swapped)
            x[i] = np.where(high, x[i], x[i] ^ swapped)
        q >>= 1
    for i in range(1, d):
        x[i] ^= x[i - 1]
    t = np.zeros(x.shape[1], np.int64)
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where(x[d - 1] & q, t ^ (q - 1), t)
        q >>= 1
    x ^= t
    key = np.zeros(x.shape[1], np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(d):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


@dataclass
class Curves:
    """Directions, cell borders and run borders of every curve. Its size depends on the parameters only."""

    directions: list[np.ndarray]
    borders: list[np.ndarray]
    runs: list[np.ndarray]

    def keys(self, c: int, unit: np.ndarray) -> np.ndarray:
        seen = unit @ self.directions[c]
        cells = np.stack([np.searchsorted(b, seen[:, i]) for i, b in enumerate(self.borders[c])], axis=1)
        return hilbert_keys(cells)

    def run_of(self, c: int, unit: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.runs[c], self.keys(c, unit), side="right")


def fit_curves(sample: np.ndarray, curves: int, dims: int, runs: int, seed: int = 7) -> Curves:
    """Curves for unit vectors, with borders from ``sample``. A curve's shift moves all its cell borders by a part of a cell."""
    rng = np.random.default_rng(seed)
    out = Curves([], [], [])
    cells = 1 << BITS
    for c in range(curves):
        directions, _ = np.linalg.qr(rng.normal(size=(sample.shape[1], min(dims, sample.shape[1]))))
        seen = sample @ directions
        shift = (c + 0.5) / curves - 0.5
        at = np.clip((np.arange(1, cells) + shift) / cells, 0, 1)
        out.directions.append(directions)
        out.borders.append(np.quantile(seen, at, axis=0).T)
        out.runs.append(np.zeros(0, np.int64))
        keys = out.keys(c, sample)
        out.runs[c] = np.unique(np.quantile(keys, np.arange(1, runs) / runs, method="nearest")) if runs > 1 else np.zeros(0, np.int64)
    return out


def usable(df: DataFrame, key: str, vector: str) -> DataFrame:
    """``id`` long, ``v`` array<double>: one row per id with a vector that can be compared."""
    v = F.col(vector).cast("array<double>")
    good = v.isNotNull() & (F.size(v) > 0) & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = df.select(F.col(key).cast("long").alias("id"), F.when(good, v).alias("v")).where("id IS NOT NULL AND v IS NOT NULL")
    return rows.groupBy("id").agg(F.min("v").alias("v"))


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of each row of ``a`` with the same row of ``b``, in double precision, the same for the same pair wherever it is computed."""
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def nearest_in(queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int, block: int = 256):
    """(query index, row index, score) of each query's ``k`` best rows, never itself; ties to the smaller id."""
    unit = _unit(rows)
    order = np.argsort(ids, kind="stable")
    unit, rows, ids = unit[order], rows[order], ids[order]
    for at in range(0, len(queries), block):
        near = _unit(queries[at : at + block]) @ unit.T
        near[query_ids[at : at + block, None] == ids[None, :]] = -np.inf
        few = min(k, near.shape[1])
        floor = -np.partition(-near, few - 1, axis=1)[:, few - 1] - 1e-9
        q, r = np.nonzero((near >= floor[:, None]) & (near > -np.inf))
        score = cosines(queries[at + q], rows[r])
        order2 = np.lexsort((ids[r], -score, q))
        q, r, score = q[order2], r[order2], score[order2]
        first = np.searchsorted(q, q)
        keep = np.arange(len(q)) - first < k
        yield at + q[keep], ids[r[keep]], score[keep]


def search(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 5,
    curves: int = 4,
    dims: int = 6,
    run_rows: int = 1024,
    sample_rows: int = 20_000,
    recall: float = 0.95,
    calibration_queries: int = 64,
    key: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: each query's ``k`` nearest rows found, never the query's own row.

    ``queries`` are rows of the same shape. Borders come from about ``sample_rows`` rows, the window from at most about
    ``calibration_queries`` queries against all rows; every row is indexed.
    """
    rows = usable(vectors, key, vector)
    asked = settle(usable(queries, key, vector).select(F.col("id").alias("query_id"), F.col("v").alias("q")))
    # of equal vectors only the first k + 1 ids can be anyone's answer
    same = Window.partitionBy("_same", "v").orderBy("id")
    rows = rows.withColumn("_same", F.xxhash64("v")).withColumn("_n", F.row_number().over(same)).where(F.col("_n") <= k + 1)
    rows = settle(rows.select("id", "v"))
    n = rows.count()
    schema = "query_id long, rank int, vec_id long, score double"
    if not n:
        return vectors.sparkSession.createDataFrame([], schema)
    length = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()["d"]
    rows, asked = rows.where(F.size("v") == length), asked.where(F.size("q") == length)

    draw = F.pmod(F.xxhash64("id", F.lit("sample")), F.lit(1 << 30)) < int(min(1.0, sample_rows / n) * (1 << 30))
    sample = _matrix(rows.where(draw).select("v").toArrow().column(0).combine_chunks())
    if len(sample) < 2:
        sample = _matrix(rows.orderBy("id").limit(1000).select("v").toArrow().column(0).combine_chunks())
    runs = max(1, n // run_rows)
    index = fit_curves(_unit(sample), curves, dims, runs)
    window = calibrate(rows, asked, index, k, recall, calibration_queries)
    def place(batches):
        for b in batches:
            x = _unit(_matrix(b.column(1)))
            for c in range(len(index.runs)):
                run = index.run_of(c, x).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(run), c, np.int32)), pa.array(run), b.column(0), pa.nulls(len(run), pa.int64()), b.column(1)], names=names
                )

    def ask(batches):
        for b in batches:
            x = _unit(_matrix(b.column(1)))
            for c, borders in enumerate(index.runs):
                run = index.run_of(c, x).astype(np.int64)
                reach = np.arange(-window, window + 1)
                goal = (run[:, None] + reach[None, :]).ravel()
                who = np.repeat(np.arange(len(run)), len(reach))
                ok = (goal >= 0) & (goal <= len(borders))
                who = pa.array(who[ok])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(ok.sum(), c, np.int32)), pa.array(goal[ok]), pa.nulls(int(ok.sum()), pa.int64()), b.column(0).take(who), b.column(1).take(who)],
                    names=names,
                )

    names = ["curve", "run", "id", "query_id", "v"]
    placed = rows.mapInArrow(place, "curve int, run long, id long, query_id long, v array<double>")
    goals = asked.mapInArrow(ask, "curve int, run long, id long, query_id long, v array<double>")

    def meet(group: pd.DataFrame) -> pd.DataFrame:
        is_query = group["query_id"].notna().to_numpy()
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        if is_query.any() and not is_query.all():
            q = np.stack(group.loc[is_query, "v"].to_numpy())
            q_ids = group.loc[is_query, "query_id"].to_numpy(np.int64)
            r = np.stack(group.loc[~is_query, "v"].to_numpy())
            r_ids = group.loc[~is_query, "id"].to_numpy(np.int64)
            found += [(q_ids[a], b, s) for a, b, s in nearest_in(q, q_ids, r, r_ids, k)]
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), map(np.concatenate, zip(*found)))))

    met = placed.unionByName(goals).groupBy("curve", "run").applyInPandas(meet, "query_id long, vec_id long, score double")
    best = met.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")).alias("rank")
    return best.select("query_id", rank, "vec_id", "score").where(F.col("rank") <= k)


def calibrate(rows: DataFrame, asked: DataFrame, index: Curves, k: int, recall: float, limit: int) -> int:
    """Smallest window (in runs) whose candidates hold at least ``recall`` of the true nearest rows of some queries."""
    runs = max(len(r) for r in index.runs) + 1
    total = asked.count()
    if runs == 1 or not total:
        return runs
    draw = F.pmod(F.xxhash64("query_id", F.lit("calibrate")), F.lit(1 << 30)) < int(min(1.0, limit / total) * (1 << 30))
    some = asked.where(draw).toArrow()
    if not some.num_rows:
        return runs
    q = _matrix(some.column("q").combine_chunks())
    q_ids = some.column("query_id").to_numpy()

    def brute(batches):
        for b in batches:
            x, ids = _matrix(b.column(1)), b.column(0).to_numpy()
            for a, r, s in nearest_in(q, q_ids, x, ids, k):
                yield pa.RecordBatch.from_arrays([pa.array(q_ids[a]), pa.array(r), pa.array(s)], names=["query_id", "id", "score"])

    near = rows.select("id", "v").mapInArrow(brute, "query_id long, id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    true = near.withColumn("_rank", rank).where(F.col("_rank") <= k).select("query_id", "id")
    pairs = true.join(rows, "id").select("query_id", "v").toArrow()  # at most limit * k rows
    order = np.argsort(q_ids)
    mine = order[np.searchsorted(q_ids[order], pairs.column("query_id").to_numpy())]
    units, goals = _unit(q), _unit(_matrix(pairs.column("v").combine_chunks()))
    apart = np.min([np.abs(index.run_of(c, goals) - index.run_of(c, units)[mine]) for c in range(len(index.runs))], axis=0)
    return int(np.quantile(apart, recall, method="higher")) + (1 if runs > 8 else 0)
