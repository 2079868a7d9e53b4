"""Second-order gradient boosting on histograms, with trees that split node by node or level by level.

Features are cut once into at most ``bins`` bins at approximate quantiles. A level of a tree needs the sums of gradient and
hessian per node, feature and bin, nothing else of the rows: each task adds them up over its rows, which are kept many to a record,
bins feature by feature, and the driver chooses the splits. The sums of a node are one record of a task; where the tasks make more
than ``DRIVER_BYTES`` of them, they are merged by node before the driver sees them, as many numbers as nodes x features x bins. Of
two sister nodes only the one with fewer rows is counted; the other is the parent less its sister. Several ensembles grow side by
side, so that one scan a level serves all.

The loss is squared error: the gradient is prediction minus target, the hessian 1. A split gains
``GL^2/(HL+reg) + GR^2/(HR+reg) - G^2/(H+reg)``, and a leaf adds ``-rate G/(H+reg)``. Ties go to the first feature and the lowest bin.
Rows are not sampled. A missing feature counts as lower than any value; rows without a target are left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from sensorloom.session import discard, settle

#: Rounds after which the rows are written with their predictions so far, so that a pass evaluates few trees.
REFRESH_ROUNDS = 3
#: Sums of tasks that the driver adds up itself; more are merged by node before.
DRIVER_BYTES = 64 << 20

_CHUNK_ROWS = 16_384  # rows in one record
_FILE_BYTES = 96 << 20  # records in one file, which one task reads


@dataclass(frozen=True)
class Boosting:
    """How an ensemble grows. ``symmetric``: all nodes of a level share one split."""

    rounds: int = 200
    rate: float = 0.05
    depth: int = 6
    reg: float = 1.0
    min_rows: float = 1.0
    symmetric: bool = False


@dataclass
class Tree:
    """Nodes in heap order: children of i are 2 i + 1 and 2 i + 2. ``feature`` is -1 at leaves; a row goes right if its bin is over ``cut``."""

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray

    @classmethod
    def empty(cls, depth: int) -> Tree:
        n = (2 << depth) - 1
        return cls(np.full(n, -1, np.int16), np.zeros(n, np.int16), np.zeros(n))

    def nodes(self, bins: np.ndarray, depth: int) -> np.ndarray:
        """Node of each row (column of ``bins``) after ``depth`` levels; a row stays at a leaf above."""
        n = bins.shape[1]
        at, place, flat = np.zeros(n, np.int64), np.arange(n), np.ascontiguousarray(bins).reshape(-1)
        split = self.feature >= 0
        start = np.where(split, self.feature, 0).astype(np.int64) * n
        left = np.where(split, 2 * np.arange(len(split)) + 1, np.arange(len(split)))
        cut = np.where(split, self.cut, np.iinfo(np.int16).max)  # no bin is over it: a row stays
        for level in range(depth):
            own = slice((1 << level) - 1, (2 << level) - 1)
            if split[own].all() and len(set(zip(start[own].tolist(), cut[own].tolist()))) == 1:
                at = 2 * at + 1 + (bins[self.feature[own.start]] > self.cut[own.start])
            else:
                at = left.take(at) + (flat.take(start.take(at) + place) > cut.take(at))
        return at

    @property
    def depth(self) -> int:
        return (len(self.feature) + 1).bit_length() - 2


@dataclass
class BoostedModel:
    """Trees over binned features. ``edges``: upper ends of the bins of each feature but the last."""

    features: list[str]
    edges: list[np.ndarray]
    base: float
    trees: list[Tree] = field(default_factory=list)

    def predict_bins(self, bins: np.ndarray) -> np.ndarray:
        out = np.full(bins.shape[1], self.base)
        for tree in self.trees:
            out += tree.value[tree.nodes(bins, tree.depth)]
        return out

    def transform(self, df: DataFrame) -> DataFrame:
        """Append ``predicted``."""
        model = self

        @F.pandas_udf("double")
        def predicted(x: pd.DataFrame) -> pd.Series:
            return pd.Series(model.predict_bins(binned([x[c].to_numpy(dtype=float, na_value=np.nan) for c in x.columns], model.edges)))

        values = F.struct(*[F.col(c).cast("double").alias(f"f{i}") for i, c in enumerate(self.features)])
        return df.withColumn("predicted", predicted(values))

    def nodes(self) -> list[tuple[int, int, str | None, float | None, float | None]]:
        """(tree, node, feature, highest value that goes left, value at a leaf) of all nodes in use."""
        out = []
        for t, tree in enumerate(self.trees):
            used = [0]
            for i in used:
                f = int(tree.feature[i])
                if f < 0:
                    out.append((t, i, None, None, float(tree.value[i])))
                else:
                    highest = float(self.edges[f][tree.cut[i] - 1]) if tree.cut[i] else -np.inf  # after bin 0 only the missing go left
                    out.append((t, i, self.features[f], highest, None))
                    used += [2 * i + 1, 2 * i + 2]
        return out


def binned(columns: Sequence[np.ndarray], edges: Sequence[np.ndarray]) -> np.ndarray:
    """Bin of each value by feature: 0 if missing, else 1 + the number of edges below it."""
    return np.stack([np.where(np.isnan(x), 0, 1 + np.searchsorted(e, x, side="left")) for x, e in zip(columns, edges)]).astype(np.int16)


def bin_edges(df: DataFrame, features: Sequence[str], bins: int = 255, accuracy: int = 10_000) -> list[np.ndarray]:
    """Distinct approximate quantiles of each feature, the greatest left out; one aggregate for all features."""
    shares = "array(" + ", ".join(f"{i / bins!r}D" for i in range(1, bins)) + ")"
    source = df.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(features)])
    source = source.select(*[F.nanvl(x, F.lit(None).cast("double")).alias(x) for x in source.columns])
    ends = [F.expr(f"percentile_approx({x}, {shares}, {accuracy})").alias(f"q{i}") for i, x in enumerate(source.columns)]
    row = source.agg(*ends, *[F.max(x).alias(f"m{i}") for i, x in enumerate(source.columns)]).first()
    found = [np.unique(np.array(row[f"q{i}"] or [], float)) for i in range(len(features))]
    return [e[e < row[f"m{i}"]] if len(e) else e for i, e in enumerate(found)]


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows of the batches, ``_CHUNK_ROWS`` at a time."""
    held, count = [], 0
    for batch in batches:
        while batch.num_rows:
            part = batch.slice(0, _CHUNK_ROWS - count)
            batch = batch.slice(part.num_rows)
            held.append(part)
            count += part.num_rows
            if count == _CHUNK_ROWS:
                yield pa.Table.from_batches(held)
                held, count = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _record(x: np.ndarray, y: np.ndarray, scores: Sequence[np.ndarray]) -> pa.RecordBatch:
    blobs = [np.ascontiguousarray(a).tobytes() for a in (x, y, np.stack(scores))]
    return pa.RecordBatch.from_arrays([pa.array([b], pa.binary()) for b in blobs], names=["x", "y", "p"])


def _records(batches: Iterator[pa.RecordBatch], k: int, kind: type) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Bins by feature and row, targets, and predictions by ensemble and row of each record."""
    for batch in batches:
        for x, y, p in zip(*(batch.column(i) for i in range(3))):
            y = np.frombuffer(y.as_buffer(), np.float64)
            yield np.frombuffer(x.as_buffer(), kind).reshape(k, len(y)), y, np.frombuffer(p.as_buffer(), np.float64).reshape(-1, len(y))


def width_of(edges: Sequence[np.ndarray]) -> int:
    return 2 + max(len(e) for e in edges)


def _kind(width: int) -> type:
    return np.uint8 if width <= 256 else np.int16


def _binned_rows(df: DataFrame, features: Sequence[str], target: str, edges: list[np.ndarray], bases: list[float], files: int | None) -> DataFrame:
    """Records of bins of the features, the target, and the prediction of each ensemble before its first tree, dealt to ``files`` if given."""
    k, kind = len(features), _kind(width_of(edges))

    def cut(batches):
        for rows in _chunks(batches):
            found = binned([rows.column(i).to_numpy().astype(float) for i in range(k)], edges).astype(kind)
            yield _record(found, rows.column(k).to_numpy(), [np.full(rows.num_rows, x) for x in bases])

    source = df.select(*[F.col(c).cast("double").alias(f"f{i}") for i, c in enumerate(features)], F.col(target).cast("double").alias("y"))
    records = source.mapInArrow(cut, "x binary, y binary, p binary")
    return settle(records.repartition(files) if files else records, compression="none")


def _refreshed(rows: DataFrame, k: int, width: int, grown: list[list[Tree]]) -> DataFrame:
    """The rows with the trees grown since the last time in their predictions."""

    def add(batches):
        for x, y, p in _records(batches, k, _kind(width)):
            yield _record(x, y, [_scores(before, trees, x) for before, trees in zip(p, grown)])

    out = settle(rows.mapInArrow(add, rows.schema), compression="none")
    discard(rows)
    return out


def _scores(before: np.ndarray, trees: list[Tree], bins: np.ndarray) -> np.ndarray:
    out = before.copy()
    for tree in trees:
        out += tree.value.take(tree.nodes(bins, tree.depth))
    return out


def _histograms(rows: DataFrame, k: int, width: int, grown: list[list[Tree]], growing: dict[int, Tree], level: int, counted: dict[int, np.ndarray], tasks: int) -> dict[int, np.ndarray]:
    """For each growing ensemble the gradient and hessian sums [node of ``counted``, feature, bin, 2], of rows read by so many tasks."""
    order = sorted(growing)
    starts = dict(zip(order, np.concatenate([[0], np.cumsum([len(counted[m]) for m in order])]).tolist()))
    slots = sum(len(counted[m]) for m in order)

    def add_up(batches):
        total = {m: np.zeros((2, k, len(counted[m]) * width)) for m in order}
        for x, y, p in _records(batches, k, _kind(width)):
            for m in order:
                own, mine, first = x, slice(None), 0
                if level:
                    slot = np.full(len(growing[m].feature), -1, np.int64)
                    slot[counted[m]] = np.arange(len(counted[m]))
                    at = slot.take(growing[m].nodes(x, level))
                    mine = np.flatnonzero(at >= 0)
                    own, first = x.take(mine, axis=1), at.take(mine) * width
                gradient = _scores(p[m][mine], grown[m], own) - y[mine]
                for f in range(k):
                    cell = first + own[f].astype(np.int64)
                    total[m][0, f] += np.bincount(cell, gradient, total[m].shape[2])
                    total[m][1, f] += np.bincount(cell, minlength=total[m].shape[2])
        part = TaskContext.get().partitionId()
        for m in order:
            by_node = total[m].reshape(2, k, -1, width).transpose(2, 0, 1, 3)
            used = np.flatnonzero(by_node[:, 1, 0].any(axis=1))
            yield sums_of(used + starts[m], part, by_node[used])

    found = added_up(rows.mapInArrow(add_up, SUMS), slots, k, width, tasks)
    return {m: found[starts[m] : starts[m] + len(counted[m])] for m in order}


#: Sums of one task over the rows of one node: target or gradient, then weight or hessian, by feature and bin.
SUMS = "slot int, part int, sums binary"


def added_up(sums: DataFrame, slots: int, k: int, width: int, tasks: int) -> np.ndarray:
    """[slot, feature, bin, 2]: the sums of each slot over all tasks, at most so many."""
    if tasks * slots * 2 * k * width * 8 > DRIVER_BYTES:
        sums = sums.repartition("slot").sortWithinPartitions("slot", "part").mapInArrow(lambda batches: _merged(batches, k, width), SUMS)
    found = np.zeros((slots, 2, k, width))
    for batch in _merged(sums.toArrow().sort_by([("slot", "ascending"), ("part", "ascending")]).to_batches(), k, width):
        for slot, own in zip(batch.column("slot").to_pylist(), batch.column("sums")):
            found[slot] = np.frombuffer(own.as_buffer()).reshape(2, k, width)
    return np.ascontiguousarray(found.transpose(0, 2, 3, 1))


def sums_of(slots: Sequence[int], part: int, sums: Sequence[np.ndarray]) -> pa.RecordBatch:
    columns = [pa.array(slots, pa.int32()), pa.array([part] * len(slots), pa.int32()), pa.array([s.tobytes() for s in sums], pa.binary())]
    return pa.RecordBatch.from_arrays(columns, names=["slot", "part", "sums"])


def _merged(batches: Iterator[pa.RecordBatch], k: int, width: int) -> Iterator[pa.RecordBatch]:
    """The sums of each slot over all tasks, of records sorted by slot and task, so that they are the same in every run."""
    last, total = None, None
    for batch in batches:
        for slot, sums in zip(batch.column("slot").to_pylist(), batch.column("sums")):
            own = np.frombuffer(sums.as_buffer()).reshape(2, k, width)
            if slot == last:
                total += own
                continue
            if last is not None:
                yield sums_of([last], 0, [total])
            last, total = slot, own.copy()
    if last is not None:
        yield sums_of([last], 0, [total])


def split_gains(sums: np.ndarray, reg: float, min_rows: float) -> np.ndarray:
    """Gain of a split of each node after each bin, for sums [node, feature, bin, 2]; -inf where a side has too few rows."""
    left = np.cumsum(sums, axis=2)[:, :, :-1]
    whole = sums[:, :1].sum(axis=2)[:, :, None]
    right = whole - left

    def part(x: np.ndarray) -> np.ndarray:
        return x[..., 0] ** 2 / (x[..., 1] + reg)

    allowed = (left[..., 1] >= min_rows) & (right[..., 1] >= min_rows)
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(allowed, part(left) + part(right) - part(whole), -np.inf)


def _split(tree: Tree, nodes: np.ndarray, sums: np.ndarray, how: Boosting) -> np.ndarray:
    """Split the nodes that gain; returns those that were split."""
    gains = split_gains(sums, how.reg, how.min_rows)
    flat = gains.reshape(len(nodes), -1)
    if how.symmetric:
        # a node that the split leaves whole gains nothing and loses nothing
        best = np.full(len(nodes), np.where(np.isfinite(flat), flat, 0.0).sum(axis=0).argmax())
        chosen = np.full(len(nodes), np.where(np.isfinite(flat), flat, 0.0).sum(axis=0).max() > 1e-12)
    else:
        best = flat.argmax(axis=1)
        chosen = flat[np.arange(len(nodes)), best] > 1e-12
    feature, cut = np.divmod(best, gains.shape[2])
    tree.feature[nodes[chosen]] = feature[chosen]
    tree.cut[nodes[chosen]] = cut[chosen]
    return nodes[chosen]


def fit_side_by_side(train: DataFrame, features: Sequence[str], target: str, growth: dict[str, Boosting], bins: int = 255) -> dict[str, BoostedModel]:
    """Grow one ensemble per entry of ``growth`` over the same rows."""
    features, k = list(features), len(features)
    kept = train.filter(F.col(target).isNotNull() & ~F.isnan(F.col(target).cast("double")))
    edges = bin_edges(kept, features, bins)
    width = width_of(edges)
    n, base = kept.agg(F.count(F.lit(1)), F.avg(F.col(target).cast("double"))).first()
    if base is None:
        raise ValueError("no row has a target")
    hows = list(growth.values())
    models = [BoostedModel(features, edges, base) for _ in hows]
    cores = train.sparkSession.sparkContext.defaultParallelism
    files = cores * math.ceil(n * (k * np.dtype(_kind(width)).itemsize + 8 + 8 * len(hows)) / (cores * _FILE_BYTES))
    rows = _binned_rows(kept, features, target, edges, [base] * len(hows), files if n > cores * _CHUNK_ROWS else None)
    tasks = rows.rdd.getNumPartitions()
    grown: list[list[Tree]] = [[] for _ in hows]
    for number in range(max((how.rounds for how in hows), default=0)):
        growing = {m: Tree.empty(how.depth) for m, how in enumerate(hows) if number < how.rounds}
        nodes = {m: np.zeros(1, np.int64) for m in growing}
        counted, sums = dict(nodes), {}
        for level in range(max(hows[m].depth for m in growing) + 1):
            active = {m: growing[m] for m in growing if len(nodes[m]) and level < hows[m].depth}
            if not active:
                break
            fresh = _histograms(rows, k, width, grown, active, level, counted, tasks)
            for m, tree in active.items():
                sums[m] = _with_sisters(fresh[m], nodes[m], counted[m], sums.get(m))
                split = _split(tree, nodes[m], sums[m], hows[m])
                nodes[m], counted[m], sums[m] = _children(tree, nodes[m], split, sums[m], hows[m])
        for m, tree in growing.items():
            models[m].trees.append(tree)
            grown[m].append(tree)
        if number % REFRESH_ROUNDS == REFRESH_ROUNDS - 1:
            rows, grown = _refreshed(rows, k, width, grown), [[] for _ in hows]
    discard(rows)
    return dict(zip(growth, models))


def _with_sisters(fresh: np.ndarray, nodes: np.ndarray, counted: np.ndarray, parents: dict[int, np.ndarray] | None) -> np.ndarray:
    """Sums of ``nodes`` from those of the counted ones; a sister's are its parent's less those of the counted child."""
    by_node = dict(zip(counted.tolist(), fresh))
    for node in nodes.tolist():
        if node not in by_node:
            sister = node + 1 if node % 2 else node - 1
            by_node[node] = parents[(node - 1) // 2] - by_node[sister]
    return np.stack([by_node[n] for n in nodes.tolist()])


def _children(tree: Tree, nodes: np.ndarray, split: np.ndarray, sums: np.ndarray, how: Boosting) -> tuple[np.ndarray, np.ndarray, dict[int, np.ndarray]]:
    """Leaf values of the new children, the children, those to be counted, and the sums of their parents."""
    children, counted, parents = [], [], {}
    done = set(split.tolist())
    for node, own in zip(nodes.tolist(), sums):
        whole = own[0].sum(axis=0)
        if node == 0:
            tree.value[0] = -how.rate * whole[0] / (whole[1] + how.reg)
        if node not in done:
            continue
        left = own[tree.feature[node], : tree.cut[node] + 1].sum(axis=0)
        for child, (g, h) in ((2 * node + 1, left), (2 * node + 2, whole - left)):
            tree.value[child] = -how.rate * g / (h + how.reg) if h > 0 else 0.0
        children += [2 * node + 1, 2 * node + 2]
        counted.append(2 * node + 1 if 2 * left[1] <= whole[1] else 2 * node + 2)
        parents[node] = own
    return np.array(children, np.int64), np.array(counted, np.int64), parents


class BoostedTrees:
    """Estimator with the ``fit`` of a pipeline, for one ensemble."""

    def __init__(self, features: Sequence[str], target: str, how: Boosting, bins: int = 255):
        self.features, self.target, self.how, self.bins = list(features), target, how, bins

    def fit(self, train: DataFrame) -> BoostedModel:
        return fit_side_by_side(train, self.features, self.target, {"one": self.how}, self.bins)["one"]
