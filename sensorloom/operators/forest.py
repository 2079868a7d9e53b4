"""Random forest whose nodes are split by histograms while they are large, and finished where their rows are brought together.

Features are cut once into at most ``bins`` bins. The large nodes of a tree are split as in :mod:`sensorloom.operators.boosting`: tasks add up
target and weight per node, feature and bin, and the driver chooses the splits. A node of at most ``SMALL_ROWS`` rows is not split there: its
rows go to one task, which grows the rest of the tree over them, down to single rows. A full-grown forest has as many nodes as rows times
trees, so that lower part is kept nowhere: the rows to be scored go the same way as the training rows and are scored right where it was grown.
Trees are taken in groups, so that no shuffle holds more than ``GROUP_ROWS`` copies of rows.

A row's weight in a tree is a Poisson draw (the bootstrap of Spark ML) that depends on the row, the tree and the seed alone. A split gains
``GL^2/HL + GR^2/HR - G^2/H``, the decrease of the squared error. Ties go to the first feature and the lowest bin.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from sensorloom.operators.boosting import SUMS, added_up, bin_edges, binned, split_gains, sums_of, width_of
from sensorloom.session import discard, settle

#: Weighted rows of a node from which on it is split by histograms.
SMALL_ROWS = 500_000
#: Rows times trees that are grown in one go.
GROUP_ROWS = 60_000_000

_TASK_ROWS = 250_000  # rows a task packs at once
_PASS_ROWS = 40_000  # rows a task adds up at once
_PASS_BYTES = 16 << 20  # sums a task holds
_PART_BYTES = 8 << 20  # packed rows in one partition
_FEW_ROWS = 8  # rows of a node of which every way to part them is scored
_BLOCK_SUMS = 1 << 17  # sums by bin, feature and node of larger ones that are held at once
_BLOCK_WAYS = 1 << 17  # ways to part rows scored at once
_NOISE = 1e-12  # gains are told apart by this share of a node's squares; less is rounding


@dataclass
class Nodes:
    """A tree, or part of one: the children of node i are ``left[i]`` and ``left[i] + 1``, a row goes right if its bin is over ``cut``.

    ``feature`` is -1 at ends; ``open`` are the ends that are not leaves, but go on in rows brought together.
    """

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    value: np.ndarray
    open: frozenset[int] = frozenset()
    depths: dict[int, int] | None = None

    def ends(self, x: np.ndarray) -> np.ndarray:
        """End each row of ``x`` (bins by feature, row) comes to."""
        n = x.shape[1]
        at = np.zeros(n, np.int64)
        if self.feature[0] < 0:
            return at
        flat, going, node = np.ascontiguousarray(x).reshape(-1), np.arange(n), at
        split = self.feature >= 0
        start, left = np.where(split, self.feature, 0).astype(np.int64) * n, self.left.astype(np.int64)
        while len(going):
            node = left.take(node) + (flat.take(start.take(node) + going) > self.cut.take(node))
            goes_on = split.take(node)
            ended = np.flatnonzero(~goes_on)
            if len(ended):
                at[going.take(ended)] = node.take(ended)
                going, node = going[goes_on], node[goes_on]
        return at


class _Growth:
    """Lists from which :class:`Nodes` are made."""

    def __init__(self):
        self.feature, self.cut, self.left, self.value = [-1], [0], [-1], [0.0]

    def split(self, node: int, feature: int, cut: int) -> int:
        self.feature[node], self.cut[node], self.left[node] = feature, cut, len(self.feature)
        for column, x in ((self.feature, -1), (self.cut, 0), (self.left, -1), (self.value, 0.0)):
            column += [x, x]
        return self.left[node]

    def nodes(self, open: Sequence[int] = (), depths: dict[int, int] | None = None) -> Nodes:
        kinds = (np.int16, np.int16, np.int32, np.float64)
        columns = [np.array(c, k) for c, k in zip((self.feature, self.cut, self.left, self.value), kinds)]
        return Nodes(*columns, frozenset(open), depths)


_POISSON = np.cumsum([math.exp(-1.0) / math.factorial(i) for i in range(16)])


def _mixed(z: np.ndarray) -> np.ndarray:
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def _poisson(z: np.ndarray) -> np.ndarray:
    return np.searchsorted(_POISSON, (z >> np.uint64(11)) * 2.0**-53, side="right").astype(np.uint8)


# draws by the first 16 bits, or 255 where the other bits decide
_FIRST = np.arange(1 << 16, dtype=np.uint64) << np.uint64(48)
_BY_START = np.where(_poisson(_FIRST) == _poisson(_FIRST + np.uint64((1 << 48) - 1)), _poisson(_FIRST), 255).astype(np.uint8)


def draws(ids: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """How often the tree drew each row: Poisson of mean 1, from the row's number, the tree and the seed."""
    start = _mixed(np.array([(seed << 20) + tree + 1], np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    z = _mixed(_mixed(ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + start) + start)
    count = _BY_START.take((z >> np.uint64(48)).astype(np.int64))
    open = np.flatnonzero(count == 255)
    count[open] = _poisson(z[open])
    return count


def _best_of_large(x: np.ndarray, sizes: np.ndarray, wy: np.ndarray, w: np.ndarray, g: np.ndarray, h: np.ndarray, noise: np.ndarray):
    """Feature (-1 where none gains) and cut of the best split of each node, from sums by bin, feature and node."""
    count, bins = len(sizes), int(x.max()) + 1
    node = np.repeat(np.arange(count), sizes)
    features = [f for f, own in enumerate(x) if own.min() != own.max()]
    if not features:
        return np.full(count, -1, np.int16), np.zeros(count, np.int16)
    sums = np.empty((2, bins, len(features), count))
    for i, f in enumerate(features):
        cell = x[f] * np.int64(count) + node
        for part, v in zip(sums, (wy, w)):
            part[:, i] = np.bincount(cell, v, bins * count).reshape(bins, count)
    for i in range(1, bins - 1):
        np.add(sums[:, i - 1], sums[:, i], out=sums[:, i])
    left_g, left_h = sums[:, :-1]
    right_h, score, right = h - left_h, left_g * left_g, g - left_g
    with np.errstate(divide="ignore", invalid="ignore"):
        score /= left_h
        right *= right
        right /= right_h
    score += right
    score[(left_h < 0.5) | (right_h < 0.5)] = -np.inf
    top = score.max(axis=0)
    found = _first_best(top, g * g / h, noise)
    own = np.arange(count)
    cut = (score[:, found, own] >= top[found, own] - noise).argmax(axis=0)
    return np.where(found < 0, -1, np.array(features)[found]), np.where(found < 0, 0, cut)


def _first_best(top: np.ndarray, best: np.ndarray, noise: np.ndarray) -> np.ndarray:
    """Place of the first feature whose score ``top``, by feature and node, is over that of those before and ``best``; -1 if none is."""
    best, found = best.copy(), np.full(len(best), -1)
    for f, own in enumerate(top):
        better = own > best + noise
        np.copyto(best, own, where=better)
        np.copyto(found, f, where=better)
    return found


def _best_of_small(x: np.ndarray, y: np.ndarray, w: np.ndarray, g: np.ndarray, h: np.ndarray, noise: np.ndarray):
    """As :func:`_best_of_large` for nodes of as many rows each, at most 8: ``x`` by feature, row and node, the others by row and node.

    Each way to part the rows of a node is scored once; the splits by all features look their score up by the rows that go left.
    """
    m, count = x.shape[1:]
    left_g, left_h = np.zeros((1 << m, count)), np.zeros((1 << m, count))
    for j in range(m):
        np.add(left_g[: 1 << j], y[j], out=left_g[1 << j : 2 << j])
        np.add(left_h[: 1 << j], w[j], out=left_h[1 << j : 2 << j])
    with np.errstate(divide="ignore", invalid="ignore"):
        scores = left_g**2 / left_h + (g - left_g) ** 2 / (h - left_h)
    scores[[0, -1]] = -np.inf  # no side without rows
    code = np.zeros(x.shape, np.uint8)
    for j in range(m):
        code |= (x[:, j : j + 1] <= x).view(np.uint8) << np.uint8(j)
    score = scores.reshape(-1).take(code * np.int64(count) + np.arange(count))
    top = score.max(axis=1)
    found, own = _first_best(top, g * g / h, noise), np.arange(count)
    cut = np.where(score[found, :, own].T >= top[found, own] - noise, x[found, :, own].T, 255).min(axis=0)
    return found, np.where(found < 0, 0, cut)


def _best_sparse(x: np.ndarray, sizes: np.ndarray, wy: np.ndarray, w: np.ndarray, g: np.ndarray, h: np.ndarray, noise: np.ndarray):
    """As :func:`_best_of_large` for many nodes of few rows: rows sorted by node and bin, sums at the places where the bin changes."""
    count, n = len(sizes), x.shape[1]
    node = np.repeat(np.arange(count), sizes)
    short = node.astype(np.uint16) if count <= 1 << 16 else node
    first = np.cumsum(sizes) - sizes
    same = node[1:] == node[:-1]
    sum_g, sum_h = np.zeros(n + 1), np.zeros(n + 1)
    best, feature, cut = g * g / h, np.full(count, -1, np.int16), np.zeros(count, np.int16)
    for f, own in enumerate(x):
        order = np.argsort(own, kind="stable")
        order = order.take(np.argsort(short.take(order), kind="stable"))
        own = own.take(order)
        at = np.flatnonzero(same & (own[1:] != own[:-1]))
        if not len(at):
            continue
        np.cumsum(wy.take(order), out=sum_g[1:])
        np.cumsum(w.take(order), out=sum_h[1:])
        mine = node.take(at)
        start = first.take(mine)
        left_g, left_h = sum_g.take(at + 1) - sum_g.take(start), sum_h.take(at + 1) - sum_h.take(start)
        score = left_g**2 / left_h + (g.take(mine) - left_g) ** 2 / (h.take(mine) - left_h)
        starts = np.flatnonzero(np.append(True, mine[1:] != mine[:-1]))
        nodes, top = mine.take(starts), np.maximum.reduceat(score, starts)
        better = np.flatnonzero(top > best.take(nodes) + noise.take(nodes))
        if not len(better):
            continue
        nodes = nodes.take(better)
        best[nodes], feature[nodes] = top.take(better), f
        least = np.full(count, np.inf)
        least[nodes] = best[nodes] - noise[nodes]
        found = np.flatnonzero(score >= least.take(mine))[::-1]
        cut[mine.take(found)] = own.take(at.take(found))  # the last written is the lowest bin
    return feature, cut


def _best_splits(x: np.ndarray, sizes: np.ndarray, wy: np.ndarray, w: np.ndarray, g: np.ndarray, h: np.ndarray, noise: np.ndarray):
    """Feature and cut of the best split of each node of a level, for rows sorted by node."""
    count = len(sizes)
    if x.shape[1] < 8 * count:
        return _best_sparse(x, sizes, wy, w, g, h, noise)
    feature, cut = np.full(count, -1, np.int16), np.zeros(count, np.int16)
    ends = np.cumsum(sizes)
    large = np.flatnonzero(sizes > _FEW_ROWS)
    if len(large):
        rows = slice(None) if len(large) == count else np.flatnonzero(np.repeat(sizes > _FEW_ROWS, sizes))
        of_large, wy_of_large, w_of_large = (x, wy, w) if len(large) == count else (x.take(rows, axis=1), wy.take(rows), w.take(rows))
        stops = np.cumsum(sizes[large])
        block = max(1, _BLOCK_SUMS // (len(x) * (int(x.max()) + 1)))
        for first in range(0, len(large), block):
            own = large[first : first + block]
            rows = slice(stops[first] - sizes[own[0]], stops[first + len(own) - 1])
            feature[own], cut[own] = _best_of_large(of_large[:, rows], sizes[own], wy_of_large[rows], w_of_large[rows], g[own], h[own], noise[own])
    for m in range(2, _FEW_ROWS + 1):
        nodes, block = np.flatnonzero(sizes == m), _BLOCK_WAYS >> m
        for own in (nodes[i : i + block] for i in range(0, len(nodes), block)):
            rows = (ends[own] - m) + np.arange(m)[:, None]
            feature[own], cut[own] = _best_of_small(x.take(rows, axis=1), wy.take(rows), w.take(rows), g[own], h[own], noise[own])
    return feature, cut


def grow(x: np.ndarray, y: np.ndarray, w: np.ndarray, width: int, depth: int) -> Nodes:
    """Tree over rows in memory, at most ``depth`` levels deep: bins ``x`` by feature and row, targets and weights.

    Level by level; the rows are kept sorted by node.
    """
    w = w.astype(float)
    wy = w * y
    wyy = wy * y
    parts, total = [], 1
    sizes = np.array([x.shape[1]])
    for level in range(depth + 1):
        count = len(sizes)
        node = np.repeat(np.arange(count), sizes)
        g, h = np.bincount(node, wy, count), np.bincount(node, w, count)
        feature, cut = np.full(count, -1, np.int16), np.zeros(count, np.int16)
        if level < depth:
            feature, cut = _best_splits(x, sizes, wy, w, g, h, _NOISE * np.bincount(node, wyy, count))
        split = feature >= 0
        left = np.where(split, total + 2 * (np.cumsum(split) - 1), -1)
        parts.append((feature, cut, left.astype(np.int32), g / h))
        total += 2 * int(split.sum())
        if not split.any():
            break
        going = np.flatnonzero(split[node])
        at = node.take(going)
        right = x.reshape(-1).take(feature.take(at).astype(np.int64) * x.shape[1] + going) > cut.take(at)
        child = 2 * (np.cumsum(split) - 1).take(at) + right
        sizes = np.bincount(child, minlength=2 * int(split.sum()))
        order = going.take(_by_child(child, right))
        x, wy, w, wyy = x.take(order, axis=1), wy.take(order), w.take(order), wyy.take(order)
    return Nodes(*[np.concatenate(column) for column in zip(*parts)])


def _by_child(child: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Stable order by child, for rows sorted by their parent."""
    sizes = np.bincount(child)
    starts = np.cumsum(sizes) - sizes
    order = np.empty(len(child), np.int64)
    for side in (0, 1):
        rows = np.flatnonzero(right == side)
        own = sizes[side::2]
        order[np.arange(len(rows)) + np.repeat(starts[side::2] - (np.cumsum(own) - own), own)] = rows
    return order


def _bins_of(batch: pa.RecordBatch, k: int) -> np.ndarray:
    """Bins by feature and row of the column ``x``, which holds ``k`` bytes a row."""
    column = batch.column("x")
    start = np.frombuffer(column.buffers()[1], np.int32)[column.offset]
    return np.frombuffer(column.buffers()[2], np.uint8, batch.num_rows * k, start).reshape(-1, k).T


def _as_bytes(x: np.ndarray) -> pa.Array:
    k, n = x.shape
    offsets = np.arange(0, (n + 1) * k, k, dtype=np.int32)
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(x.T))])


def _many(batches: Iterator[pa.RecordBatch], most: int = _TASK_ROWS) -> Iterator[pa.RecordBatch]:
    """Batches of about ``most`` rows."""
    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= most:
            yield pa.concat_batches(held)
            held, rows = [], 0
    if rows:
        yield pa.concat_batches(held)


def _binned_rows(df: DataFrame, features: Sequence[str], edges: list[np.ndarray], y, number=None) -> DataFrame:
    """Settled ``id``, ``x`` (a byte of bin per feature) and ``y``. Without a column ``number`` rows are numbered by task and place."""
    k = len(features)

    def cut(batches):
        count = 0
        for b in batches:
            found = binned([b.column(i).to_numpy(zero_copy_only=False).astype(float) for i in range(k)], edges).astype(np.uint8)
            ids = b.column(k + 1) if number else pa.array((TaskContext.get().partitionId() << 33) + count + np.arange(b.num_rows))
            count += b.num_rows
            yield pa.RecordBatch.from_arrays([ids, _as_bytes(found), b.column(k)], names=["id", "x", "y"])

    source = df.select(*[F.col(c).cast("double").alias(f"f{i}") for i, c in enumerate(features)], y.cast("double").alias("y"), *([number] if number else []))
    parts = max(2 * df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // _TASK_ROWS))
    return settle(source.repartition(parts).mapInArrow(cut, "id long, x binary, y double"))


def _histograms(rows: DataFrame, k: int, width: int, tops: dict[int, Nodes], nodes: dict[int, list[int]], seed: int, bagged: bool, tasks: int) -> dict[int, np.ndarray]:
    """Sums of target and weight [node of ``nodes``, feature, bin, 2] of each tree."""
    order = sorted(nodes)
    starts = dict(zip(order, np.concatenate([[0], np.cumsum([len(nodes[t]) for t in order])]).tolist()))
    slots = sum(len(nodes[t]) for t in order)

    def add_up(batches):
        total = np.zeros((2, k, slots * width))
        for batch in _many(batches, _PASS_ROWS):
            x, ids, y = np.ascontiguousarray(_bins_of(batch, k)), batch.column("id").to_numpy(), batch.column("y").to_numpy()
            for t in order:
                slot = np.full(len(tops[t].feature), -1, np.int64)
                slot[nodes[t]] = np.arange(len(nodes[t])) * width
                w = draws(ids, t, seed) if bagged else np.ones(len(ids), np.uint8)
                drawn = np.flatnonzero(w)
                own = x.take(drawn, axis=1)
                first = slot.take(tops[t].ends(own))
                if (first < 0).any():
                    mine = np.flatnonzero(first >= 0)
                    own, first, drawn = own.take(mine, axis=1), first.take(mine), drawn.take(mine)
                weight = w.take(drawn).astype(float)
                target, size = weight * y.take(drawn), len(nodes[t]) * width
                part = slice(starts[t] * width, starts[t] * width + size)
                for f in range(k):
                    cell = first + own[f]
                    total[0, f, part] += np.bincount(cell, target, size)
                    total[1, f, part] += np.bincount(cell, weight, size)
        by_node = total.reshape(2, k, slots, width).transpose(2, 0, 1, 3)
        used = np.flatnonzero(by_node[:, 1, 0].any(axis=1))
        yield sums_of(used, TaskContext.get().partitionId(), by_node[used])

    found = added_up(rows.mapInArrow(add_up, SUMS), slots, k, width, tasks)  # large nodes x features x bins at most
    return {t: found[starts[t] : starts[t] + len(nodes[t])] for t in order}


def _grow_tops(rows: DataFrame, n: int, k: int, width: int, trees: Sequence[int], depth: int, seed: int, bagged: bool) -> dict[int, Nodes]:
    """The large nodes of each tree."""
    growths = {t: _Growth() for t in trees}
    handed = {t: {} if n > SMALL_ROWS and depth else {0: 0} for t in trees}  # node to its depth
    nodes = {t: [0] for t in trees if not handed[t]}
    tasks = rows.rdd.getNumPartitions() if nodes else 0
    for level in range(depth):
        nodes = {t: found for t, found in nodes.items() if found}
        if not nodes:
            break
        tops = {t: growths[t].nodes() for t in nodes}
        sums = _histograms(rows, k, width, tops, nodes, seed, bagged, tasks)
        for t, own in nodes.items():
            gains = split_gains(sums[t], 0.0, 0.5)  # no side without rows
            nodes[t] = []
            for node, found, gain in zip(own, sums[t], gains.reshape(len(own), -1)):
                whole = found[0].sum(axis=0)
                growths[t].value[node] = whole[0] / whole[1] if whole[1] else 0.0
                noise = _NOISE * (max(gain.max(), 0.0) + whole[0] ** 2 / max(whole[1], 1.0))
                if gain.max() <= noise:
                    continue
                feature, cut = divmod(int((gain >= gain.max() - noise).argmax()), width - 1)
                child = growths[t].split(node, feature, cut)
                left = found[feature, : cut + 1].sum(axis=0)
                for i, (g, h) in enumerate((left, whole - left)):
                    growths[t].value[child + i] = g / h
                    if level + 1 < depth and h > SMALL_ROWS:
                        nodes[t].append(child + i)
                    elif level + 1 < depth:
                        handed[t][child + i] = level + 1
    return {t: g.nodes(handed[t], handed[t]) for t, g in growths.items()}


def _packed(rows: DataFrame, k: int, tops: dict[int, Nodes], seed: int, bagged: bool, test: bool) -> DataFrame:
    """Rows by tree and end they come to, many to a record: bins and, to train, target and weight, else the number."""

    def pack(batches):
        for batch in _many(batches):
            x, ids, y = np.ascontiguousarray(_bins_of(batch, k)), batch.column("id").to_numpy(), batch.column("y").to_numpy()
            for t, top in tops.items():
                if not test:
                    w = draws(ids, t, seed) if bagged else np.ones(len(ids), np.uint8)
                    goes_on = np.zeros(len(top.feature), bool)
                    goes_on[list(top.open)] = True
                    mine = np.flatnonzero(w)
                    at = top.ends(x.take(mine, axis=1))
                    mine, at = mine[goes_on[at]], at[goes_on[at]]
                else:
                    mine, at = np.arange(len(ids)), top.ends(x)
                order = np.argsort(at.astype(np.uint16) if len(top.feature) <= 1 << 16 else at, kind="stable")
                mine, at = mine[order], at[order]
                first = np.flatnonzero(np.append(True, at[1:] != at[:-1])[: len(at)])
                ends = at[first]
                groups = np.split(mine, first[1:]) if len(ends) else []
                blobs = [
                    np.ascontiguousarray(x[:, g]).tobytes() + (ids[g].tobytes() if test else y[g].tobytes() + w[g].tobytes()) for g in groups
                ]
                columns = [np.full(len(ends), t, np.int32), ends.astype(np.int32), np.full(len(ends), test), ids[[g[0] for g in groups]] if groups else ids[:0]]
                sizes = np.array([len(g) for g in groups], np.int32)
                yield pa.RecordBatch.from_arrays(
                    [*map(pa.array, columns), pa.array(sizes), pa.array(blobs, pa.binary())], names=["tree", "node", "test", "first", "n", "rows"]
                )

    return rows.mapInArrow(pack, "tree int, node int, test boolean, first long, n int, rows binary")


def _scored(packed: DataFrame, k: int, width: int, tops: dict[int, Nodes], depth: int) -> DataFrame:
    """``id`` and ``p``, a prediction of every tree for each row to be scored, of records sorted by tree and node, training rows first."""

    def score(batches):
        key, held, tree = None, [], None

        def finished():
            x, y, w = (np.concatenate(c, axis=-1) for c in zip(*held))
            return grow(x, y, w, width, depth - tops[key[0]].depths[key[1]])

        for batch in batches:
            ids, values = [], []
            for t, node, test, n, blob in zip(*[batch.column(c).to_pylist() for c in ("tree", "node", "test", "n", "rows")]):
                if (t, node) != key:
                    if held:
                        finished()
                    key, held, tree = (t, node), [], None
                x = np.frombuffer(blob, np.uint8, k * n).reshape(k, n)
                if not test:
                    held.append((x, np.frombuffer(blob, np.float64, n, k * n), np.frombuffer(blob, np.uint8, n, (k + 8) * n)))
                    continue
                if held:
                    tree, held = finished(), []
                ids.append(np.frombuffer(blob, np.int64, n, k * n))
                values.append(tree.value[tree.ends(x)] if tree else np.full(n, tops[t].value[node]))
            if ids:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(ids)), pa.array(np.concatenate(values))], names=["id", "p"])
        if held:
            finished()

    return packed.mapInArrow(score, "id long, p double")


@dataclass
class ForestModel:
    """Edges of the bins, the large nodes of all trees, and the training rows from which their lower parts are grown."""

    features: list[str]
    edges: list[np.ndarray]
    base: float
    tops: list[dict[int, Nodes]]
    rows: DataFrame
    count: int
    depth: int
    seed: int

    def transform(self, df: DataFrame) -> DataFrame:
        """Append ``predicted``, the mean of the trees. Grows the lower parts of all trees and scores the rows, one group of trees after the other."""
        k, width = len(self.features), width_of(self.edges)
        trees = sum(map(len, self.tops))
        numbered = settle(df.withColumn("_row", F.monotonically_increasing_id()))
        tested = _binned_rows(numbered, self.features, self.edges, F.lit(0.0), "_row")
        n = tested.count()
        sums = []
        for tops in self.tops:
            both = [_packed(rows, k, tops, self.seed, trees > 1, rows is tested) for rows in (self.rows, tested)]
            size = len(tops) * (0.64 * self.count + n) * (k + 9)
            parts = max(3 * df.sparkSession.sparkContext.defaultParallelism, math.ceil(size / _PART_BYTES))
            packed = both[0].unionByName(both[1]).repartition(parts, "tree", "node").sortWithinPartitions("tree", "node", "test", "first")
            sums.append(settle(_scored(packed, k, width, tops, self.depth).groupBy("id").agg(F.sum("p").alias("p"))))
        discard(tested)
        every = sums[0]
        for part in sums[1:]:
            every = every.unionByName(part)
        mean = every.groupBy(F.col("id").alias("_row")).agg((F.lit(self.base) + F.sum("p") / trees).alias("predicted"))
        return numbered.join(mean, "_row").select(*df.columns, "predicted")


@dataclass(frozen=True)
class RandomForest:
    """Estimator with the ``fit`` of a pipeline. All features are tried at each split; with one tree no rows are drawn."""

    features: list[str]
    target: str
    trees: int = 100
    depth: int = 30
    seed: int = 42
    bins: int = 32

    def fit(self, train: DataFrame) -> ForestModel:
        if not 2 <= self.bins <= 254:
            raise ValueError("bins must be 2 to 254")
        k = len(self.features)
        kept = train.filter(F.col(self.target).isNotNull() & ~F.isnan(F.col(self.target).cast("double")))
        n, base = kept.agg(F.count(F.lit(1)), F.avg(F.col(self.target).cast("double"))).first()
        if not n:
            raise ValueError("no row has a target")
        edges = bin_edges(kept, self.features, self.bins)
        rows = _binned_rows(kept, self.features, edges, F.col(self.target).cast("double") - F.lit(base))
        group = max(1, min(self.trees, GROUP_ROWS // n))
        groups = [range(first, min(first + group, self.trees)) for first in range(0, self.trees, group)]
        width = width_of(edges)
        # a pass serves more trees than a shuffle, as far as a task can hold their sums
        step = group * max(1, _PASS_BYTES // (group * 2 * k * width * 8 * (1 + n // max(SMALL_ROWS, 1))))
        grown = {}
        for first in range(0, self.trees, step):
            grown |= _grow_tops(rows, n, k, width, range(first, min(first + step, self.trees)), self.depth, self.seed, self.trees > 1)
        tops = [{t: grown[t] for t in trees} for trees in groups]
        return ForestModel(list(self.features), edges, base, tops, rows, n, self.depth, self.seed)
