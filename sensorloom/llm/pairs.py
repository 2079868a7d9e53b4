"""Helpers of the set joins: row ids, node filters, verification of pairs, linked groups, and runs of sorted rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import discard, settle


def fresh_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def with_row_id(df: DataFrame, key: str, text: str, out: str = "_uid") -> DataFrame:
    """Append a unique long that orders the rows by ``key`` (nulls last), then by the text's digest.

    A unique integer key is the id itself. Otherwise the rows are sorted and written once, so that ids stay.
    """
    kind = dict(df.dtypes)[key]
    if kind in ("tinyint", "smallint", "int", "bigint"):
        repeated = df.groupBy(key).agg(F.count("*").alias("n")).where((F.col("n") > 1) | F.col(key).isNull())
        if repeated.isEmpty():
            return df.withColumn(out, F.col(key).cast("long"))
    ordered = df.orderBy(F.col(key).asc_nulls_last(), F.xxhash64(F.col(text)))
    return settle(ordered.withColumn(out, F.monotonically_increasing_id()))


class KeyFilter:
    """Bloom filter of 64-bit keys with a fixed number of bits. It lets other keys pass now and then, never loses one.

    Broadcast its ``words`` (plain data) and make the filter again in the worker.
    """

    def __init__(self, words: np.ndarray):
        self.words = words

    @staticmethod
    def _bits(keys: np.ndarray, size: int) -> list[np.ndarray]:
        k = keys.view(np.uint64)
        return [(k >> np.uint64(shift)) % np.uint64(size) for shift in (0, 23, 37)]

    @classmethod
    def of(cls, keys: DataFrame, bits: int = 1 << 24) -> KeyFilter:
        """Filter of the first column (long). Every task sends its bitmap in 16 parts, and parts are merged by an aggregate."""
        parts = 16

        def fill(batches):
            words = np.zeros(bits // 8, np.uint8)
            for b in batches:
                for at in cls._bits(b.column(0).to_numpy(zero_copy_only=False).astype(np.int64), bits):
                    at = np.unique(at)
                    np.bitwise_or.at(words, at >> np.uint64(3), np.left_shift(np.uint8(1), (at & np.uint64(7)).astype(np.uint8)))
            cut = words.reshape(parts, -1)
            used = [i for i in range(parts) if cut[i].any()]
            yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array([cut[i].tobytes() for i in used], pa.binary())], names=["part", "bits"])

        def merge(group):
            words = np.bitwise_or.reduce([np.frombuffer(x, np.uint8) for x in group["bits"]], axis=0)
            return group.head(1)[["part"]].assign(bits=[words.tobytes()])

        made = keys.coalesce(32).mapInArrow(fill, "part int, bits binary")
        words = np.zeros((parts, bits // 8 // parts), np.uint8)
        for row in made.groupBy("part").applyInPandas(merge, "part int, bits binary").collect():
            words[row["part"]] = np.frombuffer(row["bits"], np.uint8)
        return cls(words.ravel())

    def has(self, keys: np.ndarray) -> np.ndarray:
        out = np.ones(len(keys), bool)
        for at in self._bits(keys, len(self.words) * 8):
            out &= (self.words[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0
        return out


def filter_bits(keys: int, most: int = 1 << 28) -> int:
    """Bits of a key filter: sixteen a key or more, but never over ``most`` (32 MB), beyond which it only passes more."""
    return min(most, max(1 << 20, 1 << (16 * keys).bit_length()))


def overlaps(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs`` (a, b, ...) with ``shared``, the exact size of the intersection of their sets (node, n, tokens)."""
    left = sets.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("tokens").alias("_ta"))
    right = sets.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("tokens").alias("_tb"))
    both = pairs.join(left, "a").join(right, "b")
    return both.withColumn("shared", F.size(F.array_intersect("_ta", "_tb"))).drop("_ta", "_tb")


def similar(shared: Column, n_a: Column, n_b: Column, percent: int) -> Column:
    """Whether the Jaccard similarity is at least ``percent`` hundredths."""
    return 100 * shared >= percent * (n_a + n_b - shared)


def _roots(forest: DataFrame) -> DataFrame:
    """``forest`` (node, group: its parent or itself; settled), replaced by the root of every node: parents jump until none moves."""
    while True:
        jump = forest.select(F.col("node").alias("group"), F.col("group").alias("_next"))
        jumped = settle(forest.join(jump, "group").select("node", F.col("_next").alias("group"), (F.col("_next") != F.col("group")).alias("_moved")))
        discard(forest)
        forest = jumped
        if forest.where("_moved").isEmpty():
            return forest


def linked_groups(edges: DataFrame) -> DataFrame:
    """``node``, ``group``: for every node of ``edges`` (a, b) the smallest node that it reaches.

    Each round hooks every group to its smallest neighbour, if that is smaller, follows the hooks to their roots and replaces
    the edges by those between the new groups, until none is left. A group that neither hooks nor is hooked to has a
    smaller neighbour in the next round, so two rounds at least halve the groups that still have edges. Rounds are
    not capped. Each is written, which cuts the lineage.
    """
    both = settle(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct())
    labels = None
    while labels is None or not both.isEmpty():
        forest = _roots(settle(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("group"))))
        moved = forest.select(F.col("node").alias("group"), F.col("group").alias("_root"))
        ends = [forest.select(F.col("node").alias(side), F.col("group").alias(f"_{side}")) for side in ("a", "b")]
        between = both.join(ends[0], "a").join(ends[1], "b").where("_a <> _b")
        between = settle(between.select(F.col("_a").alias("a"), F.col("_b").alias("b")).distinct())
        if labels is None:
            fresh = settle(forest.select("node", "group"))
        else:
            fresh = settle(labels.join(moved, "group", "left").select("node", F.coalesce("_root", "group").alias("group")))
            discard(labels)
        discard(both, forest)
        both, labels = between, fresh
    discard(both)
    return labels


def run_starts(t: pa.Table, keys: list[str]) -> np.ndarray:
    """Where the key columns change, the first row included."""
    change = np.ones(t.num_rows, bool)
    change[1:] = False
    for k in keys:
        x = t.column(k).to_numpy()
        change[1:] |= x[1:] != x[:-1]
    return np.flatnonzero(change)


def whole_runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Sorted batches cut anew, so that the rows of a key are never in two tables."""
    held: list[pa.Table] = []
    for b in batches:
        if not b.num_rows:
            continue
        t = pa.Table.from_batches([b])
        starts = run_starts(t, keys)
        same = bool(held) and all(held[-1].column(k)[-1] == t.column(k)[0] for k in keys)
        if same and len(starts) == 1:
            held.append(t)
            continue
        first = int(starts[1]) if same else 0
        if held:
            yield pa.concat_tables([*held, t.slice(0, first)]).combine_chunks()
        last = int(starts[-1])
        if last > first:
            yield t.slice(first, last - first).combine_chunks()
        held = [t.slice(last)]
    if held:
        yield pa.concat_tables(held).combine_chunks()
