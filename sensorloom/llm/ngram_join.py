"""N-gram Jaccard join of documents over an index of count vectors.

Each document becomes its set of word shingles, and the set a point: its shingles are hashed into ``GROUPS`` groups, and the
point holds the number of shingles in each. Two sets cannot share more than the sum over the groups of the smaller
count, so a pair whose bound is below the needed overlap is never compared. An R-tree over the points applies
the bound to whole subtrees: a node keeps the largest count of each group and the range of set sizes below it.

Spark deals the points out. Equal sets are one point. A set shares, with every set similar enough, at least ``c`` of its
``n - needed + c`` smallest shingles, so these shingles name the partitions of the index that a point belongs to, and
a pair that meets in fewer than ``c`` partitions (a twentieth of the smaller set) is dropped. Only partitions with several points are made: which shingles recur is
counted first and travels as a filter of fixed size. Partitions with more than ``tile`` points are cut into tiles of
consecutive set sizes, and tiles are paired only if their sizes allow it, the top level of the tree. In every partition (or pair
of tiles) a tree is packed and joined with itself; up to ``LEAF`` points are a single leaf.

Only links between different linked groups matter, so the pairs of a large group of near copies are never listed. Before
any pairing, each point is verified with the leaders of some of its partitions: the points nearest to the median of the
counts there, the likely originals of copies. Points that these links join are one group, and
partitions pair only points of different groups. The pairs that survive the bound are verified on the whole sets: first each point
with its neighbour of most survivors, then, round by round, a growing number of pairs between each two groups, until
no pair between different groups is left unverified.

Defined results: null, empty and blank texts have the empty set and are linked with nothing; repeated rows are links of equal
sets; a null id is never a component's name unless all ids of the component are null.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import discard, settle
from .pairs import KeyFilter, filter_bits, linked_groups, overlaps, run_starts, similar, whole_runs
from .texts import Prefixes, bounds, mixed, shingles, signed, slices, words

#: Groups of shingles. Counts travel as bytes; 255 stands for 255 or more and is read as no bound.
GROUPS = 128
_NO_BOUND = 1 << 24
#: Points of a leaf, and nodes of a node.
LEAF = 16


def shingle_sets(texts: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles of the texts (A-Z lower-cased), and their text index."""
    data, offsets = bounds(texts)
    starts, ends, owner = words(data, offsets)
    return shingles(Prefixes(data, lower=True).of(starts, ends), owner, len(texts), k)


def set_nodes(values: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Size and 64-bit name of the set of each text; equal sets have equal names."""
    sizes = np.bincount(owner, minlength=n)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(values), dtype=np.uint64)])
    first = np.concatenate([[0], np.cumsum(sizes)])
    return sizes, mixed(total[first[1:]] - total[first[:-1]] + sizes.astype(np.uint64))


def needed(n: np.ndarray, percent: int) -> np.ndarray:
    """Smallest overlap of a set of size n with any similar set."""
    return -(-n * percent // 100)


def common(n: np.ndarray) -> np.ndarray:
    """How many of their smallest shingles similar sets have in common at least, for the smaller of two sets of size n."""
    return 1 + n // 20


def points(docs: DataFrame, k: int, percent: int, key: str, text: str) -> DataFrame:
    """``id``, ``n``, ``node``, ``counts`` and ``smallest`` (the shingles that name its partitions) of each document."""

    def run(batches):
        for batch in batches:
            for b in slices(batch, "text"):
                values, owner = shingle_sets(b.column(1), k)
                sizes, nodes = set_nodes(values, owner, b.num_rows)
                cell = owner * GROUPS + (values % np.uint64(GROUPS)).astype(np.int64)
                counts = np.bincount(cell, minlength=b.num_rows * GROUPS).reshape(-1, GROUPS)
                counts = np.minimum(counts, 255).astype(np.uint8)
                first = np.concatenate([[0], np.cumsum(sizes)])
                place = np.arange(len(values)) - first[owner]
                keep = place < (sizes - needed(sizes, percent) + common(sizes))[owner]
                of = np.concatenate([[0], np.cumsum(np.bincount(owner[keep], minlength=b.num_rows))])
                yield pa.RecordBatch.from_arrays(
                    [
                        b.column(0),
                        pa.array(sizes.astype(np.int64)),
                        pa.array(signed(nodes)),
                        pa.array([c.tobytes() for c in counts], pa.binary()),
                        pa.ListArray.from_arrays(pa.array(of.astype(np.int32)), pa.array(signed(values[keep]))),
                    ],
                    names=["id", "n", "node", "counts", "smallest"],
                )

    source = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(run, f"id {kind}, n long, node long, counts binary, smallest array<long>")


def whole_sets(docs: DataFrame, wanted: DataFrame, k: int, key: str, text: str) -> DataFrame:
    """``node``, ``n``, ``tokens`` of the ``wanted`` (node, id) sets, read from the documents of these ids where ids are
    integers. A node may come more than once."""
    spark, bits = docs.sparkSession, filter_bits(wanted.count())
    integer = dict(wanted.dtypes)["id"] in ("tinyint", "smallint", "int", "bigint")
    nodes_in = spark.sparkContext.broadcast(KeyFilter.of(wanted.select("node"), bits).words)
    known = wanted.where("id IS NOT NULL").select(F.col("id").cast("long")) if integer else wanted.select("node").limit(0)
    ids_in = spark.sparkContext.broadcast(KeyFilter.of(known, bits).words)

    def run(batches):
        for batch in batches:
            if integer:
                ids = pc.fill_null(batch.column(0).cast(pa.int64()), 0).to_numpy(zero_copy_only=False)
                batch = batch.filter(pc.or_(pc.is_null(batch.column(0)), pa.array(KeyFilter(ids_in.value).has(ids))))
            for b in slices(batch, "text"):
                values, owner = shingle_sets(b.column(1), k)
                sizes, nodes = set_nodes(values, owner, b.num_rows)
                first = np.concatenate([[0], np.cumsum(sizes)])
                fresh = np.flatnonzero((sizes > 0) & KeyFilter(nodes_in.value).has(signed(nodes)))
                fresh = fresh[np.unique(nodes[fresh], return_index=True)[1]]
                if len(fresh):
                    tokens = [signed(values[first[i] : first[i + 1]]) for i in fresh]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(signed(nodes[fresh])), pa.array(sizes[fresh].astype(np.int64)), pa.array(tokens, pa.list_(pa.int64()))],
                        names=["node", "n", "tokens"],
                    )

    found = docs.select(F.col(key).alias("id"), F.col(text).alias("text")).mapInArrow(run, "node long, n long, tokens array<long>")
    return settle(found.join(wanted.select("node"), "node", "left_semi"))


class CountTree:
    """R-tree of count vectors, packed by set size and then by the counts."""

    def __init__(self, counts: np.ndarray, sizes: np.ndarray):
        self.order = np.lexsort((*counts.T[:2], sizes))
        top, small, large = counts[self.order], sizes[self.order], sizes[self.order]
        self.levels = [(top, small, large)]
        while len(top) > LEAF:
            at = np.arange(0, len(top), LEAF)
            top, small, large = np.maximum.reduceat(top, at), np.minimum.reduceat(small, at), np.maximum.reduceat(large, at)
            self.levels.append((top, small, large))

    def join(
        self, counts: np.ndarray, sizes: np.ndarray, percent: int, block: int = 1 << 14, groups: tuple[np.ndarray, np.ndarray] | None = None
    ) -> tuple[np.ndarray, np.ndarray]:
        """(query, point) of all pairs whose bound allows the similarity; with ``groups`` of queries and points, of different groups only."""
        top = self.levels[-1][0]
        who = np.repeat(np.arange(len(counts)), len(top))
        node = np.tile(np.arange(len(top)), len(counts))
        for depth in range(len(self.levels) - 1, -1, -1):
            top, small, large = self.levels[depth]
            kept = []
            for at in range(0, len(who), block):
                q, m = who[at : at + block], node[at : at + block]
                # sizes allow the pair, and the bound reaches what the smallest set below the node would need
                fits = (100 * large[m] >= percent * sizes[q]) & (100 * sizes[q] >= percent * small[m])
                if groups and not depth:
                    fits &= groups[0][q] != groups[1][self.order[m]]
                q, m = q[fits], m[fits]
                bound = shared_bound(counts[q], top[m])
                ok = (100 + percent) * bound >= percent * (sizes[q] + small[m])
                kept.append((q[ok], m[ok]))
            who, node = (np.concatenate(x) for x in zip(*kept)) if kept else (who[:0], node[:0])
            if depth:
                width = np.minimum(LEAF, len(self.levels[depth - 1][0]) - node * LEAF)
                who = np.repeat(who, width)
                node = np.repeat(node * LEAF, width) + np.arange(width.sum()) - np.repeat(np.cumsum(width) - width, width)
        return who, self.order[node]


def members(made: DataFrame) -> DataFrame:
    """``shingle``, ``node``, ``n``, ``turn``: the points of index partitions, but for most of those alone in theirs.

    ``turn`` numbers the partitions of a point.
    """
    again = made.select(F.explode("smallest").alias("shingle")).groupBy("shingle").agg(F.count("*").alias("c")).where("c > 1")
    again = settle(again.select("shingle"))
    shared = made.sparkSession.sparkContext.broadcast(KeyFilter.of(again, filter_bits(again.count())).words)

    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                b = batch.slice(i, 256)
                lists = b.column(2)
                values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
                owner = np.repeat(np.arange(len(sizes)), sizes)
                keep = KeyFilter(shared.value).has(values)
                of = pa.array(owner[keep])
                turn = np.arange(keep.sum()) - np.searchsorted(owner[keep], owner[keep])
                columns = [pa.array(values[keep]), b.column(0).take(of), b.column(1).take(of), pa.array(turn.astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, names=["shingle", "node", "n", "turn"])

    some = made.where("n > 0").select("node", "n", "smallest")
    return some.mapInArrow(run, "shingle long, node long, n long, turn int").distinct()


def leader_pairs(entries: DataFrame, points_of: DataFrame, percent: int, most: int = 6, leaders: int = 4) -> DataFrame:
    """Pairs (a < b) of points with leaders of their partitions, if the bounds allow them.

    A point looks at the partitions of its ``most`` smallest recurring shingles. There the leader is the point nearest to
    the median of the counts, the likely original of copies; points that its bound excludes get another, up to ``leaders``. So
    there are a few pairs per point, and the links of a large group are found without listing its pairs.
    """

    def run(batches):
        for t in batches:
            node, sizes = (t.column(c).to_numpy() for c in (1, 2))
            counts = np.frombuffer(b"".join(t.column(3).to_pylist()), np.uint8).reshape(-1, GROUPS)
            pairs = []
            # a partition that goes on in the next batch has leaders in both
            starts = run_starts(t, ["shingle"]).tolist()
            for begin, end in zip(starts, [*starts[1:], t.num_rows]):
                here = np.arange(begin, end)
                for _ in range(leaders):
                    if len(here) < 2:
                        break
                    lead = here[0]
                    if len(here) > 2:
                        middle = np.median(counts[here], axis=0)
                        lead = here[np.argmin(np.abs(counts[here] - middle).sum(axis=1))]
                    here = here[here != lead]
                    total, low, high = sizes[here] + sizes[lead], np.minimum(sizes[here], sizes[lead]), np.maximum(sizes[here], sizes[lead])
                    ok = (100 * low >= percent * high) & ((100 + percent) * shared_bound(counts[here], counts[lead]) >= percent * total)
                    pairs.append(np.stack([np.minimum(node[here[ok]], node[lead]), np.maximum(node[here[ok]], node[lead])]))
                    here = here[~ok]
            if pairs:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in np.concatenate(pairs, axis=1)], names=["a", "b"])

    dealt = entries.where(F.col("turn") < most).select("node", "shingle").join(points_of, "node").select("shingle", "node", "n", "counts")
    return dealt.repartition("shingle").sortWithinPartitions("shingle", "node").mapInArrow(run, "a long, b long").distinct()


def of_several_groups(entries: DataFrame, groups: DataFrame) -> DataFrame:
    """``entries`` with their ``group`` (a point without links is its own), of the partitions that hold more than one group."""
    named = entries.join(groups, "node", "left").select("shingle", "node", "n", F.coalesce("group", "node").alias("group"))
    here = Window.partitionBy("shingle")
    spread = named.withColumn("_lo", F.min("group").over(here)).withColumn("_hi", F.max("group").over(here))
    return spread.where("_lo < _hi").drop("_lo", "_hi")


def _allowed(counts, sizes, groups, q, p, percent: int) -> np.ndarray:
    """Whether pairs (q, p) of one partition are of different groups and pass the size and count bounds."""
    total = percent * (sizes[q] + sizes[p])
    ok = (groups[q] != groups[p]) & (100 * np.minimum(sizes[q], sizes[p]) >= percent * np.maximum(sizes[q], sizes[p]))
    some = np.flatnonzero(ok)
    for i in range(0, len(some), 1 << 14):
        part = some[i : i + (1 << 14)]
        ok[part] = (100 + percent) * shared_bound(counts[q[part]], counts[p[part]]) >= total[part]
    return ok


def shared_bound(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Largest possible overlap of each pair of count vectors: the sum of the smaller counts."""
    low = np.minimum(a, b)
    return low.sum(axis=1, dtype=np.int64) + _NO_BOUND * (low == 255).any(axis=1)


def surviving_pairs(entries: DataFrame, points_of: DataFrame, percent: int, tile: int) -> DataFrame:
    """Distinct pairs (a < b) of points of different groups that pass the bounds and meet in as many partitions as similar sets must.

    ``entries``: shingle, node, n, group; ``points_of``: node, counts.
    """
    large = settle(entries.groupBy("shingle").agg(F.count("*").alias("c")).where(F.col("c") > tile).select("shingle"))
    none = F.lit(0).cast("int")
    if large.isEmpty():
        every = entries.withColumns({"t1": none, "t2": none, "side": none})
    else:
        plain = entries.join(large, "shingle", "left_anti").withColumns({"t1": none, "t2": none, "side": none})
        by_size = Window.partitionBy("shingle").orderBy("n", "node")
        tiled = settle(entries.join(large, "shingle").withColumn("tile", F.floor((F.row_number().over(by_size) - 1) / tile).cast("int")))
        spans = tiled.groupBy("shingle", "tile").agg(F.min("n").alias("lo"), F.max("n").alias("hi"))
        fitting = (
            spans.select("shingle", F.col("tile").alias("t1"), F.col("hi").alias("hi1"))
            .join(spans.select("shingle", F.col("tile").alias("t2"), F.col("lo").alias("lo2")), "shingle")
            .where((F.col("t1") <= F.col("t2")) & (100 * F.col("hi1") >= percent * F.col("lo2")))
            .select("shingle", "t1", "t2")
        )
        first = tiled.withColumnRenamed("tile", "t1").join(fitting, ["shingle", "t1"]).withColumn("side", none)
        second = tiled.withColumnRenamed("tile", "t2").join(fitting.where("t1 < t2"), ["shingle", "t2"]).withColumn("side", none + 1)
        every = plain.unionByName(first).unionByName(second)

    def pair(node, sizes, q, p):
        least = common(np.minimum(sizes[q], sizes[p]))
        columns = [np.minimum(node[q], node[p]), np.maximum(node[q], node[p]), least]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["a", "b", "least"])

    def run(batches):
        for t in whole_runs(batches, ["shingle", "t1", "t2"]):
            node, sizes, groups = (t.column(c).to_numpy() for c in ("node", "n", "group"))
            counts = np.frombuffer(b"".join(t.column("counts").to_pylist()), np.uint8).reshape(-1, GROUPS)
            second = t.column("side").to_numpy() == 1
            runs = run_starts(t, ["shingle", "t1", "t2"])
            length = np.diff(np.append(runs, len(node)))
            block = np.repeat(np.arange(len(runs)), length)
            # single leaves, of all partitions at once: each point with the d-th after it
            small = np.repeat((length <= LEAF), length) & ~np.logical_or.reduceat(second, runs)[block]
            for d in range(1, LEAF):
                q = np.flatnonzero(small[:-d] & (block[d:] == block[:-d])) if d < len(node) else np.zeros(0, np.int64)
                if not len(q):
                    break
                ok = _allowed(counts, sizes, groups, q, q + d, percent)
                yield pair(node, sizes, q[ok], q[ok] + d)
            for i in np.flatnonzero(~small[runs]):
                here = np.arange(runs[i], runs[i] + length[i])
                left = here[~second[here]]
                right = here[second[here]] if second[here].any() else left
                q, p = CountTree(counts[right], sizes[right]).join(counts[left], sizes[left], percent, groups=(groups[left], groups[right]))
                q, p = left[q], right[p]
                keep = (node[q] != node[p]) & ((q < p) | (len(left) + len(right) == len(here)))
                q, p = q[keep], p[keep]
                ok = _allowed(counts, sizes, groups, q, p, percent)
                yield pair(node, sizes, q[ok], p[ok])

    dealt = every.join(points_of.select("node", "counts"), "node").repartition("shingle", "t1", "t2").sortWithinPartitions("shingle", "t1", "t2")
    met = dealt.mapInArrow(run, "a long, b long, least long")
    return met.groupBy("a", "b").agg(F.count("*").alias("c"), F.max("least").alias("least")).where("c >= least").select("a", "b")


def components(docs: DataFrame, k: int = 4, percent: int = 85, tile: int = 4096, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: ``key``, ``n_shingles`` and ``component_id``, the smallest key that links reach."""
    made = settle(points(docs, k, percent, key, text))
    entries = settle(members(made))
    points_of = made.join(entries.select("node").distinct(), "node").groupBy("node").agg(F.any_value("n").alias("n"), F.any_value("counts").alias("counts"))
    points_of = settle(points_of)
    linked = similar(F.col("shared"), F.col("n_a"), F.col("n_b"), percent)

    def read(nodes: DataFrame) -> DataFrame:
        wanted = settle(made.where("n > 0").join(nodes, "node").groupBy("node").agg(F.min("id").alias("id")))
        sets = whole_sets(docs, wanted, k, key, text)
        discard(wanted)
        return sets

    led = settle(leader_pairs(entries, points_of, percent))
    followed = led.select(F.col("a").alias("node")).unionByName(led.select(F.col("b").alias("node"))).distinct()
    known = read(followed)
    first_links = settle(overlaps(led, known).where(linked).select("a", "b").distinct())
    first_groups = linked_groups(first_links)
    mixed_entries = settle(of_several_groups(entries, first_groups))
    found = settle(surviving_pairs(mixed_entries, points_of, percent, tile).join(led, ["a", "b"], "left_anti"))
    discard(entries, points_of, mixed_entries, first_groups)
    both = found.unionByName(found.select(F.col("b").alias("a"), F.col("a").alias("b")))
    nodes = settle(both.groupBy("a").agg(F.count("*").alias("degree")).withColumnRenamed("a", "node"))
    more_sets = read(nodes.select("node").join(known.select("node"), "node", "left_anti"))
    sets = known.unionByName(more_sets)

    best = both.join(nodes.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.max(F.struct("degree", "b")).alias("best"))
    tried = settle(best.select(F.least("a", "best.b").alias("a"), F.greatest("a", "best.b").alias("b")).distinct())
    links = settle(overlaps(tried, sets).where(linked).select("a", "b").unionByName(first_links).distinct())
    groups = linked_groups(links)
    left, each = settle(found.join(tried, ["a", "b"], "left_anti")), 4
    while True:
        # pairs within one group are linked already; of two groups a few pairs are verified at a time, as most survivors are links
        between = left
        for side in ("a", "b"):
            name = groups.select(F.col("node").alias(side), F.col("group").alias(f"g_{side}"))
            between = between.join(name, side, "left").withColumn(f"g_{side}", F.coalesce(f"g_{side}", side))
        between = between.where("g_a <> g_b").select("a", "b", F.least("g_a", "g_b").alias("g"), F.greatest("g_a", "g_b").alias("h"))
        few = Window.partitionBy("g", "h").orderBy(F.xxhash64("a", "b"), "a", "b")
        between = settle(between.withColumn("_turn", F.row_number().over(few)))
        discard(left)
        if between.isEmpty():
            discard(between)
            break
        now = between.where(F.col("_turn") <= each).select("a", "b")
        more = settle(links.unionByName(overlaps(now, sets).where(linked).select("a", "b")).distinct())
        discard(links, groups)
        links, groups = more, linked_groups(more)
        left = settle(between.where(F.col("_turn") > each).select("a", "b"))
        discard(between)
        each *= 8

    named = made.where("n > 0").join(groups, "node", "left").select("id", "node", F.coalesce("group", "node").alias("group"))
    smallest = named.groupBy("group").agg(F.min("id").alias("component_id"))
    classes = settle(named.select("node", "group").distinct().join(smallest, "group").select("node", "component_id"))
    discard(led, found, nodes, known, more_sets, tried, first_links, links, groups)
    out = made.select("id", "n", "node").join(classes, "node", "left")
    own = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id"))
    return out.select(F.col("id").alias(key), F.col("n").alias("n_shingles"), own.alias("component_id"))
