"""Removal of byte strings that occur earlier, by hash groupings of sampled positions; no prefix doubling.

Every byte covered by a string of ``length`` bytes that also starts earlier (in a row before, or before in the same row) goes. To
sort all byte positions takes many times the corpus in shuffles, so the sort begins at positions that a repeated string cannot
miss: in each window of ``length`` bytes the ``seed_length``-byte string with the smallest hash, the leftmost of equal ones. Equal windows
choose the same string at the same offset, and about one position in thirty is chosen.

Four fixed rounds, each a grouping of positions by a hash that drops what is unique; no rank pairs are sorted. The compared strings grow from the seed to whole
windows, for fewer and fewer positions:

1. rank of the ``seed_length`` bytes at a chosen position. Positions whose rank is unique have no repeated window.
2. rank of (rank, all bytes of the windows that chose the position).
3. for what is open, its windows in blocks of ``_BLOCK`` offsets: rank of the bytes that all windows of a block share, then of
   (rank, all bytes of the block).
4. for what is open, every window: rank of its ``length`` bytes.

In rounds 2 and 3 all but the first of equal contexts lie wholly in repeated windows; the first stays open if its rank
has other contexts. In round 4 all but the first position of a rank are repeats.

Between rounds only fixed-size filters of what is open travel, and the texts are read again, so positions that are dropped
are never written. Ranks are 64-bit names of byte strings, not their alphabetical places; equality is all that is asked.

Defined results: null and empty texts have no bytes and nothing is removed; repeated keys are ordered by the text's digest;
strings shorter than ``length`` are never removed; matches never cross rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import discard, settle
from .pairs import KeyFilter, filter_bits, with_row_id
from .texts import Prefixes, bounds, mixed, signed, slices

#: A text longer than this is cut into segments, which overlap by a window.
_SEGMENT = 1 << 21
#: Window offsets of a block in round 3.
_BLOCK = 8
_LOW = np.uint64((1 << 24) - 1)


def _smallest(keys: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values."""
    span, low = 1, keys
    while span * 2 <= width:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    rest = width - span
    return np.minimum(low[: len(low) - rest], low[rest:]) if rest else low


def _spread(first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the range and value, for all values of the ranges first, first + 1, ... of ``count`` values."""
    of = np.repeat(np.arange(len(first)), count)
    return of, first[of] + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)


class Chosen:
    """Chosen positions of one segment (``seed``): text index, first and last window start that chose it, ranks."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, begin: int, length: int, seed_length: int, step: int):
        end = min(len(data), begin + step + length - 1)
        self.prefixes = Prefixes(data[begin:end])
        n = end - begin
        count = n - length + 1
        empty = np.zeros(0, np.int64)
        self.text = self.base = self.seed = self.first = self.last = empty
        self.name = self.context = np.zeros(0, np.uint64)
        if count <= 0:
            return
        names = self.prefixes.every(seed_length)
        keys = (names & ~_LOW) | np.arange(len(names), dtype=np.uint64)
        chosen = (_smallest(keys, length - seed_length + 1) & _LOW).astype(np.int64)
        # window starts that end within their text
        text, start = _spread(np.maximum(offsets[:-1], begin), np.maximum(np.minimum(offsets[1:] - length + 1, begin + count) - np.maximum(offsets[:-1], begin), 0))
        start -= begin
        chosen = chosen[start]
        if not len(start):
            return
        fresh = np.concatenate([[True], (chosen[1:] != chosen[:-1]) | (text[1:] != text[:-1])])
        lead = np.flatnonzero(fresh)
        self.text = text[lead]
        self.base = offsets[self.text] - begin  # where the text begins in the segment, at times before it
        self.first = start[lead]
        self.last = start[np.append(lead[1:], len(start)) - 1]
        self.seed = chosen[lead]
        self.name = names[chosen[lead]]
        shape = mixed(((chosen[lead] - self.first) * 4096 + (self.last - self.first)).astype(np.uint64))
        self.context = mixed(self.prefixes.of(self.first, self.last + length) + shape)

    @property
    def start(self) -> np.ndarray:
        """First window start as a place in the text."""
        return self.first - self.base


def _segments(batches, length: int, seed_length: int, rows_of: np.ndarray | None = None):
    """(row ids, chosen positions) of the texts; ``rows_of``: filter of the rows that are worth reading."""
    for batch in batches:
        if rows_of is not None:
            batch = batch.filter(pa.array(KeyFilter(rows_of).has(batch.column(0).to_numpy())))
        for b in slices(batch, "text"):
            data, offsets = bounds(b.column(1))
            # only a text of its own is cut, so the cuts do not depend on what lies beside it
            step = _SEGMENT if b.num_rows == 1 else max(1, len(data))
            for begin in range(0, max(len(data) - length + 1, 0), step):
                yield b.column(0), Chosen(data, offsets, begin, length, seed_length, step)


def _position_key(uid: np.ndarray, start: np.ndarray, level: int) -> np.ndarray:
    return signed(mixed(mixed(uid.astype(np.uint64) + np.uint64(level << 60)) + start.astype(np.uint64)))


_RANKED = "rank long, context long, uid long, start int, more int"


def _ranked(rank, context, uid, start, more) -> pa.RecordBatch:
    columns = [signed(rank), signed(context), uid, start.astype(np.int32), more.astype(np.int32)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["rank", "context", "uid", "start", "more"])


def _settled(ranked: DataFrame, length: int, level: int) -> tuple[DataFrame, DataFrame]:
    """Spans of all but the first of equal contexts; and the firsts whose rank has other contexts (uid, position).

    A context has one rank, so contexts alone are grouped and joined.
    """
    rows = settle(ranked)
    firsts = settle(rows.groupBy("context").agg(F.min(F.struct("uid", "start")).alias("first"), F.min("rank").alias("rank")))
    several = firsts.groupBy("rank").agg(F.count("*").alias("n")).where("n > 1").select("rank")
    placed = rows.drop("rank").join(firsts.select("context", "first"), "context")
    later = (F.col("uid") != F.col("first.uid")) | (F.col("start") != F.col("first.start"))
    end = (F.col("start") + F.col("more") + length).cast("int")
    spans = settle(placed.where(later).select("uid", F.col("start").alias("begin"), end.alias("end")))
    still = firsts.join(several, "rank", "left_semi").select("first.uid", "first.start")

    def keyed(batches):
        for b in batches:
            key = _position_key(b.column(0).to_numpy(), b.column(1).to_numpy().astype(np.int64), level)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(key)], names=["uid", "position"])

    still = settle(still.mapInArrow(keyed, "uid long, position long"))
    discard(rows, firsts)
    return spans, still


def _filters(still: DataFrame):
    """Broadcast filters of the open positions and of the rows that have any."""
    spark, bits = still.sparkSession, filter_bits(still.count())
    made = [KeyFilter.of(still.select(c), bits) for c in ("position", "uid")]
    discard(still)
    return [spark.sparkContext.broadcast(f.words) for f in made]


def repeated_spans(docs: DataFrame, length: int = 100, seed_length: int = 36) -> DataFrame:
    """``uid``, ``begin``, ``end``: byte ranges covered by repeated strings, overlapping. ``docs``: _uid, text."""
    source = docs.select("_uid", "text")

    def seeds(batches):
        for _, c in _segments(batches, length, seed_length):
            yield pa.RecordBatch.from_arrays([pa.array(signed(c.name))], names=["rank"])

    again = settle(source.mapInArrow(seeds, "rank long").groupBy("rank").agg(F.count("*").alias("n")).where("n > 1").select("rank"))
    seen = KeyFilter.of(again, filter_bits(again.count()))
    discard(again)
    again = docs.sparkSession.sparkContext.broadcast(seen.words)

    def contexts(batches):
        for uids, c in _segments(batches, length, seed_length):
            keep = KeyFilter(again.value).has(signed(c.name))
            if keep.any():
                yield _ranked(c.name[keep], c.context[keep], uids.to_numpy()[c.text[keep]], c.start[keep], (c.last - c.first)[keep])

    spans, still = _settled(source.mapInArrow(contexts, _RANKED), length, 1)
    open_seeds, open_rows = _filters(still)

    def blocks_of(uids, c):
        """Blocks of window offsets of the open seeds: seed, first and last window start, block number."""
        if not len(c.text):
            return (np.zeros(0, np.int64),) * 4
        uid = uids.to_numpy()[c.text]
        keep = np.flatnonzero(KeyFilter(open_seeds.value).has(_position_key(uid, c.start, 1)))
        # the offset of a window is how far before the seed it starts: at most seed - first, at least seed - last
        low, high = (c.seed - c.last)[keep] // _BLOCK, (c.seed - c.first)[keep] // _BLOCK
        of, number = _spread(low, high - low + 1)
        of = keep[of]
        first = np.maximum(c.first[of], c.seed[of] - number * _BLOCK - (_BLOCK - 1))
        return of, first, np.minimum(c.last[of], c.seed[of] - number * _BLOCK), number

    def blocks(batches):
        for uids, c in _segments(batches, length, seed_length, open_rows.value):
            of, first, last, number = blocks_of(uids, c)
            if len(of):
                # what every window of the full block covers, so that cut blocks meet whole ones
                core = c.seed[of] - number * _BLOCK
                rank = mixed(c.prefixes.of(core, core + length - (_BLOCK - 1)) + number.astype(np.uint64))
                context = mixed(c.prefixes.of(first, last + length) + ((core - first) * 64 + (core - last)).astype(np.uint64))
                yield _ranked(rank, context, uids.to_numpy()[c.text[of]], first - c.base[of], last - first)

    more, still = _settled(source.mapInArrow(blocks, _RANKED), length, 2)
    open_blocks, rows_left = _filters(still)

    def windows(batches):
        for uids, c in _segments(batches, length, seed_length, rows_left.value):
            of, first, last, _ = blocks_of(uids, c)
            if not len(of):
                continue
            uid = uids.to_numpy()[c.text[of]]
            keep = np.flatnonzero(KeyFilter(open_blocks.value).has(_position_key(uid, first - c.base[of], 2)))
            i, at = _spread(first[keep], (last - first)[keep] + 1)
            i = keep[i]
            yield pa.RecordBatch.from_arrays(
                [pa.array(signed(c.prefixes.of(at, at + length))), pa.array(uid[i]), pa.array((at - c.base[of[i]]).astype(np.int32))], names=["rank", "uid", "start"]
            )

    in_order = Window.partitionBy("rank").orderBy("uid", "start")
    ranked = source.mapInArrow(windows, "rank long, uid long, start int").withColumn("_n", F.row_number().over(in_order))
    found = ranked.where("_n > 1").select("uid", F.col("start").alias("begin"), (F.col("start") + length).cast("int").alias("end"))
    return spans.unionByName(more).unionByName(found)


def remove_repeats(docs: DataFrame, length: int = 100, seed_length: int = 36, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``kept`` (binary: the bytes that stay), ``n_bytes``, ``n_removed``, ``n_spans`` of every row."""
    rows = with_row_id(docs.select(F.col(key).alias(key), F.col(text).alias("text")), key, "text")
    spans = repeated_spans(rows, length, seed_length)
    spans = settle(spans.groupBy(F.col("uid").alias("_uid")).agg(F.collect_list("begin").alias("_begin"), F.collect_list("end").alias("_end")))
    # rows without spans, all but a few of them, need no join
    cut_rows = rows.sparkSession.sparkContext.broadcast(KeyFilter.of(spans.select("_uid"), filter_bits(spans.count())).words)

    def having(some: bool):
        def run(batches):
            for b in batches:
                yield b.filter(pa.array(KeyFilter(cut_rows.value).has(b.column(at).to_numpy()) == some))

        at = rows.columns.index("_uid")
        return rows.mapInArrow(run, rows.schema)

    data = F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("bytes")
    joined = having(True).join(spans, "_uid", "left").select(key, data, "_begin", "_end")
    none = F.lit(None).cast("array<int>")
    full = joined.unionByName(having(False).select(key, data, none.alias("_begin"), none.alias("_end")))
    kind = full.schema[key].dataType.simpleString()

    def cut(batches):
        for b in batches:
            for i in range(0, b.num_rows, 256):
                part = b.slice(i, 256)
                kept, sizes, removed, runs = [], [], [], []
                for data, begin, end in zip(part.column(1).to_pylist(), part.column(2), part.column(3)):
                    sizes.append(len(data))
                    if not begin.is_valid:
                        kept.append(data)
                        removed.append(0)
                        runs.append(0)
                        continue
                    change = np.zeros(len(data) + 1, np.int64)
                    np.add.at(change, begin.values.to_numpy(), 1)
                    np.add.at(change, end.values.to_numpy(), -1)
                    gone = np.cumsum(change[:-1]) > 0
                    kept.append(np.frombuffer(data, np.uint8)[~gone].tobytes())
                    removed.append(int(gone.sum()))
                    runs.append(int((gone & ~np.concatenate([[False], gone[:-1]])).sum()))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(kept, pa.binary()), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(runs, pa.int64())],
                    names=[key, "kept", "n_bytes", "n_removed", "n_spans"],
                )

    return full.mapInArrow(cut, f"`{key}` {kind}, kept binary, n_bytes long, n_removed long, n_spans long")
