"""Periodic runs of words: stretches that repeat with a period three times or more, found by scale and stitched by period.

A run is a stretch of consecutive words with smallest period q and a length of at least max(24, 3 q) that no neighbouring word extends
keeping period q. Words are runs of bytes other than 0x20 and 0x09-0x0D.

Periods are dealt with by octave, S <= q < 2 S (the first octave has all below 16). Each document is exploded into tiles of an octave:
one for every boundary, a multiple of S, from S words before it to 6 S words after it. A run of period q matches itself q words
on for 2 q words or more, so it has a boundary b among the first S, and the S words at b equal those at b + q. Fingerprints of S words tell
which periods of a tile can be: one vectorised comparison per octave. Tiles with such a period are solved independently of each
other by two Z-functions of the boundary, forward and backward, which give how far words match those q on, and which periods are
multiples of a smaller one. A tile sees a piece of a long run, an interval fragment; fragments of neighbouring tiles overlap. They are shuffled
by document and period and stitched. Work grows as n log n for any text, one of equal words included.

Tiles are made and solved in the task that reads the document; only fragments are shuffled, and only texts with runs meet their runs in
a join (a filter of fixed size, which passes a few others, lets the rest by).

Defined results: null and empty texts have no words, no runs and collapse to ''; texts are joined again by single spaces; repeated keys
are rows of their own. Words are compared by 64-bit fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import settle
from .pairs import KeyFilter, filter_bits, fresh_name, with_row_id
from .texts import Prefixes, bounds, slices, words

#: A run has at least so many words, and three periods; the first octave of periods is below twice FIRST, 3 * FIRST words.
MIN_WORDS, FIRST = 24, 8
_RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def z_values(s: list[int], upto: int) -> list[int]:
    """Z-function: for each place below ``upto`` the length of the longest common prefix of ``s`` and its rest from there."""
    n = len(s)
    out = [n] + [0] * (min(n, upto) - 1)
    left = right = 0
    for i in range(1, len(out)):
        k = min(right - i, out[i - left]) if i < right else 0
        while i + k < n and s[k] == s[i + k]:
            k += 1
        out[i] = k
        if i + k > right:
            left, right = i, i + k
    return out


def _prime_factors(n: int) -> list[int]:
    found, d = [], 2
    while d * d <= n:
        if n % d == 0:
            found.append(d)
            while n % d == 0:
                n //= d
        d += 1
    return found + [n] * (n > 1)


def _candidates(prints: Prefixes, owner: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Boundaries and periods of the octave at ``scale`` whose next ``scale`` words are equal, by boundary."""
    every = prints.every(scale, mix=False)
    rows = -(-len(every) // scale) + 1
    table = np.zeros((rows + 1, scale), np.uint64)
    table.ravel()[: len(every)] = every
    hit, step = np.nonzero(table[1:rows] == table[: rows - 1, :1])
    period = step + scale
    if scale == FIRST:
        more, step = np.nonzero(table[: rows - 1, 1:] == table[: rows - 1, :1])
        hit, period = np.concatenate([hit, more]), np.concatenate([period, step + 1])
    at = hit * scale
    inside = at + period + scale <= len(owner)
    at, period = at[inside], period[inside]
    same = owner[at] == owner[at + period + scale - 1]
    order = np.argsort(at[same], kind="stable")
    return at[same][order], period[same][order]


def solve_tile(values: np.ndarray, begin: int, end: int, at: int, scale: int, periods: list[int]) -> Iterator[tuple[int, int, int]]:
    """(period, first, last + 1) of the words around the boundary ``at`` that match those a period on, in a document [begin, end).

    Only for periods that are the smallest of their stretch, and for matches that make a run in the tile.
    """
    back, top = max(begin, at - scale), min(end, at + 2 * scale)
    forward = z_values(values[at : min(end, at + 6 * scale)].tolist(), 2 * scale)
    before = values[back:at][::-1].tolist()
    backward = z_values([*before, None, *values[back:top][::-1].tolist()], len(before) + 1 + top - at)
    for q in periods:
        if any(forward[q // f] >= q - q // f for f in _prime_factors(q)):
            continue
        after, ahead = min(forward[q], 4 * scale), backward[len(before) + 1 + top - at - q]
        if after + ahead >= max(MIN_WORDS - q, 2 * q):
            yield q, at - ahead, at + after


def _fragments_of(texts: pa.Array, uids: np.ndarray) -> pa.RecordBatch:
    data, offsets = bounds(texts)
    starts, ends, owner = words(data, offsets)
    counts = np.bincount(owner, minlength=len(texts))
    first = np.concatenate([[0], np.cumsum(counts)])
    found: list[tuple[int, int, int, int]] = []
    if counts.max(initial=0) >= MIN_WORDS:
        values = Prefixes(data).of(starts, ends)
        prints = Prefixes.over(values)
        scale = FIRST
        while 3 * scale <= max(counts.max(), MIN_WORDS):
            at, period = _candidates(prints, owner, scale)
            cuts = np.flatnonzero(np.diff(at, prepend=-1))
            for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(at)]):
                boundary = int(at[a])
                row = int(owner[boundary])
                begin = int(first[row])
                tile = solve_tile(values, begin, int(first[row + 1]), boundary, scale, period[a:b].tolist())
                found += [(row, q, x - begin, y - begin) for q, x, y in tile]
            scale *= 2
    row, q, x, y = np.array(found, np.int64).reshape(-1, 4).T
    return pa.RecordBatch.from_arrays([pa.array(c) for c in (uids[row], q, x, y)], names=["uid", "period", "first", "after"])


def run_fragments(rows: DataFrame) -> DataFrame:
    """``uid``, ``period``, ``first``, ``after``: words [first, after) that match those a period on, as the tiles of ``rows`` (_uid, text) see them."""

    def solve(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                yield _fragments_of(part.column(1), part.column(0).to_numpy())

    return rows.select("_uid", "text").mapInArrow(solve, "uid long, period long, first long, after long")


def stitched(fragments: DataFrame) -> DataFrame:
    """``uid``, ``start``, ``length``, ``period`` of the runs: overlapping fragments of a document and period are one."""
    by_period = Window.partitionBy("uid", "period").orderBy("first", "after")
    before = F.max("after").over(by_period.rowsBetween(Window.unboundedPreceding, -1))
    opened = fragments.withColumn("_new", F.when(F.col("first") <= before, 0).otherwise(1))
    numbered = opened.withColumn("_run", F.sum("_new").over(by_period.rowsBetween(Window.unboundedPreceding, 0)))
    ends = numbered.groupBy("uid", "period", "_run").agg(F.min("first").alias("start"), F.max("after").alias("_after"))
    return ends.select("uid", "start", (F.col("_after") + F.col("period") - F.col("start")).alias("length"), "period")


def _without(data: bytes, runs: list[dict[str, int]] | None) -> bytes:
    kept = data.split()
    if runs:
        change = np.zeros(len(kept) + 1, np.int64)
        np.add.at(change, [r["start"] + r["period"] for r in runs], 1)
        np.add.at(change, [r["start"] + r["length"] for r in runs], -1)
        kept = [kept[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]
    return b" ".join(kept)


def find_runs(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: ``key``, ``runs`` (array of start word, length, period; by start, then period) and ``collapsed``.

    ``collapsed`` is the text without the words that a run contains after its first period, joined by one space.
    """
    uid = fresh_name(docs.select(key), "_uid")
    rows = with_row_id(docs.select(F.col(key).alias(key), F.col(text).alias(fresh_name(docs.select(key), "text"))), key, fresh_name(docs.select(key), "text"), uid)
    rows = rows.toDF("_key", "text", "_uid")
    ordered = F.array_sort(F.collect_list(F.struct("start", "period", "length")))
    runs = F.transform(ordered, lambda r: F.struct(r["start"].alias("start"), r["length"].alias("length"), r["period"].alias("period")))
    runs = settle(stitched(run_fragments(rows)).groupBy(F.col("uid").alias("_uid")).agg(runs.alias("runs")))
    repeating = rows.sparkSession.sparkContext.broadcast(KeyFilter.of(runs.select("_uid"), filter_bits(runs.count())).words)
    kind = rows.schema["_key"].dataType.simpleString()

    def maybe(batches):
        for b in batches:
            yield b.filter(pa.array(KeyFilter(repeating.value).has(b.column(2).to_numpy())))

    def collapsed(part: pa.RecordBatch, runs: pa.Array) -> pa.RecordBatch:
        texts = part.column(1).cast(pa.large_binary()).to_pylist()
        kept = pa.array([_without(data, r) for data, r in zip(texts, runs.to_pylist())], pa.binary())
        return pa.RecordBatch.from_arrays([part.column(0), runs, kept.cast(pa.string())], names=["_key", "runs", "collapsed"])

    def others(batches):
        kinds = pa.list_(pa.struct([(name, pa.int64()) for name in ("start", "length", "period")]))
        for b in batches:
            b = b.filter(pa.array(~KeyFilter(repeating.value).has(b.column(2).to_numpy())))
            for part in slices(b, "text"):
                yield collapsed(part, pa.array([[]] * part.num_rows, kinds))

    def joined(batches):
        for b in batches:
            for part in slices(b, "text"):
                yield collapsed(part, part.column(2))

    schema = f"_key {kind}, runs {_RUNS}, collapsed string"
    met = rows.mapInArrow(maybe, rows.schema).join(runs, "_uid", "left")
    met = met.select("_key", "text", F.coalesce("runs", F.array().cast(_RUNS)).alias("runs")).mapInArrow(joined, schema)
    return rows.mapInArrow(others, schema).unionByName(met).withColumnRenamed("_key", key)


def strongest(runs: Column) -> Column:
    """The run with the greatest length / period, of equal ones the first, then the one of the smallest period; null without runs.

    Quotients of numbers below 2**26 are equal as doubles only if they are equal.
    """
    ranked = F.transform(runs, lambda r: F.struct((-r["length"] / r["period"]).alias("less"), r["start"], r["period"], r["length"]))
    return F.array_min(ranked)


def digest(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Per row of :func:`find_runs`: number of runs, the strongest one, and SHA-256 of the list of runs and of the collapsed text."""
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = F.col("_best")
    return found.withColumn("_best", strongest(F.col("runs"))).select(
        key, F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"), best["period"].alias("period"),
        F.expr("1000 * _best.length div _best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
