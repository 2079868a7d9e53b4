"""Removal of near-duplicate lines by an exact set-similarity join.

A line's tokens are its distinct word shingles of ``k`` words (a shorter line is one token as a whole); lines are cut at \\n. A line
goes if an earlier line, in order of key and place, has a Jaccard similarity of at least ``percent`` hundredths. Equal
token sets are one class, compared by its first line.

The join: tokens are ordered by rarity: first those that come once, then the others by counts over all lines kept in a fixed
number of hash bins, ties by value. Two similar sets of sizes a and b share at least ceil(percent (a + b) / (100 + percent))
tokens, so they share one among the first n - ceil(percent n / 100) + 1 tokens of either (prefix filter); the places of the
shared token, and the recurring tokens of the prefixes from it on, limit what can still be shared (positional filter), and
sizes must be close (length filter). Pairs that pass are verified on the whole sets.

Which tokens recur is found by a shuffle of sorted 40-bit marks, packed as differences, and travels as a filter of at most
``MOST_BITS`` bits. The filter never misses a recurring token, so tokens outside it are shared by no other line and are not
shuffled. When more recur than it has bits for, it takes tokens that come once for recurring: more is shuffled, nothing is lost.

Each line first meets the earliest line of its prefix groups, which settles most; only lines that stay unmatched meet all
earlier lines of their groups.

Defined results: null and empty texts have no lines to remove and give ''; blank lines stay; lines whose removal empties a document
leave ''. Repeated keys are ordered by the text's digest.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import discard, settle
from .ngram_join import needed, set_nodes
from .pairs import KeyFilter, filter_bits, fresh_name, overlaps, similar, with_row_id
from .texts import Prefixes, bounds, every_shingle, mixed, shingles, signed, slices, words

#: Bins of the token counts, and how many of them travel in one row.
BINS = 1 << 18
_PART = 1 << 12
#: Tokens are marked by their upper bits. Marks are dealt out by ranges, at least so many, and a task holds so many tokens at a time.
MARK = 40
LEAST_RANGES = 1 << 10
_HELD = 1 << 21
#: Bits of the filter of recurring tokens: eight a token or more, but no more than these.
MOST_BITS = 1 << 28


def _rows(names: list[str], kinds: list[pa.DataType], **given) -> pa.RecordBatch:
    """A batch of the ``given`` columns; the other columns are null."""
    length = len(next(iter(given.values())))
    return pa.RecordBatch.from_arrays([pa.array(given[c], t) if c in given else pa.nulls(length, t) for c, t in zip(names, kinds)], names=names)


def _line_words(texts: pa.Array):
    """Per line: text index, place in the text; and the fingerprints of the words with their lines."""
    data, offsets = bounds(texts)
    breaks = np.flatnonzero(data == 10)
    starts = np.unique(np.concatenate([offsets[:-1], breaks + 1]))
    starts = starts[starts < len(data)] if len(data) else starts[:0]
    of_text = np.searchsorted(offsets, starts, side="right") - 1
    place = np.arange(len(starts)) - np.searchsorted(of_text, of_text)
    begin, end, owner = words(data, np.append(starts, len(data)))
    return of_text, place, Prefixes(data).of(begin, end), owner


def _lines(texts: pa.Array, k: int):
    """Per line: text index, place in the text, set size, node; and the tokens with their lines."""
    of_text, place, hashes, owner = _line_words(texts)
    values, line = shingles(hashes, owner, len(place), k)
    sizes, nodes = set_nodes(values, line, len(place))
    return of_text, place, sizes, nodes, values, line


def _line_counts(texts: pa.Array) -> np.ndarray:
    """Lines of each text, blank ones included; an empty text has none."""
    data, offsets = bounds(texts)
    breaks = np.searchsorted(offsets, np.flatnonzero(data == 10), side="right") - 1
    return np.where(np.diff(offsets) > 0, np.bincount(breaks, minlength=len(texts)) + 1, 0)


def pack_marks(marks: np.ndarray) -> bytes:
    """Sorted marks as compressed differences, byte by byte."""
    steps = np.diff(marks, prepend=np.uint64(0))
    planes = steps.view(np.uint8).reshape(-1, 8)[:, : MARK // 8].T
    return pa.Codec("zstd", compression_level=1).compress(np.ascontiguousarray(planes).tobytes(), asbytes=True)


def unpack_marks(block: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.Codec("zstd").decompress(block, n * MARK // 8, asbytes=True), np.uint8).reshape(MARK // 8, n)
    steps = np.zeros((n, 8), np.uint8)
    steps[:, : MARK // 8] = planes.T
    return np.cumsum(steps.view(np.uint64).ravel(), dtype=np.uint64)


def scan(docs: DataFrame, k: int, ranges: int) -> DataFrame:
    """What the lines of a task hold, in parts: marks of tokens by range (``part`` from 0, ``n`` marks), and token counts by bin (below 0).

    A mark that comes more than once in a block comes there twice.
    """
    names, kinds = ["part", "n", "block"], [pa.int32(), pa.int64(), pa.binary()]
    low = np.uint64(64 - MARK)
    edges = np.arange(ranges, dtype=np.uint64) * np.uint64((1 << MARK) // ranges)

    def run(batches):
        total, held, count = np.zeros(BINS, np.int64), [], 0

        def blocks():
            marks = np.concatenate(held)
            held.clear()
            marks.sort()
            total[:] += np.bincount((marks % np.uint64(BINS)).view(np.int64), minlength=BINS)
            marks >>= low
            third = np.zeros(len(marks), bool)
            third[2:] = marks[2:] == marks[:-2]
            marks = marks[~third]
            at = np.append(np.searchsorted(marks, edges), len(marks))
            used = np.flatnonzero(np.diff(at))
            for i in range(0, len(used), 256):
                some = used[i : i + 256]
                packed = [pack_marks(marks[at[r] : at[r + 1]]) for r in some]
                yield _rows(names, kinds, part=some, n=np.diff(at)[some], block=packed)

        for batch in batches:
            for b in slices(batch, "text"):
                _, place, hashes, owner = _line_words(b.column(0))
                held.append(every_shingle(hashes, owner, len(place), k)[0])
                count += len(held[-1])
                if count >= _HELD:
                    yield from blocks()
                    held, count = [], 0
        if count:
            yield from blocks()
        parts = total.reshape(-1, _PART)
        used = [i for i in range(len(parts)) if parts[i].any()]
        yield _rows(names, kinds, part=[-1 - i for i in used], block=[parts[i].tobytes() for i in used])

    return docs.select("text").mapInArrow(run, "part int, n long, block binary")


def token_statistics(docs: DataFrame, k: int, ranges: int, most: int = MOST_BITS) -> tuple[np.ndarray, RecurringTokens]:
    """Counts of the tokens of all lines by bin, and the filter of those that recur (``most`` bits at most): of fixed sizes."""

    def merge(group):
        if group["part"].iloc[0] < 0:
            out = np.sum([np.frombuffer(x, np.int64) for x in group["block"]], axis=0)
        else:
            marks = np.sort(np.concatenate([unpack_marks(block, int(n)) for block, n in zip(group["block"], group["n"])]))
            out = RecurringTokens.block(np.unique(marks[1:][marks[1:] == marks[:-1]]), max(8, most // ranges))
        return group.head(1)[["part"]].assign(block=[out.tobytes()])

    counts = np.zeros((BINS // _PART, _PART), np.int64)
    blocks = [b"\0"] * ranges
    for row in scan(docs, k, ranges).groupBy("part").applyInPandas(merge, "part int, block binary").collect():
        if row["part"] < 0:
            counts[-1 - row["part"]] = np.frombuffer(row["block"], np.int64)
        else:
            blocks[row["part"]] = bytes(row["block"])
    return counts.ravel(), RecurringTokens.of(blocks)


class RecurringTokens:
    """Bloom filter of the marks that come more than once: a block of bits for each range, the blocks in a row. It never misses one."""

    def __init__(self, words: np.ndarray, first: np.ndarray, bits: np.ndarray):
        self.words, self.first, self.bits = words, first, bits

    @classmethod
    def of(cls, blocks: list[bytes]) -> RecurringTokens:
        sizes = np.array([len(b) for b in blocks], np.uint64)
        return cls(np.frombuffer(b"".join(blocks), np.uint8), np.cumsum(sizes, dtype=np.uint64) - sizes, sizes * np.uint64(8))

    @staticmethod
    def block(marks: np.ndarray, most: int) -> np.ndarray:
        """Bytes of the block of distinct marks of one range."""
        bits = min(most, max(8, 1 << (8 * len(marks)).bit_length()))
        out = np.zeros(bits // 8, np.uint8)
        for at in RecurringTokens._at(marks, np.uint64(bits)):
            np.bitwise_or.at(out, at >> np.uint64(3), np.left_shift(np.uint8(1), (at & np.uint64(7)).astype(np.uint8)))
        return out

    @staticmethod
    def _at(marks: np.ndarray, bits) -> list[np.ndarray]:
        keys = mixed(marks)
        return [(keys >> np.uint64(shift)) % bits for shift in (0, 23, 37)]

    def has(self, values: np.ndarray) -> np.ndarray:
        marks = values >> np.uint64(64 - MARK)
        block = (marks >> np.uint64(MARK - (len(self.first) - 1).bit_length())).astype(np.int64)
        out = np.ones(len(values), bool)
        for at in self._at(marks, self.bits[block]):
            out &= (self.words[self.first[block] + (at >> np.uint64(3))] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0
        return out


def prefixes(docs: DataFrame, counts: np.ndarray, recurring: RecurringTokens, k: int, percent: int) -> DataFrame:
    """All texts (``uid``, ``n``: lines, the rest null); all lines that have tokens (``uid``, ``place``, ``node``); and, in rows with a
    ``token``, the recurring tokens among the first of each set in order of rarity: ``node``, ``n``, their places ``at``, and how many
    of them there are from here on (``left``)."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((counts, recurring.words, recurring.first, recurring.bits))
    names = ["uid", "place", "node", "token", "n", "at", "left"]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]

    def run(batches):
        counts, *known = shared.value
        known = RecurringTokens(*known)
        for batch in batches:
            for b in slices(batch, "text"):
                of_text, place, sizes, nodes, values, line = _lines(b.column(1), k)
                has = np.flatnonzero(sizes > 0)
                uids = b.column(0).to_numpy(zero_copy_only=False)
                yield _rows(names, kinds, uid=uids, n=_line_counts(b.column(1)))
                yield _rows(names, kinds, uid=uids[of_text[has]], place=place[has], node=signed(nodes[has]))
                fresh = np.zeros(len(nodes), bool)
                fresh[np.unique(nodes, return_index=True)[1]] = True
                again = known.has(values)
                once = np.bincount(line[~again], minlength=len(nodes))
                length = sizes - needed(sizes, percent) + 1
                chosen = again & (fresh & (once < length))[line]
                values, line = values[chosen], line[chosen]
                order = np.lexsort((values, counts[(values % np.uint64(BINS)).astype(np.int64)], line))
                values, line = values[order], line[order]
                at = once[line] + np.arange(len(line)) - np.searchsorted(line, line)
                keep = at < length[line]
                values, line, at = values[keep], line[keep], at[keep]
                yield _rows(names, kinds, node=signed(nodes[line]), token=signed(values), n=sizes[line], at=at, left=length[line] - at)

    return docs.select("_uid", "text").mapInArrow(run, "uid long, place int, node long, token long, n int, at int, left int")


def line_sets(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """``node``, ``n``, ``tokens`` of the ``wanted`` (node, uid) line sets, read from the documents that have them."""
    spark, bits = docs.sparkSession, filter_bits(wanted.count())
    nodes_in, uids_in = (spark.sparkContext.broadcast(KeyFilter.of(wanted.select(c), bits).words) for c in ("node", "uid"))

    def run(batches):
        for batch in batches:
            batch = batch.filter(pa.array(KeyFilter(uids_in.value).has(batch.column(0).to_numpy())))
            for b in slices(batch, "text"):
                _, _, sizes, nodes, values, line = _lines(b.column(1), k)
                first = np.concatenate([[0], np.cumsum(sizes)])
                fresh = np.flatnonzero((sizes > 0) & KeyFilter(nodes_in.value).has(signed(nodes)))
                fresh = fresh[np.unique(nodes[fresh], return_index=True)[1]]
                if len(fresh):
                    tokens = [signed(values[first[i] : first[i + 1]]) for i in fresh]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(signed(nodes[fresh])), pa.array(sizes[fresh].astype(np.int64)), pa.array(tokens, pa.list_(pa.int64()))],
                        names=["node", "n", "tokens"],
                    )

    found = docs.select("_uid", "text").mapInArrow(run, "node long, n long, tokens array<long>").join(wanted.select("node"), "node", "left_semi")
    return settle(found.groupBy("node").agg(F.any_value("n").alias("n"), F.any_value("tokens").alias("tokens")))


def _may_match(percent: int):
    """Length filter, and positional filter at a shared token of the sides x and y.

    At the first token that both prefixes have, no more can be shared than what is behind it, nor more than the recurring
    tokens from it on in either prefix and what one of the sets has behind its prefix.
    """
    n, m = F.col("x.n"), F.col("y.n")
    beyond = F.floor((percent * F.greatest(n, m) + 99) / 100) - 1
    most = F.least(n - F.col("x.at"), m - F.col("y.at"), beyond + F.least("x.left", "y.left"))
    return (100 * F.least(n, m) >= percent * F.greatest(n, m)) & ((100 + percent) * most >= percent * (n + m))


def later_matches(docs: DataFrame, k: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The lines that have a similar line before them (``uid``, ``place``), and the number ``n`` of lines of each ``uid``. ``docs``: _uid, text."""
    ranges = max(LEAST_RANGES, 1 << (8 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))).bit_length())
    counts, recurring = token_statistics(docs, k, ranges)
    dealt = settle(prefixes(docs, counts, recurring, k, percent))
    lines = dealt.where("place IS NOT NULL").select("uid", "place", "node")
    entries = dealt.where("token IS NOT NULL").select("token", "node", "n", "at", "left")
    by_token = Window.partitionBy("token")
    entries = entries.withColumn("_lo", F.min("node").over(by_token)).withColumn("_hi", F.max("node").over(by_token))
    shared = entries.where("_lo < _hi").drop("_lo", "_hi").distinct()
    first = settle(lines.groupBy("node").agg(F.min(F.struct("uid", "place")).alias("first")))
    members = settle(shared.join(first, "node"))

    # round 1: each line with the earliest of its groups
    lead = members.groupBy("token").agg(F.min(F.struct("first", "node", "n", "at", "left")).alias("lead"))
    met = members.alias("x").join(lead.select("token", "lead.*").alias("y"), "token").where(F.col("x.node") != F.col("y.node"))
    tried = settle(met.where(_may_match(percent)).select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct())
    passed = similar(F.col("shared"), F.col("n_a"), F.col("n_b"), percent)

    def verified(pairs: DataFrame) -> DataFrame:
        """Nodes ``a`` of the pairs that are similar. Sets are read for the lines of the pairs alone."""
        both = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
        wanted = settle(both.join(first, "node").select("node", "first.uid"))
        sets = line_sets(docs, wanted, k)
        found = settle(overlaps(pairs, sets).where(passed).select(F.col("a").alias("node")).distinct())
        discard(wanted, sets)
        return found

    matched = verified(tried)

    # round 2: what is unmatched with every earlier line of its groups
    left = members.join(matched, "node", "left_anti")
    met = left.alias("x").join(members.alias("y"), "token").where(F.col("y.first") < F.col("x.first"))
    rest = met.where(_may_match(percent)).select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()
    rest = settle(rest.join(tried, ["a", "b"], "left_anti"))
    gone = matched.unionByName(verified(rest)).distinct()
    discard(members, tried, rest)

    repeated = lines.join(first, "node").where((F.col("uid") != F.col("first.uid")) | (F.col("place") != F.col("first.place")))
    firsts = first.join(gone, "node").select("first.uid", "first.place")
    out = settle(repeated.select("uid", "place").unionByName(firsts).distinct())
    counted = settle(dealt.where("token IS NULL AND place IS NULL").select("uid", "n"))
    discard(dealt, first, matched)
    return out, counted


def line_keys(uids: np.ndarray, places: np.ndarray) -> np.ndarray:
    """64-bit names of lines."""
    return signed(mixed(mixed(uids.astype(np.int64).view(np.uint64)) + places.astype(np.uint64)))


class LostLines:
    """Which lines of a document go, told by filters of bounded size: the first passes all lines that go, the second all others that
    the first passes, the third all lines that go and that the second passes. What the third passes is in doubt: the last
    filter passes all documents with such lines, whose places have to be looked up.
    """

    def __init__(self, filters: list[np.ndarray]):
        self.go, self.stay, self.back, self.doubt = (KeyFilter(f) for f in filters)

    def places(self, uids: np.ndarray, n: np.ndarray) -> list[np.ndarray | None]:
        """Places of the lines that go; none: null; for a document in doubt -1."""
        of = np.repeat(np.arange(len(n)), n)
        place = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
        keys = line_keys(uids[of], place)
        gone = np.flatnonzero(self.go.has(keys))
        gone = gone[~self.stay.has(keys[gone]) | self.back.has(keys[gone])]
        at = np.searchsorted(of[gone], np.arange(len(n) + 1))
        place = place[gone].astype(np.int32)
        found = [place[i:j] if j > i else None for i, j in zip(at[:-1], at[1:])]
        for i in np.flatnonzero(self.doubt.has(uids)):
            found[i] = np.array([-1], np.int32)
        return found


def lost_lines(lost: DataFrame, counted: DataFrame) -> list[np.ndarray]:
    """The filters of :class:`LostLines`, from the lines that go (uid, place) and the number ``n`` of lines of each ``uid``."""
    spark = lost.sparkSession

    def filter_of(df, run=None, kind="key long"):
        found = df.mapInArrow(run, kind) if run else df
        return KeyFilter.of(found, filter_bits(df.count()))

    def keys(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(line_keys(*(b.column(i).to_numpy() for i in (0, 1))))], names=["key"])

    def passing(known):
        def run(batches):
            has = KeyFilter(known.value).has
            for b in batches:
                yield b.filter(pa.array(has(line_keys(*(b.column(i).to_numpy() for i in (0, 1))))))

        return run

    def every_line(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 4096):
                uids, n = (c.to_numpy() for c in batch.slice(i, 4096).columns)
                places = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(uids, n)), pa.array(places.astype(np.int32))], names=["uid", "place"])

    def through(df, known, first=None):
        ask = passing(spark.sparkContext.broadcast(known.words))
        return df.mapInArrow(lambda batches: ask(first(batches) if first else batches), "uid long, place int")

    go = filter_of(lost, keys)
    wrong = settle(through(counted, go, every_line).join(lost, ["uid", "place"], "left_anti"))
    stay = filter_of(wrong, keys)
    missed = settle(through(lost, stay))
    back = filter_of(missed, keys)
    doubt = settle(missed.unionByName(through(wrong, back)).select("uid").distinct())
    made = [f.words for f in (go, stay, back, filter_of(doubt))]
    discard(wrong, missed, doubt)
    return made


def remove_lines(docs: DataFrame, k: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with ``text`` freed of later matches, and ``n_lines``, ``n_removed`` appended (columns so named are replaced)."""
    kept = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    uid, lost = fresh_name(docs, "_uid"), fresh_name(docs, "_gone")
    rows = with_row_id(docs.select(*kept), key, text, uid)
    gone, counted = later_matches(rows.select(F.col(uid).alias("_uid"), F.col(text).alias("text")), k, percent)
    shared = docs.sparkSession.sparkContext.broadcast(lost_lines(gone, counted))

    @F.pandas_udf("boolean")
    def in_doubt(uids: pd.Series) -> pd.Series:
        return pd.Series(KeyFilter(shared.value[3]).has(uids.to_numpy(np.int64)))

    @F.pandas_udf("array<int>")
    def places(uids: pd.Series, n: pd.Series) -> pd.Series:
        return pd.Series(LostLines(shared.value).places(uids.to_numpy(np.int64), n.to_numpy(np.int64)), dtype=object)

    # asked once a row: as a nondeterministic function it is not copied into the filter on it
    places = places.asNondeterministic()
    whole = F.coalesce(F.col(text), F.lit(""))
    breaks = F.octet_length(whole) - F.octet_length(F.replace(whole, F.lit("\n"), F.lit("")))
    rows = rows.withColumn("n_lines", F.when(F.octet_length(whole) > 0, breaks + 1).otherwise(0).cast("long"))
    # documents in doubt are few, unless more lines go than the filters have bits for; only these are shuffled
    looked_up = gone.groupBy("uid").agg(F.collect_set("place").alias(lost)).withColumnRenamed("uid", uid)
    sure = rows.withColumn(lost, places(uid, "n_lines")).where(F.coalesce(F.col(lost)[0] >= 0, F.lit(True)))
    full = sure.unionByName(rows.where(in_doubt(uid)).join(looked_up, uid, "left").select(*sure.columns))
    gone = F.col(lost)
    # the parts are bound once per row; without that every line would split the text again
    stay = F.transform(
        F.array(F.split(whole, "\n", -1)),
        lambda p: F.array_join(
            F.transform(F.array_except(F.sequence(F.lit(0), F.size(p) - 1), gone), lambda i: F.element_at(p, i + 1)), "\n"
        ),
    )[0]
    full = full.withColumn("n_removed", F.when(gone.isNull(), F.lit(0)).otherwise(F.size(gone)).cast("long"))
    full = full.withColumn(text, F.when(gone.isNull(), whole).otherwise(stay))
    return full.select(*kept, "n_lines", "n_removed")
