"""Benchmark passages in documents: one Aho-Corasick automaton over normalised items, one scan of every text.

A text is normalised to its words: A-Z become a-z, and a word is a run of digits, a-z and characters from U+0080 on. A window is
``window`` consecutive words of an item; an item with fewer words, but not none, is one window. The words of the windows are
numbered, and the automaton reads the word numbers of a document once, from begin to end; words of no window are 0. Word places
lead back to the original: hits are given by words and by code points of the text as it was.

The automaton is broadcast. It holds at most ``pairs_per_automaton`` pairs of window and item and about ``bytes_per_automaton``
of window text. A larger benchmark is cut by hash into blocks of that size, each with an automaton and a scan of its own, and the
hits of a document are put together by a shuffle of the hits alone; the result is the same.

Defined results: null and empty texts have no words and no hits; an empty benchmark hits nothing; repeated keys are rows of their own;
benchmark rows with one id are one item; windows of a null id hit, but list no item; one window of several items lists them all. Texts
are scanned in pieces, so a long text costs the memory of its bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import settle
from .pairs import fresh_name, with_row_id
from .texts import slices

#: Separators become spaces, capitals a-z; digits, a-z and bytes of other characters stay.
_NORMAL = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))
_PIECE_BYTES = 1 << 20
_HITS = "array<struct<first:bigint,last:bigint,start:bigint,end:bigint>>"
_HIT_TYPE = pa.list_(pa.struct([(name, pa.int64()) for name in ("first", "last", "start", "end")]))
RESULT = ["n_words", "hits", "items"]


def _word_lists(normal: bytes) -> Iterator[list[bytes]]:
    """The words of a normalised text, in lists from about a megabyte each."""
    at = 0
    while at < len(normal):
        end = normal.find(b" ", at + _PIECE_BYTES)
        end = len(normal) if end < 0 else end
        yield normal[at:end].split()
        at = end


class Matcher:
    """The automaton over the word numbers of windows. ``windows``: (text of the window, its item ids)."""

    def __init__(self, windows: list[tuple[bytes, list[str]]]):
        self.numbers: dict[bytes, int] = {}
        self.items = [items for _, items in windows]
        self.lengths = []
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
        for i, (window, _) in enumerate(windows):
            words = window.split(b" ")
            self.lengths.append(len(words))
            self.automaton.add_word(tuple(self.numbers.setdefault(w, len(self.numbers) + 1) for w in words), i)
        if windows:
            self.automaton.make_automaton()

    @classmethod
    def of(cls, shared: dict) -> Matcher:
        """Matcher that lives in the broadcast value, for the next tasks of the worker."""
        if "matcher" not in shared:
            shared["matcher"] = cls(shared["windows"])
        return shared["matcher"]

    def scan(self, normal: bytes) -> tuple[int, list[list[int]], set[int]]:
        """Number of words, hit runs of words [first, last] in order, and the windows that occur."""
        n, runs, found, reader = 0, [], set(), None
        for words in _word_lists(normal):
            n += len(words)
            if not self.lengths or not words:
                continue
            numbers = tuple(map(self.numbers.get, words, repeat(0)))
            if reader is None:
                reader = self.automaton.iter(numbers)
            else:
                reader.set(numbers, False)
            for last, window in reader:
                found.add(window)
                first = last + 1 - self.lengths[window]
                while runs and first <= runs[-1][1] + 1:
                    first = min(first, runs.pop()[0])
                runs.append([first, last])
        return n, runs, found

    def listed(self, found: set[int]) -> list[str]:
        return sorted({item for window in found for item in self.items[window]})


def _in_text(data: bytes, normal: bytes, runs: list[list[int]]) -> list[dict[str, int]]:
    """Hit runs with the code points [start, end) that they cover in the original text."""
    inside = np.frombuffer(normal, np.uint8) != 32
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    follow = np.flatnonzero((np.frombuffer(data, np.uint8) & 0xC0) == 0x80)  # bytes that begin no code point
    first, last = np.array(runs, np.int64).T
    start, end = (x - np.searchsorted(follow, x) for x in (edges[2 * first], edges[2 * last + 1]))
    return [dict(zip(("first", "last", "start", "end"), x)) for x in zip(first.tolist(), last.tolist(), start.tolist(), end.tolist())]


def benchmark_windows(items: DataFrame, window: int = 10, key: str = "item_id", text: str = "text") -> DataFrame:
    """``window`` (normalised words joined by spaces) and ``item`` (id as string), each pair once."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, "_text"):
                names, found = [], []
                for item, data in zip(part.column(0).to_pylist(), part.column(1).cast(pa.large_binary()).to_pylist()):
                    words = data.translate(_NORMAL).split()
                    made = {b" ".join(words[i : i + window]) for i in range(max(1, len(words) - window + 1))} if words else ()
                    names += [item] * len(made)
                    found += made
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary()), pa.array(names, pa.string())], names=["window", "item"])

    source = items.select(F.col(key).cast("string").alias("_item"), F.col(text).alias("_text"))
    return source.mapInArrow(run, "window binary, item string").distinct()


def _scanned(source: DataFrame, carried: int, matcher: DataFrame, only_hits: bool) -> tuple[DataFrame, Broadcast]:
    """``source`` (carried columns, then the text), the text replaced by :data:`RESULT`; ``matcher`` (window, item) fits one automaton.

    With the broadcast windows, for the caller to destroy when the frame is no longer read.
    """
    windows: dict[bytes, list[str]] = {}
    for row in matcher.toLocalIterator():
        windows.setdefault(bytes(row["window"]), []).extend([row["item"]] if row["item"] is not None else [])
    shared = source.sparkSession.sparkContext.broadcast({"windows": sorted(windows.items())})
    names = [f"c{i}" for i in range(carried)]

    def run(batches):
        machine = Matcher.of(shared.value)
        for batch in batches:
            for part in slices(batch, batch.schema.names[carried]):
                counts, hits, items = [], [], []
                for data in part.column(carried).cast(pa.large_binary()).to_pylist():
                    normal = data.translate(_NORMAL)
                    n, runs, found = machine.scan(normal)
                    counts.append(n)
                    hits.append(_in_text(data, normal, runs) if runs else [])
                    items.append(machine.listed(found))
                made = [pa.array(counts, pa.int64()), pa.array(hits, _HIT_TYPE), pa.array(items, pa.list_(pa.string()))]
                out = pa.RecordBatch.from_arrays([*part.columns[:carried], *made], names=[*names, *RESULT])
                yield out.filter(pa.array([bool(x) for x in hits], pa.bool_())) if only_hits else out

    renamed = source.toDF(*names, "_text")
    columns = [f"{n} {f.dataType.simpleString()}" for n, f in zip(names, renamed.schema)]
    made = renamed.mapInArrow(run, ", ".join([*columns, "n_words long", f"hits {_HITS}", "items array<string>"]))
    return made.toDF(*source.columns[:carried], *RESULT), shared


def _joined_parts(parts: DataFrame) -> DataFrame:
    """``parts`` (uid, lists of hits, lists of items) with the hits of several automata as maximal runs, and each item once."""

    def run(batches):
        for batch in batches:
            hits, items = [], []
            for of_row, listed in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                runs: list[dict[str, int]] = []
                for x in sorted((x for part in of_row for x in part), key=lambda x: x["first"]):
                    if runs and x["first"] <= runs[-1]["last"] + 1:
                        runs[-1] |= {"last": max(runs[-1]["last"], x["last"]), "end": max(runs[-1]["end"], x["end"])}
                    else:
                        runs.append(x)
                hits.append(runs)
                items.append(sorted({item for part in listed for item in part}))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(hits, _HIT_TYPE), pa.array(items, pa.list_(pa.string()))], names=["uid", "hits", "items"]
            )

    return parts.mapInArrow(run, f"uid long, hits {_HITS}, items array<string>")


def find(
    docs: DataFrame, items: DataFrame, window: int = 10, key: str = "doc_id", text: str = "text", carry: tuple[str, ...] = (),
    item_key: str = "item_id", item_text: str = "text", pairs_per_automaton: int = 200_000, bytes_per_automaton: int = 32 << 20,
) -> DataFrame:
    """Per row of ``docs``: ``key``, the columns of ``carry``, ``n_words``, ``hits`` and ``items``.

    ``hits``: maximal runs of words that lie in occurring windows, as words [first, last] and code points [start, end) of the text.
    ``items``: sorted ids, as strings, of the items with occurring windows. Carried columns must not be named like these.
    """
    pairs = settle(benchmark_windows(items, window, item_key, item_text))
    size = pairs.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("window")), F.lit(0)).alias("b")).first()
    blocks = max(1, -(-size["n"] // pairs_per_automaton), -(-size["b"] // bytes_per_automaton))
    kept = list(dict.fromkeys([key, *carry]))
    if blocks == 1:
        return _scanned(docs.select(*kept, F.col(text).alias("_text")), len(kept), pairs, only_hits=False)[0]
    uid, body = fresh_name(docs, "_uid"), fresh_name(docs, "_text")
    rows = with_row_id(docs.select(*kept, F.col(text).alias(body)), key, body, uid)
    block = F.pmod(F.xxhash64("window", "item"), F.lit(blocks))
    every = None
    for i in range(blocks):
        scanned, shared = _scanned(rows.select(uid, body), 1, pairs.where(block == i), only_hits=True)
        part = settle(scanned)
        shared.destroy()
        every = part if every is None else every.unionByName(part)
    grouped = every.groupBy(F.col(uid).alias("uid")).agg(F.collect_list("hits").alias("hits"), F.collect_list("items").alias("items"))
    found = settle(_joined_parts(grouped).withColumnRenamed("uid", uid))
    counted, _ = _scanned(rows.select(uid, *kept, body), 1 + len(kept), pairs.limit(0), only_hits=False)
    joined = counted.drop("hits", "items").join(found, uid, "left")
    empty = [F.coalesce("hits", F.array().cast(_HITS)).alias("hits"), F.coalesce("items", F.array().cast("array<string>")).alias("items")]
    return joined.select(*kept, "n_words", *empty)


def cut(text: Column, hits: Column) -> Column:
    """The text without its hits; null text: ''. ``hits`` as :func:`find` gives them, so carry the text through it."""
    text = F.coalesce(text, F.lit(""))
    begin = F.struct(F.lit("").alias("kept"), F.lit(0).cast("bigint").alias("at"))

    def step(held, hit):
        between = F.substring(text, (held["at"] + 1).cast("int"), (hit["start"] - held["at"]).cast("int"))
        return F.struct(F.concat(held["kept"], between).alias("kept"), hit["end"].alias("at"))

    return F.aggregate(hits, begin, step, lambda held: F.concat(held["kept"], F.substring(text, (held["at"] + 1).cast("int"), F.length(text))))


def n_hit(hits: Column) -> Column:
    """Number of hit words."""
    return F.aggregate(hits, F.lit(0).cast("bigint"), lambda n, x: n + x["last"] - x["first"] + 1)


def digest(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Per row of :func:`find`: numbers of words, hit words and items, SHA-256 of the item ids joined by commas, and whether any word is hit."""
    hit = n_hit(F.col("hits"))
    return found.select(
        key, "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("hits") > 0).alias("contaminated"),
    )
