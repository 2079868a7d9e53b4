"""Byte-level BPE: encoding by batched merge rounds in numpy, and decoding.

Texts are cut into words by the pre-tokenizer's pattern. Words not met before are merged together: the symbols of all
of them lie in one flat array, the rank of each neighbouring pair is found by binary search over the sorted pair
keys, and a round merges, in every word, all places of its lowest-ranked pair, left to right. A word leaves
the array when none of its pairs has a rank. Merged words are kept in a cache of the worker, bounded by bytes.
Packed ids are made without an object per chunk: short chunks of a group of texts are looked up together, by their bytes, in a
sorted table of the worker, and their ids are gathered at once.

Defined results: null and empty texts have no ids and decode to ''; the text of an added token in a document becomes its
single id, as the tokenizers library does; bytes that are no UTF-8 decode to U+FFFD.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .texts import mixed

#: Fixed value: the public pre-tokenizer pattern of byte-level BPE.
WORD_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
_NONE = np.int64(1) << 40
_SHIFT = np.int64(32)
CACHE_BYTES = 48 << 20  # of words that a worker keeps
_LONG_CHUNK = 256  # characters from which a chunk is not kept for later texts


_KEY_BYTES = 15  # of a chunk that is looked up by its bytes
_ENTRY_BYTES = 40  # of such a chunk in the table, besides its ids
_MASKS = np.array([(1 << 8 * i) - 1 for i in range(9)], np.uint64)
_WHITE = np.isin(np.arange(256), [32, *range(9, 14)])
#: Of ASCII characters 1 (letter), 2 (digit) or 3 (other); 0 of white space and of all bytes of longer characters.
_KIND = np.array([0 if w or b > 127 else 1 if chr(b).isalpha() else 2 if chr(b).isdigit() else 3 for b, w in enumerate(_WHITE)], np.uint8)


def _weight(chunk: str, ids: tuple[int, ...] | bytes) -> int:
    """About the bytes of a cached chunk: text, ids (objects shared) and entry."""
    return 220 + 2 * len(chunk) + 8 * len(ids)


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in vocabulary files, as letter -> byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class BpeCodec:
    """Encoder and decoder for one vocabulary; small and picklable, so it can be broadcast."""

    def __init__(self, vocabulary: dict[str, int], merges: list[tuple[str, str]], added: dict[str, int], cache_bytes: int = CACHE_BYTES):
        letters = byte_letters()
        size = max([*vocabulary.values(), *added.values()]) + 1
        self.tokens = [b""] * size
        for token, i in vocabulary.items():
            self.tokens[i] = bytes(letters[c] for c in token)
        for token, i in added.items():
            self.tokens[i] = token.encode()
        self.of_byte = np.zeros(256, np.int64)
        for letter, byte in letters.items():
            self.of_byte[byte] = vocabulary[letter]
        keys = np.array([(vocabulary[a] << 32) | vocabulary[b] for a, b in merges], np.int64)
        into = np.array([vocabulary[a + b] for a, b in merges], np.int64)
        keys, first = np.unique(keys, return_index=True)
        self.keys, self.ranks, self.into = keys, first.astype(np.int64), into
        self.added = dict(added)
        self.cache_bytes = cache_bytes

    @classmethod
    def from_file(cls, path: str, **options) -> BpeCodec:
        """Read a tokenizer description (JSON with model.vocab, model.merges, added_tokens) on the driver."""
        with open(path, encoding="utf-8") as f:
            told = json.load(f)
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in told["model"]["merges"]]
        added = {t["content"]: t["id"] for t in told.get("added_tokens") or []}
        return cls(told["model"]["vocab"], merges, added, **options)

    def shared(self, spark: SparkSession) -> Broadcast:
        """The tables as plain data for workers; :meth:`over` makes a codec of them there."""
        return spark.sparkContext.broadcast({k: v for k, v in self.__dict__.items() if not k.startswith("_")})

    @classmethod
    def over(cls, tables: dict) -> BpeCodec:
        """Codec that lives in ``tables``: its cache of words stays with the broadcast for the next tasks of the worker."""
        codec = cls.__new__(cls)
        codec.__dict__ = tables
        return codec

    def _ready(self) -> None:
        if "_cache" not in self.__dict__:
            self._cache: dict[str, tuple[int, ...]] = {}
            self._packed: dict[str, tuple[int, ...]] = {}  # of chunks too long for the table
            self._held_packed = 0
            self._held = 0  # bytes of the cache, by estimate
            self._ids = list(range(len(self.tokens)))  # one object per id, shared by all cached words
            self._pattern = regex.compile(WORD_PATTERN)
            self._odd = regex.compile(r"\p{White_Space} | \p{White_Space}")
            self._space = regex.compile(r"(?<=\P{White_Space}) (?=\P{White_Space})")
            self._clear_table()
            names = sorted(self.added, key=len, reverse=True)
            self._added = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = (left << _SHIFT) | right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.ranks[at], _NONE)

    def merge_words(self, words: list[bytes]) -> list[tuple[int, ...]]:
        """Ids of each word. Rounds end when no word has a pair with a rank."""
        self._ready()
        out: list[tuple[int, ...]] = [()] * len(words)
        lengths = np.array([len(w) for w in words], np.int64)
        if not lengths.sum():
            return out
        symbols = self.of_byte[np.frombuffer(b"".join(words), np.uint8)]
        owner = np.repeat(np.arange(len(words)), lengths)
        # rank[i] belongs to the pair of the symbols i and i + 1; none across words
        rank = np.full(len(symbols), _NONE)
        joined = np.flatnonzero(owner[1:] == owner[:-1])
        rank[joined] = self._rank(symbols[joined], symbols[joined + 1])
        while len(symbols):
            starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            sizes = np.diff(np.append(starts, len(symbols)))
            lowest = np.minimum.reduceat(rank, starts)
            done = lowest == _NONE
            if done.any():
                ids = list(map(self._ids.__getitem__, symbols.tolist()))
                for word, s, n in zip(owner[starts[done]].tolist(), starts[done].tolist(), sizes[done].tolist()):
                    out[word] = tuple(ids[s : s + n])
                stay = np.repeat(~done, sizes)
                symbols, owner, rank = symbols[stay], owner[stay], rank[stay]
                lowest, sizes = lowest[~done], sizes[~done]
                if not len(symbols):
                    break
            hit = rank == np.repeat(lowest, sizes)
            # of touching places, as in "aaa" for (a, a), every second one counts from the left
            places = np.flatnonzero(hit)
            run = np.concatenate([[True], np.diff(places) != 1])
            run_start = np.maximum.accumulate(np.where(run, np.arange(len(places)), 0))
            places = places[(np.arange(len(places)) - run_start) % 2 == 0]
            symbols[places] = self.into[rank[places]]
            keep = np.ones(len(symbols), bool)
            keep[places + 1] = False
            symbols, owner, rank = symbols[keep], owner[keep], rank[keep]
            places -= np.arange(len(places))
            beside = np.zeros(len(symbols) + 1, bool)
            beside[places + 1] = beside[places] = True  # the pair before is one place back
            changed = np.flatnonzero(beside[1:])
            last = changed + 1 >= len(symbols)
            rank[changed[last]] = _NONE
            changed = changed[~last]
            pair = owner[changed] == owner[changed + 1]
            rank[changed[~pair]] = _NONE
            changed = changed[pair]
            rank[changed] = self._rank(symbols[changed], symbols[changed + 1])
        return out

    def _merged(self, words: set[str]) -> dict[str, tuple[int, ...]]:
        every, out = list(words), {}
        for i in range(0, len(every), 20_000):
            part = every[i : i + 20_000]
            out.update(zip(part, self.merge_words([w.encode() for w in part])))
        return out

    def _tidied(self, cache: dict, fresh: dict, held: int, most: int) -> int:
        """After a group of texts: drop its long chunks, of which each may be a whole text, and all chunks when they are too many.
        Returns the bytes that are left of ``held``."""
        for chunk in fresh:
            if len(chunk) > _LONG_CHUNK:
                held -= _weight(chunk, cache.pop(chunk))
        if held > most:
            cache.clear()
            held = 0
        return held

    def _words_of(self, chunk: str) -> list[str]:
        if chunk.isascii() and (chunk[1:] if chunk[:1] == " " else chunk).isalpha():
            return [chunk]
        return self._pattern.findall(chunk)

    def _ids_of(self, chunks: Iterable[str]) -> dict[str, tuple[int, ...]]:
        cut = {c: self._words_of(c) for c in chunks}
        merged = self._merged(set(chain.from_iterable(cut.values())))
        return {c: merged[words[0]] if len(words) == 1 else tuple(chain.from_iterable(map(merged.__getitem__, words))) for c, words in cut.items()}

    def _pieces(self, text: str) -> list[list[str] | int]:
        """Chunks of the text, cut at added tokens; those are given by their ids.

        A chunk ends before a space between two characters that are no white space: there a word always begins
        with the space, so the words of a text are those of its chunks. Chunks after the first begin with the space.
        """
        parts = self._added.split(text) if self._added and self._added.search(text) else [text]
        return [self.added[p] if p in self.added else self._chunks(p) for p in parts if p]

    def _chunks(self, text: str) -> list[str]:
        if self._odd.search(text):
            return self._space.sub("\0", text).replace("\0", "\0 ").split("\0") if "\0" not in text else [text]
        return text.replace(" ", "\0 ").split("\0") if "\0" not in text else [text]

    def encode(self, texts: Iterable[str | None], group_chars: int = 1 << 20) -> Iterator[list[int]]:
        """Ids of each text, without special tokens around it. Words are merged for groups of texts together."""
        self._ready()
        group, size = [], 0
        for text in texts:
            group.append(self._pieces(text) if text else [])
            size += len(text or "")
            if size >= group_chars:
                yield from self._encoded(group)
                group, size = [], 0
        yield from self._encoded(group)

    def encode_packed(self, texts: Iterable[str | None], kind: np.dtype, group_chars: int = 1 << 21) -> Iterator[bytes]:
        """The ids of :meth:`encode` as bytes of ``kind``, gathered for groups of texts without a list of numbers per text."""
        self._ready()
        if len(self.tokens) > np.iinfo(kind).max - 1:
            raise ValueError(f"{len(self.tokens)} ids and two marks do not fit {kind}")
        group, size = [], 0
        for text in texts:
            group.append(text or "")
            size += len(text or "")
            if size >= group_chars:
                yield from self._joined(group, kind)
                group, size = [], 0
        yield from self._joined(group, kind)

    def _joined(self, group: list[str], kind: np.dtype) -> Iterator[bytes]:
        parts: list[str] = []
        made: list[list[int]] = []  # of each text its parts by number, and its added tokens as -1 - id
        for text in group:
            cut = self._added.split(text) if self._added and any(name in text for name in self.added) else [text]
            own = []
            for p in filter(None, cut):
                if len(cut) > 1 and p in self.added:
                    own.append(-1 - self.added[p])
                else:
                    own.append(len(parts))
                    parts.append(p)
            made.append(own)
        ids, bounds = self._gathered([p.encode() for p in parts], kind)
        data, at = memoryview(ids.tobytes()), (bounds * kind.itemsize).tolist()
        for own in made:
            yield b"".join(data[at[p] : at[p + 1]] if p >= 0 else np.array([-1 - p], kind).tobytes() for p in own)

    def _clear_table(self) -> None:
        """The table of short chunks: sorted hashes with their rows; per row the bytes of the chunk and where its ids begin."""
        self._hashes, self._rows = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self._keys, self._begin = np.zeros((2, 0), np.uint64), np.zeros(1, np.int64)
        self._flat = np.zeros(0, np.int32)

    def _learn(self, hashes: np.ndarray, keys: np.ndarray, found: list[tuple[int, ...]]) -> None:
        """Add chunks to the table; ``hashes`` are sorted and not in it."""
        rows = len(self._begin) - 1 + np.arange(len(found))
        at = np.searchsorted(self._hashes, hashes)
        self._hashes, self._rows = np.insert(self._hashes, at, hashes), np.insert(self._rows, at, rows)
        self._keys = np.concatenate([self._keys, keys], axis=1)
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        self._begin = np.concatenate([self._begin, self._begin[-1] + np.cumsum(sizes)])
        self._flat = np.concatenate([self._flat, np.fromiter(chain.from_iterable(found), np.int32, int(sizes.sum()))])

    def _gathered(self, parts: list[bytes], kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all parts (not empty, in UTF-8, without added tokens) in one array, and the bounds of the parts in it.

        A chunk ends where a word surely ends: after ASCII letters, digits or others, if the next character is ASCII of another
        kind (but not after an apostrophe, which may begin a word with letters), and behind a single white space that
        cannot begin a word. A chunk of up to 15 bytes is its bytes and its length in two longs, so equal keys are equal chunks.
        """
        if not parts:
            return np.zeros(0, kind), np.zeros(1, np.int64)
        text = b"".join(parts)
        n = len(text)
        data = np.frombuffer(text + bytes(16), np.uint8)
        first_of = np.cumsum([0, *map(len, parts)])
        kinds, white = _KIND[data[:n]], _WHITE[data[:n]]
        begins = np.zeros(n, bool)
        begins[1:] = (kinds[1:] != kinds[:-1]) & (kinds[:-1] > 0) & (data[: n - 1] != ord("'")) & ((kinds[1:] > 0) | white[1:])
        begins[1:] |= white[1:] & (kinds[:-1] > 0)
        begins[2:] |= (kinds[2:] > 0) & (white & (data[:n] != 32))[1:-1] & (kinds[:-2] > 0)
        begins[first_of[:-1]] = True
        starts = np.flatnonzero(begins)
        sizes = np.diff(np.append(starts, n))
        eight = np.ndarray(n + 9, "<u8", data, strides=(1,))
        low = eight[starts] & _MASKS[np.minimum(sizes, 8)]
        high = (eight[starts + 8] & _MASKS[np.clip(sizes - 8, 0, 7)]) | (np.minimum(sizes, 255).astype(np.uint64) << np.uint64(56))
        hashes = mixed(low ^ mixed(high))

        def chunks(of: np.ndarray) -> list[str]:
            return [text[s:e].decode() for s, e in zip(starts[of].tolist(), (starts[of] + sizes[of]).tolist())]

        short = np.flatnonzero(sizes <= _KEY_BYTES)
        values, first, which = np.unique(hashes[short], return_index=True, return_inverse=True)
        first = short[first]
        at = np.searchsorted(self._hashes, values)
        new = np.ones(len(values), bool)
        inside = at < len(self._hashes)
        new[inside] = self._hashes[at[inside]] != values[inside]
        fresh = chunks(first[new])
        known = self._ids_of(fresh)
        self._learn(values[new], np.stack([low[first[new]], high[first[new]]]), [known[c] for c in fresh])
        row = np.full(len(starts), -1)
        row[short] = self._rows[np.searchsorted(self._hashes, values)][which]
        # long chunks, and chunks whose hash is another chunk's, are kept by their text
        other = sizes > _KEY_BYTES
        other[short] = (self._keys[0, row[short]] != low[short]) | (self._keys[1, row[short]] != high[short])
        other = np.flatnonzero(other)
        names = chunks(other)
        own = {c: i for i, c in enumerate(dict.fromkeys(names))}
        unmet = self._ids_of(own.keys() - self._packed.keys())
        self._packed.update(unmet)
        found = self._packed
        lengths = np.fromiter(map(len, map(found.__getitem__, own)), np.int64, len(own))
        flat = np.concatenate([self._flat, np.fromiter(chain.from_iterable(map(found.__getitem__, own)), np.int32, int(lengths.sum()))])
        begin = np.concatenate([self._begin, self._begin[-1] + np.cumsum(lengths)])
        row[other] = len(self._begin) - 1 + np.fromiter(map(own.__getitem__, names), np.int64, len(names))
        counts = begin[row + 1] - begin[row]
        ends = np.cumsum(counts)
        ids = flat[np.repeat(begin[row] - ends + counts, counts) + np.arange(ends[-1])].astype(kind)
        bounds = np.append(0, ends)[np.append(np.searchsorted(starts, first_of[:-1]), len(starts))]
        self._held_packed += sum(map(_weight, unmet, unmet.values()))
        self._held_packed = self._tidied(self._packed, unmet, self._held_packed, self.cache_bytes // 4)
        if _ENTRY_BYTES * len(self._rows) + 4 * len(self._flat) > self.cache_bytes - self.cache_bytes // 4:
            self._clear_table()
        return ids, bounds

    def _encoded(self, group: list[list[list[str] | int]]) -> Iterator[list[int]]:
        chunks = set(chain.from_iterable(p for pieces in group for p in pieces if isinstance(p, list)))
        fresh = self._ids_of(chunks.difference(self._cache))
        self._cache.update(fresh)
        self._held += sum(map(_weight, fresh, fresh.values()))
        known = self._cache.__getitem__
        for pieces in group:
            yield list(chain.from_iterable((p,) if isinstance(p, int) else chain.from_iterable(map(known, p)) for p in pieces))
        self._held = self._tidied(self._cache, fresh, self._held, self.cache_bytes)

    def decode(self, ids: list[int]) -> str:
        """Text of the ids; special tokens are kept."""
        return b"".join(map(self.tokens.__getitem__, ids)).decode("utf-8", errors="replace")


def _texts(batch: pa.RecordBatch, column: int, rows: int = 64) -> Iterator[str | None]:
    for i in range(0, batch.num_rows, rows):
        yield from batch.column(column).slice(i, rows).to_pylist()


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Append the ids of ``text`` as array<int> (null and empty text: empty array). A column named ``ids`` is replaced."""
    shared = BpeCodec.from_file(path).shared(df.sparkSession)
    kept = [c for c in df.columns if c != ids]
    at = kept.index(text)

    def run(batches):
        codec = BpeCodec.over(shared.value)
        for batch in batches:
            found = list(codec.encode(_texts(batch, at)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.list_(pa.int32()))], names=[*kept, ids])

    source = df.select(*kept)
    return source.mapInArrow(run, source.withColumn(ids, F.array().cast("array<int>")).schema)


def decode(df: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Append the text of the ids (null or empty: ''). A column named ``text`` is replaced."""
    shared = BpeCodec.from_file(path).shared(df.sparkSession)
    kept = [c for c in df.columns if c != text]
    at = kept.index(ids)

    def run(batches):
        codec = BpeCodec.over(shared.value)
        for batch in batches:
            texts = [codec.decode(x or []) for x in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*kept, text])

    source = df.select(*kept)
    return source.mapInArrow(run, source.withColumn(text, F.lit("")).schema)


def round_trip_digest(df: DataFrame, path: str, key: str = "doc_id", text: str = "text", cache_bytes: int = CACHE_BYTES) -> DataFrame:
    """Per row: number of ids, SHA-256 of the decimal ids joined by commas, and of the text decoded from the ids.

    ``cache_bytes`` bounds the words that a worker keeps; more of them save merges.
    """
    shared = BpeCodec.from_file(path, cache_bytes=cache_bytes).shared(df.sparkSession)

    def run(batches):
        codec = BpeCodec.over(shared.value)
        decimal = [str(i) for i in range(len(codec.tokens))]
        for batch in batches:
            counts, of_ids, of_text = [], [], []
            for ids in codec.encode(_texts(batch, 1)):
                counts.append(len(ids))
                of_ids.append(hashlib.sha256(",".join(map(decimal.__getitem__, ids)).encode()).hexdigest())
                of_text.append(hashlib.sha256(codec.decode(ids).encode()).hexdigest())
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=[key, "n_tokens", "ids_sha256", "decoded_sha256"])

    source = df.select(key, text)
    key_type = source.schema[0].dataType.simpleString()
    return source.mapInArrow(run, f"`{key}` {key_type}, n_tokens long, ids_sha256 string, decoded_sha256 string")
