"""Whole texts of an Arrow batch as one byte buffer, with fingerprints of words, shingles and byte ranges.

Everything is vectorised over a slice of rows whose texts hold about ``SLICE_BYTES`` together (one longer text
makes a slice of its own), so memory does not depend on the rows of a batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 18
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_U = np.uint64


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch cut into runs of rows with about ``limit`` bytes of text each; null texts become empty."""
    at = batch.schema.get_field_index(column)
    texts = pc.fill_null(batch.column(at).cast(pa.large_utf8()), "")
    batch = batch.set_column(at, column, texts)
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    begin = 0
    while begin < len(ends):
        before = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield batch.slice(begin, end - begin)
        begin = end


def bounds(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts of a ``large_utf8`` array, and the n + 1 offsets of the texts in them."""
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


_known_powers: dict[int, np.ndarray] = {}


def _powers(base: np.uint64, n: int) -> np.ndarray:
    """The first n powers; up to a slice's worth is kept for the next slices of the task."""
    held = _known_powers.get(int(base))
    if held is None or len(held) < n:
        held = np.full(max(n, SLICE_BYTES + (SLICE_BYTES >> 3)), base, np.uint64)
        held[0] = 1
        np.cumprod(held, dtype=np.uint64, out=held)
        if len(held) <= 2 * SLICE_BYTES:
            _known_powers[int(base)] = held
    return held[:n]


class Prefixes:
    """Fingerprints of byte ranges: a polynomial over random byte values modulo 2**64, made position-free.

    Equal ranges have equal fingerprints; different ones differ but for about one pair in 2**60.
    """

    def __init__(self, data: np.ndarray, lower: bool = False):
        values = mixed(np.arange(1, 257, dtype=np.uint64))
        if lower:
            values[65:91] = values[97:123]
        self._sum(values[data])

    @classmethod
    def over(cls, values: np.ndarray) -> Prefixes:
        """Fingerprints of ranges of a sequence of 64-bit values, such as fingerprints of words."""
        made = cls.__new__(cls)
        made._sum(mixed(values))
        return made

    def _sum(self, terms: np.ndarray) -> None:
        n = len(terms)
        terms *= _powers(_BASE, n)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(terms, dtype=np.uint64, out=self.sums[1:])
        self.inverse = _powers(_INVERSE, n + 1)

    def every(self, length: int, mix: bool = True) -> np.ndarray:
        """Fingerprints of all ranges of ``length`` bytes, by their start. Unmixed ones can be compared with each other only."""
        n = max(0, len(self.sums) - length)
        found = (self.sums[length:] - self.sums[:n]) * self.inverse[:n]
        return mixed(found + _U(length)) if mix else found

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self.sums[ends] - self.sums[starts]) * self.inverse[starts] + (ends - starts).astype(np.uint64))


def words(data: np.ndarray, offsets: np.ndarray, breaks: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and text index of the words, runs of bytes other than 0x20 and 0x09-0x0D.

    ``offsets`` bounds the texts (or lines); a word never crosses them.
    """
    n = len(data)
    inside = (data != 32) & ((data < 9) | (data > 13))
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:n]))
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def every_shingle(hashes: np.ndarray, owner: np.ndarray, n_owners: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of ``k`` words of each owner in order of place, repeated ones as often as they come, and their owners.

    An owner with fewer than ``k`` words has its whole sequence as one shingle; one without words has none.
    """
    counts = np.bincount(owner, minlength=n_owners)
    first = np.concatenate([[0], np.cumsum(counts)])
    m = len(hashes)
    if not m:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    acc = np.zeros(m, np.uint64)
    for j in range(k):
        part = np.zeros(m, np.uint64)
        part[: m - j if j else m] = hashes[j:]
        inside = np.arange(m) + j < first[owner + 1]
        acc = (acc ^ np.where(inside, mixed(part + _U(j + 1)), _U(0))) * _U(0xD6E8FEB86659FD93)
    position = np.arange(m) - first[owner]
    keep = (position + k <= counts[owner]) | ((position == 0) & (counts[owner] < k))
    return mixed(acc[keep]), owner[keep]


def shingles(hashes: np.ndarray, owner: np.ndarray, n_owners: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of :func:`every_shingle`, sorted by owner and value, and their owners."""
    values, owners = every_shingle(hashes, owner, n_owners, k)
    order = _by_owner(values, owners)
    values, owners = values[order], owners[order]
    fresh = np.ones(len(values), bool)
    fresh[1:] = (values[1:] != values[:-1]) | (owners[1:] != owners[:-1])
    return values[fresh], owners[fresh]


def _by_owner(values: np.ndarray, owners: np.ndarray) -> np.ndarray:
    """Order by owner, then by value. One key holds the owner and the upper bits of the value, which nearly always decide."""
    shift = int(owners[-1]).bit_length() if len(owners) else 0
    if shift <= 24:
        keys = (owners.astype(np.uint64) << _U(64 - shift) if shift else np.zeros(len(owners), np.uint64)) | (values >> _U(shift))
        order = np.argsort(keys)
        keys = keys[order]
        if not (values[order][1:] != values[order][:-1])[keys[1:] == keys[:-1]].any():
            return order
    return np.lexsort((values, owners))


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
