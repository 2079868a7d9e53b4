"""Token ids in training order: fixed-stride binary shards behind a keyed permutation.

The token stream of each input split (its documents in file order, an end mark after each) is cut into sequences of ``length`` ids.
Texts are encoded once: the sequences are written with their split (file and offset) and place in it. They are counted per
split, running sums give every sequence a dense number, and the second pass needs no shuffle to number its rows. Until they are in
their shard, sequences are kept and shuffled compressed, in the shuffle those of a batch and shard together. A keyed Feistel network permutes the
numbers: it works on the smallest even number of bits that holds them, and values beyond the last number walk
on along their cycle until they fall inside. So each sequence has one slot, each slot one sequence, and the inverse is as cheap.

Rows are then dealt by shard, ``per_shard`` consecutive slots each; one task fills one shard and moves it to its
name when it is whole, so a repeated task writes the same file. A reader finds slot s in shard s // per_shard at byte
(s % per_shard) * stride, and can stop and resume anywhere.

Ids are bytes of UTF-8 by default (one byte each; 0xFF ends a document, 0xFE fills the last sequence of a split: neither occurs in UTF-8).
With a BPE vocabulary file they are its ids in two bytes, with 0xFFFF and 0xFFFE as marks.

Defined results: null and empty texts are an end mark alone; an empty table has no sequences and no shards.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import discard, new_path, settle
from .bpe import BpeCodec
from .texts import mixed, slices

_U = np.uint64
_PACKING = "zstd"
CACHE_BYTES = 96 << 20  # of words that a worker keeps


def feistel(numbers: np.ndarray, n: int, key: int, rounds: int = 6, back: bool = False) -> np.ndarray:
    """Permutation of range(n), or its inverse: cycle-walking over the smallest balanced Feistel domain."""
    half = max(1, ((max(n - 1, 1)).bit_length() + 1) // 2)
    mask = _U((1 << half) - 1)
    keys = [mixed(np.array([key * 64 + r], np.uint64))[0] for r in range(rounds)]

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> _U(half), x & mask
        for k in reversed(keys) if back else keys:
            if back:
                left, right = right ^ (mixed(left ^ k) & mask), left
            else:
                left, right = right, left ^ (mixed(right ^ k) & mask)
        return (left << _U(half)) | right

    out = once(numbers.astype(np.uint64))
    while (outside := out >= _U(n)).any():
        out[outside] = once(out[outside])
    return out.astype(np.int64)


def _ids(path: str | None, shared) -> tuple[np.dtype, int, int]:
    kind = np.dtype("<u2") if path else np.dtype("u1")
    top = int(np.iinfo(kind).max)
    return kind, top, top - 1


def _encoded(texts: list[str | None], tables: dict | None, kind: np.dtype, end: int) -> Iterator[np.ndarray]:
    mark = np.array([end], kind)
    for ids in BpeCodec.over(tables).encode_packed(texts, kind) if tables else ((t or "").encode() for t in texts):
        yield np.frombuffer(ids, kind)
        yield mark


def write_shards(
    docs: DataFrame, folder: str, length: int = 2048, per_shard: int = 4096, key: int = 20, vocabulary: str | None = None, text: str = "text"
) -> DataFrame:
    """Write the shards of a file-backed ``docs`` into ``folder`` and return the written manifest.

    The manifest has ``shard``, ``path``, ``first_slot``, ``sequences`` and ``stride`` (bytes).
    """
    spark = docs.sparkSession
    kind, end, fill = _ids(vocabulary, None)
    shared = BpeCodec.from_file(vocabulary, cache_bytes=CACHE_BYTES).shared(spark) if vocabulary else None
    stride = length * kind.itemsize
    split = docs.select(F.col(text).alias("text"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))

    def binary(data: np.ndarray) -> pa.Array:
        rows = pa.FixedSizeBinaryArray.from_buffers(pa.binary(stride), len(data) // length, [None, pa.py_buffer(np.ascontiguousarray(data).tobytes())])
        return rows.cast(pa.binary())

    def sequences(batches):
        here, done, rest = None, 0, np.zeros(0, kind)

        def made(ids: np.ndarray, first: int) -> pa.RecordBatch:
            n = len(ids) // length
            columns = [pa.array([here[0]] * n, pa.string()), pa.array([here[1]] * n, pa.int64()), pa.array(np.arange(first, first + n)), binary(ids)]
            return pa.RecordBatch.from_arrays(columns, names=["file", "block", "place", "ids"])

        def closed() -> Iterator[pa.RecordBatch]:
            if len(rest):
                yield made(np.concatenate([rest, np.full(length - len(rest), fill, kind)]), done)

        for b in batches:
            for part in slices(b, "text", 1 << 21):
                names = list(zip(part.column(1).to_pylist(), part.column(2).to_pylist()))
                cuts = [0, *(j for j in range(1, len(names)) if names[j] != names[j - 1]), len(names)]
                for s, e in zip(cuts, cuts[1:]):
                    if names[s] != here:
                        yield from closed()
                        here, done, rest = names[s], 0, np.zeros(0, kind)
                    texts = part.column(0).slice(s, e - s).to_pylist()
                    stream = np.concatenate([rest, *_encoded(texts, shared.value if shared else None, kind, end)])
                    whole = len(stream) // length
                    for at in range(0, whole, 1024):
                        stop = min(whole, at + 1024)
                        yield made(stream[at * length : stop * length], done + at)
                    done, rest = done + whole, stream[whole * length :]
        yield from closed()

    held = settle(split.mapInArrow(sequences, "file string, block long, place long, ids binary"), compression=_PACKING)
    splits = settle(held.groupBy("file", "block").agg(F.count("*").alias("own")))
    n = splits.agg(F.sum("own").alias("n")).first()["n"] or 0
    manifest = "shard long, path string, first_slot long, sequences long, stride long"
    if not n:
        return spark.createDataFrame([], manifest)
    by_file = Window.orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)
    placed = splits.withColumn("base", F.coalesce(F.sum("own").over(by_file), F.lit(0))).select("file", "block", "base")

    def numbered(batches):
        codec = pa.Codec(_PACKING, 3)
        for b in batches:
            if not b.num_rows:
                continue
            slots = feistel(b.column(0).to_numpy(), n, key)
            order = np.argsort(slots)
            slots = slots[order]
            data = b.column(1).cast(pa.binary(stride)).take(pa.array(order)).buffers()[1]
            cuts = [0, *(1 + np.flatnonzero(np.diff(slots // per_shard))).tolist(), len(slots)]
            columns = [
                pa.array(slots[cuts[:-1]] // per_shard),
                pa.array([slots[s:e].tobytes() for s, e in zip(cuts, cuts[1:])], pa.binary()),
                pa.array([codec.compress(data[s * stride : e * stride], asbytes=True) for s, e in zip(cuts, cuts[1:])], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["shard", "slots", "packed"])

    rows = held.join(placed, ["file", "block"]).select((F.col("base") + F.col("place")).alias("number"), "ids")
    rows = rows.mapInArrow(numbered, "shard long, slots binary, packed binary")
    shards = -(-n // per_shard)

    def fill_shards(batches):
        shard, sizes = None, 0
        table = np.zeros((0, stride), np.uint8)

        def saved() -> Iterator[pa.RecordBatch]:
            if shard is None:
                return
            own = min(per_shard, n - shard * per_shard)
            if sizes != own:
                raise RuntimeError(f"shard {shard} has {sizes} of {own} sequences")
            fs, root = pafs.FileSystem.from_uri(folder)
            fs.create_dir(root, recursive=True)
            name = f"shard-{shard:08d}.bin"
            hidden = f"{root}/_{name}.{np.random.default_rng().integers(1 << 62):x}"
            with fs.open_output_stream(hidden) as f:
                f.write(table[:own].tobytes())
            fs.move(hidden, f"{root}/{name}")
            yield pa.RecordBatch.from_pydict(
                {"shard": [shard], "path": [f"{folder}/{name}"], "first_slot": [shard * per_shard], "sequences": [own], "stride": [stride]}
            )

        codec = pa.Codec(_PACKING)
        for b in batches:
            for s, slots, packed in zip(b.column(0).to_pylist(), b.column(1), b.column(2)):
                if s != shard:
                    yield from saved()
                    shard, sizes, table = s, 0, np.zeros((per_shard, stride), np.uint8)
                slots = np.frombuffer(slots.as_buffer(), np.int64)
                data = codec.decompress(packed.as_buffer(), len(slots) * stride)
                table[slots - s * per_shard] = np.frombuffer(data, np.uint8).reshape(-1, stride)
                sizes += len(slots)
        yield from saved()

    dealt = rows.repartitionById(int(shards), F.col("shard").cast("int"))
    written = settle(dealt.mapInArrow(fill_shards, manifest))
    discard(held, splits)
    return written


def read_shards(manifest: DataFrame, folder: str, first: int = 0, last: int | None = None) -> DataFrame:
    """``slot``, ``shard``, ``offset`` and ``ids`` (binary) of the slots from ``first`` up to ``last``, straight from the files."""
    spark = manifest.sparkSession
    files = spark.read.format("binaryFile").option("pathGlobFilter", "shard-*.bin").load(folder) if not manifest.isEmpty() else None
    if files is None:
        return spark.createDataFrame([], "slot long, shard long, offset long, ids binary")
    shard = F.regexp_extract("path", r"shard-(\d+)\.bin$", 1).cast("long").alias("shard")
    held = files.select(shard, "content").join(manifest.select("shard", "first_slot", "sequences", "stride"), "shard")
    held = held.where((F.col("first_slot") + F.col("sequences") > first) & (F.lit(True) if last is None else F.col("first_slot") < last))
    place = F.explode(F.sequence(F.lit(0).cast("long"), F.col("sequences") - 1)).alias("_i")
    rows = held.select("shard", "content", "first_slot", "stride", place)
    rows = rows.select(
        (F.col("first_slot") + F.col("_i")).alias("slot"),
        "shard",
        (F.col("_i") * F.col("stride")).alias("offset"),
        F.substring(F.col("content"), (F.col("_i") * F.col("stride") + 1).cast("int"), F.col("stride").cast("int")).alias("ids"),
    )
    return rows.where((F.col("slot") >= first) & (F.lit(True) if last is None else F.col("slot") < last))


def shard_folder(df: DataFrame) -> str:
    """A fresh folder that all executors reach, as a URI."""
    path = new_path(df.sparkSession, "shards")
    return path if "://" in path or path.startswith("file:") else f"file://{path}"
