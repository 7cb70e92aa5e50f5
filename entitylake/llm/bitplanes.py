"""Token ids in files of shuffled planes: blocks of ids, transposed, each plane compressed by zstandard.

A file is a byte string of bounded size that holds whole documents in order (one very long
document may exceed the bound):

    magic, mode, block size | the planes of each block, compressed | index | length of the index

The index holds, for each block, its number of ids and the compressed length of each plane, and
for each document its id (or null) and number of ids. So any range of ids is read by
decompressing its blocks only. Files are rows of a Parquet table: Spark's committer keeps
exactly one attempt of each, whatever executors are lost, and any store that Spark can write to
holds them. A manifest gives each file its first id in the whole output.

Documents are range-partitioned by id, so files are written in parallel in ascending order.

Defined results: a null or empty text has no ids but the end id; null ids come first; rows with
equal ids are ordered by the hash of their text and keep rows of their own; an empty table gives
no files.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from entitylake.llm.encoder import VOCABULARY, encoder
from entitylake.llm.shared import shared_folder, slices, written

MAGIC = b"PLANES01"
BYTES, BITS = 0, 1
BLOCK_IDS = 16_384
FILE_IDS = 262_144
LEVEL = 3
END_ID = 2


def shuffled(ids: np.ndarray, mode: int) -> list[bytes]:
    """The planes of a block: plane p holds byte (or bit) p of every id."""
    rows = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    if mode == BITS:
        bits = np.unpackbits(rows, axis=1, bitorder="little")
        return [np.packbits(plane, bitorder="little").tobytes() for plane in np.ascontiguousarray(bits.T)]
    return [plane.tobytes() for plane in np.ascontiguousarray(rows.T)]


def unshuffled(planes: list[bytes], count: int, mode: int) -> np.ndarray:
    """The ids of a block from its planes."""
    if mode == BITS:
        bits = [np.unpackbits(np.frombuffer(p, np.uint8), count=count, bitorder="little") for p in planes]
        rows = np.packbits(np.ascontiguousarray(np.stack(bits).T), axis=1, bitorder="little")
    else:
        rows = np.ascontiguousarray(np.stack([np.frombuffer(p, np.uint8) for p in planes]).T)
    return rows.reshape(-1).view("<u4")


def packed(
    documents: list[tuple[int | None, bytes]], mode: int = BYTES, block_ids: int = BLOCK_IDS, level: int = LEVEL
) -> bytes:
    """A file of documents, each an id and its token ids as little-endian 32-bit numbers."""
    press = zstandard.ZstdCompressor(level=level, write_checksum=False)
    ids = np.frombuffer(b"".join(body for _, body in documents), "<u4")
    parts, counts, lengths = [struct.pack("<8sBI", MAGIC, mode, block_ids)], [], []
    for low in range(0, len(ids), block_ids):
        block = ids[low : low + block_ids]
        planes = [press.compress(plane) for plane in shuffled(block, mode)]
        parts += planes
        counts.append(len(block))
        lengths += [len(plane) for plane in planes]
    index = b"".join(
        (
            struct.pack("<II", len(counts), len(documents)),
            np.array(counts, "<u4").tobytes(),
            np.array(lengths, "<u4").tobytes(),
            np.array([number is None for number, _ in documents], np.uint8).tobytes(),
            np.array([number or 0 for number, _ in documents], "<i8").tobytes(),
            np.array([len(body) // 4 for _, body in documents], "<u8").tobytes(),
        )
    )
    pressed = press.compress(index)
    return b"".join((*parts, pressed, struct.pack("<I", len(pressed))))


@dataclass
class PlaneFile:
    """A file opened for reading; blocks are decompressed when they are asked for."""

    data: bytes

    def __post_init__(self) -> None:
        magic, self.mode, self.block_ids = struct.unpack_from("<8sBI", self.data)
        if magic != MAGIC:
            raise ValueError("not a file of planes")
        (length,) = struct.unpack("<I", self.data[-4:])
        index = zstandard.ZstdDecompressor().decompress(self.data[-4 - length : -4])
        blocks, documents = struct.unpack_from("<II", index)
        planes, at = 32 if self.mode == BITS else 4, 8
        self.counts = np.frombuffer(index, "<u4", blocks, at)
        at += 4 * blocks
        self.lengths = np.frombuffer(index, "<u4", blocks * planes, at).reshape(blocks, planes)
        at += 4 * blocks * planes
        missing = np.frombuffer(index, np.uint8, documents, at)
        numbers = np.frombuffer(index, "<i8", documents, at + documents)
        self.doc_ids = [None if gone else int(n) for n, gone in zip(numbers, missing, strict=True)]
        self.sizes = np.frombuffer(index, "<u8", documents, at + 9 * documents).astype(np.int64)
        ends = np.cumsum(self.lengths.reshape(-1), dtype=np.int64) + struct.calcsize("<8sBI")
        self.places = (ends - self.lengths.reshape(-1)).reshape(self.lengths.shape)

    def block(self, k: int) -> np.ndarray:
        undo = zstandard.ZstdDecompressor()
        planes = [
            undo.decompress(self.data[place : place + length])
            for place, length in zip(self.places[k].tolist(), self.lengths[k].tolist(), strict=True)
        ]
        return unshuffled(planes, int(self.counts[k]), self.mode)

    def read(self, start: int, count: int) -> np.ndarray:
        """Ids of a range, from the blocks that it touches."""
        if count <= 0:
            return np.empty(0, "<u4")
        first, last = start // self.block_ids, (start + count - 1) // self.block_ids
        ids = np.concatenate([self.block(k) for k in range(first, last + 1)])
        return ids[start - first * self.block_ids :][:count]

    def documents(self) -> Iterator[tuple[int | None, int, bytes]]:
        """Each document's id, start in this file, and ids as bytes; a block is decompressed once."""
        start, at, held = 0, -1, np.empty(0, "<u4")
        for number, size in zip(self.doc_ids, self.sizes.tolist(), strict=True):
            parts, need, place = [], size, start
            while need:
                if place // self.block_ids != at:
                    at = place // self.block_ids
                    held = self.block(at)
                part = held[place - at * self.block_ids :][:need]
                parts.append(part.tobytes())
                need, place = need - len(part), place + len(part)
            yield number, start, b"".join(parts)
            start += size


def _writer(vocabulary: str, end_id: int, mode: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(vocabulary).encode, struct.pack("<I", end_id)
        held: list[tuple[int | None, bytes]] = []
        size = sequence = 0
        part = TaskContext.get().partitionId()

        def file() -> pa.RecordBatch:
            columns = [[part], [sequence], [len(held)], [size], [packed(held, mode)]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, ["part", "sequence", "n_docs", "n_ids", "data"])

        for batch in slices(batches, 1):
            numbers = batch.column(0).to_pylist()
            for number, ids in zip(numbers, encode(batch.column(1).to_pylist()), strict=True):
                held.append((number, ids + end))
                size += len(ids) // 4 + 1
                if size >= FILE_IDS:
                    yield file()
                    held, size, sequence = [], 0, sequence + 1
        if held:
            yield file()

    return run


def write_ids(
    docs: DataFrame,
    path: str,
    ident: str = "doc_id",
    text: str = "text",
    vocabulary: str = VOCABULARY,
    end_id: int = END_ID,
    mode: int = BYTES,
) -> None:
    """Encode every text and write the files, in ascending order of ``ident``, as a table at ``path``."""
    body = F.col(f"`{text}`")
    ordered = (
        docs.select(F.col(f"`{ident}`").cast("long").alias("doc_id"), body.alias("text"))
        .repartitionByRange("doc_id", F.xxhash64("text"))
        .sortWithinPartitions("doc_id", F.xxhash64("text"))
    )
    schema = "part int, sequence int, n_docs long, n_ids long, data binary"
    files = ordered.mapInArrow(_writer(vocabulary, end_id, mode), schema)
    files.write.option("compression", "uncompressed").parquet(path)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """Each file's first id in the whole output. Sums per part come first, so no task sees all files."""
    files = spark.read.parquet(path).select("part", "sequence", "n_docs", "n_ids")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = files.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    bases = parts.select("part", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("part").orderBy("sequence").rowsBetween(Window.unboundedPreceding, -1)
    return files.join(bases, "part").select(
        "part", "sequence", "n_docs", "n_ids", (F.col("base") + F.coalesce(F.sum("n_ids").over(inside), F.lit(0))).alias("first_id")
    )


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["part", "sequence", "doc_id", "start_in_file", "n_tokens", "ids_crc32"]
    for batch in batches:
        for row in range(batch.num_rows):
            part, sequence = batch.column(0)[row].as_py(), batch.column(1)[row].as_py()
            found = [(n, s, len(b) // 4, zlib.crc32(b)) for n, s, b in PlaneFile(batch.column(2)[row].as_py()).documents()]
            columns = [list(c) for c in zip(*found, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([part] * len(found), pa.int32()),
                    pa.array([sequence] * len(found), pa.int32()),
                    *[pa.array(c, pa.int64()) for c in columns],
                ],
                names,
            )


def _contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            found = list(PlaneFile(batch.column(0)[row].as_py()).documents())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([n for n, _, _ in found], pa.int64()),
                    pa.array([np.frombuffer(b, "<u4").astype(np.int64) for _, _, b in found], pa.list_(pa.int64())),
                ],
                ["doc_id", "ids"],
            )


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Every document's ids, decoded from the files."""
    return spark.read.parquet(path).select("data").mapInArrow(_contents, "doc_id long, ids array<long>")


def digests(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: its place in the whole output, its length and its checksum."""
    schema = "part int, sequence int, doc_id long, start_in_file long, n_tokens long, ids_crc32 long"
    found = spark.read.parquet(path).select("part", "sequence", "data").mapInArrow(_digests, schema)
    places = written(manifest(spark, path).select("part", "sequence", "first_id"))
    return found.join(places, ["part", "sequence"]).select(
        "doc_id", (F.col("first_id") + F.col("start_in_file")).alias("start"), "n_tokens", "ids_crc32"
    )


def op6_bit_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded, written and read back."""
    path = shared_folder(spark)
    write_ids(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), path)
    return digests(spark, path)
