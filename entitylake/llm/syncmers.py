"""Document fingerprints of closed syncmers, compared by position.

Of all substrings of k code points a closed syncmer is one whose smallest inner substring of s
code points (by hash) starts at its first or last place. Whether a substring is chosen depends
on itself alone, so passages shared by two texts give the same anchors in both, whatever stands
around them, and every k - s + 1 places in a row hold one at least.

A fingerprint lists all anchors of the whole text in order, each as 24 bits of its hash and the
distance from the one before (below 256 by the bound above), in base 64. Two fingerprints are
compared by the anchors that they share at the same offset as a neighbouring shared anchor:
likeness is twice their number by the number of all anchors, 0 to 1.

Short texts use shorter substrings (``SIZES``), so that every text that is not empty has anchors.

Defined results: a null text is empty; the fingerprint of an empty text is the empty string,
and two empty ones are alike with 1; equal texts have equal fingerprints; documents with equal
ids are ordered by the hash of their text, null ids come last in descending order; a single
document is its own next one; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entitylake.llm.shared import slices, without

#: From how many code points on which k and s are used.
SIZES = ((128, 32, 8), (48, 8, 3), (12, 3, 1), (0, 1, 1))

#: Code points of text per range of ids, about, and ranges at most: their edges go to every task, 8 bytes each.
RANGE_CHARS = 1_000_000
RANGES = 1_000_000

_MIX = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xD6E8FEB86659FD93


class _Powers:
    """Powers of the base and of its inverse, modulo 2^64; the tables grow by doubling."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, count: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.up) < count:
            size = len(self.up)
            self.up = np.concatenate([self.up, self.up * np.uint64(pow(_BASE, size, 1 << 64))])
            self.down = np.concatenate([self.down, self.down * np.uint64(pow(pow(_BASE, -1, 1 << 64), size, 1 << 64))])
        return self.up, self.down


_POWERS = _Powers()


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * _MIX
    return values ^ (values >> np.uint64(29))


def _window_hashes(sums: np.ndarray, down: np.ndarray, places: np.ndarray | slice, length: int) -> np.ndarray:
    """Hashes of the substrings of a length at some places, from running sums."""
    if isinstance(places, slice):
        found = (sums[length:] - sums[:-length]) * down[: len(sums) - length]
    else:
        found = (sums[places + length] - sums[places]) * down[places]
    return _mixed(found)


def _minima(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each window, by doubling."""
    found, reach = values, 1
    while 2 * reach <= width:
        found, reach = np.minimum(found[:-reach], found[reach:]), 2 * reach
    if reach < width:
        found = np.minimum(found[: len(values) - width + 1], found[width - reach :])
    return found


def anchors(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashes (24 bits) and places of the closed syncmers of a text."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    if not len(codes):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    _, k, s = next(size for size in SIZES if len(codes) >= size[0])
    up, down = _POWERS.upto(len(codes) + 1)
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * up[: len(codes)], out=sums[1:])
    inner = _window_hashes(sums, down, slice(None), s)
    width = k - s + 1
    least = _minima(inner, width)
    places = np.flatnonzero((inner[: len(least)] == least) | (inner[width - 1 :] == least))
    return _window_hashes(sums, down, places, k) >> np.uint64(40), places


@dataclass(frozen=True)
class Fingerprint:
    """The anchors of a text."""

    hashes: np.ndarray
    places: np.ndarray

    @classmethod
    def of(cls, text: str) -> Fingerprint:
        return cls(*anchors(text))

    @classmethod
    def parsed(cls, shown: str) -> Fingerprint:
        packed = np.frombuffer(base64.b64decode(shown), "<u4").astype(np.uint64)
        return cls(packed >> np.uint64(8), np.cumsum((packed & np.uint64(255)).astype(np.int64)))

    @cached_property
    def shown(self) -> str:
        gaps = np.diff(self.places, prepend=0).astype(np.uint64)
        return base64.b64encode((self.hashes << np.uint64(8) | gaps).astype("<u4").tobytes()).decode("ascii")

    @cached_property
    def keyed(self) -> tuple[np.ndarray, np.ndarray]:
        """Different keys in ascending order (hash, and which of its occurrences), with their places."""
        order = np.argsort(self.hashes, kind="stable")
        ranked = self.hashes[order]
        new = np.ones(len(ranked), bool)
        new[1:] = ranked[1:] != ranked[:-1]
        count = np.arange(len(ranked))
        nth = count - np.maximum.accumulate(np.where(new, count, 0))
        return ranked << np.uint64(32) | nth.astype(np.uint64), self.places[order]

    def likeness(self, other: Fingerprint) -> float:
        total = len(self.places) + len(other.places)
        if not total:
            return 1.0
        (keys, mine), (others, theirs) = self.keyed, other.keyed
        if not len(keys) or not len(others):
            return 0.0
        at = np.minimum(np.searchsorted(others, keys), len(others) - 1)
        shared = others[at] == keys
        left, right = mine[shared], theirs[at[shared]]
        order = np.argsort(left, kind="stable")
        offset = left[order] - right[order]
        if min(len(self.places), len(other.places)) == 1:
            matches = len(offset)
        else:
            like = np.zeros(len(offset), bool)
            same = offset[1:] == offset[:-1]
            like[1:] |= same
            like[:-1] |= same
            matches = int(like.sum())
        return 2 * matches / total


def fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """The input with the ``fingerprint`` of its text."""

    @F.pandas_udf("string")
    def shown(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for series in texts:
            yield pd.Series([Fingerprint.of(x or "").shown for x in series], dtype=object)

    return without(docs, "fingerprint").withColumn("fingerprint", shown(F.col(f"`{text}`")))


def _edges(rows: DataFrame) -> list[int]:
    """Ids that end the ranges, and the largest id.

    A document ends a range with a chance in proportion to its text, by a hash of its id, so ranges
    hold about ``RANGE_CHARS`` of text whatever the lengths, and their number grows with the table
    (beyond ``RANGES`` of them the ranges do).
    """
    chars = (F.length(F.coalesce("text", F.lit(""))) + 1).cast("double")
    total, largest = rows.agg(F.sum(chars), F.max("doc_id")).first()
    share = chars / max(float(RANGE_CHARS), (total or 0.0) / RANGES)
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) / float(1 << 40)
    found = {row[0] for row in rows.where(F.col("doc_id").isNotNull() & (draw < share)).select("doc_id").distinct().collect()}
    return sorted(found if largest is None else found | {largest})


def with_next(docs: DataFrame, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (bucket, guest, doc_id, text) so sorted that each document is followed by its next one.

    Ids are cut into ranges that end at ids of the table. The first document of a range, in
    descending order, is the next one of the last document of the range above: it is sent
    there too, as a guest that closes the range. So texts are shuffled once, no window or
    task sees all rows, and the largest id closes the lowest range.
    """
    rows = docs.select(F.col(f"`{ident}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    edges = np.array(_edges(rows), np.int64)

    @F.pandas_udf("array<struct<bucket: int, guest: int>>")
    def places(ids: pd.Series) -> pd.Series:
        numbers, missing = ids.fillna(0).astype("int64").to_numpy(), ids.isna().to_numpy()
        at = np.searchsorted(edges, numbers)
        at[missing] = 0
        found = []
        for number, bucket, gone in zip(numbers.tolist(), at.tolist(), missing.tolist(), strict=True):
            own = [{"bucket": bucket, "guest": 0}]
            if not gone and edges[bucket] == number:
                own.append({"bucket": (bucket + 1) % len(edges), "guest": 1})
            found.append(own)
        return pd.Series(found)

    return (
        rows.select("doc_id", "text", F.explode(places("doc_id")).alias("place"))
        .select("place.bucket", "place.guest", "doc_id", "text")
        .repartition("bucket")
        .sortWithinPartitions("bucket", "guest", F.col("doc_id").desc_nulls_last(), F.xxhash64("text"))
    )


@dataclass
class _Document:
    bucket: int
    doc_id: int | None
    text: str

    @cached_property
    def fingerprint(self) -> Fingerprint:
        return Fingerprint.of(self.text)


def _followed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[_Document, _Document]]:
    """Each document with its next one, from the rows of ``with_next``."""
    first = held = None
    for batch in slices(batches, 3):
        for bucket, guest, number, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if held is not None and bucket != held.bucket:
                yield held, first
                first = held = None
            if guest and held is None:
                continue  # a second guest with the same id
            row = _Document(bucket, number, text or "")
            if held is not None:
                yield held, row
            if guest:
                first = held = None
            else:
                first, held = first or row, row
    if held is not None:
        yield held, first


NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
KINDS = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
ROWS = 256


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), KINDS, strict=True)], NAMES)

    done = []
    for own, after in _followed(batches):
        count = len(own.text)
        edited = own.text[: count - count // 2] + after.text[: count // 2]
        mark, changed = own.fingerprint, Fingerprint.of(edited)
        digest = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
        near = mark.likeness(changed), mark.likeness(after.fingerprint)
        done.append((own.doc_id, count, digest, mark.shown, changed.shown, *near))
        if len(done) == ROWS:
            yield batch(done)
            done = []
    if done:
        yield batch(done)


def compared(docs: DataFrame, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document its fingerprint, that of its text with the second half replaced, and their likeness."""
    schema = (
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )
    return with_next(docs, ident, text).mapInArrow(_compared, schema)


def op8_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against their edited texts and their next documents."""
    return compared(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
