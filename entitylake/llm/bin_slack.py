"""Packing by minimum bin slack: windows of 1024 ids filled from the multiset of remaining lengths.

Documents are cut into whole windows and one rest. The lengths of all rests form a histogram of
at most 1024 numbers, whatever the size of the corpus; it is all that the planner needs. The
planner takes the longest remaining length, finds by subset sums on a bitset the lengths that
fill its window closest to capacity, backtracks the counts, and uses this pattern as often as
the histogram allows. Every step uses up a length (or leaves fewer of it than a pattern holds),
so the steps are bounded by the capacity alone, not by the data.

Pieces find their place without meeting: a piece's rank among those of its length (a prefix sum
of counts per task) falls into the ranks that one pattern takes, and gives window and offset.

Defined results: a null or empty text is a document of the end id alone; repeated rows are
documents of their own; null ids stay; an empty table gives no pieces.
"""

from __future__ import annotations

import struct
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from entitylake.llm.encoder import VOCABULARY, encoder
from entitylake.llm.shared import shared_folder, slices, written

CAPACITY = 1024
END_ID = 0

PIECE = "doc_id long, start long, length long, doc_tokens long, ids binary, task int, serial long"


@dataclass(frozen=True)
class Pattern:
    """Counts of lengths that share a window, and how many windows look like this."""

    counts: tuple[tuple[int, int], ...]
    times: int


def fill(lengths: dict[int, int], capacity: int) -> dict[int, int]:
    """Counts of lengths whose sum comes closest to the capacity from below.

    Bit s of ``sums`` says that s can be reached. Lengths come in descending order, a length
    with count c by doubling; as soon as the capacity itself is reached the rest can wait.
    """
    sums, mask, layers = 1, (1 << capacity + 1) - 1, []
    for length in sorted((x for x in lengths if lengths[x] > 0 and x <= capacity), reverse=True):
        most = min(lengths[length], capacity // length)
        layers.append((length, most, sums))
        left, step = most, 1
        while left:
            step = min(step, left)
            sums |= sums << step * length & mask
            left, step = left - step, 2 * step
        if sums >> capacity & 1:
            break
    total, used = sums.bit_length() - 1, {}
    for length, most, before in reversed(layers):
        for count in range(most + 1):
            if total >= count * length and before >> total - count * length & 1:
                break
        if count:
            used[length] = count
            total -= count * length
    return used


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    """Patterns that use up the histogram."""
    left = {length: count for length, count in histogram.items() if count > 0}
    patterns = []
    while left:
        longest = max(left)
        rest = {**left, longest: left[longest] - 1}
        counts = Counter(fill(rest, capacity - longest))
        counts[longest] += 1
        times = min(left[length] // count for length, count in counts.items())
        patterns.append(Pattern(tuple(sorted(counts.items(), reverse=True)), times))
        for length, count in counts.items():
            left[length] -= times * count
            if not left[length]:
                del left[length]
    return patterns


def table_of(patterns: list[Pattern]) -> list[tuple[int, int, int, int, int, int]]:
    """Per pattern and length: the ranks it takes, its count, its first offset and window."""
    taken: Counter[int] = Counter()
    rows, window = [], 0
    for pattern in patterns:
        offset = 0
        for length, count in pattern.counts:
            rows.append((length, taken[length], taken[length] + count * pattern.times, count, offset, window))
            taken[length] += count * pattern.times
            offset += length * count
        window += pattern.times
    return rows


def _ranks(lengths: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """How many pieces of the same length came before each one; ``seen`` counts them on."""
    order = np.argsort(lengths, kind="stable")
    ordered = lengths[order]
    first = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
    within = np.arange(len(ordered)) - np.repeat(first, np.diff(np.r_[first, len(ordered)]))
    ranks = np.empty(len(lengths), np.int64)
    ranks[order] = within + seen[ordered]
    seen += np.bincount(lengths, minlength=len(seen))
    return ranks


def _cutter(vocabulary: str, end_id: int, capacity: int):
    names = [field.split()[0] for field in PIECE.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(vocabulary).encode, struct.pack("<I", end_id)
        task, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in slices(batches, 1):
            texts = encode(batch.column(1).to_pylist())
            totals = np.array([len(ids) // 4 + 1 for ids in texts], np.int64)
            counts = -(-totals // capacity)
            document = np.repeat(np.arange(len(totals)), counts)
            starts = (np.arange(len(document)) - np.repeat(np.cumsum(counts) - counts, counts)) * capacity
            lengths = np.minimum(capacity, totals[document] - starts)
            # The pieces of all documents lie one after the other in what is joined here.
            edges = np.zeros(len(lengths) + 1, np.int64)
            np.cumsum(4 * lengths, out=edges[1:])
            joined = b"".join(part for ids in texts for part in (ids, end))
            ids = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), len(lengths), [None, pa.py_buffer(edges), pa.py_buffer(joined)]
            ).cast(pa.binary())
            columns = [
                batch.column(0).take(pa.array(document)),
                pa.array(starts),
                pa.array(lengths),
                pa.array(totals[document]),
                ids,
                pa.array(np.full(len(lengths), task, np.int32)),
                pa.array(_ranks(lengths, seen)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def pieces(
    docs: DataFrame,
    ident: str = "doc_id",
    text: str = "text",
    vocabulary: str = VOCABULARY,
    end_id: int = END_ID,
    capacity: int = CAPACITY,
) -> DataFrame:
    """Every document's ids cut into windows and a rest, written once to the shared folder."""
    rows = docs.select(F.col(f"`{ident}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    path = shared_folder(docs.sparkSession)
    rows.mapInArrow(_cutter(vocabulary, end_id, capacity), PIECE).write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.parquet(path)


def placed(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The rows of ``pieces`` (any of its columns besides task, length, serial) with ``sequence_id`` and ``offset``.

    To the driver come one count per length; the planned table has at most a row for each
    length in each pattern, a number bounded by the capacity, and is broadcast.
    """
    spark = cut.sparkSession
    counts = written(cut.groupBy("task", "length").agg(F.count("*").alias("n")))
    histogram = {row["length"]: row["n"] for row in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = spark.createDataFrame(
        table_of(plan(histogram, capacity)), "length long, low long, high long, per_window long, first_offset long, window long"
    )
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    # One row per task, with its base for every length: a fraction of the room of single rows.
    every = F.sequence(F.lit(0).cast("long"), F.lit(capacity).cast("long"))
    found = bases.groupBy("task").agg(F.map_from_entries(F.collect_list(F.struct("length", "base"))).alias("known"))
    lists = found.select("task", F.transform(every, lambda n: F.coalesce(F.try_element_at("known", n), F.lit(0))).alias("bases"))
    ranked = cut.join(lists, "task").withColumn("rank", F.get("bases", F.col("length").cast("int")) + F.col("serial"))
    p, t = ranked.alias("p"), F.broadcast(table).alias("t")
    here = (F.col("p.length") == F.col("t.length")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high"))
    nth = F.col("rank") - F.col("low")
    return p.join(t, here).select(
        *[F.col(f"p.`{name}`") for name in cut.columns],
        (F.col("window") + F.floor(nth / F.col("per_window"))).cast("long").alias("sequence_id"),
        (F.col("first_offset") + nth % F.col("per_window") * F.col("p.length")).cast("long").alias("offset"),
    )


def sequences(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Per sequence its ids as bytes and the ids of its documents in order; a group has at most ``capacity`` ids."""
    row = F.struct("offset", "ids", "doc_id")
    grouped = placed(cut, capacity).groupBy("sequence_id").agg(F.array_sort(F.collect_list(row)).alias("rows"))
    joined = F.aggregate("rows", F.lit(b""), lambda done, x: F.concat(done, x["ids"]))
    return grouped.select("sequence_id", joined.alias("ids"), F.transform("rows", lambda x: x["doc_id"]).alias("doc_ids"))


def packing(docs: DataFrame) -> DataFrame:
    """Per piece its place and checksum. The ids stay where they were written: only checksums move."""
    cut = pieces(docs)
    narrow = cut.select("doc_id", "start", "length", "doc_tokens", F.crc32("ids").alias("ids_crc32"), "task", "serial")
    return placed(narrow).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


def op7_bin_slack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 1024 ids."""
    return packing(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
