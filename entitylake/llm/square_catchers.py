"""Periodic runs of words by online catchers of squares over completed power-of-two blocks.

Words are appended one by one. Whenever a block of 4, 8, 16, ... words is complete, a catcher for
it goes on the level of its size B: it waits for the block to come back at a distance from 2B - 1
to 4B - 2. A stretch of q words or more that repeats at such a distance q holds a whole block, so
every square with a half of seven words or more is caught on one level, while its second half is
appended; shorter halves are caught by comparing the last two words at the six distances. What
is caught is extended to its start at once (by less than two blocks) and then word by word: each
appended word advances the comparison of all open stretches or ends them. Squares of one period
that touch are one open stretch, so they merge into a run as they come. A stretch whose period
is a multiple of one that is already open there is not opened: its runs are the shorter one's.

A level is asked only if enough words in a row ended four words seen before, and not inside an
open run that covers all its blocks. Blocks are named by a polynomial hash and compared word by
word before they count. n words cost O(n log n) steps and O(n) memory, periodic or not.

Defined results: a null or empty text has no words and no runs; a row without an id is not
altered by the query; repeated rows are judged one by one; columns of the input stay, those
named like an output column are replaced; an empty table gives none.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence
from itertools import chain
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entitylake.llm.shared import WORD, bind, fresh_name, slices, without, words_of

LEAST_WORDS = 12

#: Distances that are compared directly, and the smallest block.
NEAR = 6
BLOCK = 4

#: Polynomial hash of word numbers, kept to the 30 bits that Python computes with fastest.
MASK, BASE = (1 << 30) - 1, 0x2545F491


_START = itemgetter(1)


class SquareCatchers:
    """Takes words (any hashable values) and gives the runs that they have ended so far."""

    def __init__(self, least: int = LEAST_WORDS) -> None:
        if least < 2 * NEAR:
            raise ValueError(f"runs shorter than {2 * NEAR} words need smaller blocks")
        self.least = least
        self.words: list = []
        self.hashes = [0]
        self.numbers: dict = {}
        #: Where each word, by its number, was last.
        self.latest = [0]
        self.seen: set[int] = set()
        self.near = self.known = 0
        #: Per level: block size, hash factor of a block, starts of completed blocks by name.
        self.levels: list[tuple[int, int, dict[int, list[int]]]] = [(BLOCK, pow(BASE, BLOCK, MASK + 1), {})]
        #: Open stretches: period and start.
        self.open: list[tuple[int, int]] = []
        self.found: dict[tuple[int, int], int] = {}

    def extend(self, words: Iterable) -> None:
        """Appends words, one after the other."""
        numbers, latest, seen, hashes, known_words = self.numbers, self.latest, self.seen, self.hashes, self.words
        near, known, running = self.near, self.known, self.hashes[-1]
        factor = self.levels[0][1]
        i = len(known_words)
        for word in words:
            number = numbers.get(word)
            if number is None:
                number = numbers[word] = len(latest)
                latest.append(i)
                near = 0
            else:
                near = near + 1 if i - latest[number] <= NEAR else 0
                latest[number] = i
            known_words.append(number)
            running = (running * BASE + number) & MASK
            hashes.append(running)
            if self.open:
                self._advance(i, number)
            if near >= 2:
                self._catch_near(i)
            if i >= BLOCK - 1:
                name = (running - hashes[i + 1 - BLOCK] * factor) & MASK
                if name in seen:
                    known += 1
                    self._catch(i, known)
                else:
                    seen.add(name)
                    known = 0
                if not (i + 1) % BLOCK:
                    self._complete(i + 1, name)
            i += 1
        self.near, self.known = near, known

    def runs(self) -> list[tuple[int, int, int]]:
        """Start, length and smallest period of all runs of the words so far, by start, then period."""
        ended = dict(self.found)
        for period, start in self.open:
            self._keep(ended, period, start, len(self.words))
        return sorted(((start, length, period) for (start, length), period in ended.items()), key=lambda r: (r[0], r[2]))

    def _keep(self, found: dict[tuple[int, int], int], period: int, start: int, end: int) -> None:
        length = end - start
        if length >= max(self.least, 2 * period):
            found[start, length] = min(period, found.get((start, length), period))

    def _advance(self, i: int, number: int) -> None:
        words, still = self.words, []
        for stretch in self.open:
            if words[i - stretch[0]] == number:
                still.append(stretch)
            else:
                self._keep(self.found, *stretch, i)
        self.open = still

    def _complete(self, end: int, name: int) -> None:
        """Sets catchers for the blocks that end here; ``name`` is the smallest one's."""
        size, level = BLOCK, 0
        while True:
            starts = self.levels[level][2]
            if name in starts:
                starts[name].append(end - size)
            else:
                starts[name] = [end - size]
            size, level = 2 * size, level + 1
            if end % size:
                return
            if level == len(self.levels):
                self.levels.append((size, pow(BASE, size, MASK + 1), {}))
            name = (self.hashes[end] - self.hashes[end - size] * self.levels[level][1]) & MASK

    def _catch_near(self, i: int) -> None:
        """Compares the last two words at the small distances.

        Not inside a long enough stretch of such a period: a run of twelve words in there would
        have a multiple of that period, and one that leaves it is caught as soon as it does.
        """
        for period, start in self.open:
            if period <= NEAR and i + 1 - start >= self.least + NEAR:
                return
        words = self.words
        for period in range(1, min(NEAR, i - 1) + 1):
            if words[i - period] == words[i] and words[i - 1 - period] == words[i - 1]:
                if not self._is_open(i - 1 - period, period):
                    self._open(i - 1 - period, period)

    def _catch(self, i: int, known: int) -> None:
        """Asks the levels whose blocks end here; ``known`` words in a row ended four words seen before.

        Blocks inside an open stretch come back there at multiples of its period only, if that
        is no longer than the block, so only blocks that start before it are of interest.
        """
        inside, begin = (0, 0) if not self.open else self.open[0] if len(self.open) == 1 else min(self.open, key=_START)
        for size, factor, starts in self.levels:
            if size > known + BLOCK - 1:
                return
            here, least, most = i + 1 - size, 2 * size - 1, 4 * size - 2
            if 0 < inside <= size and (not begin or begin <= here - most):
                continue
            name = (self.hashes[i + 1] - self.hashes[here] * factor) & MASK
            for start in reversed(starts.get(name, ())):
                period = here - start
                if period > most:
                    break
                if period < least or self._is_open(start, period):
                    continue
                if self.words[start : start + size] == self.words[here : i + 1]:
                    self._open(start, period)

    def _is_open(self, start: int, period: int) -> bool:
        """The stretch that holds ``start`` is open with this period or a divisor of it."""
        for other, begun in self.open:
            if begun <= start and not period % other:
                return True
        return False

    def _open(self, start: int, period: int) -> None:
        """Opens a stretch from its first word on."""
        words = self.words
        while start and words[start - 1] == words[start - 1 + period]:
            start -= 1
        self.open.append((period, start))


def runs_of(words: Iterable, least: int = LEAST_WORDS) -> list[tuple[int, int, int]]:
    """Start, length, period of every maximal run."""
    catchers = SquareCatchers(least)
    catchers.extend(words)
    return catchers.runs()


def collapsed(words: Sequence, runs: Iterable[tuple[int, int, int]]) -> list:
    """The words that no run holds behind its first period."""
    left, at = [], 0
    for low, high in sorted((start + period, start + length) for start, length, period in runs):
        left.append(words[at : max(at, low)])
        at = max(at, high)
    return list(chain(*left, words[at:]))


_WORD = re.compile(WORD)
RUNS = T.ArrayType(T.StructType([T.StructField(name, T.LongType()) for name in ("start", "length", "period")]))


def _finder(least: int):
    run = pa.struct([(name, pa.int64()) for name in ("start", "length", "period")])

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 0):
            spans, texts = [], []
            for text in batch.column(0).to_pylist():
                words = _WORD.findall(text or "")
                runs = runs_of(words, least)
                spans.append([{"start": s, "length": n, "period": q} for s, n, q in runs])
                texts.append(" ".join(collapsed(words, runs) if runs else words))
            columns = [*batch.columns[1:], pa.array(spans, pa.list_(run)), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[1:], "runs", "collapsed"])

    return found


def periodic_runs(docs: DataFrame, text: str = "text", least: int = LEAST_WORDS) -> DataFrame:
    """The input with ``runs`` (start, length, period; by start, then period) and ``collapsed``.

    Each row by itself: nothing is shuffled. A text with its words numbered fits a task.
    """
    kept = without(docs, "runs", "collapsed")
    own = fresh_name(kept, "llm_text")
    rows = docs.select(F.col(f"`{text}`").alias(own), *[F.col(f"`{name}`") for name in kept.columns])
    schema = T.StructType([*rows.schema.fields[1:], T.StructField("runs", RUNS), T.StructField("collapsed", T.StringType())])
    return rows.mapInArrow(_finder(least), schema)


def altered(text: Column, ident: Column) -> Column:
    """The text with a periodic end planted, for every tenth document by the hash of its number."""
    h = F.crc32(ident.cast("string"))
    g = F.floor(h / 10)

    def planted(words: Column) -> Column:
        n = F.size(words)
        at = (g % n).cast("int")
        period = (1 + F.floor((n - at) / (3 + g % 8))).cast("int")
        return F.array_join(
            F.transform(words, lambda word, i: F.when(i < at, word).otherwise(F.get(words, at + (i - at) % period))), " "
        )

    return F.when(
        (h % 10 == 0) & text.isNotNull(),
        bind(words_of(text), lambda words: F.when(F.size(words) > 0, planted(words)).otherwise(text)),
    ).otherwise(text)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document, altered as above, with its runs counted and digested."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = periodic_runs(docs.select("doc_id", altered(F.col("text"), F.col("doc_id")).alias("text")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("n"), (-r["start"]).alias("s"), (-r["period"]).alias("q"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *(r[name].cast("string") for name in ("start", "length", "period"))), F.lit("\n")))
    return found.select("doc_id", "runs", "collapsed", best.alias("best"), F.array_join(lines, "").alias("lines")).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.s")).alias("start"),
        F.col("best.n").alias("length"),
        (-F.col("best.q")).alias("period"),
        F.floor(1000 * F.col("best.n") / -F.col("best.q")).cast("long").alias("exponent_milli"),
        F.sha2("lines", 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
