"""Helpers of the operators: tables in the shared folder, bindings inside expressions, batches."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: What separates words, as code points, and the pattern of a word.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"

#: Most code points of text that a Python function works on at once; longer single texts stay whole.
BATCH_CHARS = 2_000_000


def shared_folder(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``; where that is unset (as in tests), one of our own."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        root = tempfile.mkdtemp(prefix="entitylake-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/llm-{uuid.uuid4().hex}"


def written(table: DataFrame) -> DataFrame:
    """The table, written once to the shared folder and read back.

    Cuts the lineage: a lost executor costs no more than the tasks it ran. The files are
    Parquet, so later reads take only the columns they need, and Spark knows their size.
    """
    path = shared_folder(table.sparkSession)
    table.write.parquet(path)
    return table.sparkSession.read.schema(table.schema).parquet(path)


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, for use inside lambdas."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    """The words of a text as an array; none for a null text."""
    plain = F.translate(F.coalesce(text, F.lit("")), SPACES, " " * len(SPACES))
    return F.filter(F.split(plain, " "), lambda word: word != "")


def fresh_name(table: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of the table has it (case ignored)."""
    taken = {column.lower() for column in table.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def without(table: DataFrame, *names: str) -> DataFrame:
    """The table without columns that an operator is about to add (case ignored)."""
    lowered = {name.lower() for name in names}
    return table.drop(*[column for column in table.columns if column.lower() in lowered])


def slices(batches: Iterator[pa.RecordBatch], text: int) -> Iterator[pa.RecordBatch]:
    """Batches cut so that the text column holds about ``BATCH_CHARS`` bytes at most, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        block = (np.cumsum(sizes, dtype=np.int64) - sizes) // BATCH_CHARS
        edges = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), batch.num_rows]
        for low, high in zip(edges, edges[1:], strict=False):
            yield batch.slice(low, high - low)
