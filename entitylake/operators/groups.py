"""First rows of each group when one group may hold much of the table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

# Slices that a group is reduced in before it comes together.
SLICES = 256


def _first(rows: DataFrame, partition: list[str], order: list[Column], n: int) -> DataFrame:
    window = Window.partitionBy(*partition).orderBy(*order)
    return rows.withColumn("place", F.row_number().over(window)).filter(F.col("place") <= n)


def first_in_slices(
    rows: DataFrame, key: str, order: list[Column], n: int, slice_by: str, slices: int = SLICES
) -> DataFrame:
    """The first ``n`` rows of each ``key`` and their ``place``, counted from 1.

    Every group is reduced in slices of ``slice_by`` before it comes together, so a group
    of any size costs its last task ``slices * n`` rows at most. Spark drops what is beyond
    the first ``n`` of a slice before each shuffle, so wide rows move in that number only.
    """
    sliced = rows.withColumn("slice", F.pmod(F.xxhash64(slice_by), F.lit(slices)))
    reduced = _first(sliced, [key, "slice"], order, n).select(*rows.columns)
    return _first(reduced, [key], order, n)
