"""Lookup tables on shared storage: rows by the hash of a key, sorted by it inside each file.

A lookup opens only the directories of its keys, and row groups outside them are skipped by
their statistics.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 256


def bucket_of(key: Column, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets))


def write_buckets(table: DataFrame, path: str, key: str, *order: str, buckets: int = BUCKETS) -> None:
    """Parquet with a directory per bucket, sorted by key and ``order``.

    Rebalancing splits a bucket that one very common key fills into files of the advised size,
    and merges small ones, so no task receives all rows of a key.
    """
    placed = table.withColumn("bucket", bucket_of(F.col(key), buckets))
    placed.hint("rebalance", F.col("bucket")).sortWithinPartitions("bucket", key, *order).write.partitionBy(
        "bucket"
    ).parquet(path)


def read_buckets(
    spark: SparkSession, path: str, key: str, wanted: Iterable[str] | None = None, buckets: int = BUCKETS
) -> DataFrame:
    """The stored table, or its rows with one of the wanted keys."""
    stored = spark.read.parquet(path)
    if wanted is not None:
        keys = list(dict.fromkeys(wanted))
        stored = stored.filter(
            F.col("bucket").isin(*[bucket_of(F.lit(k), buckets) for k in keys]) & F.col(key).isin(*keys)
        )
    return stored.drop("bucket")
