"""Fuzzy lookup of many words at once by deletion neighbourhoods.

Two strings within n edits have a common string that each reaches by deleting n characters or
fewer. This holds for their first ``PREFIX`` characters too: where one prefix reaches further into
the common part than the other, it can drop its last characters, and both together never need
more than n. So every token is stored under all strings that deletions make of its prefix, a
number that depends on n and ``PREFIX`` alone, and a table of words finds its neighbours by an
equality join. Candidates are then compared as whole words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from entitylake.functions import text as T
from entitylake.sources.buckets import BUCKETS, read_buckets, write_buckets

#: Characters of a token from which deletions are made.
PREFIX = 8
MAX_EDITS = 3


def variants(token: Column, n: int) -> Column:
    """The prefix of a token and all that up to ``n`` deletions make of it."""

    def shorter(text: Column) -> Column:
        places = F.when(F.length(text) > 0, F.sequence(F.lit(1), F.length(text))).otherwise(F.array().cast("array<int>"))
        return F.transform(
            places, lambda i: F.concat(F.left(text, i - 1), F.substr(text, i + 1))
        )

    def reach(texts: Column, left: int) -> Column:
        if not left:
            return texts
        return T.bind(
            F.array_distinct(F.concat(texts, F.flatten(F.transform(texts, shorter)))), lambda more: reach(more, left - 1)
        )

    return T.bind(F.left(token, F.lit(PREFIX)), lambda prefix: reach(F.array(prefix), n))


def _edits(n: int) -> int:
    if not 0 <= n <= MAX_EDITS:
        raise ValueError(f"edit distance must be between 0 and {MAX_EDITS}, got {n!r}")
    return n


def neighbourhoods(tokens: DataFrame, n: int = 2) -> DataFrame:
    """``variant, token`` for every distinct token of a dictionary."""
    distinct = tokens.select("token").filter(F.col("token").isNotNull()).distinct()
    return distinct.select(F.explode(variants(F.col("token"), _edits(n))).alias("variant"), "token")


def write_neighbourhoods(table: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    write_buckets(table, path, "variant", "token", buckets=buckets)


def read_neighbourhoods(
    spark: SparkSession, path: str, word: str | None = None, n: int = 2, buckets: int = BUCKETS
) -> DataFrame:
    """The stored table; for one word only the buckets of its variants are opened."""
    if word is None:
        return read_buckets(spark, path, "variant", buckets=buckets)
    literal, made = word.lower()[:PREFIX], set()
    made.add(literal)
    for _ in range(_edits(n)):
        made |= {text[:i] + text[i + 1 :] for text in made for i in range(len(text))}
    return read_buckets(spark, path, "variant", sorted(made), buckets=buckets)


def close_tokens(table: DataFrame, words: DataFrame, n: int = 2) -> DataFrame:
    """``word, token`` for all pairs within ``n`` edits, from a table made for ``n`` or more.

    A token meets a word under several variants; partial aggregation removes the repeats before
    the words are compared.
    """
    asked = words.select(F.lower("word").alias("word")).filter(F.col("word").isNotNull()).distinct()
    wanted = asked.select("word", F.explode(variants(F.col("word"), _edits(n))).alias("variant"))
    near = F.abs(F.length("word") - F.length("token")) <= n
    pairs = wanted.join(table, "variant").filter(near).select("word", "token").distinct()
    compared = pairs.select(F.inline(F.array(F.struct("word", "token"))))
    return compared.filter(F.levenshtein("word", "token", n) >= 0)


def fuzzy_hits(postings: DataFrame, table: DataFrame, words: DataFrame, n: int = 2) -> DataFrame:
    """``word, id``: entities that hold a token within ``n`` edits of a word."""
    close = close_tokens(table, words, n)
    return postings.select("token", "id").distinct().join(close, "token").select("word", "id").distinct()
