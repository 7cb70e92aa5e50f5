"""Phrases and proximity over stored postings, by merging sorted positions.

Only rows of the query's words are read (``rank.read_postings`` opens their buckets). Positions
come together per entity, which bounds a group by the length of one text.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entitylake.functions import text as T
from entitylake.functions import tokens as W


def _positions(postings: DataFrame, words: list[str]) -> DataFrame:
    """Entities that hold every word, with the sorted places of each: ``id, places0, places1, ...``."""
    lists = [
        F.array_sort(F.collect_list(F.when(F.col("token") == word, F.col("pos")))).alias(f"places{i}")
        for i, word in enumerate(words)
    ]
    found = postings.filter(F.col("token").isin(*words)).groupBy("id").agg(*lists)
    return found.filter(reduce(lambda a, b: a & b, [F.size(f"places{i}") > 0 for i in range(len(words))]))


def phrase_starts(postings: DataFrame, phrase: str) -> DataFrame:
    """``id, starts``: where the words of a phrase stand next to each other.

    Places of each word are shifted back by its offset in the phrase; what is left of their
    intersection are the starts. The rarest lists are merged like the others: intersections
    only get shorter.
    """
    words = W.literal_words(phrase)
    if not words:
        raise ValueError("a phrase needs at least one word")
    distinct = list(dict.fromkeys(words))

    def shifted(word: str, offset: int) -> Column:
        return F.transform(f"places{distinct.index(word)}", lambda pos: pos - offset)

    starts = reduce(F.array_intersect, [shifted(word, offset) for offset, word in enumerate(words)])
    return _positions(postings, distinct).select("id", starts.alias("starts")).filter(F.size("starts") > 0)


def phrase_ids(postings: DataFrame, phrase: str) -> DataFrame:
    """Ids of entities that hold the phrase; equal to ``predicates.has_phrase`` over the texts."""
    return phrase_starts(postings, phrase).select("id")


def near_ids(postings: DataFrame, terms: Iterable[str], n: int) -> DataFrame:
    """Ids of entities with all terms within ``n`` words; equal to ``predicates.near`` over the texts.

    The places of all terms are merged into one sorted list. A window that starts at a place ends
    ``n`` words later, so it holds ``n + 1`` places at most: those that follow in the list.
    """
    words = list(dict.fromkeys(w for term in terms for w in W.literal_words(term)))
    if not words:
        raise ValueError("proximity needs at least one word")

    def marked(i: int) -> Column:
        return F.transform(f"places{i}", lambda pos: F.struct(pos.alias("pos"), F.lit(i).alias("term")))

    merged = F.array_sort(F.flatten(F.array(*[marked(i) for i in range(len(words))])))

    def together(places: Column) -> Column:
        def complete(first: Column, i: Column) -> Column:
            inside = F.filter(F.slice(places, i + 1, F.lit(n + 1)), lambda p: p["pos"] <= first["pos"] + n)
            return F.size(F.array_distinct(F.transform(inside, lambda p: p["term"]))) == len(words)

        return F.exists(F.transform(places, complete), lambda found: found)

    return _positions(postings, words).filter(T.bind(merged, together)).select("id")
