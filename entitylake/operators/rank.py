"""Relevance by BM25, over the text itself or over a table of postings."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from entitylake import constants as K
from entitylake.functions import text as T
from entitylake.functions import tokens as W
from entitylake.operators import predicates as P

POSTING_BUCKETS = 256


def _weight(tf: Column, words: Column, df: Column, docs: Column, average: Column) -> Column:
    rarity = F.log(1 + (docs - df + 0.5) / (df + 0.5))
    length = 1 - K.BM25_B + K.BM25_B * words / average
    return rarity * tf * (K.BM25_K1 + 1) / (tf + K.BM25_K1 * length)


def _occurrences(words: Column, term: str) -> Column:
    return F.size(F.filter(words, lambda w: w == term))


def query_terms(query: str) -> list[str]:
    return list(dict.fromkeys(W.literal_words(query)))


# --- Over the text --------------------------------------------------------


def score_text(entities: DataFrame, query: str, words: Column | None = None) -> DataFrame:
    """Entities that hold a query word, with ``score``.

    Words are counted inside each row, so no posting is shuffled: a first pass adds up
    document counts and lengths to one row, a second one scores the rows that match.
    """
    terms = query_terms(query)
    if not terms:
        raise ValueError("a query needs at least one word")
    # The generator hands the counts on as values, so neither the filter below nor the
    # scores split the text again.
    counts = T.bind(
        P.search_words() if words is None else words,
        lambda all_words: F.struct(
            F.size(all_words).alias("length"),
            *[_occurrences(all_words, term).alias(f"tf{i}") for i, term in enumerate(terms)],
        ),
    )
    counted = entities.select("*", F.inline(F.array(counts)))
    corpus = counted.agg(
        F.struct(
            F.count("*").alias("docs"),
            F.avg("length").alias("average"),
            *[F.count_if(F.col(f"tf{i}") > 0).alias(f"df{i}") for i in range(len(terms))],
        ).alias("corpus")
    )
    matched = counted.filter(reduce(lambda a, b: a | b, [F.col(f"tf{i}") > 0 for i in range(len(terms))]))
    corpus_row = corpus.scalar()
    total = reduce(
        add,
        [
            _weight(
                F.col(f"tf{i}"),
                F.col("length"),
                F.col(f"corpus.df{i}"),
                F.col("corpus.docs"),
                F.col("corpus.average"),
            )
            for i in range(len(terms))
        ],
    )
    return matched.withColumn("corpus", corpus_row).select(
        *[c for c in entities.columns if c != "score"], total.alias("score")
    )


# --- Over postings --------------------------------------------------------


def build_postings(entities: DataFrame, text: Column | None = None) -> DataFrame:
    """One row per word occurrence: ``token, id, pos`` and the length of the text."""
    words = P.search_words() if text is None else W.words(text)
    return (
        entities.select("id", words.alias("words"))
        .select("id", F.size("words").alias("length"), F.posexplode("words").alias("pos", "token"))
        .select("token", "id", "pos", "length")
    )


def corpus_stats(entities: DataFrame, text: Column | None = None) -> DataFrame:
    """One row: how many entities there are and their average length in words."""
    words = P.search_words() if text is None else W.words(text)
    return entities.select(F.size(words).alias("length")).agg(
        F.count("*").alias("docs"), F.avg("length").alias("average")
    )


def write_postings(postings: DataFrame, path: str, buckets: int = POSTING_BUCKETS) -> None:
    """Parquet by token bucket, sorted by token inside each file.

    Rebalancing splits a bucket that a very common token fills into files of the advised
    size, and merges small ones, so no task receives all occurrences of a token.
    """
    placed = postings.withColumn("bucket", F.pmod(F.xxhash64("token"), F.lit(buckets)))
    placed.hint("rebalance", F.col("bucket")).sortWithinPartitions("bucket", "token", "id").write.partitionBy(
        "bucket"
    ).parquet(path)


def read_postings(
    spark: SparkSession, path: str, query: str | None = None, buckets: int = POSTING_BUCKETS
) -> DataFrame:
    """The stored postings; with a query only the buckets of its words are opened."""
    stored = spark.read.parquet(path)
    terms = [] if query is None else query_terms(query)
    if terms:
        stored = stored.filter(F.col("bucket").isin(*[F.pmod(F.xxhash64(F.lit(t)), F.lit(buckets)) for t in terms]))
    return stored.select("token", "id", "pos", "length")


def score_postings(postings: DataFrame, stats: DataFrame, query: str) -> DataFrame:
    """``id, score`` from postings; only rows of the query words are read.

    The document counts are one row per query word, so that side is safe to broadcast.
    """
    terms = query_terms(query)
    if not terms:
        raise ValueError("a query needs at least one word")
    counts = (
        postings.filter(F.col("token").isin(*terms))
        .groupBy("token", "id")
        .agg(F.count("*").alias("tf"), F.first("length").alias("length"))
    )
    frequency = counts.groupBy("token").agg(F.count("*").alias("df"))
    row = stats.select(F.struct("docs", "average").alias("corpus")).scalar()
    weighted = counts.join(F.broadcast(frequency), "token").withColumn("corpus", row)
    weight = _weight(
        F.col("tf"), F.col("length"), F.col("df"), F.col("corpus.docs"), F.col("corpus.average")
    )
    return weighted.groupBy("id").agg(F.sum(weight).alias("score"))


def dictionary(postings: DataFrame) -> DataFrame:
    """Each token once, with the number of its occurrences."""
    return postings.groupBy("token").agg(F.count("*").alias("n"))


def fuzzy_tokens(tokens: DataFrame, term: str, n: int = 2) -> DataFrame:
    """Tokens within edit distance ``n``.

    The comparison runs once per distinct token: the generator keeps the optimizer from
    moving it below the grouping, where it would run once per occurrence.
    """
    distinct = tokens.select(F.explode(F.array("token")).alias("token"))
    return distinct.filter(P.is_close(F.col("token"), term.lower(), n))


def fuzzy_ids(postings: DataFrame, term: str, n: int = 2) -> DataFrame:
    """Ids of entities that hold a word close to ``term``."""
    close = fuzzy_tokens(dictionary(postings), term, n)
    return postings.select("token", "id").join(close, "token", "left_semi").select("id").distinct()
