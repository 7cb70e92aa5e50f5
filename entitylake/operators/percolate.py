"""Many saved queries at once, kept as a table.

A saved query asks for words, phrases and exact filters, all of them required, and may exclude
words or phrases. Its conditions become tokens: the words themselves, and one token per filter.
The rarest token of a query is its key. Entities meet a query only through its key, so the work
follows the number of candidates, not entities times queries; candidates are then verified on the
entity. The plan is the same for one query and for a million. Hits are counted another way, in
cells of entities and queries, because the pairs of both can be too many to be rows.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entitylake.functions import tokens as W
from entitylake.operators import predicates as P
from entitylake.operators import tally as T
from entitylake.session import written

#: One saved query. ``words`` and ``excluded`` may hold phrases; ``filters`` names properties,
#: ``schema``, ``schemata``, ``collection_id`` or ``dataset``. NULL means no such condition.
SAVED_QUERY = "query_id string, words array<string>, excluded array<string>, filters map<string,string>"

#: Between a filter's name and its value; no word holds it.
_MARK = "\x00"
_ANY = _MARK + "any"
_OUTER = ("schema", "collection_id", "dataset")

#: Entities of a span at least, and spans at most.
BLOCK = 2048
SPANS = 24
#: Queries and conditions of a chunk at most: a task holds them.
CHUNK = 1_000_000
CHUNK_CONDITIONS = 4_000_000
#: Conditions that are known by a short number, and bits that tell what is asked for at all.
COMMON = 1_000_000
MOST_BITS = 1 << 28
#: Bits of one bitmap that Spark makes.
PAGE = 32_768


def _lines(phrases: Column) -> Column:
    """Each phrase as `` word word ``; blank ones are dropped."""
    some = F.coalesce(phrases, F.array().cast("array<string>"))
    return F.array_distinct(F.filter(F.transform(some, W.word_line), lambda line: F.trim(line) != ""))


def _filter_tokens(filters: Column) -> Column:
    pairs = F.coalesce(F.map_entries(filters), F.array().cast("array<struct<key:string,value:string>>"))
    wanted = F.filter(pairs, lambda p: p["value"].isNotNull() & (F.trim(p["key"]) != ""))
    return F.transform(
        wanted, lambda p: F.concat(F.regexp_replace(F.trim(p["key"]), r"\Aproperties\.", ""), F.lit(_MARK), p["value"])
    )


def prepared(queries: DataFrame) -> DataFrame:
    """Saved queries with their conditions as tokens: ``query_id, lines, unwanted, facts, tokens``."""
    read = queries.select(
        "query_id",
        _lines(F.col("words")).alias("lines"),
        _lines(F.col("excluded")).alias("unwanted"),
        F.array_distinct(_filter_tokens(F.col("filters"))).alias("facts"),
    )
    words = F.flatten(F.transform("lines", lambda line: F.split(F.trim(line), " ")))
    every = F.array_distinct(F.concat(words, F.col("facts")))
    return read.withColumn("tokens", F.when(F.size(every) == 0, F.array(F.lit(_ANY))).otherwise(every))


def _facts() -> Column:
    """What filters can ask for: outer columns, types above, and property values."""
    named = lambda name, value: F.concat(F.lit(name + _MARK), value)
    none = F.array().cast("array<string>")
    outer = F.filter(F.array(*[named(name, F.col(name)) for name in _OUTER]), lambda x: x.isNotNull())
    above = F.transform(F.coalesce("schemata", none), lambda name: named("schemata", name))
    values = F.flatten(
        F.transform(
            F.coalesce(F.map_entries("props"), F.array().cast("array<struct<key:string,value:array<string>>>")),
            lambda p: F.transform(F.coalesce(p["value"], none), lambda v: F.concat(p["key"], F.lit(_MARK), v)),
        )
    )
    parents = F.transform(F.coalesce("document_ids", none), lambda v: named("document", v))
    return F.array_distinct(F.concat(outer, above, values, parents))


def candidates(entities: DataFrame, saved: DataFrame) -> DataFrame:
    """``id`` and query of every entity that holds the query's rarest token.

    ``saved`` is a written table of prepared queries. Only (token, id) rows of tokens that some
    query asks for are kept, and written once: they are counted and then joined. Queries with a
    token that no entity has are out at once.
    """
    vocabulary = saved.select(F.explode("tokens").alias("token")).distinct()
    held = F.array_distinct(F.concat(P.search_words(), _facts(), F.array(F.lit(_ANY))))
    found = written(
        entities.filter(F.col("id").isNotNull())
        .select("id", F.explode(held).alias("token"))
        .join(vocabulary, "token", "left_semi")
    )
    frequency = found.groupBy("token").agg(F.count("*").alias("n"))
    asked = saved.select("query_id", F.explode("tokens").alias("token")).join(frequency, "token", "left")
    keys = asked.groupBy("query_id").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token")).alias("rarest")
    )
    keys = keys.filter("rarest.n > 0").select("query_id", F.col("rarest.token").alias("token"))
    return found.join(keys, "token").select("id", "query_id").distinct()


def percolate(entities: DataFrame, queries: DataFrame) -> DataFrame:
    """``query_id, id`` of every entity that satisfies a saved query.

    Candidates carry ids only; they meet the entities' texts in one join by id, where each
    entity's word line is made once, however many queries it is a candidate for.
    """
    saved = written(prepared(queries))
    pairs = candidates(entities, saved).join(saved.drop("tokens"), "query_id")
    texts = entities.filter(F.col("id").isNotNull()).select(
        "id", F.inline(F.array(F.struct(P.search_line().alias("line"), _facts().alias("held"))))
    )
    holds = lambda wanted: F.contains(F.col("line"), wanted)
    return (
        pairs.join(texts, "id")
        .filter(
            F.forall("lines", holds)
            & F.forall("facts", lambda fact: F.array_contains("held", fact))
            & ~F.exists("unwanted", holds)
        )
        .select("query_id", "id")
        .distinct()
    )


def _hashed(tokens: Column) -> Column:
    return F.transform(tokens, lambda token: F.xxhash64(token))


def _condition(token: Column) -> Column:
    """A condition as the hashes of its words; a fact is a word."""
    return _hashed(F.when(F.contains(token, F.lit(_MARK)), F.array(token)).otherwise(F.split(token, " ")))


def _numbered(queries: DataFrame) -> DataFrame:
    """``query_id, ask, ways``: each query once, by a number, with its different ways to be satisfied."""
    plain = lambda lines: F.transform(lines, lambda line: F.trim(line))
    every = F.array_distinct(F.concat(plain("lines"), F.col("facts")))
    must = F.when(F.size(every) == 0, F.array(F.lit(_ANY))).otherwise(every)
    way = F.struct(
        F.transform(F.array_sort(must), _condition).alias("must"),
        F.transform(F.array_sort(plain("unwanted")), _condition).alias("never"),
    )
    # A query without an id is no query; its row stays, with a count of zero.
    ways = F.collect_set(F.when(F.col("query_id").isNotNull(), way))
    return prepared(queries).groupBy("query_id").agg(ways.alias("ways")).withColumn("ask", F.monotonically_increasing_id())


def _asked(queries: DataFrame, chunks: int, most: int) -> tuple[T.Known, dict[int, np.ndarray]]:
    """What queries ask for most, and for each chunk a bit by the end of each hash. Both are
    bounded; ``most`` is about the number of a chunk's conditions."""
    hashes = queries.select("chunk", F.explode(F.concat("must", "never")).alias("hash"))
    often = written(hashes.groupBy("hash").agg(F.count("*").alias("n")))
    # How many hashes are asked for so often; that these numbers are different keeps them few.
    sizes = sorted(((row.n, row["count"]) for row in often.groupBy("n").count().collect()), reverse=True)
    least = [n for (n, _), total in zip(sizes, accumulate(count for _, count in sizes), strict=True) if total <= COMMON]
    top = often.filter(F.col("n") >= least[-1] if least else F.lit(False)).toArrow()
    order = np.lexsort((top["hash"].to_numpy(), -top["n"].to_numpy()))
    known = T.Known(top["hash"].to_numpy()[order].view(np.uint64), len(least) == len(sizes))

    size = max(min(1 << (16 * most).bit_length(), 1 << (MOST_BITS // chunks).bit_length() - 1), PAGE)
    at = F.pmod("hash", F.lit(size))
    pages = hashes.groupBy("chunk", (at / PAGE).cast("int").alias("page")).agg(F.bitmap_construct_agg(at % PAGE).alias("bits"))
    bits: dict[int, np.ndarray] = {}
    for row in pages.collect():
        of_chunk = bits.setdefault(row.chunk, np.zeros(size // 8, np.uint8))
        of_chunk[row.page * PAGE // 8 :][: PAGE // 8] = np.frombuffer(row.bits, np.uint8)
    return known, bits


def _tallied(entities: DataFrame, saved: DataFrame) -> DataFrame:
    """``ask, n`` of the queries that some entity satisfies, without a row per pair.

    ``saved`` is a written table of numbered queries. Entities keep hashes of what they hold of the
    conditions, and each cell of one span of entities and one chunk of queries is counted by itself
    (``tally``). Entities travel once per chunk and queries once per span; chunks are as large
    as a task can hold and spans at most ``SPANS``, so what is shuffled does not follow the cells.
    """
    ways = saved.select("ask", F.inline("ways"))
    lengths = ways.select(F.explode(F.concat("must", "never")).alias("words")).groupBy(F.size("words").alias("n")).count().collect()
    some = entities.filter(F.col("id").isNotNull())
    conditions = sum(row["count"] for row in lengths)
    chunks = max(-(-saved.count() // CHUNK), -(-conditions // CHUNK_CONDITIONS), 1)
    spans = min(-(-some.count() // BLOCK) or 1, SPANS)
    by = lambda name, n: F.pmod(F.xxhash64(name), F.lit(n)).cast("int")

    hashed = written(ways.select(by("ask", chunks).alias("chunk"), "*").mapInArrow(T.hashed, T.HASHED))
    known, bits = _asked(hashed, chunks, conditions // chunks)
    facts = F.filter(F.concat(_facts(), F.array(F.lit(_ANY))), lambda fact: fact.isNotNull())
    held = some.select(
        F.xxhash64("id").alias("key"), _hashed(P.search_words()).alias("words"), _hashed(facts).alias("facts")
    ).mapInArrow(T.holdings([row.n for row in lengths], known, bits), T.HELD)
    cells = (
        hashed.mapInArrow(T.packs(known), T.PACKED)
        .select("*", F.explode(F.sequence(F.lit(0), F.lit(spans - 1))).alias("span"))
        .unionByName(held.withColumn("span", by("key", spans)), allowMissingColumns=True)
        .repartitionById(chunks * spans, F.col("chunk") * spans + F.col("span"))
        .sortWithinPartitions(F.asc_nulls_first("key"))
    )
    return cells.mapInArrow(T.cell(known), T.FOUND).groupBy("ask").agg(F.sum("n").alias("n"))


def hits_per_saved_query(entities: DataFrame, queries: DataFrame) -> DataFrame:
    """``query_id, n``: distinct entities per saved query, zero included."""
    saved = written(_numbered(queries))
    counts = _tallied(entities, saved)
    return saved.join(counts, "ask", "left").select("query_id", F.coalesce("n", F.lit(0)).alias("n"))


def verify_claims(entities: DataFrame, queries: DataFrame) -> DataFrame:
    """The same with a verdict, so that queries without a match are reported too."""
    verdict = F.when(F.col("n") == 0, F.lit("no indexed match")).otherwise(F.lit("indexed matches"))
    return hits_per_saved_query(entities, queries).withColumn("verdict", verdict)


def saved_query(
    query_id: Column,
    words: Column | None = None,
    excluded: Column | None = None,
    filters: Column | None = None,
) -> list[Column]:
    """The columns of a table of saved queries from columns of any table."""
    no_list, no_map = F.lit(None).cast("array<string>"), F.lit(None).cast("map<string,string>")
    return [
        query_id.alias("query_id"),
        (no_list if words is None else words).alias("words"),
        (no_list if excluded is None else excluded).alias("excluded"),
        (no_map if filters is None else filters).alias("filters"),
    ]
