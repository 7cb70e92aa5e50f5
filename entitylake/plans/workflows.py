"""Investigation workflows built from the search, link and body operators."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entitylake.functions import text as T
from entitylake.functions import tokens as W
from entitylake.operators import bodies as BD
from entitylake.operators import graph as G
from entitylake.operators import joins as J
from entitylake.operators import predicates as P
from entitylake.operators import search as S
from entitylake.operators import shape as SH
from entitylake.session import written


def follow_company(entities: DataFrame, name: str, link_keys: Iterable[str]) -> DataFrame:
    """Who is tied to the companies a phrase finds: ``entity_id, role, source_id``.

    Every link of an entity that names such a company is returned, so a contract that names
    it leads on to the orders and people the contract names; and every link of the companies
    themselves. The few entities that are tied to a company are found first, by a semi join of
    the links with the companies; a second one keeps their links. Only ids of companies and of
    tied entities meet the links, so Spark broadcasts them while they are few.
    """
    links = G.entity_links(entities, link_keys)
    companies = written(S.matching(entities, P.has_phrase(name), schemata="Company").select("id").distinct())
    naming = links.join(companies.select(F.col("id").alias("target_id")), "target_id", "left_semi")
    tied = written(naming.select("source_id").unionByName(companies.select(F.col("id").alias("source_id"))).distinct())
    return links.join(tied, "source_id", "left_semi").select(F.col("target_id").alias("entity_id"), "role", "source_id")


def mentions(
    entities: DataFrame,
    variants: Iterable[str],
    excluded: Iterable[str] = (),
    schemas: Iterable[str] = ("Pages", "Email"),
) -> DataFrame:
    """Documents and mails that hold a name variant and none of the excluded phrases."""
    wanted, unwanted = list(variants), list(excluded)

    def mentioned(line: Column) -> Column:
        found = P.has_any(wanted, line)
        return found & ~P.has_any(unwanted, line) if unwanted else found

    return S.matching(entities, P.on_text(mentioned), schema=list(schemas))


def triage(
    entities: DataFrame,
    collection_id: str,
    where: Column | None = None,
    schemata: Iterable[str] | None = None,
    extra_filters: Mapping[str, str] | None = None,
    date_key: str = "date",
    dates: tuple[str, str] | None = None,
    limit: int | None = None,
    offset: int = 0,
) -> DataFrame:
    """One collection as a table to sort through: ``id, type, title, date``."""
    hits = S.matching(
        entities,
        where,
        collection_id=collection_id,
        schemata=list(schemata) if schemata else None,
        extra_filters=extra_filters,
    )
    if dates:
        hits = hits.filter(P.prop_date_between(date_key, *dates))
    first = lambda key: F.get(P.values(key), F.lit(0))
    return S.page(hits, limit, offset).select(
        "id",
        F.col("schema").alias("type"),
        F.coalesce(first("title"), first("subject"), first("name"), first("fileName")).alias("title"),
        first(date_key).alias("date"),
    )


def hits_per_query(entities: DataFrame, queries: Mapping[str, Column]) -> DataFrame:
    """Hit count of each query, zero included, from a single pass over the entities."""
    names = list(queries)
    counted = entities.agg(
        *[F.count_if(queries[name]).alias(f"n{i}") for i, name in enumerate(names)]
    )
    pairs = F.array(
        *[
            F.struct(F.lit(name).alias("query"), F.col(f"n{i}").alias("n"))
            for i, name in enumerate(names)
        ]
    )
    return counted.select(F.inline(pairs))


def verify_claim(entities: DataFrame, queries: Mapping[str, Column]) -> DataFrame:
    """The same with a verdict, so that queries without a match are reported too."""
    return hits_per_query(entities, queries).withColumn(
        "verdict",
        F.when(F.col("n") == 0, F.lit("no indexed match")).otherwise(F.lit("indexed matches")),
    )


def citations(
    entities: DataFrame,
    phrase: str,
    children: DataFrame | None = None,
    excerpt_chars: int = 200,
) -> DataFrame:
    """``id, schema, link, collection_id, excerpt`` with a verbatim piece of the body.

    The phrase is found by its words, as the search finds it: in any case, with any signs or
    white space between them. Bodies are lower-cased once and tested for the words as plain
    substrings; the pattern looks at what is left, and what stands before the first word is
    looked at only where that word is.

    Bodies are built first and searched afterwards, because the text of a paged file may
    only exist on its pages.
    """
    words = W.literal_words(phrase)
    if not words:
        raise ValueError("a phrase needs at least one word")
    body = F.coalesce("bodyMarkdown", "bodyText")
    side = max(0, (excerpt_chars - len(phrase)) // 2)
    bodies = BD.full_body(entities, children, keep=("link", "collection_id"))
    between, after = W.SEPARATOR_PATTERN, r"(?![\p{L}\p{N}])"

    def pattern(flags: str) -> Column:
        first, *others = [re.escape(word) for word in words]
        return F.lit(rf"{flags}{first}(?<![\p{{L}}\p{{N}}]{first})" + "".join(between + word for word in others) + after)

    def place(lowered: Column) -> Column:
        # Where small letters have another length, places have to come from the body itself.
        even = F.length(lowered) == F.length(body)
        found = F.when(even, F.regexp_instr(lowered, pattern(""))).otherwise(F.regexp_instr(body, pattern("(?iu)")))
        return F.when(reduce(lambda a, b: a & b, [F.contains(lowered, F.lit(word)) for word in words]), found)

    excerpt = T.bind(
        T.bind(F.lower(body), place),
        lambda at: F.when(
            at > 0,
            F.substring(
                body, F.greatest(at - side, F.lit(1)), F.least(at - 1, F.lit(side)) + len(phrase) + side
            ),
        ),
    )
    return bodies.select(
        "id", "schema", "link", "collection_id", SH.evaluated_once(excerpt).alias("excerpt")
    ).filter(F.col("excerpt").isNotNull())


def cross_border(
    entities: DataFrame, names: Iterable[str], countries: Iterable[str], schemata: str = "LegalEntity"
) -> DataFrame:
    """Matching legal entities per country: ``value, n``."""
    wanted = list(countries)
    in_country = reduce(lambda a, b: a | b, [P.prop_eq("countries", c) for c in wanted])
    hits = S.matching(entities, P.has_any(names) & in_country, schemata=schemata)
    counts = S.facets(hits, ["countries"])
    return counts.filter(F.col("value").isin(*wanted)).select("value", "n")
