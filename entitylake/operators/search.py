"""Search over the entity table: filter, rank, page, facet and highlight."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, BooleanType, DateType, NumericType, StringType, TimestampType

from entitylake import constants as K
from entitylake.functions import bounds as B
from entitylake.functions import text as T
from entitylake.operators import predicates as P
from entitylake.operators import rank as R
from entitylake.operators.groups import first_in_slices
from entitylake.session import written


def matching(
    entities: DataFrame,
    where: Column | None = None,
    *,
    collection_id: str | None = None,
    schema: str | Iterable[str] | None = None,
    schemata: str | Iterable[str] | None = None,
    closure: DataFrame | None = None,
    extra_filters: Mapping[str, str | None] | None = None,
) -> DataFrame:
    """All entities that satisfy every argument given.

    An extra filter on the collection, or on the schema when one schema is asked for,
    replaces that argument. Outer columns are filtered first, so type and collection
    reach the scan before any text is looked at.
    """
    names, upper = B.schema_names(schema), B.schema_names(schemata)
    extra = {k.strip(): v for k, v in (extra_filters or {}).items() if k.strip() and v is not None}
    rows = entities
    if collection_id and "collection_id" not in extra:
        rows = rows.filter(P.in_collection(collection_id))
    if names and not (len(names) == 1 and "schema" in extra):
        rows = rows.filter(P.schema_in(names))
    if extra:
        rows = rows.filter(P.extra_filters(extra))
    if upper:
        rows = (
            rows.filter(P.schemata_in(upper))
            if closure is None
            else P.with_descendants(rows, upper, closure)
        )
    return rows if where is None else rows.filter(where)


def _place(score: Column, ident: Column) -> Column:
    """What hits are ordered by, as one value: best score first, none last, ties by id."""
    number = F.coalesce(score, F.lit(0.0))
    return F.struct(
        score.isNull().alias("unscored"),
        (~F.isnan(number)).alias("finite"),
        F.when(F.isnan(number), F.lit(0.0)).otherwise(-number).alias("below"),
        ident.alias("id"),
    )


_PLACE_TYPES = {"unscored": "boolean", "finite": "boolean", "below": "double", "id": "string", "tie": "long"}


_PLAIN = (StringType, NumericType, BooleanType, DateType, TimestampType, BinaryType)


def _full_place(hits: DataFrame) -> Column:
    """The place, and a hash of the row's plain columns after it: hits that share score and id
    (missing or repeated ids) keep one order, whatever the partitions."""
    place = _place(F.col("score").cast("double"), F.col("id"))
    plain = [F.col(f"`{f.name}`") for f in hits.schema.fields if isinstance(f.dataType, _PLAIN)]
    return F.struct(*[place[name].alias(name) for name in _PLACE_TYPES if name != "tie"], F.xxhash64(*plain).alias("tie"))


def _place_at(keys: DataFrame, sizes: dict[int, int], rank: int) -> tuple[Row | None, int]:
    """The place of the hit at a rank (from 0), and how many hits before it share that place.

    ``keys`` are sorted parts; only the part that holds the rank is read.
    """
    before = 0
    for part in sorted(sizes):
        if rank < before + sizes[part]:
            inside = keys.filter(F.col("part") == part).groupBy("place").agg(F.count("*").alias("n"))
            upto = inside.withColumn("upto", F.sum("n").over(Window.orderBy("place")))
            found = upto.filter(F.col("upto") > rank - before).orderBy("place").first()
            return found["place"], rank - before - (found["upto"] - found["n"])
        before += sizes[part]
    return None, 0


def _from_rank(hits: DataFrame, skip: int) -> DataFrame:
    """The hits from a rank on, without sorting those before it.

    The places of all hits are written once, dealt into sorted parts by range, and the parts'
    sizes tell which one holds the rank.
    """
    places = written(hits.select(_full_place(hits).alias("place")))
    keys = written(places.repartitionByRange("place").withColumn("part", F.spark_partition_id()))
    sizes = {row["part"]: row["n"] for row in keys.groupBy("part").agg(F.count("*").alias("n")).collect()}
    first, passed = _place_at(keys, sizes, skip)
    if first is None:
        return hits.limit(0)
    start = F.struct(*[F.lit(first[k]).cast(t).alias(k) for k, t in _PLACE_TYPES.items()])
    here = _full_place(hits)
    rest = hits.filter(here >= start)
    if passed:
        # Rows alike in all plain columns: some of them belong to the pages before.
        tied = rest.filter(here == start).offset(passed)
        rest = tied.unionByName(rest.filter(here > start))
    return rest


def page(
    hits: DataFrame,
    limit: int | None = None,
    offset: float | None = 0,
    after: tuple[float | None, str | None] | None = None,
) -> DataFrame:
    """One page of the hits, best score first, ties by id, then by a hash of the row.

    A page that ends within the largest page is a top-k: of the best ``offset + limit`` hits the
    last ``limit`` are numbered off. Further on, the places of all hits are written in sorted
    parts and the hits from the page's first place on make the page: no task sees the skipped
    hits. Hits with equal places are rows of their own, whether ids are missing or repeated.
    ``after`` continues behind the last (score, id) of a page and needs no count; hits equal to it
    are behind it.
    """
    skip, size = B.clean_offset(offset), B.clamp_limit(limit)
    if after is not None:
        last = _place(F.lit(after[0]).cast("double"), F.lit(after[1]).cast("string"))
        hits = hits.filter(_place(F.col("score").cast("double"), F.col("id")) > last)
    if skip and size is not None and skip + size <= K.MAX_SEARCH_LIMIT:
        # Both sort by the same key, and the second one sees the few best hits only.
        best = hits.withColumn("hit_place", _full_place(hits)).orderBy("hit_place").limit(skip + size)
        numbered = best.withColumn("hit_number", F.row_number().over(Window.orderBy("hit_place")))
        return numbered.filter(F.col("hit_number") > skip).orderBy("hit_place").select(*hits.columns)
    if skip:
        hits = _from_rank(hits, skip)
    ordered = hits.orderBy(_full_place(hits))
    return ordered if size is None else ordered.limit(size)


def search(
    entities: DataFrame,
    where: Column | None = None,
    *,
    query: str | None = None,
    limit: int | None = None,
    offset: float | None = 0,
    highlight: bool = True,
    highlight_count: int | None = None,
    highlight_length: int | None = None,
    **filters,
) -> DataFrame:
    """One page of hits.

    With ``query`` the hits hold at least one of its words, are scored by BM25 within
    the filtered entities, and carry highlights; without it the stored score decides.
    Highlights are cut after paging, so they cost one page of texts.
    """
    hits = matching(entities, where, **filters)
    if query is not None:
        hits = R.score_text(hits, query)
    hits = page(hits, limit, offset)
    if query is not None and highlight:
        hits = with_highlights(hits, R.query_terms(query), highlight_count, highlight_length)
    return hits.select(*entities.columns)


def total(hits: DataFrame) -> DataFrame:
    return hits.agg(F.count("*").alias("total"))


# --- Facets ---------------------------------------------------------------


def _facet_values(field: str) -> Column:
    if field in ("schema", "collection_id", "dataset"):
        return F.array(F.col(field))
    if field == "schemata":
        return F.col("schemata")
    return P.values(field.removeprefix("properties."))


def _facet_pairs(name: str) -> Column:
    found = F.coalesce(
        F.array_distinct(_facet_values(name)), F.array().cast("array<string>")
    )
    return F.transform(found, lambda v: F.struct(F.lit(name).alias("facet"), v.alias("value")))


def facets(
    hits: DataFrame, fields: Iterable[str], top: int | None = None, repeated: bool = False
) -> DataFrame:
    """Number of entities per value of each field, all fields in one pass.

    Values are made distinct inside each row, so over a table with one row per entity counting
    rows counts entities, and the counts combine before the shuffle however common a value is.
    Where entities repeat (hits of several searches, captured pages), ``repeated`` counts distinct
    ids: each (facet, value, id) once, in its own shuffle with partial aggregation, then as above;
    rows without an id count one each.
    """
    names = [name for name in dict.fromkeys(f.strip() for f in fields) if name]
    pairs = F.flatten(F.array(*[_facet_pairs(name) for name in names]))
    if repeated:
        # An id that is missing can't be told from another one that is.
        own = F.when(F.col("id").isNull(), F.monotonically_increasing_id())
        found = hits.select("id", own.alias("own"), F.inline(pairs)).distinct()
    else:
        found = hits.select(F.inline(pairs))
    counts = found.filter(F.col("value").isNotNull()).groupBy("facet", "value").agg(F.count("*").alias("n"))
    if top is None:
        return counts
    order = [F.col("n").desc(), F.col("value")]
    return first_in_slices(counts, "facet", order, top, slice_by="value").select(
        "facet", "value", "n"
    )


# --- Highlights -----------------------------------------------------------


_IN_WORD = r"[\p{L}\p{N}]"


def fragments(
    text: Column,
    terms: list[str],
    count: int | None = None,
    length: int | None = None,
    whole_words: bool = False,
) -> Column:
    """Pieces of ``length`` characters around the terms (letters of any case), which are marked
    with ``<em>``. Pieces don't overlap; the last may be shorter at the end of the text.

    With ``whole_words`` a term counts where no letter or digit stands beside it in the text (not
    only in the piece), as the search counts words; without it also inside longer words.
    """
    count = B.within("highlight_count", count or K.DEFAULT_HIGHLIGHT_COUNT, 1, K.MAX_HIGHLIGHT_COUNT)
    length = B.within(
        "highlight_length", length or K.DEFAULT_HIGHLIGHT_LENGTH, 1, K.MAX_HIGHLIGHT_LENGTH
    )
    wanted = [t for t in terms if t]
    if not wanted:
        return F.array().cast("array<string>")
    named = f"({'|'.join(re.escape(t) for t in sorted(wanted, key=len, reverse=True))})"
    pattern = f"(?isu)(?<!{_IN_WORD}){named}(?!{_IN_WORD})" if whole_words else f"(?isu){named}"
    long = max(0, (length - max(len(t) for t in wanted)) // 2)

    def starts(between: Column, words: Column) -> Column:
        """Where windows begin: each around the first term that lies behind the last one.

        One pass over the terms: the pieces between them and their own lengths sum up to their
        places, and only ``count`` windows are kept at most.
        """

        def step(done: Column, i: Column) -> Column:
            size, at = F.length(F.get(words, i)), done["at"] + F.length(F.get(between, i))

            def placed(at: Column) -> Column:
                begin = F.greatest(at - long, done["free"])
                taken = F.struct(
                    (at + size).alias("at"),
                    F.greatest(begin + length, at + size).alias("free"),
                    F.concat(done["starts"], F.array(begin)).alias("starts"),
                )
                passed = F.struct((at + size).alias("at"), done["free"].alias("free"), done["starts"].alias("starts"))
                return F.when((at >= done["free"]) & (F.size(done["starts"]) < count), taken).otherwise(passed)

            return T.bind(at, placed)

        none = F.struct(F.lit(0).alias("at"), F.lit(0).alias("free"), F.array().cast("array<int>").alias("starts"))
        return F.aggregate(F.sequence(F.lit(0), F.size(words) - 1), none, step, lambda done: done["starts"])

    def marked(start: Column) -> Column:
        piece = F.substring(text, start + 1, F.lit(length))
        if not whole_words:
            return F.regexp_replace(piece, pattern, "<em>$1</em>")

        # Where the piece cuts a word, its first or last letters are no word of the text.
        def mark(cut_before: bool, cut_after: bool) -> Column:
            edges = (r"(?<!\A)" if cut_before else "", r"(?!\z)" if cut_after else "")
            return F.regexp_replace(piece, f"(?isu)(?<!{_IN_WORD}){edges[0]}{named}(?!{_IN_WORD}){edges[1]}", "<em>$1</em>")

        before = (start > 0) & F.substring(text, start, F.lit(1)).rlike(_IN_WORD)
        after = F.substring(text, start + length + 1, F.lit(1)).rlike(_IN_WORD)
        return (
            F.when(before & after, mark(True, True)).when(before, mark(True, False)).when(after, mark(False, True)).otherwise(mark(False, False))
        )

    none = F.array().cast("array<string>")
    return F.coalesce(
        T.bind(
            F.regexp_extract_all(text, F.lit(pattern), F.lit(1)),
            lambda words: F.when(F.size(words) == 0, none).otherwise(
                T.bind(
                    F.split(text, pattern, -1),
                    lambda between: F.transform(starts(between, words), marked),
                )
            ),
        ),
        none,
    )


def with_highlights(
    hits: DataFrame, terms: list[str], count: int | None = None, length: int | None = None
) -> DataFrame:
    """Highlights of whole words: those that made the entity a hit and count for its score."""
    found = fragments(P.search_text(), terms, count, length, whole_words=True)
    return hits.withColumn("highlight", found).withColumn("highlight_is_array", F.lit(True))
