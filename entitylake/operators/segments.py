"""Bodies of paged files at any size: as segments, with the place of every page, and citations by page.

Where a page begins in its file's body is a sum of the lengths before it. The sums come in two
levels over narrow rows (no texts): rows are range-partitioned by file and order, summed per file
and range, and summed on inside each range; so a file that holds a third of all pages is many
tasks' work. Texts are cut by these offsets and meet in groups of bounded size only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from entitylake import constants as K
from entitylake.functions import text as T
from entitylake.functions import tokens as W
from entitylake.operators import bodies as BD
from entitylake.operators import shape as SH
from entitylake.session import written

SEGMENT_CHARS = 1_000_000

_JOINER = len(K.PARAGRAPH)
_PAGE = ("parent_id", "position", "id", "tag")
_WORD = r"[\p{L}\p{N}]+"


def sums_before(rows: DataFrame, group: str, order: Sequence[str], sizes: Sequence[str]) -> DataFrame:
    """The rows with ``<size>_before``: the sum of each size over the rows before, in order, of the same group."""
    dealt = written(rows.repartitionByRange(group, *order).withColumn("part", F.spark_partition_id()))
    sums = dealt.groupBy(group, "part").agg(*[F.sum(size).alias(size) for size in sizes])
    earlier = Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    bases = sums.select(group, "part", *[F.coalesce(F.sum(s).over(earlier), zero).alias(f"{s}_base") for s in sizes])
    inside = Window.partitionBy(group, "part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return dealt.join(bases, [group, "part"]).select(
        *rows.columns,
        *[(F.col(f"{s}_base") + F.coalesce(F.sum(s).over(inside), zero)).alias(f"{s}_before") for s in sizes],
    )


def page_texts(children: DataFrame) -> DataFrame:
    """Pages with text: ``parent_id, position, id, tag, text``; ``tag`` tells pages of the same place apart."""
    pages = BD.child_rows(children).filter(F.col("parent_id").isNotNull() & F.col("text").isNotNull())
    body = T.unify_newlines(F.col("text"))
    return pages.select("parent_id", "position", "id", F.xxhash64(body).alias("tag"), body.alias("text"))


def page_starts(children: DataFrame) -> DataFrame:
    """Where each page lies in its file: ``parent_id, position, id, tag, copies, chars, words, start, first_word``.

    ``start`` counts the body's code points before the page's text, ``first_word`` its words. A page
    that occurs several times alike is one row with its ``copies``, which follow each other. Pages
    with the same place and id are ordered by the start of their text. Written.
    """
    narrow = (
        page_texts(children)
        .select(*_PAGE, F.length("text").alias("chars"), F.size(W.words(F.col("text"))).alias("words"), F.left("text", F.lit(32)).alias("head"))
        .groupBy(*_PAGE)
        .agg(F.count("*").alias("copies"), F.first("chars").alias("chars"), F.first("words").alias("words"), F.first("head").alias("head"))
        .withColumns({"room": F.col("copies") * (F.col("chars") + _JOINER), "all_words": F.col("copies") * F.col("words")})
    )
    placed = sums_before(narrow, "parent_id", ["position", "id", "head", "tag"], ["room", "all_words"])
    return written(
        placed.select(
            *_PAGE, "copies", "chars", "words", F.col("room_before").alias("start"), F.col("all_words_before").alias("first_word")
        )
    )


def _same_page(left: str, right: str) -> Column:
    same = [F.col(f"{left}.{name}").eqNullSafe(F.col(f"{right}.{name}")) for name in _PAGE[1:]]
    return (F.col(f"{left}.parent_id") == F.col(f"{right}.parent_id")) & same[0] & same[1] & same[2]


def segments(children: DataFrame, starts: DataFrame | None = None, segment_chars: int = SEGMENT_CHARS) -> DataFrame:
    """``parent_id, segment, start, text``: the body of every file of pages in pieces of equal length.

    The pieces of a file in order are the text that ``bodies.child_bodies`` joins; each but the last
    has ``segment_chars`` code points. Texts move once to where their page's offset is, and each
    piece once to its segment.
    """
    if segment_chars < 1:
        raise ValueError(f"segment_chars must be 1 or more, got {segment_chars!r}")
    starts = page_starts(children) if starts is None else starts
    texts = page_texts(children).groupBy(*_PAGE).agg(F.first("text").alias("text"))
    pages = texts.alias("t").join(starts.alias("s"), _same_page("t", "s")).select(
        "s.parent_id",
        "t.text",
        F.explode(
            F.transform(
                F.sequence(F.lit(0).cast("long"), F.col("s.copies") - 1), lambda k: F.col("s.start") + k * (F.col("s.chars") + _JOINER)
            )
        ).alias("start"),
    )
    # Every page but a file's first brings the blank line before it along.
    first = F.col("start") == 0
    pieces = pages.select(
        "parent_id",
        F.when(first, F.col("text")).otherwise(F.concat(F.lit(K.PARAGRAPH), "text")).alias("piece"),
        F.when(first, F.col("start")).otherwise(F.col("start") - _JOINER).alias("at"),
    ).withColumn("end", F.col("at") + F.length("piece"))
    size = F.lit(segment_chars).cast("long")
    cut = pieces.select(
        "parent_id", "piece", "at", "end", F.explode(F.sequence(F.floor(F.col("at") / size), F.floor((F.col("end") - 1) / size))).alias("segment")
    )
    low = F.greatest(F.col("at"), F.col("segment") * size)
    high = F.least(F.col("end"), (F.col("segment") + 1) * size)
    part = F.substr("piece", (low - F.col("at") + 1).cast("int"), (high - low).cast("int"))
    grouped = cut.select("parent_id", "segment", F.struct(low.alias("at"), part.alias("part")).alias("part")).groupBy(
        "parent_id", "segment"
    )
    joined = F.array_join(F.transform(F.array_sort(F.collect_list("part")), lambda p: p["part"]), "")
    return grouped.agg(joined.alias("text")).select(
        "parent_id", "segment", (F.col("segment") * size).alias("start"), "text"
    )


def _word_place(text: Column, i: Column) -> Column:
    """Code points of the text before its i-th word (from 0)."""
    between, words = F.split(text, _WORD), F.regexp_extract_all(text, F.lit(_WORD), F.lit(0))
    chars = lambda parts: F.length(F.array_join(parts, ""))
    return chars(F.slice(between, F.lit(1), i + 1)) + F.when(i == 0, F.lit(0)).otherwise(chars(F.slice(words, F.lit(1), i)))


def phrase_places(children: DataFrame, phrase: str, starts: DataFrame) -> DataFrame:
    """Every occurrence of a phrase in the bodies of files, also across pages.

    ``parent_id, page_id, page_position, page_offset, end_page_id, body_offset``. A page's words are
    numbered on from the page before, so words that follow each other across a page break have
    numbers that do. Only rows of the phrase's words are shuffled, without texts; pages with an
    occurrence are looked at once more for its offset. Words are runs of letters and digits, compared
    in small letters.
    """
    wanted = W.literal_words(phrase)
    if not wanted:
        raise ValueError("a phrase needs at least one word")
    texts = page_texts(children)
    words = F.regexp_extract_all("text", F.lit(_WORD), F.lit(0))
    held = texts.select(*_PAGE, F.posexplode(words).alias("nth", "word")).select(*_PAGE, "nth", F.lower("word").alias("word"))
    held = held.filter(F.col("word").isin(*wanted)).distinct()
    copies = F.sequence(F.lit(0).cast("long"), F.col("s.copies") - 1)
    numbered = held.alias("h").join(starts.alias("s"), _same_page("h", "s")).select(
        *[F.col(f"s.{name}") for name in _PAGE], "s.start", "s.chars", "s.words", "s.first_word", "h.nth", "h.word", F.explode(copies).alias("copy")
    )
    offsets = F.array(*[F.when(F.col("word") == word, F.lit(i)) for i, word in enumerate(wanted)])
    numbered = numbered.withColumn("start", F.col("start") + F.col("copy") * (F.col("chars") + _JOINER))
    place = F.struct("position", "id", "tag", "nth", "start")
    shifted = numbered.select(
        "parent_id",
        (F.col("first_word") + F.col("copy") * F.col("words") + F.col("nth")).alias("number"),
        place.alias("place"),
        F.explode(F.array_compact(offsets)).alias("offset"),
    )
    found = (
        shifted.groupBy("parent_id", (F.col("number") - F.col("offset")).alias("first"))
        .agg(
            F.count("*").alias("n"),
            F.max(F.when(F.col("offset") == 0, F.col("place"))).alias("begin"),
            F.max(F.when(F.col("offset") == len(wanted) - 1, F.col("place"))).alias("stop"),
        )
        .filter(F.col("n") == len(wanted))
        .select("parent_id", "begin.*", F.col("stop.id").alias("end_page_id"))
    )
    once = texts.groupBy(*_PAGE).agg(F.first("text").alias("text"))
    matched = found.alias("f").join(once.alias("t"), _same_page("f", "t")).select("f.*", "t.text")
    inside = _word_place(F.col("text"), F.col("nth")).cast("long")
    return matched.select(
        "parent_id",
        F.col("id").alias("page_id"),
        F.col("position").alias("page_position"),
        SH.evaluated_once(inside).alias("page_offset"),
        "end_page_id",
        "start",
    ).select(
        "parent_id", "page_id", "page_position", "page_offset", "end_page_id", (F.col("start") + F.col("page_offset")).alias("body_offset")
    )


def page_citations(
    children: DataFrame, phrase: str, excerpt_chars: int = 200, segment_chars: int = SEGMENT_CHARS
) -> DataFrame:
    """The places of a phrase with a verbatim piece of the body around each, over page breaks too.

    A citation meets the segments that its excerpt touches by file and segment number.
    """
    starts = page_starts(children)
    places = written(phrase_places(children, phrase, starts))
    side = max(0, (excerpt_chars - len(phrase)) // 2)
    size = F.lit(segment_chars).cast("long")
    low = F.greatest(F.col("body_offset") - side, F.lit(0).cast("long"))
    ranged = places.withColumns({"low": low, "take": F.least(F.col("body_offset"), F.lit(side)) + len(phrase) + side})
    touched = F.sequence(F.floor(F.col("low") / size), F.floor((F.col("low") + F.col("take") - 1) / size))
    asked = ranged.select("parent_id", "body_offset", "low", "take", F.explode(touched).alias("segment"))
    stored = segments(children, starts, segment_chars).withColumnRenamed("start", "segment_start")
    met = asked.join(stored, ["parent_id", "segment"])
    skip = F.greatest(F.col("low") - F.col("segment_start"), F.lit(0).cast("long"))
    upto = F.least(F.col("low") + F.col("take") - F.col("segment_start"), size)
    part = F.substr("text", (skip + 1).cast("int"), (upto - skip).cast("int"))
    pieces = met.select("parent_id", "body_offset", F.struct("segment", part.alias("part")).alias("part"))
    excerpt = F.array_join(F.transform(F.array_sort(F.collect_list("part")), lambda p: p["part"]), "")
    quoted = pieces.groupBy("parent_id", "body_offset").agg(excerpt.alias("excerpt"))
    return places.join(quoted, ["parent_id", "body_offset"])
