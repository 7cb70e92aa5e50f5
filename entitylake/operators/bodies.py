"""Full bodies of mails and paged files, and the report of what has none."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from entitylake import constants as K
from entitylake.functions import bounds as B
from entitylake.functions import text as T
from entitylake.operators import shape as SH
from entitylake.operators.groups import first_in_slices

_JOINER = len(K.PARAGRAPH)
# Code points that one row may hold: four bytes each stay below what a string can have.
MAX_ROW_CHARS = 500_000_000


def child_rows(entities: DataFrame) -> DataFrame:
    """Pages by parent: ``parent_id, position, id, text``. Pages without an index sort last."""
    text, _ = SH.own_page_text()
    return entities.filter(F.col("schema") == K.CHILD_SCHEMA).select(
        F.explode(F.array_distinct("document_ids")).alias("parent_id"),
        F.coalesce("page_index", F.lit(float("inf"))).alias("position"),
        "id",
        text.alias("text"),
    )


def first_children(children: DataFrame, max_children: int = K.MAX_CHILD_PAGES) -> DataFrame:
    """The first pages of each parent, in index order, with or without text."""
    B.within("max_children", max_children, 1, K.MAX_CHILD_PAGES)
    order = [F.col("position"), F.col("id")]
    return first_in_slices(children, "parent_id", order, max_children, slice_by="id")


def oversize_files(children: DataFrame) -> DataFrame:
    """``parent_id, file_chars`` of files whose joined pages are too long for one row.

    Lengths alone are summed, with partial sums first, so no task sees all pages of a file.
    """
    lengths = children.select("parent_id", (F.length("text") + _JOINER).cast("long").alias("chars"))
    return lengths.groupBy("parent_id").agg(F.sum("chars").alias("file_chars")).filter(F.col("file_chars") > MAX_ROW_CHARS)


def child_bodies(
    children: DataFrame,
    max_children: int | None = None,
    max_source_chars: int | None = None,
    skip_oversize: bool = False,
) -> DataFrame:
    """Texts of all pages joined with blank lines, one row per parent.

    ``max_children`` limits the pages, ``max_source_chars`` the joined text; without them
    nothing is left out. ``childPagesTotal`` counts all pages of the parent, blank ones too,
    and ``childPagesCut`` says that pages were left out. Lengths are summed over narrow rows
    before texts come together: a file too long for one row ends the job with its name instead
    of being cut, or is left out with ``skip_oversize``; ``oversize_files`` lists such files and
    ``segments.segments`` has their bodies in pieces.
    """
    place = F.lit(1)
    if max_children is not None:
        if max_children < 1:
            raise ValueError(f"max_children must be 1 or more, got {max_children!r}")
        place = F.row_number().over(Window.partitionBy("parent_id").orderBy("position", "id"))
    ranked = children.withColumn("place", place)
    inside = F.lit(True) if max_children is None else F.col("place") <= max_children
    ranked = ranked.withColumn("inside", inside)
    oversize = oversize_files(ranked.filter("inside"))
    if skip_oversize:
        texts, text = ranked.join(oversize, "parent_id", "left_anti"), F.col("text")
    else:
        texts = ranked.join(oversize, "parent_id", "left")
        too_long = F.raise_error(F.concat(F.lit("too long for one row: file "), F.col("parent_id")))
        text = F.when(F.col("file_chars").isNotNull(), too_long.cast("string")).otherwise(F.col("text"))
    piece = F.struct("position", "id", text.alias("text"))
    wanted = F.col("inside") & F.col("text").isNotNull()
    grouped = texts.groupBy("parent_id").agg(
        F.count_if(wanted).alias("childPageCount"),
        F.count("*").alias("childPagesTotal"),
        (F.count_if(~F.col("inside")) > 0).alias("childPagesCut"),
        F.array_sort(F.collect_list(F.when(wanted, piece))).alias("pieces"),
    )
    joined = F.array_join(F.transform("pieces", lambda p: p.getField("text")), K.PARAGRAPH)
    sourced = grouped.withColumn("source", SH.evaluated_once(joined))
    return sourced.select(
        "parent_id",
        SH.evaluated_once(SH.full_page_body(F.col("source"), max_source_chars)).alias("bodyText"),
        _cut(F.col("source"), max_source_chars).alias("htmlSourceTruncated"),
        "childPageCount",
        "childPagesTotal",
        "childPagesCut",
    ).filter(F.col("bodyText").isNotNull())


def _cut(source: Column, max_source_chars: int | None) -> Column:
    return F.lit(False) if max_source_chars is None else F.length(source) > max_source_chars


def _sources(entities: DataFrame) -> DataFrame:
    """Entities with the text their own body comes from."""
    page_text, _ = SH.own_page_text()
    return entities.select(
        "*",
        F.when(T.is_email(F.col("schema")), T.flatten_text(F.col("texts.bodyHtml"))).alias("html"),
        F.when(T.is_page(F.col("schema")), page_text).alias("plain"),
    )


def _needs_children() -> Column:
    return T.is_page_parent(F.col("schema")) & F.col("plain").isNull() & F.col("id").isNotNull()


def mail_bodies(
    entities: DataFrame, keep: tuple[str, ...] = (), max_source_chars: int | None = None
) -> DataFrame:
    """Markdown of every mail whose HTML converts to some text."""
    return (
        _sources(entities.filter(T.is_email(F.col("schema"))))
        .select(
            "id",
            F.col("raw_schema").alias("schema"),
            SH.evaluated_once(SH.full_mail_body(F.col("html"), max_source_chars)).alias("bodyMarkdown"),
            _cut(F.col("html"), max_source_chars).alias("htmlSourceTruncated"),
            *keep,
        )
        .filter(F.col("bodyMarkdown").isNotNull())
        .withColumn("bodyMarkdownFullChars", F.length("bodyMarkdown"))
    )


def page_bodies(
    entities: DataFrame, keep: tuple[str, ...] = (), max_source_chars: int | None = None
) -> DataFrame:
    """Plain text of every page or paged file that has text of its own."""
    return (
        _sources(entities.filter(T.is_page(F.col("schema"))))
        .select(
            "id",
            F.col("raw_schema").alias("schema"),
            SH.evaluated_once(SH.full_page_body(F.col("plain"), max_source_chars)).alias("bodyText"),
            _cut(F.col("plain"), max_source_chars).alias("htmlSourceTruncated"),
            *keep,
        )
        .filter(F.col("bodyText").isNotNull())
        .withColumn("bodyTextFullChars", F.length("bodyText"))
    )


def parent_bodies(
    entities: DataFrame,
    children: DataFrame | None = None,
    max_children: int | None = None,
    keep: tuple[str, ...] = (),
    max_source_chars: int | None = None,
) -> DataFrame:
    """Bodies of paged files without own text, joined from their pages.

    Parents with text never reach the join. Each side has one row per id there, so no
    key is hot.
    """
    parents = _sources(entities.filter(T.is_page_parent(F.col("schema")))).filter(_needs_children())
    pages = child_rows(entities if children is None else children)
    bodies = child_bodies(pages, max_children, max_source_chars)
    return parents.join(bodies, F.col("id") == F.col("parent_id")).select(
        "id",
        F.col("raw_schema").alias("schema"),
        "bodyText",
        F.length("bodyText").alias("bodyTextFullChars"),
        "htmlSourceTruncated",
        "childPageCount",
        "childPagesTotal",
        "childPagesCut",
        *keep,
    )


def full_body(
    entities: DataFrame,
    children: DataFrame | None = None,
    max_children: int | None = None,
    include_raw: bool = False,
    keep: tuple[str, ...] = (),
    max_source_chars: int | None = None,
) -> DataFrame:
    """Uncut bodies: mail first, then own page text, then the text of child pages.

    Whole texts and all pages unless ``max_source_chars`` or ``max_children`` limit them.

    Three branches by type, so mails and pages with text are never shuffled. ``keep``
    carries more entity columns along.
    """
    keep = (*keep, "raw") if include_raw else keep
    mails = mail_bodies(entities, keep, max_source_chars)
    pages = page_bodies(entities, keep, max_source_chars).withColumn("bodyTextFromChildren", F.lit(False))
    joined = parent_bodies(entities, children, max_children, keep, max_source_chars).withColumn(
        "bodyTextFromChildren", F.lit(True)
    )
    rows = mails.unionByName(pages, allowMissingColumns=True).unionByName(
        joined, allowMissingColumns=True
    )
    return rows.select(
        "id",
        "schema",
        "bodyMarkdown",
        "bodyMarkdownFullChars",
        "bodyText",
        "bodyTextFullChars",
        "htmlSourceTruncated",
        "bodyTextFromChildren",
        "childPageCount",
        "childPagesTotal",
        "childPagesCut",
        *keep,
    )


def listed_keys(keys: Column, limit: int = K.MAX_LISTED_KEYS) -> Column:
    """Property names in alphabetical order, the first twenty and how many more."""

    def render(names: Column) -> Column:
        head = F.array_join(F.slice(names, 1, limit), ", ")
        more = F.concat(
            head, F.lit(f", {K.ELLIPSIS} (+"), (F.size(names) - limit).cast("string"), F.lit(" more)")
        )
        return (
            F.when(F.size(names) == 0, F.lit(K.NO_KEYS_NOTE))
            .when(F.size(names) > limit, more)
            .otherwise(head)
        )

    return T.bind(F.array_sort(F.coalesce(keys, F.array().cast("array<string>"))), render)


def missing_body(entities: DataFrame, children: DataFrame | None = None) -> DataFrame:
    """Entities without any body text, with the property names they do have.

    Only paged files without own text need a join, and it compares ids alone: any page
    with text counts, and its text is never moved.
    """
    sourced = _sources(entities).select(
        "id",
        "schema",
        "raw_schema",
        "present_keys",
        F.col("plain"),
        SH.evaluated_once(
            F.coalesce(SH.full_mail_body(F.col("html"), None), SH.full_page_body(F.col("plain"), None)).isNull()
        ).alias("bodyless"),
    )
    bodyless = sourced.filter("bodyless")
    with_pages = (
        child_rows(entities if children is None else children)
        .filter(F.col("text").isNotNull())
        .select(F.col("parent_id").alias("id"))
        .distinct()
    )
    missing = bodyless.filter(~_needs_children()).unionByName(
        bodyless.filter(_needs_children()).join(with_pages, "id", "left_anti")
    )
    return missing.select(
        "id",
        F.coalesce("raw_schema", F.lit("unknown")).alias("schema"),
        listed_keys(F.col("present_keys")).alias("present_keys"),
    )
