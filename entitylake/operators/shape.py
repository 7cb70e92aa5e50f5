"""Slim records: one narrow projection over the entity table, without a shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entitylake import constants as K
from entitylake.functions import bounds as B
from entitylake.functions import html as H
from entitylake.functions import text as T

_NO_PREVIEWS = "CAST(map() AS MAP<STRING, STRING>)"


def heavy_values(name: str) -> Column:
    """Display values of one body field."""
    return F.coalesce(F.try_element_at("heavy_props", F.lit(name)), F.col(f"texts.{name}"))


def own_page_text() -> tuple[Column, Column]:
    """Text of the first body field that has any, and the name of that field."""
    found = [(name, T.flatten_text(F.col(f"texts.{name}"))) for name in K.PAGE_TEXT_FIELDS]
    text = F.coalesce(*[value for _, value in found])
    field = F.coalesce(*[F.when(value.isNotNull(), F.lit(name)) for name, value in found])
    return text, field


def highlight_source() -> Column:
    """Plain text of the highlights; only real lists of snippets count."""
    return F.when(F.col("highlight_is_array"), T.highlight_text(F.col("highlight")))


def full_mail_body(html: Column, max_chars: int | None = K.MAX_CONVERSION_CHARS) -> Column:
    """Markdown of one mail body, guarded unless ``max_chars`` is None."""
    return H.mail_markdown(html if max_chars is None else T.guard_html(html, max_chars))


def full_page_body(text: Column, max_chars: int | None = K.MAX_CONVERSION_CHARS) -> Column:
    """Plain text of one page body, guarded unless ``max_chars`` is None; NULL when empty."""
    kept = text if max_chars is None else T.guard_plain(text, max_chars)
    return T.bind(T.unify_newlines(kept), lambda body: F.when(body != "", body))


def evaluated_once(value: Column) -> Column:
    """A generator with one row: later filters on the value use the value itself instead
    of repeating the conversion inside a pushed-down predicate."""
    return F.explode(F.array(value))


def slim(
    entities: DataFrame,
    *,
    include_content_fields: bool = False,
    content_preview_chars: int = 0,
    body_markdown_max_chars: int = K.SEARCH_BODY_CHARS,
    max_array_values_per_field: int = K.DEFAULT_VALUES_PER_FIELD,
    include_raw: bool = False,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Compact records with a body that is cut at a natural boundary.

    Work is staged so that each text is converted once: pick the source text, make the
    body, then derive length, cut text and flags from it. Entities of other types skip
    the conversion altogether.
    """
    B.within("content_preview_chars", content_preview_chars, 0, K.MAX_PREVIEW_CHARS)
    B.within("body_markdown_max_chars", body_markdown_max_chars, 1, K.MAX_BODY_CHARS)
    B.within("max_array_values_per_field", max_array_values_per_field, 1, K.MAX_VALUES_PER_FIELD)
    max_chars = content_preview_chars or body_markdown_max_chars

    staged = entities
    if include_content_fields:
        staged = staged.select(
            "*",
            F.lit(None).cast("string").alias("body"),
            F.lit(None).cast("string").alias("body_field"),
            F.lit(False).alias("from_highlight"),
            F.lit(None).cast("string").alias("source_field"),
        )
    else:
        mail, page = T.is_email(F.col("schema")), T.is_page(F.col("schema"))
        own_text, own_field = own_page_text()
        staged = staged.select(
            "*",
            F.when(mail, T.flatten_text(F.col("texts.bodyHtml"))).alias("html_source"),
            F.when(page, own_text).alias("text_source"),
            F.when(page, own_field).alias("source_field"),
            F.when(page & own_field.isNull(), highlight_source()).alias("highlight_source"),
        )
        body = F.when(mail, full_mail_body(F.col("html_source"))).otherwise(
            full_page_body(F.coalesce("text_source", "highlight_source"))
        )
        staged = staged.select(
            *entities.columns,
            F.when(F.col("html_source").isNotNull(), F.lit("bodyHtml"))
            .otherwise(F.col("source_field"))
            .alias("source_field"),
            F.col("highlight_source").isNotNull().alias("from_highlight"),
            F.when(mail, F.lit("bodyMarkdown")).otherwise(F.lit("bodyText")).alias("body_field"),
            evaluated_once(body).alias("body"),
        )
    staged = staged.withColumn("cut", T.cut_at_boundary(F.col("body"), max_chars))
    return staged.select(
        *keep,
        "schema",
        _properties(include_content_fields, max_array_values_per_field).alias("properties"),
        _previews(include_content_fields, content_preview_chars).alias("previews"),
        "parent",
        "parent_is_object",
        "ancestors",
        "ancestors_is_object",
        "recipients",
        "dataset",
        "score",
        "id",
        "link",
        (F.length("cut") < F.length("body")).alias("truncatedBody"),
        F.length("body").alias("bodyMarkdownFullChars"),
        F.length("cut").alias("bodyMarkdownReturnedChars"),
        F.when(F.col("from_highlight"), F.lit(True)).alias("bodyTextFromSearchHighlight"),
        F.when(F.size("highlight") > 0, F.col("highlight")).alias("highlight"),
        "highlight_is_array",
        "highlight_json",
        *(["raw"] if include_raw else []),
    )


def search_records(entities: DataFrame, **options) -> DataFrame:
    """Slim records with the short body of a result list."""
    options.setdefault("body_markdown_max_chars", K.SEARCH_BODY_CHARS)
    return slim(entities, **options)


def entity_records(entities: DataFrame, **options) -> DataFrame:
    """Slim records with the longer body of a single entity."""
    options.setdefault("body_markdown_max_chars", K.ENTITY_BODY_CHARS)
    return slim(entities, **options)


def _properties(include_content: bool, max_values: int) -> Column:
    """Light properties, the derived body and, when asked for, the body fields."""
    replaced = F.coalesce(F.col("source_field") == "bodyHtml", F.lit(False))
    light = F.map_filter(
        F.col("props"),
        lambda k, v: ~k.isin(*K.PROCESSING_FIELDS) & ~(replaced & (k == "bodyMarkdown")),
    )
    entries = [
        F.transform_values(light, lambda k, v: F.slice(v, 1, max_values)),
    ]
    if include_content:
        heavy = F.create_map(
            *[
                x
                for name in K.HEAVY_FIELDS
                for x in (F.lit(name), F.slice(heavy_values(name), 1, max_values))
            ]
        )
        entries.append(F.map_filter(heavy, lambda k, v: v.isNotNull()))
    else:
        body = F.create_map(F.col("body_field"), F.array("cut"))
        entries.append(F.map_filter(body, lambda k, v: F.col("cut").isNotNull()))
    return F.map_concat(*entries)


def _previews(include_content: bool, preview_chars: int) -> Column:
    """``<field>Preview`` for every body field that is left out of the record."""
    if include_content or preview_chars == 0:
        return F.expr(_NO_PREVIEWS)
    previews = F.create_map(
        *[
            x
            for name in K.HEAVY_FIELDS
            for x in (
                F.lit(f"{name}Preview"),
                F.when(
                    ~F.coalesce(F.col("source_field") == name, F.lit(False)),
                    T.preview(heavy_values(name), preview_chars),
                ),
            )
        ]
    )
    return F.map_filter(previews, lambda k, v: v.isNotNull())


# --- Structured output ----------------------------------------------------

_ALWAYS_PRESENT = ("dataset", "score", "id", "link")
_ONLY_WHEN_SET = (
    "truncatedBody",
    "bodyMarkdownFullChars",
    "bodyMarkdownReturnedChars",
    "bodyTextFromSearchHighlight",
)


def _variant(value: Column) -> Column:
    """Structured values need the object form; missing struct fields drop out."""
    return F.try_parse_json(F.to_json(value))


def _explicit(value: Column, options: dict[str, str] | None = None) -> Column:
    return F.try_parse_json(F.to_json(value, options or {"ignoreNullFields": "false"}))


def _references(name: str) -> Column:
    refs = F.col(name)
    one = _explicit(F.get(refs, F.lit(0)))
    return F.when(
        refs.isNotNull(), F.when(F.col(f"{name}_is_object"), one).otherwise(_explicit(refs))
    )


def record_variant() -> Column:
    """One slim record as VARIANT, with the field presence of the JSON output."""
    # A preview takes the place of a property that happens to have its name.
    own = F.map_filter("properties", lambda k, v: ~F.map_contains_key("previews", k))
    properties = F.map_filter(
        F.map_concat(
            F.transform_values(own, lambda k, v: F.to_variant_object(v)),
            F.transform_values("previews", lambda k, v: v.cast("variant")),
            F.create_map(
                F.lit("parent"), _references("parent"),
                F.lit("ancestors"), _references("ancestors"),
            ),
            F.map_filter(
                F.create_map(F.lit("recipients"), _variant(F.col("recipients"))),
                lambda k, v: v.isNotNull(),
            ),
        ),
        lambda k, v: v.isNotNull(),
    )
    null = F.parse_json(F.lit("null"))
    highlight = F.coalesce(
        F.try_parse_json("highlight_json"),
        F.when(F.col("highlight_is_array"), F.to_variant_object("highlight")).otherwise(
            F.get("highlight", F.lit(0)).cast("variant")
        ),
    )
    fields: list[Column] = [F.lit("schema"), F.col("schema").cast("variant")]
    fields += [F.lit("properties"), F.try_parse_json(F.to_json(properties))]
    for name in _ALWAYS_PRESENT:
        fields += [F.lit(name), F.coalesce(F.col(name).cast("variant"), null)]
    for name in _ONLY_WHEN_SET:
        fields += [F.lit(name), F.col(name).cast("variant")]
    fields += [F.lit("highlight"), highlight]
    return F.map_filter(F.create_map(*fields), lambda k, v: v.isNotNull())


def to_json_records(records: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One JSON object per record; ``raw`` sits beside the record when it was kept."""
    record = F.to_json(record_variant())
    if "raw" in records.columns:
        record = F.concat(
            F.lit('{"result":'), record, F.lit(',"raw":'), F.coalesce("raw", F.lit("null")), F.lit("}")
        )
    return records.select(*keep, record.alias("json"))
