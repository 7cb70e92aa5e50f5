"""From captured JSON to the entity table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from entitylake import constants as K
from entitylake import schema as S
from entitylake.functions import display as D
from entitylake.functions import text as T
from entitylake.functions import urls as U


def read_json_lines(spark: SparkSession, path: str) -> DataFrame:
    """One JSON entity per line, undecoded, in column ``raw``."""
    return spark.read.text(path).withColumnRenamed("value", "raw")


def decode(df: DataFrame, body: str = "raw") -> DataFrame:
    """Add ``doc`` (VARIANT) and ``raw_text``.

    Empty text gives neither. Text that is no JSON, or repeats a key, is kept as it is
    in ``raw_text`` and never fails the job.
    """
    return df.withColumn("doc", F.try_parse_json(body)).withColumn(
        "raw_text",
        F.when(F.col("doc").isNull() & (F.length(body) > 0), F.col(body)),
    )


def split_responses(responses: DataFrame, label: str = "Request failed") -> tuple[DataFrame, DataFrame]:
    """Good responses (status 2xx) and failed ones with a printable ``error``."""
    good = F.col("status").between(200, 299)
    decoded = decode(responses, "body")
    payload = F.coalesce(
        F.nullif(F.to_json("doc"), F.lit("null")),
        F.when(
            F.col("raw_text").isNotNull(),
            F.to_json(F.struct(F.col("raw_text").alias("raw"))),
        ),
    )
    status = F.col("status").cast("string")
    headline = F.concat(
        F.lit("HTTP "), status, F.lit(f": {label}: HTTP "), status
    )
    failed = decoded.filter(~F.coalesce(good, F.lit(False))).select(
        "url", "status", "body", F.concat_ws("\n", headline, payload).alias("error")
    )
    return responses.filter(good), failed


def scan_envelopes(
    df: DataFrame, body: str = "body", keep: tuple[str, ...] = (), decoded: bool = False
) -> DataFrame:
    """Entities inside search responses; ``rank`` is their place in the response.

    Bodies without a ``results`` list give no rows. With ``decoded`` the table has its ``doc`` already.
    """
    results = F.expr("try_variant_get(doc, '$.results', 'array<variant>')")
    hits = (df if decoded else decode(df, body)).select(*keep, F.posexplode(results).alias("rank", "doc"))
    return entities_from_documents(hits, keep)


def scan_entities(
    df: DataFrame, body: str = "raw", keep: tuple[str, ...] = (), decoded: bool = False
) -> DataFrame:
    """Entities from rows that hold one JSON object each; other rows are left out
    here and reported by :func:`rejected_entities`."""
    one = F.expr("filter(array(doc), d -> try_variant_get(d, '$', 'map<string,variant>') IS NOT NULL)")
    return entities_from_documents(
        (df if decoded else decode(df, body)).select(*keep, F.posexplode(one).alias("rank", "doc")), keep
    )


def rejected_entities(df: DataFrame, body: str = "raw") -> DataFrame:
    """Rows whose body is not one JSON object."""
    return decode(df, body).filter(~D.is_object("doc")).select(*df.columns, "raw_text")


def entities_from_documents(docs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Map decoded objects (columns ``doc`` and ``rank``) to entity rows.

    Three projections, because each later one uses a decoded value many times: the
    property map, its display form, then the entity columns. No shuffle. The documents
    come out of a generator, so a filter on any column below is tested on the decoded
    value and never pushes the parser into the predicate.
    """
    opened = docs.filter(D.is_object("doc")).select(
        *keep,
        "rank",
        "doc",
        F.expr(
            "coalesce(try_variant_get(doc, '$.properties', 'map<string,variant>'), "
            "map_filter(map('', doc), (k, x) -> false))"
        ).alias("p"),
        F.expr("try_variant_get(doc, '$.links', 'map<string,variant>')").alias("links_v"),
    )
    shown = opened.select(
        "*",
        D.display_map(_OWN_VALUES).alias("shown"),
        F.expr(
            "transform_values(links_v, (k, x) -> "
            "IF(schema_of_variant(x) = 'STRING', CAST(x AS STRING), NULL))"
        ).alias("links"),
        S.texts(
            **{name: _present(D.text_list(_prop(name))) for name in K.HEAVY_FIELDS}
        ).alias("texts"),
    )
    collection = F.coalesce(
        T.nonblank(D.string_field("doc", "collection_id")),
        T.nonblank(D.string_field("doc", "collection.id")),
    )
    raw_schema = D.string_field("doc", "schema")
    schema = F.coalesce(T.nonblank(raw_schema), F.lit(K.UNKNOWN_SCHEMA))
    own_id = T.nonblank(D.string_field("doc", "id"))
    listed = D.text_list("try_variant_get(doc, '$.schemata', 'variant')")
    shaped = shown.select(
        *keep,
        U.canonical_id(own_id, F.col("links")).alias("id"),
        own_id.alias("own_id"),
        schema.alias("schema"),
        raw_schema.alias("raw_schema"),
        F.array_union(F.array(schema), listed).alias("schemata"),
        F.coalesce(T.nonblank(D.string_field("doc", "dataset")), collection).alias("dataset"),
        collection.alias("collection_id"),
        D.score("doc").alias("score"),
        F.try_element_at("links", F.lit(K.UI_LINK_KEY)).alias("link"),
        F.map_filter(
            "shown",
            lambda k, v: ~k.isin(*K.HEAVY_FIELDS),
        ).alias("props"),
        "texts",
        _differing(F.col("shown"), F.col("texts")).alias("heavy_props"),
        D.present_keys("p").alias("present_keys"),
        D.references(_prop("parent")).alias("parent"),
        D.is_object(_prop("parent")).alias("parent_is_object"),
        D.references(_prop("ancestors")).alias("ancestors"),
        D.is_object(_prop("ancestors")).alias("ancestors_is_object"),
        D.recipients(_prop("recipients")).alias("recipients"),
        D.snippets("try_variant_get(doc, '$.highlight', 'variant')").alias("highlight"),
        D.is_array("try_variant_get(doc, '$.highlight', 'variant')").alias(
            "highlight_is_array"
        ),
        D.linked_ids(_prop("document")).alias("document_ids"),
        D.first_number(_prop("index")).alias("page_index"),
        "rank",
        F.to_json("doc").alias("raw"),
        D.linked_map("p").alias("linked"),
        D.mixed_highlight("try_variant_get(doc, '$.highlight', 'variant')").alias("highlight_json"),
    )
    return shaped if keep else S.conform(shaped)


# Linked entities have columns of their own; recipients that are no list stay a property.
_OWN_VALUES = (
    "map_filter(p, (k, x) -> k NOT IN ('parent', 'ancestors') "
    "AND NOT (k = 'recipients' AND try_variant_get(x, '$', 'array<variant>') IS NOT NULL))"
)


def _prop(name: str) -> str:
    return f"try_element_at(p, '{name}')"


def _present(values: Column) -> Column:
    return F.when(F.size(values) > 0, values)


def _differing(shown: Column, texts: Column) -> Column:
    """Body fields whose display values are not just their string values."""
    plain = F.create_map(
        *[x for name in K.HEAVY_FIELDS for x in (F.lit(name), texts.getField(name))]
    )
    kept = F.map_filter(
        shown,
        lambda k, v: k.isin(*K.HEAVY_FIELDS) & ~v.eqNullSafe(F.try_element_at(plain, k)),
    )
    return F.when(F.size(kept) > 0, kept)
