"""Queries for slim records."""

from __future__ import annotations

from pyspark.sql import functions as F

from entitylake import schema as S
from entitylake.operators import predicates as PR
from entitylake.operators import shape as SH
from entitylake.plans import duck as Q
from entitylake.plans.catalog.registry import query
from entitylake.sources import payloads as P
from entitylake.sources import testbed as TB


def _people(spark, sf):
    return P.scan_entities(TB.raw_people(spark, sf))


def _joined(column, key):
    return F.array_join(F.try_element_at(F.col(column), F.lit(key)), "|")


_PLACES = "customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"


@query(
    "prj1_slim_record",
    f"""SELECT 'person.' || c_custkey AS id, CASE WHEN c_custkey % 5 <> 0 THEN 'Person' ELSE 'Unknown' END AS schema,
        c_name || '|' || upper(c_mktsegment) AS names, n_name AS country, 'registry' AS dataset,
        CASE WHEN c_custkey % 3 < 2 THEN c_acctbal END AS score,
        '{Q.ORIGIN}/entities/person.' || c_custkey AS link, NULL::BOOLEAN AS truncated
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
)
def prj1_slim_record(spark, sf):
    return SH.entity_records(_people(spark, sf)).select(
        "id",
        "schema",
        _joined("properties", "name").alias("names"),
        _joined("properties", "country").alias("country"),
        "dataset",
        "score",
        "link",
        F.col("truncatedBody").alias("truncated"),
    )


@query(
    "prj2_kept_keys",
    """SELECT 'person.' || c_custkey AS id, 'balance codes country name profile' AS keys FROM customer""",
)
def prj2_kept_keys(spark, sf):
    records = SH.entity_records(_people(spark, sf))
    return records.select("id", F.array_join(F.array_sort(F.map_keys("properties")), " ").alias("keys"))


@query(
    "prj3_value_lists",
    """SELECT 'person.' || c_custkey AS id, c_name AS first_name, 1 AS names, 2 AS all_names FROM customer""",
)
def prj3_value_lists(spark, sf):
    people = _people(spark, sf)
    names = PR.values("name")
    short = SH.entity_records(people.withColumn("all_names", F.size(names)), max_array_values_per_field=1, keep=("all_names",))
    kept = F.try_element_at("properties", F.lit("name"))
    return short.select(
        "id", F.get(kept, F.lit(0)).alias("first_name"), F.size(kept).alias("names"), "all_names"
    )


def _two_bodies(spark, sf):
    """Files with body text and index text, so that one stays out of the record."""
    return TB.documents(spark, sf).withColumn(
        "texts",
        S.texts(
            bodyText=F.coalesce("texts.bodyText", "texts.indexText", "texts.rawText"),
            indexText=F.array("collection_id", "id"),
            translatedText=F.coalesce("texts.rawText", "texts.bodyText", "texts.indexText"),
        ),
    )


@query(
    "prj4_heavy_fields_left_out",
    f"""SELECT 'doc.' || doc_id AS id, 'bodyText fileName languages mimeType' AS keys,
        {Q.cut(Q.trim('text'), 200)} AS body FROM documents""",
)
def prj4_heavy_fields_left_out(spark, sf):
    return SH.search_records(_two_bodies(spark, sf)).select(
        "id",
        F.array_join(F.array_sort(F.map_keys("properties")), " ").alias("keys"),
        _joined("properties", "bodyText").alias("body"),
    )


@query(
    "prj4_heavy_fields_kept",
    """SELECT 'doc.' || doc_id AS id, trim(text) AS body, source || '|doc.' || doc_id AS index_text,
       NULL::BIGINT AS full_chars FROM documents""",
)
def prj4_heavy_fields_kept(spark, sf):
    return SH.search_records(_two_bodies(spark, sf), include_content_fields=True).select(
        "id",
        _joined("properties", "bodyText").alias("body"),
        _joined("properties", "indexText").alias("index_text"),
        F.col("bodyMarkdownFullChars").alias("full_chars"),
    )


@query(
    "prj5_previews",
    f"""SELECT 'doc.' || doc_id AS id, 'indexTextPreview translatedTextPreview' AS keys, source[:4] ||
        CASE WHEN length(source) > 4 THEN '...' ELSE '' END AS index_preview,
        CASE WHEN length(text) > 4 THEN left(text, 4) || '...' ELSE text END AS translated_preview,
        {Q.cut(Q.trim('text'), 4)} AS body FROM documents""",
)
def prj5_previews(spark, sf):
    records = SH.search_records(_two_bodies(spark, sf), content_preview_chars=4)
    return records.select(
        "id",
        F.array_join(F.array_sort(F.map_keys("previews")), " ").alias("keys"),
        F.col("previews")["indexTextPreview"].alias("index_preview"),
        F.col("previews")["translatedTextPreview"].alias("translated_preview"),
        _joined("properties", "bodyText").alias("body"),
    )


@query(
    "prj6_display_values",
    """SELECT 'person.' || c_custkey AS id, n_name AS country, c_acctbal::DOUBLE AS balance,
       '{"segment":"' || c_mktsegment || '"}' AS profile, c_custkey || ', x|y' AS codes
       FROM customer JOIN nation ON c_nationkey = n_nationkey""",
)
def prj6_display_values(spark, sf):
    return _people(spark, sf).select(
        "id",
        _joined("props", "country").alias("country"),
        _joined("props", "balance").cast("double").alias("balance"),
        _joined("props", "profile").alias("profile"),
        _joined("props", "codes").alias("codes"),
    )


@query(
    "prj7_names_of_objects",
    """SELECT 'order.' || o_orderkey AS id, c_name AS customer FROM orders JOIN customer ON o_custkey = c_custkey""",
)
def prj7_names_of_objects(spark, sf):
    orders = TB.table(spark, sf, "orders")
    customers = TB.table(spark, sf, "customer").select("c_custkey", "c_name")
    nested = F.struct(
        F.concat(F.lit("person."), F.col("c_custkey").cast("string")).alias("id"),
        F.struct(F.array(F.lit(" "), F.col("c_name")).alias("name")).alias("properties"),
    )
    raw = TB.spread(orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))).select(
        F.to_json(
            F.struct(
                F.concat(F.lit("order."), F.col("o_orderkey").cast("string")).alias("id"),
                F.struct(F.array(nested).alias("customer")).alias("properties"),
            )
        ).alias("raw")
    )
    return P.scan_entities(raw).select("id", _joined("props", "customer").alias("customer"))


@query(
    "prj9_references",
    f"""SELECT 'person.' || c_custkey AS id, 'Country' AS parent_schema, n_name AS parent_caption,
        'nation.' || n_nationkey AS parent_id, true AS parent_is_object, n_name || '|' || r_name AS ancestors
        FROM {_PLACES}""",
)
def prj9_references(spark, sf):
    parent = F.get("parent", F.lit(0))
    return SH.entity_records(_people(spark, sf)).select(
        "id",
        parent["schema"].alias("parent_schema"),
        parent["caption"].alias("parent_caption"),
        parent["id"].alias("parent_id"),
        "parent_is_object",
        F.array_join(F.transform("ancestors", lambda a: a["caption"]), "|").alias("ancestors"),
    )


@query(
    "prj10_recipients",
    f"""SELECT 'person.' || c_custkey AS id, 'Region' AS schema, 'region.' || r_regionkey AS recipient_id,
        r_name AS name, NULL::VARCHAR AS email, 1 AS n FROM {_PLACES}""",
)
def prj10_recipients(spark, sf):
    first = F.get("recipients", F.lit(0))
    return SH.entity_records(_people(spark, sf)).select(
        "id",
        first["schema"].alias("schema"),
        first["id"].alias("recipient_id"),
        first["name"].alias("name"),
        first["email"].alias("email"),
        F.size("recipients").alias("n"),
    )


@query(
    "prj12_score_and_dataset",
    """SELECT 'person.' || c_custkey AS id, 'registry' AS dataset,
       CASE WHEN c_custkey % 3 = 2 THEN NULL ELSE c_acctbal END AS score FROM customer""",
)
def prj12_score_and_dataset(spark, sf):
    return _people(spark, sf).select("id", "dataset", "score")


@query(
    "prj14_canonical_ids",
    """SELECT 'person.' || c_custkey AS id, CASE WHEN c_custkey % 4 <> 0 THEN 'person.' || c_custkey END AS own_id
       FROM customer""",
)
def prj14_canonical_ids(spark, sf):
    return _people(spark, sf).select("id", "own_id")


@query(
    "prj15_schema_names",
    """SELECT CASE WHEN c_custkey % 5 <> 0 THEN 'Person' ELSE 'Unknown' END AS schema, count(*) AS n
       FROM customer GROUP BY ALL""",
)
def prj15_schema_names(spark, sf):
    return _people(spark, sf).groupBy("schema").agg(F.count("*").alias("n"))


@query(
    "prj16_highlight_bodies",
    f"""WITH t AS (SELECT *, role = 'user' AS own,
          CASE WHEN role = 'user' THEN {Q.trim('text')} ELSE {Q.strip_highlight("'<em>' || text || '</em>'")} END AS body
          FROM conversations), c AS (SELECT *, {Q.cut('body', 200)} AS cut FROM t)
        SELECT 'conv.' || conv_id || '.' || turn AS id, cut AS body, CASE WHEN NOT own THEN true END AS from_highlight,
          length(cut) < length(body) AS truncated, length(body) AS full_chars,
          CASE WHEN NOT own THEN '<em>' || text || '</em>' END AS highlight FROM c""",
)
def prj16_highlight_bodies(spark, sf):
    hits = P.scan_envelopes(TB.responses(spark, sf).filter(F.col("url").contains("/api/2/search")))
    return SH.search_records(hits).select(
        "id",
        _joined("properties", "bodyText").alias("body"),
        F.col("bodyTextFromSearchHighlight").alias("from_highlight"),
        F.col("truncatedBody").alias("truncated"),
        F.col("bodyMarkdownFullChars").alias("full_chars"),
        F.array_join("highlight", "|").alias("highlight"),
    )


@query(
    "prj18_mail_records",
    f"""WITH m AS (SELECT *, {Q.markdown('html')} AS md FROM pages), c AS (SELECT *, {Q.cut('md', 200)} AS cut FROM m)
        SELECT 'mail.' || page_id AS id, cut AS body, length(cut) < length(md) AS truncated,
        length(md) AS full_chars, length(cut) AS returned_chars, 'bodyMarkdown subject' AS keys FROM c""",
)
def prj18_mail_records(spark, sf):
    mails = TB.mails(spark, sf).withColumn(
        "props", F.map_concat("props", F.create_map(F.lit("bodyMarkdown"), F.array(F.lit("<div>x</div>"))))
    )
    return SH.search_records(mails).select(
        "id",
        _joined("properties", "bodyMarkdown").alias("body"),
        F.col("truncatedBody").alias("truncated"),
        F.col("bodyMarkdownFullChars").alias("full_chars"),
        F.col("bodyMarkdownReturnedChars").alias("returned_chars"),
        F.array_join(F.array_sort(F.map_keys("properties")), " ").alias("keys"),
    )


@query(
    "prj19_page_records",
    f"""WITH d AS (SELECT *, {Q.trim('text')} AS body FROM documents), c AS (SELECT *, {Q.cut('body', 6000)} AS cut FROM d)
        SELECT 'doc.' || doc_id AS id, md5(cut) AS body, length(cut) < length(body) AS truncated,
        length(body) AS full_chars FROM c""",
)
def prj19_page_records(spark, sf):
    return SH.entity_records(TB.documents(spark, sf)).select(
        "id",
        F.md5(_joined("properties", "bodyText")).alias("body"),
        F.col("truncatedBody").alias("truncated"),
        F.col("bodyMarkdownFullChars").alias("full_chars"),
    )


@query(
    "lim6_value_cap",
    """SELECT 'order.' || o_orderkey AS id, 20 AS kept FROM orders""",
)
def lim6_value_cap(spark, sf):
    many = TB.orders(spark, sf).withColumn(
        "props", F.create_map(F.lit("codes"), F.transform(F.sequence(F.lit(1), F.lit(30)), lambda i: i.cast("string")))
    )
    return SH.search_records(many).select(
        "id", F.size(F.try_element_at("properties", F.lit("codes"))).alias("kept")
    )


def _order_json(spark, sf, **fields):
    """Orders as JSON entities with the given outer fields."""
    orders = TB.spread(TB.table(spark, sf, "orders"))
    key = F.concat(F.lit("order."), F.col("o_orderkey").cast("string"))
    body = F.struct(key.alias("id"), *[value.alias(name) for name, value in fields.items()])
    return P.scan_entities(orders.select(F.to_json(body).alias("raw")))


@query(
    "prj8_property_values",
    """SELECT 'order.' || o_orderkey AS id, o_orderstatus AS status, o_orderpriority AS priority,
       NULL::VARCHAR AS blank, o_orderstatus || '|true|' || o_custkey AS mixed FROM orders""",
)
def prj8_property_values(spark, sf):
    properties = F.struct(
        F.concat(F.lit(" "), F.col("o_orderstatus")).alias("status"),
        F.array(F.lit(None).cast("string"), F.lit("  "), F.col("o_orderpriority")).alias("priority"),
        F.array(F.lit(""), F.lit(" ")).alias("blank"),
    )
    mixed = F.to_json(F.struct(F.col("o_orderstatus").alias("s")))
    rows = TB.spread(TB.table(spark, sf, "orders")).select(
        F.concat(
            F.regexp_replace(
                F.to_json(
                    F.struct(
                        F.concat(F.lit("order."), F.col("o_orderkey").cast("string")).alias("id"),
                        properties.alias("properties"),
                    )
                ),
                r"\}\}\z",
                "",
            ),
            F.lit(',"mixed":['),
            F.regexp_extract(mixed, r":(.*)\}\z", 1),
            F.lit(",true,null,"),
            F.col("o_custkey").cast("string"),
            F.lit("]}}"),
        ).alias("raw")
    )
    return P.scan_entities(rows).select(
        "id", *[_joined("props", name).alias(name) for name in ("status", "priority", "blank", "mixed")]
    )


@query(
    "prj11_dataset",
    """SELECT 'order.' || o_orderkey AS id, CASE o_orderstatus WHEN 'O' THEN 'O' WHEN 'F' THEN o_orderpriority
       ELSE 'person.' || o_custkey END AS dataset FROM orders""",
)
def prj11_dataset(spark, sf):
    status = F.col("o_orderstatus")
    rows = _order_json(
        spark,
        sf,
        dataset=F.when(status == "O", F.concat(F.lit(" "), status)).otherwise(F.lit(" ")),
        collection_id=F.when(status == "F", F.col("o_orderpriority")),
        collection=F.struct(F.concat(F.lit("person."), F.col("o_custkey").cast("string")).alias("id")),
    )
    return SH.search_records(rows).select("id", "dataset")


@query(
    "prj13_link",
    """SELECT 'order.' || o_orderkey AS id, ' /ui/' || o_orderstatus || ' ' AS link FROM orders""",
)
def prj13_link(spark, sf):
    """The link is kept as it is, white space included."""
    rows = _order_json(
        spark,
        sf,
        links=F.struct(F.concat(F.lit(" /ui/"), F.col("o_orderstatus"), F.lit(" ")).alias("ui")),
    )
    return SH.search_records(rows).select("id", "link")


@query(
    "prj17_body_lengths",
    f"""WITH d AS (SELECT *, {Q.trim('text')} AS body FROM documents), c AS (SELECT *, {Q.cut('body', 1000)} AS cut FROM d)
        SELECT 'doc.' || doc_id AS id, length(cut) < length(body) AS truncated, length(body) AS full_chars,
        length(cut) AS returned_chars FROM c
        UNION ALL SELECT 'person.' || c_custkey, NULL, NULL, NULL FROM customer""",
)
def prj17_body_lengths(spark, sf):
    rows = TB.entities(spark, sf, TB.documents, TB.people)
    return SH.slim(rows, body_markdown_max_chars=1000).select(
        "id",
        F.col("truncatedBody").alias("truncated"),
        F.col("bodyMarkdownFullChars").alias("full_chars"),
        F.col("bodyMarkdownReturnedChars").alias("returned_chars"),
    )
