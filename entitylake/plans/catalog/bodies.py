"""Queries for full bodies, child pages and the missing-body report."""

from __future__ import annotations

from pyspark.sql import functions as F

from entitylake import constants as K
from entitylake.functions import text as T
from entitylake.operators import bodies as B
from entitylake.plans import duck as Q
from entitylake.plans.catalog.registry import query
from entitylake.sources import testbed as TB

_CHILD_BODIES = f"""child AS (
  SELECT 'conv.' || conv_id AS id, string_agg({Q.trim('text')}, chr(10) || chr(10) ORDER BY turn) AS body,
         count(*) AS pages
  FROM conversations WHERE {Q.trim('text')} <> '' GROUP BY conv_id)"""


def _files(spark, sf):
    return TB.entities(spark, sf, TB.conversation_files, TB.conversation_pages)


def _with_bodies(spark, sf):
    return TB.entities(spark, sf, TB.documents, TB.conversation_files, TB.conversation_pages, TB.mails)


@query(
    "joi1_child_page_bodies",
    f"""WITH {_CHILD_BODIES}, c AS (SELECT *, {Q.cut('body', 200)} AS cut FROM child)
        SELECT id, cut AS body, pages, length(body) AS full_chars, length(cut) < length(body) AS truncated FROM c""",
)
def joi1_child_page_bodies(spark, sf):
    """Files without text: their pages joined in order and cut for display."""
    joined = B.parent_bodies(_files(spark, sf)).withColumn("cut", T.cut_at_boundary(F.col("bodyText"), 200))
    return joined.select(
        "id",
        F.col("cut").alias("body"),
        F.col("childPageCount").alias("pages"),
        F.length("bodyText").alias("full_chars"),
        (F.length("cut") < F.length("bodyText")).alias("truncated"),
    )


@query(
    "agg1_child_text",
    f"WITH {_CHILD_BODIES} SELECT id AS parent_id, body, pages, false AS truncated FROM child",
)
def agg1_child_text(spark, sf):
    bodies = B.child_bodies(B.child_rows(TB.conversation_pages(spark, sf)))
    return bodies.select(
        "parent_id",
        F.col("bodyText").alias("body"),
        F.col("childPageCount").alias("pages"),
        F.col("htmlSourceTruncated").alias("truncated"),
    )


@query(
    "agg2_pages_with_text",
    """SELECT 'conv.' || conv_id AS parent_id, count(*) AS pages FROM conversations WHERE role = 'user'
       GROUP BY conv_id""",
)
def agg2_pages_with_text(spark, sf):
    """Only pages with text are counted; every answer page is blank here."""
    pages = B.child_rows(
        TB.conversation_pages(spark, sf)
    ).join(
        TB.table(spark, sf, "conversations").select(
            F.format_string("conv.%d.%d", "conv_id", "turn").alias("id"), "role"
        ),
        "id",
    )
    blanked = pages.withColumn("text", F.when(F.col("role") == "user", F.col("text"))).select(
        "parent_id", "position", "id", "text"
    )
    return B.child_bodies(blanked).select("parent_id", F.col("childPageCount").alias("pages"))


@query(
    "win1_first_children",
    """SELECT 'conv.' || conv_id AS parent_id, 'conv.' || conv_id || '.' || turn AS id,
       row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS place FROM conversations
       QUALIFY place <= 3""",
)
def win1_first_children(spark, sf):
    pages = B.child_rows(TB.conversation_pages(spark, sf))
    return B.first_children(pages, 3).select("parent_id", "id", "place")


@query(
    "lim5_child_order",
    """WITH p AS (SELECT conv_id, turn, CASE WHEN turn % 3 <> 1 THEN 7 - turn // 2 END AS position FROM conversations)
       SELECT 'conv.' || conv_id AS parent_id, 'conv.' || conv_id || '.' || turn AS id,
       row_number() OVER (PARTITION BY conv_id ORDER BY coalesce(position, 1e9), 'conv.' || conv_id || '.' || turn) AS place
       FROM p""",
)
def lim5_child_order(spark, sf):
    """Pages with equal and missing indexes."""
    pages = TB.conversation_pages(spark, sf)
    shuffled = pages.withColumn(
        "page_index",
        F.when(F.col("page_index") % 3 != 1, F.lit(7) - F.floor(F.col("page_index") / 2)).cast("double"),
    )
    return B.first_children(B.child_rows(shuffled), 500).select("parent_id", "id", "place")


@query(
    "bod1_mail_bodies",
    f"""WITH m AS (SELECT page_id, html, {Q.markdown('html')} AS md FROM pages)
        SELECT 'mail.' || page_id AS id, 'Email' AS schema, md AS body, length(md) AS full_chars,
        false AS source_cut FROM m WHERE md IS NOT NULL""",
)
def bod1_mail_bodies(spark, sf):
    return B.mail_bodies(TB.mails(spark, sf)).select(
        "id",
        "schema",
        F.col("bodyMarkdown").alias("body"),
        F.col("bodyMarkdownFullChars").alias("full_chars"),
        F.col("htmlSourceTruncated").alias("source_cut"),
    )


@query(
    "bod2_page_bodies",
    f"""SELECT 'doc.' || doc_id AS id, md5({Q.trim('text')}) AS body, length({Q.trim('text')}) AS full_chars,
        false AS source_cut FROM documents WHERE {Q.trim('text')} <> ''""",
)
def bod2_page_bodies(spark, sf):
    return B.page_bodies(TB.documents(spark, sf)).select(
        "id",
        F.md5("bodyText").alias("body"),
        F.col("bodyTextFullChars").alias("full_chars"),
        F.col("htmlSourceTruncated").alias("source_cut"),
    )


_ALL_BODIES = f"""WITH {_CHILD_BODIES}, b AS (
  SELECT 'doc.' || doc_id AS id, 'Pages' AS schema, NULL AS md, {Q.trim('text')} AS body, false AS kids, NULL::BIGINT AS pages
  FROM documents
  UNION ALL SELECT 'conv.' || conv_id || '.' || turn, 'Page', NULL, {Q.trim('text')}, false, NULL FROM conversations
  UNION ALL SELECT id, 'Pages', NULL, body, true, pages FROM child
  UNION ALL SELECT 'mail.' || page_id, 'Email', {Q.markdown('html')}, NULL, NULL, NULL FROM pages)"""


@query(
    "bod4_full_bodies",
    f"""{_ALL_BODIES} SELECT id, schema, md5(md) AS markdown, md5(body) AS body, length(md) AS markdown_chars,
        length(body) AS body_chars, kids AS from_children, pages FROM b WHERE coalesce(md, body) <> ''""",
)
def bod4_full_bodies(spark, sf):
    return B.full_body(_with_bodies(spark, sf)).select(
        "id",
        "schema",
        F.md5("bodyMarkdown").alias("markdown"),
        F.md5("bodyText").alias("body"),
        F.col("bodyMarkdownFullChars").alias("markdown_chars"),
        F.col("bodyTextFullChars").alias("body_chars"),
        F.col("bodyTextFromChildren").alias("from_children"),
        F.col("childPageCount").alias("pages"),
    )


@query(
    "set2_body_branches",
    f"""{_ALL_BODIES} SELECT schema, count(md) AS mails, count(body) AS texts, count(pages) AS joined
        FROM b WHERE coalesce(md, body) <> '' GROUP BY schema""",
)
def set2_body_branches(spark, sf):
    return (
        B.full_body(_with_bodies(spark, sf))
        .groupBy("schema")
        .agg(
            F.count("bodyMarkdown").alias("mails"),
            F.count("bodyText").alias("texts"),
            F.count("childPageCount").alias("joined"),
        )
    )


@query(
    "aud1_missing_bodies",
    f"""WITH f AS (SELECT DISTINCT conv_id FROM conversations),
        kept AS (SELECT DISTINCT conv_id FROM conversations WHERE role = 'user' AND length({Q.trim('text')}) >= 300)
        SELECT 'conv.' || conv_id AS id, 'Pages' AS schema, 'title' AS present_keys FROM f
        WHERE conv_id NOT IN (SELECT conv_id FROM kept)
        UNION ALL SELECT 'person.' || c_custkey, 'Person', 'balance, countries, name, topics' FROM customer
        UNION ALL SELECT 'mail.' || page_id, 'Email', 'bodyHtml, subject' FROM pages WHERE {Q.markdown('html')} IS NULL
        UNION ALL SELECT 'doc.' || doc_id, 'Pages',
          CASE doc_id % 3 WHEN 0 THEN 'bodyText, ' ELSE '' END || 'fileName, ' ||
          CASE doc_id % 3 WHEN 1 THEN 'indexText, ' ELSE '' END || 'languages, mimeType' ||
          CASE doc_id % 3 WHEN 2 THEN ', rawText' ELSE '' END
        FROM documents WHERE {Q.trim('text')} = ''""",
)
def aud1_missing_bodies(spark, sf):
    """People, empty mails and texts, and files none of whose questions is long."""
    pages = TB.conversation_pages(spark, sf)
    long = F.length(T.flatten_text(F.col("texts.bodyText"))) >= 300
    left = pages.filter((F.get(F.col("props")["author"], F.lit(0)) == "user") & long)
    entities = TB.entities(spark, sf, TB.documents, TB.conversation_files, TB.mails, TB.people)
    return B.missing_body(entities, children=left)


@query(
    "joi4_without_body",
    f"""SELECT 'person.' || c_custkey AS id FROM customer
        UNION ALL SELECT 'mail.' || page_id FROM pages WHERE {Q.markdown('html')} IS NULL
        UNION ALL SELECT 'conv.' || conv_id FROM (SELECT conv_id FROM conversations GROUP BY conv_id
          HAVING count(*) FILTER ({Q.trim('text')} <> '') = 0)""",
)
def joi4_without_body(spark, sf):
    entities = TB.entities(spark, sf, TB.mails, TB.people, TB.conversation_files)
    return B.missing_body(entities, children=TB.conversation_pages(spark, sf)).select("id")


@query(
    "lim7_listed_keys",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN '(no non-empty properties)'
       WHEN o_orderkey % 3 = 1 THEN 'customer, date, priority, status, total'
       ELSE 'k01, k02, k03, k04, k05, k06, k07, k08, k09, k10, k11, k12, k13, k14, k15, k16, k17, k18, k19, k20, … (+5 more)'
       END AS keys FROM orders""",
)
def lim7_listed_keys(spark, sf):
    many = F.transform(F.sequence(F.lit(1), F.lit(25)), lambda i: F.format_string("k%02d", i))
    few = F.array(*[F.lit(k) for k in ("total", "date", "customer", "status", "priority")])
    key = F.col("o_orderkey") % 3
    keys = F.when(key == 1, few).when(key == 2, many)
    return TB.table(spark, sf, "orders").select("o_orderkey", B.listed_keys(keys).alias("keys"))


@query(
    "bod3_child_fallback",
    f"""WITH {_CHILD_BODIES} SELECT id, 'Pages' AS schema, md5(body) AS body, length(body) AS full_chars,
        false AS source_cut, pages FROM child""",
)
def bod3_child_fallback(spark, sf):
    """Only files without own text fall back to their pages."""
    corpus = TB.entities(spark, sf, TB.documents, TB.conversation_files, TB.conversation_pages)
    return B.parent_bodies(corpus).select(
        "id",
        "schema",
        F.md5("bodyText").alias("body"),
        F.col("bodyTextFullChars").alias("full_chars"),
        F.col("htmlSourceTruncated").alias("source_cut"),
        F.col("childPageCount").alias("pages"),
    )
