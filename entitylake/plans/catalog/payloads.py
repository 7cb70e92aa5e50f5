"""Queries for scans of captured payloads, logs and structured output."""

from __future__ import annotations

from pyspark.sql import functions as F

from entitylake import constants as K
from entitylake.functions import display as D
from entitylake.operators import joins as J
from entitylake.operators import shape as SH
from entitylake.plans import duck as Q
from entitylake.plans.catalog.registry import query
from entitylake.sources import logs as L
from entitylake.sources import payloads as P
from entitylake.sources import tables as TA
from entitylake.sources import testbed as TB

_SEARCH = "contains(url, '/api/2/search')"
_ENTITY = "contains(url, '/api/2/entities/')"

_TURNS = """turns AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, turn // 10 ORDER BY turn) - 1 AS rank
  FROM conversations)"""


@query(
    "src1_search_envelopes",
    f"""WITH {_TURNS} SELECT 'conv.' || conv_id || '.' || turn AS id, 'Page' AS schema,
        'conversations' AS dataset, rank, turn::DOUBLE AS page_index, 'conv.' || conv_id AS parent_id
        FROM turns""",
)
def src1_search_envelopes(spark, sf):
    entities = P.scan_envelopes(TB.responses(spark, sf).filter(_SEARCH))
    return entities.select(
        "id", "schema", "dataset", "rank", "page_index", F.get("document_ids", F.lit(0)).alias("parent_id")
    )


@query(
    "src2_entities_by_id",
    """SELECT 'person.' || c_custkey AS id, c_name || ',' || upper(c_mktsegment) AS names FROM customer
       WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)""",
)
def src2_entities_by_id(spark, sf):
    people = P.scan_entities(TB.raw_people(spark, sf))
    wanted = (
        TB.table(spark, sf, "orders")
        .filter("o_totalprice > 400000")
        .select(F.concat(F.lit("person."), F.col("o_custkey").cast("string")).alias("id"))
    )
    found = J.get_entities(people, wanted)
    return found.select("id", F.array_join(F.try_element_at("props", F.lit("name")), ",").alias("names"))


@query(
    "src2_rejected_bodies",
    f"""SELECT '{Q.ORIGIN}/api/2/entities/mail.' || page_id AS url, length(html) AS raw_chars FROM pages
        WHERE page_id % 7 = 0""",
)
def src2_rejected_bodies(spark, sf):
    rejected = P.rejected_entities(TB.responses(spark, sf), "body")
    return rejected.select("url", F.length("raw_text").alias("raw_chars"))


@query(
    "src3_lenient_decode",
    f"""SELECT '{Q.ORIGIN}/api/2/entities/mail.' || page_id AS url, page_id % 7 <> 0 AS decoded,
        CASE WHEN page_id % 7 = 0 THEN md5(html) END AS raw_text FROM pages""",
)
def src3_lenient_decode(spark, sf):
    return P.decode(TB.responses(spark, sf).filter(_ENTITY), "body").select(
        "url", F.col("doc").isNotNull().alias("decoded"), F.md5("raw_text").alias("raw_text")
    )


@query(
    "src4_failed_responses",
    f"""SELECT '{Q.ORIGIN}/api/2/entities/mail.' || page_id AS url,
        CASE WHEN page_id % 7 = 0 THEN 502 ELSE 404 END AS status,
        CASE WHEN page_id % 7 = 0
          THEN 'HTTP 502: Get entity failed: HTTP 502' || chr(10) || json_object('raw', html)::VARCHAR
          ELSE 'HTTP 404: Get entity failed: HTTP 404' || chr(10) || '{{"message":"not found"}}' END AS error
        FROM pages WHERE page_id % 7 IN (0, 1)""",
)
def src4_failed_responses(spark, sf):
    _, failed = P.split_responses(TB.responses(spark, sf), "Get entity failed")
    return failed.select("url", "status", "error")


@query(
    "src4_good_responses",
    f"""WITH {_TURNS} SELECT url, 200 AS status FROM (
        SELECT DISTINCT '{Q.ORIGIN}/api/2/search?q=*&document=conv.' || conv_id || '&offset=' || (turn // 10 * 10) AS url
        FROM turns) UNION ALL SELECT '{Q.ORIGIN}/api/2/entities/mail.' || page_id, 200 FROM pages
        WHERE page_id % 7 > 1""",
)
def src4_good_responses(spark, sf):
    good, _ = P.split_responses(TB.responses(spark, sf))
    return good.select("url", "status")


@query(
    "src5_shaped_log",
    f"""WITH {_TURNS}, s AS (
        SELECT '{Q.ORIGIN}/api/2/search?q=*&document=conv.' || conv_id || '&offset=' || (turn // 10 * 10) AS url,
          list('conv.' || conv_id || '.' || turn ORDER BY rank) AS ids FROM turns GROUP BY ALL)
        SELECT url, 'search' AS kind, len(ids) AS hits, ids[1] AS first_id, NULL::BIGINT AS body_chars FROM s
        UNION ALL
        SELECT '{Q.ORIGIN}/api/2/entities/mail.' || page_id, CASE WHEN page_id % 7 > 1 THEN 'entity' ELSE 'other' END,
          NULL, CASE WHEN page_id % 7 > 1 THEN 'mail.' || page_id END,
          CASE WHEN page_id % 7 = 0 THEN length(html) WHEN page_id % 7 = 1 THEN length('{{"message":"not found"}}')
          ELSE length({Q.markdown('html')}) END FROM pages""",
)
def src5_shaped_log(spark, sf):
    log = L.shape_log(TB.responses(spark, sf))
    search, entity = F.col("kind") == "search", F.col("kind") == "entity"
    return log.select(
        "url",
        "kind",
        F.when(search, F.json_array_length("body")).cast("bigint").alias("hits"),
        F.when(search, F.get_json_object("body", "$[0].id"))
        .when(entity, F.get_json_object("body", "$.id"))
        .alias("first_id"),
        F.when(entity, F.get_json_object("body", "$.bodyMarkdownFullChars").cast("bigint"))
        .when(~search, F.length("body"))
        .alias("body_chars"),
    )


@query(
    "src6_redacted_headers",
    """SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'ApiKey ***' ELSE '***' END AS authorization,
       event_type AS accept FROM events""",
)
def src6_redacted_headers(spark, sf):
    secret = F.when(F.col("event_id") % 2 == 0, F.lit(" apikey ")).otherwise(F.lit("Bearer "))
    headers = F.create_map(
        F.lit("AUTHORIZATION"),
        F.concat(secret, F.col("user_id").cast("string")),
        F.lit("accept"),
        F.col("event_type"),
    )
    masked = TB.table(spark, sf, "events").select("event_id", L.redact_headers(headers).alias("h"))
    return masked.select(
        "event_id",
        F.col("h")["AUTHORIZATION"].alias("authorization"),
        F.col("h")["accept"].alias("accept"),
    )


@query(
    "src7_capped_bodies",
    f"""SELECT doc_id, md5(CASE WHEN length(text) > {K.LOG_CONSOLE_BODY_CHARS} THEN
          left(text, {K.LOG_CONSOLE_BODY_CHARS}) || chr(10) || '{K.ELLIPSIS} [truncated for console, ' || length(text) ||
          ' chars total; see log file for up to {K.LOG_FILE_BODY_CHARS} chars]' || chr(10) ELSE text END) AS console,
        length(CASE WHEN length(text) > {K.LOG_FILE_BODY_CHARS} THEN
          left(text, {K.LOG_FILE_BODY_CHARS}) || chr(10) || '{K.ELLIPSIS} [truncated, ' || length(text) ||
          ' chars total]' || chr(10) ELSE text END) AS file_chars FROM documents""",
)
def src7_capped_bodies(spark, sf):
    return TB.table(spark, sf, "documents").select(
        "doc_id",
        F.md5(L.cap_body(F.col("text"), console=True)).alias("console"),
        F.length(L.cap_body(F.col("text"))).alias("file_chars"),
    )


def _json_list(x: str) -> str:
    return f"json_array({x})"


@query(
    "snk1_structured_json",
    f"""WITH d AS (SELECT *, {Q.trim('text')} AS body FROM documents), c AS (SELECT *, {Q.cut('body', 200)} AS cut FROM d)
        SELECT 'doc.' || doc_id AS id, json_object('schema', 'Pages', 'properties', json_object(
          'bodyText', {_json_list('cut')}, 'fileName', {_json_list("source || '-' || doc_id || '.txt'")},
          'languages', {_json_list('lang')}, 'mimeType', {_json_list("'text/plain'")}),
          'dataset', source, 'score', NULL, 'id', 'doc.' || doc_id, 'link', '{Q.ORIGIN}/entities/doc.' || doc_id,
          'truncatedBody', length(cut) < length(body), 'bodyMarkdownFullChars', length(body),
          'bodyMarkdownReturnedChars', length(cut))::VARCHAR AS json FROM c""",
)
def snk1_structured_json(spark, sf):
    records = SH.search_records(TB.documents(spark, sf), keep=())
    return SH.to_json_records(records, keep=("id",))


@query(
    "snk2_record_and_raw",
    """SELECT 'person.' || c_custkey AS id, 'person.' || c_custkey AS record_id,
       CASE WHEN c_custkey % 4 <> 0 THEN '  person.' || c_custkey END AS raw_id, c_mktsegment AS segment
       FROM customer""",
)
def snk2_record_and_raw(spark, sf):
    records = SH.entity_records(P.scan_entities(TB.raw_people(spark, sf)), include_raw=True)
    return SH.to_json_records(records, keep=("id",)).select(
        "id",
        F.get_json_object("json", "$.result.id").alias("record_id"),
        F.get_json_object("json", "$.raw.id").alias("raw_id"),
        F.get_json_object("json", "$.raw.properties.profile[0].segment").alias("segment"),
    )


@query(
    "snk3_raw_rows",
    """SELECT c_name AS name, c_acctbal AS balance, n_name AS nation FROM customer JOIN nation
       ON c_nationkey = n_nationkey""",
)
def snk3_raw_rows(spark, sf):
    raw = TA.raw_rows(P.scan_entities(TB.raw_people(spark, sf)))
    return raw.select(
        F.get_json_object("raw", "$.properties.name[0]").alias("name"),
        F.get_json_object("raw", "$.properties.balance").cast("double").alias("balance"),
        F.get_json_object("raw", "$.properties.parent.caption").alias("nation"),
    )


@query(
    "scl13_index_from_json",
    """SELECT 'conv.' || conv_id || '.' || turn AS id, turn::DOUBLE AS page_index FROM conversations""",
)
def scl13_index_from_json(spark, sf):
    turns = TB.table(spark, sf, "conversations")
    nested = F.array(
        F.array(F.lit("none")), F.array(F.concat(F.lit(" "), F.col("turn").cast("string"), F.lit("abc")))
    )
    raw = turns.select(
        F.format_string("conv.%d.%d", "conv_id", "turn").alias("id"),
        F.try_parse_json(F.to_json(F.struct(nested.alias("index")))).alias("doc"),
    )
    return raw.select("id", D.first_number("try_variant_get(doc, '$.index', 'variant')").alias("page_index"))
