"""Queries for the investigation workflows."""

from __future__ import annotations

from pyspark.sql import functions as F

from entitylake.operators import predicates as P
from entitylake.plans import duck as Q
from entitylake.plans import workflows as WF
from entitylake.plans.catalog.registry import query
from entitylake.sources import testbed as TB

_ALL = f"WITH {Q.ENTITIES}"
_DOCS = f"WITH {Q.DOCS}, d AS (SELECT *, {Q.line('search_text')} AS line FROM docs)"


@query(
    "wrk1_follow_company",
    """WITH c AS (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem
         JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey WHERE n_name = 'NATION_8')
       SELECT 'company.' || l_suppkey AS entity_id, 'supplier' AS role,
         'contract.' || l_orderkey || '.' || l_suppkey AS source_id FROM c
       UNION ALL SELECT 'order.' || l_orderkey, 'order', 'contract.' || l_orderkey || '.' || l_suppkey FROM c""",
)
def wrk1_follow_company(spark, sf):
    rows = TB.entities(spark, sf, TB.companies, TB.contracts, TB.people, TB.orders)
    return WF.follow_company(rows, "nation 8", ["supplier", "order"])


@query(
    "wrk2_person_of_interest",
    f"""{_DOCS}, m AS (SELECT 'mail.' || page_id AS id, 'Email' AS schema,
          {Q.line("concat_ws(' ', regexp_extract(html, '<title>([^<]*)</title>', 1), regexp_replace(html, '<[^>]+>', ' ', 'g'))")} AS line FROM pages),
        a AS (SELECT id, 'Pages' AS schema, line FROM d UNION ALL SELECT * FROM m
          UNION ALL SELECT 'conv.' || conv_id, 'Pages', ' conversation ' || conv_id || ' ' FROM (SELECT DISTINCT conv_id FROM conversations))
        SELECT id, schema FROM a WHERE (contains(line, ' erst the ') OR contains(line, ' en la ') OR contains(line, ' conversation 3 '))
        AND NOT contains(line, ' that the ')""",
)
def wrk2_person_of_interest(spark, sf):
    found = WF.mentions(TB.entities(spark, sf), ["Erst the", "en la", "Conversation 3"], ["that the"])
    return found.select("id", "schema")


@query(
    "wrk3_leak_triage",
    f"""{_ALL} SELECT id, schema AS type, coalesce(props['title'], props['subject'], props['name'], props['fileName']) AS title,
        props['date'] AS date FROM entities WHERE collection_id = 'trade' AND schema = 'Order'
        AND props['status'] = 'P' AND props['date'] BETWEEN '1998-01-01' AND '1999-06-30'
        ORDER BY id LIMIT 100 OFFSET 50""",
)
def wrk3_leak_triage(spark, sf):
    return WF.triage(
        TB.entities(spark, sf),
        "trade",
        schemata=["Interval"],
        extra_filters={"status": "P"},
        dates=("1998-01-01", "1999-06-30"),
        limit=100,
        offset=50,
    )


@query(
    "wrk3_file_triage",
    f"""{_ALL} SELECT id, schema AS type, props['fileName'] AS title, NULL::VARCHAR AS date FROM entities
        WHERE collection_id = 'src3' AND props['mimeType'] = 'text/plain'""",
)
def wrk3_file_triage(spark, sf):
    return WF.triage(
        TB.entities(spark, sf), "src3", schemata=["Document"], extra_filters={"mimeType": "text/plain"}
    )


@query(
    "wrk4_verify_claim",
    f"""{_DOCS} SELECT unnest(['phrase', 'either', 'nothing']) AS query,
        unnest([count(*) FILTER (contains(line, ' of the ')),
                count(*) FILTER (contains(line, ' erst ') OR contains(line, ' tion ')), 0]) AS n,
        unnest(['indexed matches', 'indexed matches', 'no indexed match']) AS verdict FROM d""",
)
def wrk4_verify_claim(spark, sf):
    line = P.search_line()
    return WF.verify_claim(
        TB.documents(spark, sf),
        {
            "phrase": P.has_phrase("of the", line),
            "either": P.has_any(["erst", "tion"], line),
            "nothing": P.has_phrase("no such words anywhere", line),
        },
    )


@query(
    "agg5_hits_per_query",
    f"""{_ALL} SELECT unnest(['people', 'rich', 'none', 'late']) AS query,
        unnest([count(*) FILTER (schema = 'Person'), count(*) FILTER (try_cast(props['balance'] AS DOUBLE) > 9000),
                0, count(*) FILTER (try_cast(props['date'] AS DATE) >= DATE '2001-01-01')]) AS n FROM entities""",
)
def agg5_hits_per_query(spark, sf):
    return WF.hits_per_query(
        TB.entities(spark, sf),
        {
            "people": P.schema_is("Person"),
            "rich": P.prop_num_cmp("balance", ">", 9000),
            "none": P.prop_eq("countries", "Atlantis"),
            "late": P.prop_date_cmp("date", ">=", "2001-01-01"),
        },
    )


@query(
    "wrk5_citations",
    rf"""WITH b AS (
          SELECT 'doc.' || doc_id AS id, 'Pages' AS schema, '{Q.ORIGIN}/entities/doc.' || doc_id AS link,
                 source AS collection_id, {Q.trim('text')} AS body FROM documents
          UNION ALL SELECT 'conv.' || conv_id, 'Pages', '{Q.ORIGIN}/entities/conv.' || conv_id, 'conversations',
                 string_agg({Q.trim('text')}, chr(10) || chr(10) ORDER BY turn) FROM conversations GROUP BY conv_id
          UNION ALL SELECT 'mail.' || page_id, 'Email', url, 'mail', {Q.markdown('html')} FROM pages),
        e AS (SELECT *, length(regexp_extract(body, '(?is)^(.*?[^\p{{L}}\p{{N}}]|)of[^\p{{L}}\p{{N}}]+the(?:[^\p{{L}}\p{{N}}]|$)', 1)) AS before FROM b
          WHERE regexp_matches(body, '(?is)(?:^|[^\p{{L}}\p{{N}}])of[^\p{{L}}\p{{N}}]+the(?:[^\p{{L}}\p{{N}}]|$)'))
        SELECT id, schema, link, collection_id,
          right(left(body, before), 97) || substring(body, before + 1, 6 + 97) AS excerpt FROM e""",
)
def wrk5_citations(spark, sf):
    files = TB.entities(spark, sf, TB.documents, TB.conversation_files, TB.mails)
    return WF.citations(files, "of the", children=TB.conversation_pages(spark, sf))


@query(
    "wrk6_cross_border",
    f"""{_ALL} SELECT props['countries'] AS value, count(*) AS n FROM entities
        WHERE schema IN ('Person', 'Company') AND props['countries'] IN ('NATION_1', 'NATION_2', 'NATION_9')
        AND (starts_with(props['name'], 'Supplier#') OR props['topics'] = 'BUILDING') GROUP BY ALL""",
)
def wrk6_cross_border(spark, sf):
    rows = TB.entities(spark, sf)
    return WF.cross_border(rows, ["Supplier", "building"], ["NATION_1", "NATION_2", "NATION_9"])
