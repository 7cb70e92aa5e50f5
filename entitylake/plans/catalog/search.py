"""Queries for search predicates, paging, facets, ranking and links."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from entitylake import constants as K
from entitylake.functions import tokens as W
from entitylake.operators import joins as J
from entitylake.operators import predicates as P
from entitylake.operators import rank as R
from entitylake.operators import search as S
from entitylake.plans import duck as Q
from entitylake.plans.catalog.registry import query
from entitylake.sources import payloads as PL
from entitylake.sources import testbed as TB

_DOCS = f"WITH {Q.DOCS}, d AS (SELECT *, {Q.line('search_text')} AS line, {Q.words('search_text')} AS words FROM docs)"
_ALL = f"WITH {Q.ENTITIES}"


def _ids(df):
    return df.select("id")


def _docs(spark, sf):
    return TB.documents(spark, sf)


# --- Free text ------------------------------------------------------------


@query("flt1_match_all", f"{_ALL} SELECT id, schema FROM entities")
def flt1_match_all(spark, sf):
    return S.matching(TB.entities(spark, sf), P.match_all()).select("id", "schema")


@query("flt2_term", f"{_DOCS} SELECT id FROM d WHERE contains(line, ' erst ')")
def flt2_term(spark, sf):
    return _ids(S.matching(_docs(spark, sf), P.has_term("Erst")))


@query("flt3_phrase", f"{_DOCS} SELECT id FROM d WHERE contains(line, ' of the ')")
def flt3_phrase(spark, sf):
    return _ids(S.matching(_docs(spark, sf), P.has_phrase("of  The")))


def _close(x: str, term: str, n: int) -> str:
    # DuckDB compares bytes; one sign for each letter beyond ASCII makes it compare characters.
    plain = f"regexp_replace({x}, '[^\\x00-\\x7F]', '#', 'g')"
    return f"abs(length({x}) - {len(term)}) <= {n} AND levenshtein({plain}, '{term}') <= {n}"


@query(
    "flt4_fuzzy",
    f"{_DOCS} SELECT id FROM d WHERE len(list_filter(words, lambda w: {_close('w', 'tionment', 2)})) > 0",
)
def flt4_fuzzy(spark, sf):
    return _ids(S.matching(_docs(spark, sf), P.has_fuzzy("Tionment", 2)))


@query(
    "flt5_proximity",
    f"""{_DOCS}, pos AS (SELECT id, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM d),
        k AS (SELECT * FROM pos WHERE w IN ('from', 'with', 'that'))
        SELECT DISTINCT a.id FROM (SELECT * FROM k WHERE w = 'from') a
        JOIN (SELECT * FROM k WHERE w = 'with') b ON a.id = b.id AND abs(a.i - b.i) <= 12
        JOIN (SELECT * FROM k WHERE w = 'that') c ON a.id = c.id
        WHERE greatest(a.i, b.i, c.i) - least(a.i, b.i, c.i) <= 12""",
)
def flt5_proximity(spark, sf):
    return _ids(S.matching(_docs(spark, sf), P.near(["from", "with that"], 12)))


@query(
    "flt6_boolean",
    f"""{_DOCS} SELECT id FROM d WHERE (contains(line, ' the ') OR contains(line, ' les '))
        AND NOT contains(line, ' from ')""",
)
def flt6_boolean(spark, sf):
    where = P.on_text(
        lambda line: (P.has_term("the", line) | P.has_term("les", line)) & ~P.has_term("from", line)
    )
    return _ids(S.matching(_docs(spark, sf), where))


@query(
    "flt7_must_and_must_not",
    f"""{_DOCS} SELECT id FROM d WHERE contains(line, ' the ') AND contains(line, ' with ')
        AND NOT contains(line, ' from ') AND NOT contains(line, ' was the ')""",
)
def flt7_must_and_must_not(spark, sf):
    where = P.on_text(
        lambda line: P.must(P.has_term("the", line), P.has_term("with", line))
        & P.must_not(P.has_term("from", line), P.has_phrase("was the", line))
    )
    return _ids(S.matching(_docs(spark, sf), where))


@query(
    "flt2_mail_text",
    f"""WITH m AS (SELECT page_id, {Q.line("concat_ws(' ', regexp_extract(html, '<title>([^<]*)</title>', 1), " + Q.replace_all("html", K.HIGHLIGHT_TAG_PATTERN, " ") + ")")} AS line FROM pages)
        SELECT 'mail.' || page_id AS id FROM m WHERE contains(line, ' que ') AND contains(line, ' les ')""",
)
def flt2_mail_text(spark, sf):
    return _ids(S.matching(TB.mails(spark, sf), P.has_all(["que", "les"])))


# --- Properties -----------------------------------------------------------


@query("flt8_property", f"{_ALL} SELECT id FROM entities WHERE props['countries'] = 'NATION_7'")
def flt8_property(spark, sf):
    return _ids(S.matching(TB.entities(spark, sf), P.prop_eq("countries", "NATION_7")))


@query(
    "flt9_property_fuzzy",
    f"{_ALL} SELECT id FROM entities WHERE {_close('lower(props[$$topics$$])', 'bilding', 2)}",
)
def flt9_property_fuzzy(spark, sf):
    return _ids(S.matching(TB.entities(spark, sf), P.prop_fuzzy("topics", "Bilding", 2)))


@query(
    "flt10_property_regex",
    f"{_ALL} SELECT id FROM entities WHERE regexp_matches(props['name'], '^(?:Customer#0+[0-9]*7|Supplier#.*3)$')",
)
def flt10_property_regex(spark, sf):
    where = P.prop_regex("name", "Customer#0+[0-9]*7|Supplier#.*3")
    return _ids(S.matching(TB.entities(spark, sf), where))


@query(
    "flt11_date_after",
    f"{_ALL} SELECT id FROM entities WHERE try_cast(props['date'] AS DATE) > DATE '2000-07-01'",
)
def flt11_date_after(spark, sf):
    return _ids(S.matching(TB.entities(spark, sf), P.prop_date_cmp("date", ">", "2000-07-01")))


@query(
    "flt12_date_range",
    f"""{_ALL} SELECT id FROM entities WHERE try_cast(props['date'] AS DATE)
        BETWEEN DATE '1996-01-01' AND DATE '1997-12-31'""",
)
def flt12_date_range(spark, sf):
    where = P.prop_date_between("date", "1996-01-01", "1997-12-31")
    return _ids(S.matching(TB.entities(spark, sf), where))


@query(
    "flt13_number",
    f"{_ALL} SELECT id FROM entities WHERE try_cast(props['k'] AS DOUBLE) > 90",
)
def flt13_number(spark, sf):
    return _ids(S.matching(TB.entities(spark, sf), P.prop_num_cmp("k", ">", 90)))


# --- Types, collections, exact filters ------------------------------------


@query("flt14_schema", f"{_ALL} SELECT id FROM entities WHERE schema = 'Email'")
def flt14_schema(spark, sf):
    return _ids(S.matching(TB.entities(spark, sf), schema="Email"))


@query(
    "flt15_schemata",
    f"{_ALL}, {Q.CLOSURE} SELECT id, schema FROM entities WHERE schema IN (SELECT schema FROM closure WHERE ancestor = 'LegalEntity')",
)
def flt15_schemata(spark, sf):
    return S.matching(TB.entities(spark, sf), schemata="LegalEntity").select("id", "schema")


@query(
    "joi3_descendants",
    f"{_ALL}, {Q.CLOSURE} SELECT id, schema FROM entities WHERE schema IN (SELECT schema FROM closure WHERE ancestor IN ('Document', 'Company'))",
)
def joi3_descendants(spark, sf):
    found = S.matching(
        TB.entities(spark, sf), schemata=["Document", "Company"], closure=TB.closure(spark)
    )
    return found.select("id", "schema")


@query(
    "flt16_several_schemas",
    f"{_ALL} SELECT id, schema FROM entities WHERE schema IN ('Email', 'Pages', 'Company')",
)
def flt16_several_schemas(spark, sf):
    return S.matching(TB.entities(spark, sf), schema="Email, Pages Company,,Email").select("id", "schema")


@query(
    "flt17_query_and_schema",
    f"{_DOCS} SELECT id FROM d WHERE contains(line, ' with ')",
)
def flt17_query_and_schema(spark, sf):
    rows = TB.entities(spark, sf, TB.documents, TB.people, TB.companies)
    return _ids(S.matching(rows, P.has_term("with"), schemata="Document"))


@query("flt18_collection", f"{_ALL} SELECT id, schema FROM entities WHERE collection_id = 'src7'")
def flt18_collection(spark, sf):
    return S.matching(TB.entities(spark, sf), collection_id="src7").select("id", "schema")


@query(
    "flt19_extra_filters",
    f"""{_ALL} SELECT id, schema FROM entities WHERE schema = 'Person' AND props['topics'] = 'MACHINERY'
        AND props['countries'] = 'NATION_3'""",
)
def flt19_extra_filters(spark, sf):
    """The extra filter on the schema replaces the argument."""
    found = S.matching(
        TB.entities(spark, sf),
        schema="Company",
        extra_filters={"schema": "Person", "properties.topics": "MACHINERY", "countries": "NATION_3", " ": "x"},
    )
    return found.select("id", "schema")


@query(
    "flt20_children_of",
    f"{_ALL} SELECT id FROM entities WHERE props['document'] = 'conv.12'",
)
def flt20_children_of(spark, sf):
    rows = TB.entities(spark, sf)
    return _ids(S.matching(rows, schema="Page", extra_filters={"properties.document": "conv.12"}))


@query(
    "flt21_type_tests",
    f"""{_ALL} SELECT count(*) FILTER (schema = 'Email') AS mails,
        count(*) FILTER (schema IN ('Page', 'Pages')) AS pages FROM entities""",
)
def flt21_type_tests(spark, sf):
    from entitylake.functions import text as T

    padded = F.concat(F.lit(" "), F.upper("schema"), F.lit(chr(160)))
    return TB.entities(spark, sf).agg(
        F.count_if(T.is_email(padded)).alias("mails"), F.count_if(T.is_page(padded)).alias("pages")
    )


@query(
    "flt22_nonempty_properties",
    """SELECT 'order.' || o_orderkey AS id, CASE WHEN o_orderkey % 2 = 0 THEN 'customer' ELSE 'customer date' END AS keys FROM orders""",
)
def flt22_nonempty_properties(spark, sf):
    rows = TB.table(spark, sf, "orders")
    day = F.array(F.col("o_orderdate").cast("string"))
    empty = F.array().cast("array<string>")
    props = F.create_map(
        F.lit("customer"),
        F.array(F.col("o_custkey").cast("string")),
        F.lit("date"),
        F.when(F.col("o_orderkey") % 2 == 1, day).otherwise(empty),
        F.lit("status"),
        F.lit(None).cast("array<string>"),
    )
    return rows.select(
        F.concat(F.lit("order."), F.col("o_orderkey").cast("string")).alias("id"),
        F.array_join(F.array_sort(F.map_keys(P.nonempty_props(props))), " ").alias("keys"),
    )


# --- Paging, totals, facets -----------------------------------------------


def _scored_orders(spark, sf):
    orders = TB.orders(spark, sf)
    return orders.withColumn("score", F.get(P.values("total"), F.lit(0)).cast("double"))


@query(
    "lim2_offset_page",
    """SELECT 'order.' || o_orderkey AS id, o_totalprice AS score FROM orders
       ORDER BY o_totalprice DESC, 'order.' || o_orderkey LIMIT 25 OFFSET 40""",
)
def lim2_offset_page(spark, sf):
    return S.page(_scored_orders(spark, sf), limit=25, offset=40.9).select("id", "score")


@query(
    "lim2_deep_page",
    """SELECT l_orderkey || '.' || l_linenumber AS id, l_extendedprice AS score FROM lineitem
       ORDER BY l_extendedprice DESC, id LIMIT 40 OFFSET (SELECT count(*) * 5 // 8 FROM lineitem)""",
)
def lim2_deep_page(spark, sf):
    """A page far behind the middle of a large table."""
    rows = TB.table(spark, sf, "lineitem")
    hits = rows.select(
        F.concat_ws(".", "l_orderkey", "l_linenumber").alias("id"), F.col("l_extendedprice").cast("double").alias("score")
    )
    return S.page(hits, limit=40, offset=rows.count() * 5 // 8).select("id", "score")


@query(
    "lim3_result_order",
    """WITH s AS (SELECT 'order.' || o_orderkey AS id, CASE WHEN o_orderstatus <> 'F' THEN o_totalprice END AS score FROM orders)
       SELECT id, score, row_number() OVER (ORDER BY score DESC NULLS LAST, id) AS place FROM s
       QUALIFY place <= 10000""",
)
def lim3_result_order(spark, sf):
    """A page beyond the maximum is the maximum; rows without a score come last."""
    rows = _scored_orders(spark, sf).withColumn(
        "score", F.when(F.get(P.values("status"), F.lit(0)) != "F", F.col("score"))
    )
    hits = S.page(rows, limit=999_999).select("id", "score")
    from pyspark.sql import Window

    order = Window.orderBy(F.col("score").desc_nulls_last(), "id")
    return hits.withColumn("place", F.row_number().over(order))


@query(
    "agg3_facets",
    f"""{_ALL}, f AS (
        SELECT 'schema' AS facet, schema AS value FROM entities
        UNION ALL SELECT 'collection_id', collection_id FROM entities
        UNION ALL SELECT 'countries', props['countries'] FROM entities
        UNION ALL SELECT 'properties.languages', props['languages'] FROM entities
        UNION ALL SELECT 'author', props['author'] FROM entities
        UNION ALL SELECT 'date', props['date'] FROM entities)
        SELECT facet, value, count(*) AS n FROM f WHERE value IS NOT NULL GROUP BY ALL""",
)
def agg3_facets(spark, sf):
    fields = ["schema", "collection_id", "countries", "properties.languages", "author", " ", "date"]
    return S.facets(TB.entities(spark, sf), fields)


@query(
    "agg3_top_facets",
    f"""{_ALL}, f AS (
        SELECT 'collection_id' AS facet, collection_id AS value FROM entities
        UNION ALL SELECT 'customer', props['customer'] FROM entities
        UNION ALL SELECT 'date', props['date'] FROM entities),
        c AS (SELECT facet, value, count(*) AS n FROM f WHERE value IS NOT NULL GROUP BY ALL)
        SELECT facet, value, n FROM c QUALIFY row_number() OVER (PARTITION BY facet ORDER BY n DESC, value) <= 5""",
)
def agg3_top_facets(spark, sf):
    return S.facets(TB.entities(spark, sf), ["collection_id", "customer", "date"], top=5)


@query(
    "agg4_total",
    f"{_DOCS} SELECT count(*) AS total FROM d WHERE contains(line, ' the ')",
)
def agg4_total(spark, sf):
    return S.total(S.matching(_docs(spark, sf), P.has_term("the")))


# --- Ranking --------------------------------------------------------------


def _bm25(words: str, terms: list[str]) -> str:
    tf = ", ".join(f"len(list_filter(words, lambda w: w = '{t}')) AS tf{i}" for i, t in enumerate(terms))
    df = ", ".join(f"count(*) FILTER (tf{i} > 0) AS df{i}" for i in range(len(terms)))
    weight = " + ".join(
        f"ln(1 + (docs - df{i} + 0.5) / (df{i} + 0.5)) * tf{i} * {K.BM25_K1 + 1}::DOUBLE "
        f"/ (tf{i} + {K.BM25_K1}::DOUBLE * ({1 - K.BM25_B}::DOUBLE + {K.BM25_B}::DOUBLE * length / average))"
        for i in range(len(terms))
    )
    hit = " OR ".join(f"tf{i} > 0" for i in range(len(terms)))
    return f"""t AS (SELECT id, text, search_text, len(words) AS length, {tf} FROM {words}),
        s AS (SELECT count(*) AS docs, avg(length) AS average, {df} FROM t),
        r AS (SELECT id, text, search_text, {weight} AS score FROM t, s WHERE {hit})"""


@query(
    "lim4_bm25_text",
    f"{_DOCS}, {_bm25('d', ['erst', 'tionment', 'from'])} SELECT id, round(score, 6) AS score FROM r",
)
def lim4_bm25_text(spark, sf):
    scored = R.score_text(_docs(spark, sf), "Erst tionment from")
    return scored.select("id", F.round("score", 6).alias("score"))


@query(
    "lim4_bm25_postings",
    f"{_DOCS}, {_bm25('d', ['erst', 'que', 'from'])} SELECT id, round(score, 6) AS score FROM r",
)
def lim4_bm25_postings(spark, sf):
    docs = _docs(spark, sf)
    scored = R.score_postings(R.build_postings(docs), R.corpus_stats(docs), "erst que from")
    return scored.select("id", F.round("score", 6).alias("score"))


@query(
    "lim4_ranked_search",
    f"""WITH RECURSIVE {_DOCS.removeprefix("WITH ")}, {_bm25('d', ['erst', 'with'])},
        p AS (SELECT id, search_text, round(score, 6) AS score FROM r ORDER BY score DESC, id LIMIT 20),
        {Q.word_fragments('p', 'search_text', ['erst', 'with'], 2, 100, ['id', 'score'])}
        SELECT id, score, len(found) AS fragments FROM fragments""",
)
def lim4_ranked_search(spark, sf):
    hits = S.search(_docs(spark, sf), query="erst with", limit=20, highlight_count=2)
    return hits.select("id", F.round("score", 6).alias("score"), F.size("highlight").alias("fragments"))


@query(
    "post1_postings",
    f"""{_DOCS}, p AS (SELECT id, unnest(words) AS token, generate_subscripts(words, 1) - 1 AS pos FROM d)
        SELECT token, count(*) AS n, count(DISTINCT id) AS docs, min(pos) AS first_pos, max(pos) AS last_pos
        FROM p GROUP BY token""",
)
def post1_postings(spark, sf):
    """Summed per token, first within each text, so a common token moves few rows."""
    postings = R.build_postings(_docs(spark, sf))
    by_text = postings.groupBy("token", "id").agg(
        F.count("*").alias("n"), F.min("pos").alias("first_pos"), F.max("pos").alias("last_pos")
    )
    return by_text.groupBy("token").agg(
        F.sum("n").alias("n"),
        F.count("*").alias("docs"),
        F.min("first_pos").alias("first_pos"),
        F.max("last_pos").alias("last_pos"),
    )


@query(
    "post1_fuzzy_postings",
    f"{_DOCS} SELECT id FROM d WHERE len(list_filter(words, lambda w: {_close('w', 'through', 2)})) > 0",
)
def post1_fuzzy_postings(spark, sf):
    return R.fuzzy_ids(R.build_postings(_docs(spark, sf)), "through", 2)


@query(
    "post1_fuzzy_tokens",
    f"""{_DOCS}, p AS (SELECT unnest(words) AS token FROM d)
        SELECT DISTINCT token FROM p WHERE {_close('token', 'through', 3)}""",
)
def post1_fuzzy_tokens(spark, sf):
    return R.fuzzy_tokens(R.dictionary(R.build_postings(_docs(spark, sf))), "through", 3)


# --- Fetching and links ---------------------------------------------------


@query(
    "joi2_top_hits",
    """SELECT 'conv.' || conv_id || '.' || turn AS id, length(text) AS chars FROM conversations
       ORDER BY turn % 10, 'conv.' || conv_id || '.' || turn LIMIT 50""",
)
def joi2_top_hits(spark, sf):
    hits = PL.scan_envelopes(TB.responses(spark, sf).filter(F.col("url").contains("/api/2/search")))
    full = J.fetch_top_hits(TB.conversation_pages(spark, sf), hits, 100)
    return full.select("id", F.length(F.get("texts.bodyText", F.lit(0))).alias("chars"))


@query(
    "win2_top_hits_per_search",
    f"""SELECT '{Q.ORIGIN}/api/2/search?q=*&document=conv.' || conv_id || '&offset=' || (turn // 10 * 10) AS url,
        'conv.' || conv_id || '.' || turn AS id FROM conversations
        QUALIFY row_number() OVER (PARTITION BY conv_id, turn // 10 ORDER BY turn) <= 2""",
)
def win2_top_hits_per_search(spark, sf):
    searches = TB.responses(spark, sf).filter(F.col("url").contains("/api/2/search"))
    hits = PL.scan_envelopes(searches, keep=("url",))
    return J.top_hit_ids(hits, None, search_key="url").select("url", "id")


@query(
    "joi5_pivot",
    """SELECT 'order.' || o_orderkey AS source_id, 'customer' AS role, 'person.' || o_custkey AS target_id,
       c_name AS name FROM orders JOIN customer ON o_custkey = c_custkey""",
)
def joi5_pivot(spark, sf):
    found = J.pivot(TB.orders(spark, sf), TB.people(spark, sf), "customer")
    return found.select(
        "source_id", "role", "target_id", F.get(F.col("target_props")["name"], F.lit(0)).alias("name")
    )


@query(
    "joi5_referring",
    """SELECT DISTINCT 'contract.' || l_orderkey || '.' || l_suppkey AS source_id, 'supplier' AS role,
       'company.' || l_suppkey AS target_id FROM lineitem
       WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 5000)""",
)
def joi5_referring(spark, sf):
    rich = S.matching(TB.companies(spark, sf), P.prop_num_cmp("balance", ">", 5000))
    return J.referring(TB.contracts(spark, sf), "supplier", rich)


@query(
    "lim1_limit_clamp",
    """SELECT 'order.' || o_orderkey AS id, o_totalprice AS score FROM orders
       ORDER BY o_totalprice DESC, 'order.' || o_orderkey LIMIT 1""",
)
def lim1_limit_clamp(spark, sf):
    """A limit below one is one."""
    return S.page(_scored_orders(spark, sf), limit=-5).select("id", "score")
