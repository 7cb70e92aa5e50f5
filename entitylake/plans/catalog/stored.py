"""Queries over tables that are written first and looked up then, and over tables of queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from entitylake.functions import tokens as W
from entitylake.operators import graph as G
from entitylake.operators import neighbours as N
from entitylake.operators import percolate as PC
from entitylake.operators import positions as PO
from entitylake.operators import predicates as P
from entitylake.operators import rank as R
from entitylake.operators import search as S
from entitylake.operators import segments as SG
from entitylake.operators import trigrams as TG
from entitylake.plans import duck as Q
from entitylake.plans.catalog.registry import query
from entitylake.session import shared_folder
from entitylake.sources import testbed as TB
from entitylake.sources import zones as Z

_DOCS = f"WITH {Q.DOCS}, d AS (SELECT *, {Q.line('search_text')} AS line, {Q.words('search_text')} AS words FROM docs)"


def _postings(spark, sf, query_text: str):
    """Postings of all documents, written by bucket; only the query's buckets are read again."""
    path = shared_folder(spark)
    R.write_postings(R.build_postings(TB.documents(spark, sf)), path)
    return R.read_postings(spark, path, query=query_text)


# --- Tables of queries ----------------------------------------------------


def _drawn_queries(spark, sf):
    """A saved query per document from words and columns of the document, some without any match."""
    number, words = F.col("doc_id"), F.col("words")
    asked = F.array(
        F.get(words, F.lit(8)),
        F.concat_ws(" ", F.get(words, F.lit(3)), F.get(words, F.lit(4))),
        F.when(number % 5 == 4, F.concat(F.lit("unheard"), number.cast("string"))),
    )
    filters = (
        F.when(number % 3 == 0, F.create_map(F.lit("collection_id"), F.col("source")))
        .when(number % 3 == 1, F.create_map(F.lit("properties.languages"), F.col("lang")))
    )
    rows = TB.table(spark, sf, "documents").select("*", W.words(F.col("text")).alias("words"))
    return rows.select(
        *PC.saved_query(
            F.concat(F.lit("q"), number.cast("string")),
            F.filter(asked, lambda x: x.isNotNull()),
            F.when(number % 4 == 1, F.array(F.get(words, F.lit(10)))),
            filters,
        )
    )


_DRAWN = f"""w AS (SELECT doc_id, source, lang, {Q.words('text')} AS words FROM documents),
  q AS (SELECT 'q' || doc_id AS query_id, words[9] AS one, concat_ws(' ', words[4], words[5]) AS two,
          CASE WHEN doc_id % 4 = 1 THEN words[11] END AS excluded,
          CASE WHEN doc_id % 3 = 0 THEN source END AS in_source, CASE WHEN doc_id % 3 = 1 THEN lang END AS in_lang
        FROM w WHERE doc_id % 5 <> 4),
  n AS (SELECT query_id, count(*) AS n FROM q JOIN d ON (one IS NULL OR contains(line, ' ' || one || ' '))
          AND (two = '' OR contains(line, ' ' || two || ' ')) AND (excluded IS NULL OR NOT contains(line, ' ' || excluded || ' '))
          AND (in_source IS NULL OR in_source = source) AND (in_lang IS NULL OR in_lang = lang) GROUP BY ALL)"""


@query(
    "agg5_percolated",
    f"{_DOCS}, {_DRAWN} SELECT 'q' || doc_id AS query_id, coalesce(n, 0) AS n FROM documents LEFT JOIN n ON query_id = 'q' || doc_id",
)
def agg5_percolated(spark, sf):
    """As many saved queries as there are documents, counted in one job."""
    return PC.hits_per_saved_query(TB.documents(spark, sf), _drawn_queries(spark, sf))


@query(
    "wrk4_verified_claims",
    f"""{_DOCS}, {_DRAWN}, c AS (SELECT coalesce(n, 0) AS n FROM documents LEFT JOIN n ON query_id = 'q' || doc_id)
        SELECT CASE WHEN n = 0 THEN 'no indexed match' ELSE 'indexed matches' END AS verdict, count(*) AS queries, sum(n)::BIGINT AS hits
        FROM c GROUP BY ALL""",
)
def wrk4_verified_claims(spark, sf):
    claims = PC.verify_claims(TB.documents(spark, sf), _drawn_queries(spark, sf))
    return claims.groupBy("verdict").agg(F.count("*").alias("queries"), F.sum("n").alias("hits"))


# --- Positions and neighbourhoods -----------------------------------------


@query("flt3_phrase_postings", f"{_DOCS} SELECT id FROM d WHERE contains(line, ' of the ')")
def flt3_phrase_postings(spark, sf):
    return PO.phrase_ids(_postings(spark, sf, "of the"), "of  The")


@query(
    "flt5_proximity_postings",
    f"""{_DOCS}, pos AS (SELECT id, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM d),
        k AS (SELECT * FROM pos WHERE w IN ('from', 'with', 'that'))
        SELECT DISTINCT a.id FROM (SELECT * FROM k WHERE w = 'from') a
        JOIN (SELECT * FROM k WHERE w = 'with') b ON a.id = b.id AND abs(a.i - b.i) <= 12
        JOIN (SELECT * FROM k WHERE w = 'that') c ON a.id = c.id
        WHERE greatest(a.i, b.i, c.i) - least(a.i, b.i, c.i) <= 12""",
)
def flt5_proximity_postings(spark, sf):
    return PO.near_ids(_postings(spark, sf, "from with that"), ["from", "with that"], 12)


#: Each letter beyond ASCII as one of its own within it: DuckDB compares bytes.
_ONE_BYTE = "translate({}, 'éèñßêçíüóöä', 'ABCDEFGHIJK')"


@query(
    "post1_fuzzy_neighbours",
    f"""WITH t AS (SELECT DISTINCT unnest({Q.words('text')}) AS token FROM documents),
        b AS (SELECT DISTINCT unnest({Q.words('text')}) AS word FROM benchmark)
        SELECT word, count(*) AS n, min(token) AS first_token, max(token) AS last_token FROM b JOIN t
        ON abs(length(word) - length(token)) <= 2 AND levenshtein({_ONE_BYTE.format('word')}, {_ONE_BYTE.format('token')}) <= 2
        GROUP BY word""",
)
def post1_fuzzy_neighbours(spark, sf):
    """All words of one table that are close to some word of another."""
    path = shared_folder(spark)
    vocabulary = TB.table(spark, sf, "documents").select(F.explode(W.words(F.col("text"))).alias("token"))
    N.write_neighbourhoods(N.neighbourhoods(vocabulary, 2), path)
    words = TB.table(spark, sf, "benchmark").select(F.explode(W.words(F.col("text"))).alias("word"))
    close = N.close_tokens(N.read_neighbourhoods(spark, path), words, 2)
    return close.groupBy("word").agg(
        F.count("*").alias("n"), F.min("token").alias("first_token"), F.max("token").alias("last_token")
    )


# --- Regular expressions by trigrams --------------------------------------


@query(
    "flt10_regex_trigrams",
    f"""WITH {Q.ENTITIES} SELECT id FROM entities
        WHERE regexp_matches(props['name'], '^(?:Customer#0+[0-9]*7|Supplier#.*3|.*#0000000[1-4]2)$')""",
)
def flt10_regex_trigrams(spark, sf):
    """The pattern runs over distinct names that hold its literal parts, found in a written table."""
    pattern, path = "Customer#0+[0-9]*7|Supplier#.*3|.*#0000000[1-4]2", shared_folder(spark)
    named = TB.entities(spark, sf)
    TG.write_trigrams(TG.value_trigrams(TG.property_values(named, "name")), path)
    return TG.regex_ids(named, "name", TG.read_trigrams(spark, path, pattern), pattern)


# --- Ancestors and hops ---------------------------------------------------


def _direct_parents(spark):
    """Each type of the test entities with the types directly above it."""
    rows = [pair for names in TB.ANCESTORS.values() for pair in zip(names, names[1:])]
    return spark.createDataFrame(sorted(set(rows)), "schema string, parent string")


_PARENTS = """parents(schema, parent) AS (VALUES ('Page', 'Document'), ('Pages', 'Document'), ('Email', 'Document'),
  ('Person', 'LegalEntity'), ('Company', 'Organization'), ('Organization', 'LegalEntity'), ('Contract', 'Interval'),
  ('Order', 'Interval'), ('Event', 'Interval'))"""


@query(
    "joi3_closure",
    f"""WITH RECURSIVE {Q.ENTITIES}, {_PARENTS}, closure AS (
          SELECT schema, schema AS ancestor FROM parents UNION SELECT parent, parent FROM parents
          UNION SELECT c.schema, p.parent FROM closure c JOIN parents p ON p.schema = c.ancestor)
        SELECT id, schema FROM entities WHERE schema IN (SELECT schema FROM closure WHERE ancestor IN ('Document', 'LegalEntity'))""",
)
def joi3_closure(spark, sf):
    """Entities below two types, by the ancestors that direct parents lead to."""
    closure = G.ancestor_closure(_direct_parents(spark))
    return S.matching(TB.entities(spark, sf), schemata=["Document", "LegalEntity"], closure=closure).select("id", "schema")


@query(
    "joi3_part_closure",
    """WITH RECURSIVE parents AS (
         SELECT DISTINCT 'order.' || l_orderkey AS schema, 'part.' || l_partkey AS parent FROM lineitem
         UNION SELECT 'part.' || p_partkey, 'brand.' || p_brand FROM part
         UNION SELECT 'part.' || p_partkey, 'type.' || p_type FROM part
         UNION SELECT 'brand.' || p_brand, 'size.' || (p_size % 7) FROM part),
       closure AS (
         SELECT schema, schema AS ancestor FROM parents UNION SELECT parent, parent FROM parents
         UNION SELECT c.schema, p.parent FROM closure c JOIN parents p ON p.schema = c.ancestor)
       SELECT ancestor, count(*) AS n FROM closure GROUP BY ancestor""",
)
def joi3_part_closure(spark, sf):
    """The same over the data: orders below parts, parts below brands and types, brands below sizes."""
    lines, parts = TB.table(spark, sf, "lineitem"), TB.table(spark, sf, "part")
    name = lambda prefix, key: F.concat(F.lit(f"{prefix}."), key.cast("string"))
    part = name("part", F.col("p_partkey"))
    levels = [
        lines.select(name("order", F.col("l_orderkey")).alias("schema"), name("part", F.col("l_partkey")).alias("parent")),
        parts.select(part.alias("schema"), name("brand", F.col("p_brand")).alias("parent")),
        parts.select(part.alias("schema"), name("type", F.col("p_type")).alias("parent")),
        parts.select(name("brand", F.col("p_brand")).alias("schema"), name("size", F.col("p_size") % 7).alias("parent")),
    ]
    parents = levels[0]
    for level in levels[1:]:
        parents = parents.unionByName(level)
    return G.ancestor_closure(parents).groupBy("ancestor").agg(F.count("*").alias("n"))


@query(
    "wrk1_hops",
    """WITH contract AS (SELECT DISTINCT 'contract.' || l_orderkey || '.' || l_suppkey AS id, 'company.' || l_suppkey AS company,
           'order.' || l_orderkey AS ord FROM lineitem),
         links AS (SELECT id AS source, 'supplier' AS role, company AS target FROM contract
           UNION ALL SELECT id, 'order', ord FROM contract
           UNION ALL SELECT 'order.' || o_orderkey, 'customer', 'person.' || o_custkey FROM orders),
         ways AS (SELECT source AS near, role, target AS far FROM links UNION ALL SELECT target, role, source FROM links),
         h0 AS (SELECT 'company.' || s_suppkey AS id, 0 AS hop, NULL::VARCHAR AS via, NULL::VARCHAR AS role FROM supplier
           JOIN nation ON s_nationkey = n_nationkey WHERE n_name = 'NATION_8'),
         h1 AS (SELECT far AS id, 1 AS hop, min((near, ways.role)) AS step FROM h0 JOIN ways ON near = id
           WHERE far NOT IN (SELECT id FROM h0) GROUP BY far),
         h2 AS (SELECT far AS id, 2 AS hop, min((near, ways.role)) AS step FROM h1 JOIN ways ON near = id
           WHERE far NOT IN (SELECT id FROM h0 UNION SELECT id FROM h1) GROUP BY far),
         h3 AS (SELECT far AS id, 3 AS hop, min((near, ways.role)) AS step FROM h2 JOIN ways ON near = id
           WHERE far NOT IN (SELECT id FROM h0 UNION SELECT id FROM h1 UNION SELECT id FROM h2) GROUP BY far),
         later AS (SELECT * FROM h1 UNION ALL SELECT * FROM h2 UNION ALL SELECT * FROM h3)
       SELECT * FROM h0 UNION ALL SELECT id, hop, struct_extract_at(step, 1), struct_extract_at(step, 2) FROM later""",
)
def wrk1_hops(spark, sf):
    """From the companies of one nation over contracts and orders to people."""
    companies = S.matching(TB.companies(spark, sf), P.has_phrase("nation 8"), schemata="Company")
    rows = TB.entities(spark, sf, TB.companies, TB.contracts, TB.people, TB.orders)
    return G.within_hops(G.entity_links(rows, ["supplier", "order", "customer"]), companies, 3)


# --- Bodies of any size ---------------------------------------------------

_BODIES = f"""pages AS (SELECT conv_id, turn, {Q.trim('text')} AS text FROM conversations WHERE {Q.trim('text')} <> ''),
  bodies AS (SELECT conv_id, string_agg(text, chr(10) || chr(10) ORDER BY turn) AS body FROM pages GROUP BY conv_id)"""


@query(
    "bod3_segments",
    f"""WITH {_BODIES}, cut AS (SELECT conv_id, body, unnest(range((length(body) + 499) // 500)) AS segment FROM bodies)
        SELECT 'conv.' || conv_id AS parent_id, segment, segment * 500 AS start, substring(body, segment * 500 + 1, 500) AS text FROM cut""",
)
def bod3_segments(spark, sf):
    return SG.segments(TB.conversation_pages(spark, sf), segment_chars=500)


@query(
    "wrk5_page_citations",
    rf"""WITH {_BODIES}, parts AS (SELECT conv_id, turn, unnest(regexp_extract_all(text, '[\p{{L}}\p{{N}}]+|[^\p{{L}}\p{{N}}]+')) AS part,
            generate_subscripts(regexp_extract_all(text, '[\p{{L}}\p{{N}}]+|[^\p{{L}}\p{{N}}]+'), 1) AS i FROM pages),
          placed AS (SELECT *, sum(length(part)) OVER (PARTITION BY conv_id, turn ORDER BY i) - length(part) AS page_offset FROM parts),
          sized AS (SELECT conv_id, turn, sum(length(text) + 2) OVER (PARTITION BY conv_id ORDER BY turn) - length(text) - 2 AS start FROM pages),
          words AS (SELECT *, lead(lower(part)) OVER w AS next_word, lead(turn) OVER w AS next_turn FROM placed
            WHERE regexp_matches(part, '[\p{{L}}\p{{N}}]') WINDOW w AS (PARTITION BY conv_id ORDER BY turn, i)),
          found AS (SELECT *, (start + page_offset)::BIGINT AS place FROM words JOIN sized USING (conv_id, turn) WHERE lower(part) = 'of' AND next_word = 'the')
        SELECT 'conv.' || conv_id AS parent_id, place AS body_offset, 'conv.' || conv_id || '.' || turn AS page_id, turn::DOUBLE AS page_position,
          page_offset::BIGINT AS page_offset, 'conv.' || conv_id || '.' || next_turn AS end_page_id,
          substring(body, greatest(place - 97, 0) + 1, least(place, 97) + 6 + 97) AS excerpt FROM found JOIN bodies USING (conv_id)""",
)
def wrk5_page_citations(spark, sf):
    return SG.page_citations(TB.conversation_pages(spark, sf), "of the", segment_chars=300)


# --- Facets over hits that repeat -----------------------------------------


@query(
    "agg3_repeated_facets",
    f"""WITH {Q.ENTITIES}, f AS (SELECT 'status' AS facet, props['status'] AS value, id FROM entities
          UNION ALL SELECT 'customer', props['customer'], id FROM entities UNION ALL SELECT 'schema', schema, id FROM entities)
        SELECT facet, value, count(DISTINCT id) AS n FROM f WHERE value IS NOT NULL GROUP BY ALL""",
)
def agg3_repeated_facets(spark, sf):
    """Facets of all entities and, once more, of the open orders and the trade collection."""
    rows = TB.entities(spark, sf)
    again = [S.matching(rows, P.prop_eq("status", "O")), S.matching(rows, collection_id="trade")]
    hits = rows.unionByName(again[0]).unionByName(again[1])
    return S.facets(hits, ["status", "customer", "schema"], repeated=True)


# --- Tables that skip -----------------------------------------------------

_ZONES = {"date": "date", "total": "double"}


def _zoned(spark, sf, *builders):
    path = shared_folder(spark)
    Z.write_zoned(TB.entities(spark, sf, *builders), path, _ZONES)
    return Z.read_zoned(spark, path, _ZONES)


@query(
    "flt12_pruned_range",
    f"""WITH {Q.ENTITIES} SELECT id FROM entities WHERE (schema = 'Order' OR schema = 'Event')
        AND try_cast(props['date'] AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1996-03-31'""",
)
def flt12_pruned_range(spark, sf):
    """Dates over a written table whose zone columns skip other years."""
    rows = _zoned(spark, sf, TB.orders, TB.events)
    return S.matching(rows, Z.date_between("date", "1996", "1996-03"), schema=["Order", "Event"]).select("id")


@query(
    "flt13_pruned_number",
    f"""WITH {Q.ENTITIES} SELECT id FROM entities WHERE schema = 'Order' AND try_cast(props['total'] AS DOUBLE) > 490000""",
)
def flt13_pruned_number(spark, sf):
    return S.matching(_zoned(spark, sf, TB.orders), Z.num_cmp("total", ">", 490000)).select("id")


@query(
    "src2_stored_lookup",
    f"""WITH {Q.ENTITIES} SELECT id, schema FROM entities WHERE id IN ('order.100', 'person.7', 'order.absent', 'contract.1.1')""",
)
def src2_stored_lookup(spark, sf):
    """Four ids, one of them absent, looked up in a written table by its Bloom filters."""
    rows = _zoned(spark, sf, TB.orders, TB.people, TB.contracts)
    return Z.lookup(rows, ["order.100", "person.7", " order.absent ", "contract.1.1", "order.100"]).select("id", "schema")
