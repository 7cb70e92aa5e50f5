"""Queries for the scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from entitylake import constants as K
from entitylake.functions import html as H
from entitylake.functions import text as T
from entitylake.functions import urls as U
from entitylake.operators import search as S
from entitylake.plans import duck as Q
from entitylake.plans.catalog.registry import query
from entitylake.sources.testbed import ORIGIN, table

_PADDED = "chr(160) || chr(12288) || text || chr(65279) || chr(10) || ' '"


@query(
    "scl1_trim",
    f"SELECT doc_id, md5({Q.trim(_PADDED)}) AS trimmed, length({Q.trim(_PADDED)}) AS n FROM documents",
)
def scl1_trim(spark, sf):
    padded = F.concat(F.lit(chr(160) + chr(12288)), F.col("text"), F.lit(chr(65279) + "\n "))
    return table(spark, sf, "documents").select(
        "doc_id", F.md5(T.js_trim(padded)).alias("trimmed"), F.length(T.js_trim(padded)).alias("n")
    )


@query(
    "scl2_cut_at_boundary",
    f"""SELECT doc_id, {Q.cut('text', 200)} AS cut_200, {Q.cut('text', 80)} AS cut_80,
        md5({Q.cut('text', 6000)}) AS cut_6000 FROM documents""",
)
def scl2_cut_at_boundary(spark, sf):
    text = F.col("text")
    return table(spark, sf, "documents").select(
        "doc_id",
        T.cut_at_boundary(text, 200).alias("cut_200"),
        T.cut_at_boundary(text, 80).alias("cut_80"),
        F.md5(T.cut_at_boundary(text, 6000)).alias("cut_6000"),
    )


@query(
    "scl3_guard_html",
    f"""SELECT page_id, md5({Q.guard('html', 2000, '>', 1)}) AS cut_2000,
        length({Q.guard('html', 2000, '>', 1)}) AS n_2000,
        length({Q.guard('html', K.MAX_CONVERSION_CHARS, '>', 1)}) AS n_full FROM pages""",
)
def scl3_guard_html(spark, sf):
    html = F.col("html")
    return table(spark, sf, "pages").select(
        "page_id",
        F.md5(T.guard_html(html, 2000)).alias("cut_2000"),
        F.length(T.guard_html(html, 2000)).alias("n_2000"),
        F.length(T.guard_html(html)).alias("n_full"),
    )


@query(
    "scl4_guard_plain",
    f"""SELECT doc_id, md5({Q.guard('text', 1500, chr(10), 0)}) AS cut_1500,
        length({Q.guard('text', 1500, chr(10), 0)}) AS n_1500,
        length({Q.guard('text', K.MAX_CONVERSION_CHARS, chr(10), 0)}) AS n_full FROM documents""",
)
def scl4_guard_plain(spark, sf):
    text = F.col("text")
    return table(spark, sf, "documents").select(
        "doc_id",
        F.md5(T.guard_plain(text, 1500)).alias("cut_1500"),
        F.length(T.guard_plain(text, 1500)).alias("n_1500"),
        F.length(T.guard_plain(text)).alias("n_full"),
    )


@query(
    "scl5_newlines",
    r"""SELECT doc_id, md5(replace(replace(text, chr(10), chr(13) || chr(10)), chr(13) || chr(10), chr(10)))
        AS unified FROM documents""",
)
def scl5_newlines(spark, sf):
    windows = F.replace(F.col("text"), F.lit("\n"), F.lit("\r\n"))
    return table(spark, sf, "documents").select(
        "doc_id", F.md5(T.unify_newlines(windows)).alias("unified")
    )


@query(
    "scl6_flatten",
    f"""SELECT doc_id, md5(nullif(array_to_string(list_filter(list_transform(string_split(text, chr(10)),
        lambda x: {Q.trim('x')}), lambda x: x <> ''), chr(10) || chr(10)), '')) AS joined FROM documents""",
)
def scl6_flatten(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", F.md5(T.flatten_text(F.split("text", "\n"))).alias("joined")
    )


@query(
    "scl7_strip_highlight",
    f"SELECT page_id, md5({Q.strip_highlight('html')}) AS plain FROM pages",
)
def scl7_strip_highlight(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id", F.md5(T.strip_highlight(F.col("html"))).alias("plain")
    )


@query(
    "scl8_join_highlight",
    f"""SELECT page_id, md5(nullif(array_to_string(list_filter(list_transform(
        string_split(html, '<p>'), lambda s: {Q.strip_highlight('s')}), lambda s: s <> ''),
        {Q.lit(K.HIGHLIGHT_JOINER)}), '')) AS joined FROM pages""",
)
def scl8_join_highlight(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id", F.md5(T.highlight_text(F.split("html", "<p>"))).alias("joined")
    )


@query(
    "scl9_clean_html",
    f"SELECT page_id, {Q.clean_html('html')} AS cleaned FROM pages",
)
def scl9_clean_html(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id", H.clean_mail_html(F.col("html")).alias("cleaned")
    )


@query(
    "scl10_html_to_markdown",
    f"SELECT page_id, {Q.markdown('html')} AS markdown FROM pages",
)
def scl10_html_to_markdown(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id", H.mail_markdown(F.col("html")).alias("markdown")
    )


_STYLED = "'@font-face {x}' || chr(10) || text || chr(10) || '  mso-style: y' || repeat(chr(10), 5) || 'size: 9' || chr(10) || 'end'"


@query(
    "scl11_style_lines",
    f"""SELECT doc_id, md5({Q.trim(Q.replace_all(
        f"array_to_string(list_filter(string_split({_STYLED}, chr(10)), lambda l: NOT regexp_matches(l, {Q.lit(K.STYLE_LINE_PATTERN)})), chr(10))",
        chr(10) + "{3,}", chr(10) * 2))}) AS kept FROM documents""",
)
def scl11_style_lines(spark, sf):
    styled = F.concat(
        F.lit("@font-face {x}\n"), F.col("text"), F.lit("\n  mso-style: y\n\n\n\n\nsize: 9\nend")
    )
    return table(spark, sf, "documents").select(
        "doc_id", F.md5(H.drop_style_lines(styled)).alias("kept")
    )


@query(
    "scl12_leftover_tags",
    f"""SELECT page_id, md5({Q.trim(Q.replace_all(Q.replace_all('html', K.LEFTOVER_TAG_PATTERN, ''),
        K.COMMENT_PATTERN, ''))}) AS stripped FROM pages""",
)
def scl12_leftover_tags(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id", F.md5(H.strip_leftover_tags(F.col("html"))).alias("stripped")
    )


@query(
    "scl13_first_number",
    r"""SELECT o_orderkey, try_cast(nullif(regexp_extract(o_orderpriority, '^\s*([+-]?[0-9]+)', 1), '')
        AS DOUBLE) AS first_number FROM orders""",
)
def scl13_first_number(spark, sf):
    values = F.array("o_orderstatus", "o_orderpriority")
    return table(spark, sf, "orders").select(
        "o_orderkey", T.first_leading_integer(values).alias("first_number")
    )


@query(
    "scl14_link_ids",
    f"""SELECT page_id, nullif(url_decode(replace('mail.' || url, '+', '%2B')), '') AS api_id,
        'mail ' || page_id AS ui_id, page_id::VARCHAR AS relative_id, NULL::VARCHAR AS expand_id FROM pages""",
)
def scl14_link_ids(spark, sf):
    name = F.replace(F.url_encode(F.concat(F.lit("mail."), F.col("url"))), F.lit("+"), F.lit("%20"))
    key = F.col("page_id").cast("string")
    return table(spark, sf, "pages").select(
        "page_id",
        U.id_from_api_url(F.concat(F.lit(f" {ORIGIN}/api/2/entities/"), name, F.lit("/?x=1"))).alias("api_id"),
        U.id_from_ui_url(F.concat(F.lit(f"{ORIGIN}/entities/mail%20"), key, F.lit("#top"))).alias("ui_id"),
        U.id_from_api_url(F.concat(F.lit("/api/2/entities/"), key, F.lit("/expand?a=b"))).alias("relative_id"),
        U.id_from_api_url(F.concat(F.lit(f"{ORIGIN}/api/2/entities/"), key, F.lit("/expand"))).alias("expand_id"),
    )


@query(
    "scl15_first_text",
    f"""SELECT doc_id, md5(CASE WHEN doc_id % 4 = 0 THEN lang ELSE {Q.trim('text')} END) AS body
        FROM documents""",
)
def scl15_first_text(spark, sf):
    blank = F.array(F.lit(" "), F.lit(" "))
    first = F.when(F.col("doc_id") % 4 == 0, F.array("lang")).otherwise(blank)
    return table(spark, sf, "documents").select(
        "doc_id", F.md5(T.first_text(first, F.array("text"))).alias("body")
    )


def _fragments(terms: list[str], count: int, length: int) -> str:
    return f"""WITH RECURSIVE {Q.fragments('documents', 'text', terms, count, length, ['doc_id'])}
        SELECT doc_id, coalesce(len(found), 0) AS n, coalesce(array_to_string(found, '|'), '') AS fragments FROM fragments"""


def _found(spark, sf, terms, count, length):
    found = S.fragments(F.col("text"), terms, count=count, length=length)
    return table(spark, sf, "documents").select("doc_id", found.alias("found")).select(
        "doc_id", F.size("found").alias("n"), F.array_join("found", "|").alias("fragments")
    )


@query("scl16_fragments", _fragments(["tion", "ment"], 2, 98))
def scl16_fragments(spark, sf):
    return _found(spark, sf, ["tion", "ment"], 2, 98)


@query("scl16_long_fragments", _fragments(["ÉTION", "heit", "que"], 3, 5000))
def scl16_long_fragments(spark, sf):
    """Long pieces, and a term whose first letter is beyond ASCII."""
    return _found(spark, sf, ["ÉTION", "heit", "que"], 3, 5000)


@query(
    "scl16_word_fragments",
    f"""WITH RECURSIVE {Q.word_fragments('documents', 'text', ['tion', 'the', 'un'], 3, 60, ['doc_id'])}
        SELECT doc_id, coalesce(len(found), 0) AS n, coalesce(array_to_string(found, '|'), '') AS fragments FROM fragments""",
)
def scl16_word_fragments(spark, sf):
    """Terms as whole words; the marks are taken out again for the comparison."""
    found = S.fragments(F.col("text"), ["tion", "the", "un"], count=3, length=60, whole_words=True)
    plain = F.transform("found", lambda x: F.regexp_replace(x, "</?em>", ""))
    return table(spark, sf, "documents").select("doc_id", found.alias("found")).select(
        "doc_id", F.size("found").alias("n"), F.array_join(plain, "|").alias("fragments")
    )


@query(
    "set1_schema_names",
    """SELECT c_custkey, c_mktsegment || ' Email Pages' AS names FROM customer""",
)
def set1_schema_names(spark, sf):
    listed = F.concat(
        F.col("c_mktsegment"), F.lit(" , Email,Pages "), F.col("c_mktsegment"), F.lit(",,Email")
    )
    return table(spark, sf, "customer").select(
        "c_custkey", F.array_join(T.name_list(listed), " ").alias("names")
    )
