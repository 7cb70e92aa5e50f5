import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from entitylake import constants as K
from entitylake.functions import bounds as B
from entitylake.functions import html as H
from entitylake.functions import text as T
from entitylake.functions import tokens as W
from entitylake.functions import urls as U

SPACES = K.WHITESPACE


def cut(text, limit):
    """The rule in plain Python, to compare with."""
    if limit <= 0 or len(text) <= limit:
        return text
    head, keep = text[:limit], math.floor(limit * 0.45)
    for mark in ("\n\n", "\n", " "):
        at = head.rfind(mark)
        if at >= keep:
            return text[:at].rstrip(SPACES) + mark + "…"
    return head.rstrip(SPACES) + "…"


@settings(deadline=None, max_examples=5)
@given(
    st.lists(
        st.tuples(st.text(alphabet="ab \n\r é …", max_size=60), st.sampled_from([1, 5, 8, 20, 33])),
        min_size=20,
        max_size=60,
    )
)
def test_cut_matches_plain_python(spark, cases):
    rows = spark.createDataFrame(cases, "t string, n int")
    for limit in {n for _, n in cases}:
        texts = [t for t, n in cases if n == limit]
        got = rows.filter(F.col("n") == limit).select("t", T.cut_at_boundary(F.col("t"), limit).alias("c"))
        found = sorted((r.t, r.c) for r in got.collect())
        assert found == sorted((t, cut(t, limit)) for t in texts)


def test_one_character_over_is_longer_than_the_limit(one):
    assert one(lambda t: T.cut_at_boundary(t, 10), "x" * 11) == "x" * 10 + "…"
    assert one(lambda t: T.cut_at_boundary(t, 0), "abc") == "abc"


def test_guards(one):
    html = "<p>" + "a" * 90 + "</p>" + "b" * 50
    assert one(lambda t: T.guard_html(t, 100), html) == "<p>" + "a" * 90 + "</p>"
    assert one(lambda t: T.guard_html(t, 100), "b" * 150) == "b" * 100
    assert one(lambda t: T.guard_plain(t, 100), "a" * 90 + "\n" + "b" * 50) == "a" * 90
    assert one(lambda t: T.guard_plain(t, 100), "a\n" + "b" * 150) == "a\n" + "b" * 98


def test_trim_knows_unicode_spaces(one):
    assert one(T.js_trim, f"  　x y ﻿\n") == "x y"
    assert one(T.nonblank, SPACES) is None


@pytest.mark.parametrize(
    "text,number", [("12abc", 12.0), (" -3", -3.0), ("+7", 7.0), ("abc", None), ("", None), ("1.9", 1.0)]
)
def test_leading_integer(one, text, number):
    assert one(T.leading_integer, text) == number


def test_highlight_text(one):
    snippets = "a <em>key</em>\n word| |<b></b>|second"
    assert one(lambda t: T.highlight_text(F.split(t, r"\|")), snippets) == "a key word\n...\nsecond"


@pytest.mark.parametrize(
    "html,expected",
    [
        ("<p>Hello <strong>world</strong></p>", "Hello **world**"),
        ("<html>Figures of March</html>", "Figures of March"),
        ("<h2 class='x'>T</h2><p>a</p> <p>b</p>", "## T\n\na\n\nb"),
        ("<ul><li>one</li> <li>two</li></ul>", "*   one\n\n*   two"),
        ("a<br/>b<hr>c", "a\nb\n\n* * *\n\nc"),
        ("<a class=k href=\"/x\">L</a> <img src='i' alt='A'> <em>e</em>", "[L](/x) ![A](i) _e_"),
        ("x <pre class=c>a\n   <b>b</b></pre> y", "x\n\n```\na\n   b\n```\n\ny"),
        ("&amp;lt; &#8217; &#x41; &eacute; &nope; &lt;b&gt;z", "&lt; ’ A é &nope; z"),
        ("<!doctype html><custom-tag a='1'>t</custom-tag> 1 < 2", "t 1 < 2"),
        ("<b>open <i>both", "open both"),
        ("<HEAD><title>no</title></HEAD><STYLE>p{}</STYLE>yes", "yes"),
        ("<!-- only -->", None),
    ],
)
def test_mail_markdown(one, html, expected):
    assert one(H.mail_markdown, html) == expected


def test_office_noise_disappears(one):
    html = (
        "<!-- /* Font */ @font-face {font-family:x; panose-1:2 4;} --><div>@page WordSection1 {size:8.5in}</div>"
        "<p>mso-style-name: x</p><p>Real message text here.</p>"
    )
    assert one(H.mail_markdown, html) == "Real message text here."


def test_link_ids(one):
    assert one(U.id_from_api_url, "https://h/api/2/entities/a%2Fb+c/?q#f") == "a/b+c"
    assert one(U.id_from_api_url, "https://h/api/2/entities/x/expand") is None
    assert one(U.id_from_api_url, "/api/2/entities/x/expand") == "x"
    assert one(U.id_from_api_url, "https://h/api/2/entities/%zz") is None
    assert one(U.id_from_ui_url, " https://h/entities/12.ab ") == "12.ab"


def test_words(one):
    assert one(W.words, "Ärger, 3rd—Über") == ["ärger", "3rd", "über"]
    assert one(W.word_line, "A, b") == " a b "
    assert W.literal_words("Ärger, 3rd—Über") == ["ärger", "3rd", "über"]


def test_bounds():
    assert [B.clamp_limit(x) for x in (None, 0, -3, 2.9, 999_999, math.inf, math.nan)] == [
        None, 1, 1, 2, 10_000, 1, 1,
    ]
    assert [B.clean_offset(x) for x in (None, -1, 2.9, math.inf)] == [0, 0, 2, 0]
    assert [B.top_hits(x) for x in (None, -1, 0, 7, 99)] == [2, 2, 0, 7, 50]
    assert B.schema_names("Email,Pages") == ["Email", "Pages"]
    assert B.schema_names([" Email ", "Pages"]) == ["Email", "Pages"]
    assert B.schema_names(" , , ") == [] and B.schema_names(None) == []
    with pytest.raises(ValueError):
        B.required_id("  ")
    with pytest.raises(ValueError):
        B.within("x", 0, 1, 200)


def test_character_names_of_html_5(one):
    from entitylake.functions import html as H

    assert one(H.decode_references, "&check; &lbrace;&eacute; &amp;lt; &nosuchname; &AMP;") == "✓ {é &lt; &nosuchname; &"
