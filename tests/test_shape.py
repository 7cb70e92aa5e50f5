import json

import pytest
from pyspark.sql import functions as F

from entitylake.operators import shape as SH
from entitylake.sources import payloads as P


def records(entities, **options):
    return [json.loads(r.json) for r in SH.to_json_records(SH.search_records(entities, **options)).collect()]


def record(entities, **options):
    (only,) = records(entities, **options)
    return only


MAIL = {"id": "m1", "schema": "Email", "properties": {"subject": ["S"], "bodyHtml": ["<html>Figures of March</html>"]}}


def test_mail_body_replaces_html(entity):
    out = record(entity(MAIL))
    assert "bodyHtml" not in out["properties"]
    assert out["properties"]["bodyMarkdown"] == ["Figures of March"]
    assert out["truncatedBody"] is False
    assert out["bodyMarkdownFullChars"] == out["bodyMarkdownReturnedChars"] == len("Figures of March")


def test_preview_length_cuts_the_body(entity):
    out = record(entity(MAIL), content_preview_chars=8)
    body = out["properties"]["bodyMarkdown"][0]
    assert "…" in body and len(body) <= 32
    assert out["truncatedBody"] is True
    assert out["bodyMarkdownReturnedChars"] < out["bodyMarkdownFullChars"]


def test_one_over_hard_cut_does_not_count_as_truncated(entity):
    mail = {"schema": "Email", "properties": {"bodyHtml": "x" * 11}}
    out = record(entity(mail), body_markdown_max_chars=10)
    assert out["properties"]["bodyMarkdown"] == ["x" * 10 + "…"]
    assert out["truncatedBody"] is False


def test_supplied_markdown_is_dropped_only_with_html(entity):
    props = {"bodyHtml": ["<p>Shown part</p>"], "bodyMarkdown": ["<div>older copy</div>"]}
    assert record(entity({"schema": "Email", "properties": props}))["properties"] == {
        "bodyMarkdown": ["Shown part"]
    }
    alone = {"schema": "Email", "properties": {"bodyMarkdown": ["kept"]}}
    out = record(entity(alone))
    assert out["properties"] == {"bodyMarkdown": ["kept"]} and "truncatedBody" not in out
    empty = {"schema": "Email", "properties": {"bodyHtml": ["<!-- x -->"], "bodyMarkdown": ["y"]}}
    out = record(entity(empty))
    assert out["properties"] == {} and "truncatedBody" not in out


def test_content_fields_on_request(entity):
    mail = {"schema": "Email", "properties": {"bodyHtml": ["<p>Full</p>"]}}
    out = record(entity(mail), include_content_fields=True)
    assert out["properties"] == {"bodyHtml": ["<p>Full</p>"]}


def test_nested_objects_are_readable(entity):
    related = {"id": "p", "schema": "Person", "properties": {"name": ["Mira Tolle"]}}
    props = {
        "relatedEntities": [related],
        "plainObject": [{"note": "nested"}],
        "caption": {"caption": "C", "label": "L"},
        "label": {"label": " L "},
        "ids": [{"schema": "S", "id": "i"}, {"id": "j"}, {}],
        "blocked": {"name": [], "properties": {"name": ["no"]}, "id": "z"},
        "scalars": [1, 1.0, 2.5, True, None, " ", "x"],
        "nested": [["a", ["b", 3]], []],
        "deep": [[[[[["too deep"]]]]]],
        "blank": [" "],
        "none": None,
    }
    assert record(entity({"schema": "Email", "properties": props}))["properties"] == {
        "relatedEntities": ["Mira Tolle"],
        "plainObject": ['{"note":"nested"}'],
        "caption": ["C"],
        "label": ["L"],
        "ids": ["S:i", "j"],
        "blocked": ["z"],
        "scalars": ["1", "1", "2.5", "true", "x"],
        "nested": ["a, b, 3"],
        "deep": ["too deep"],
    }


def test_lists_nested_deeper_than_the_limit_vanish(entity):
    props = {"a": [[[[[[["x"]]]]]]]}
    assert record(entity({"schema": "X", "properties": props}))["properties"] == {}


def test_long_json_is_cut(entity):
    out = record(entity({"schema": "X", "properties": {"o": {"k": "v" * 900}}}))
    (value,) = out["properties"]["o"]
    assert len(value) == 800 and value.endswith("...")


def test_id_and_link_from_links(entity):
    links = {"self": "https://h/api/2/entities/12.8f%2B", "ui": "https://h/entities/other"}
    out = record(entity({"schema": "Pages", "links": links, "properties": {"title": ["t"]}}))
    assert out["id"] == "12.8f+" and out["link"] == links["ui"]
    fallback = {"self": "https://h/api/2/entities/x/expand", "ui": "https://h/entities/u"}
    assert record(entity({"links": fallback}))["id"] == "u"


def test_references_are_compressed(entity):
    props = {
        "processingAgent": ["a"],
        "processingStatus": ["b"],
        "parent": {"id": "f", "schema": "Folder", "caption": "F", "extra": 1},
        "ancestors": [{"id": "r", "schema": "Folder"}, "text"],
        "recipients": [
            {"id": "p", "schema": "Person", "properties": {"name": ["N"], "email": ["e@x"]}},
            {"properties": {}},
            "text",
        ],
    }
    out = record(entity({"schema": "Email", "properties": props}), max_array_values_per_field=1)
    assert out["properties"] == {
        "parent": {"schema": "Folder", "caption": "F", "id": "f"},
        "ancestors": [{"schema": "Folder", "caption": None, "id": "r"}],
        "recipients": [{"schema": "Person", "id": "p", "name": "N", "email": "e@x"}],
    }
    odd = {"parent": "text", "ancestors": [], "recipients": "somebody"}
    assert record(entity({"schema": "Email", "properties": odd}))["properties"] == {
        "recipients": ["somebody"]
    }


@pytest.mark.parametrize("field", ["bodyText", "indexText", "rawText"])
def test_page_text_sources(entity, field):
    text = "Paragraph one.\r\n\r\nParagraph two."
    out = record(entity({"schema": " PAGES ", "properties": {field: [text, " "]}}))
    assert out["properties"] == {"bodyText": ["Paragraph one.\n\nParagraph two."]}
    assert "bodyTextFromSearchHighlight" not in out and out["schema"] == "PAGES"


def test_second_body_field_is_previewed(entity):
    page = {"schema": "Page", "properties": {"bodyText": ["body"], "indexText": ["index text", "more"]}}
    out = record(entity(page), content_preview_chars=5)
    assert out["properties"] == {"bodyText": ["body"], "indexTextPreview": "index..."}


def test_highlight_fallback(entity):
    snippets = ["a <em>keyword</em> here", "another <em>keyword</em>"]
    out = record(entity({"schema": "Pages", "properties": {"title": ["t"]}, "highlight": snippets}))
    assert out["properties"]["bodyText"] == ["a keyword here\n...\nanother keyword"]
    assert out["bodyTextFromSearchHighlight"] is True and out["highlight"] == snippets
    single = record(entity({"schema": "Pages", "highlight": "<em>x</em>"}))
    assert single["highlight"] == "<em>x</em>" and single["properties"] == {}
    assert "highlight" not in record(entity({"schema": "Pages", "highlight": []}))


def test_highlight_stays_whole_beside_a_cut_body(entity):
    page = {"schema": "Page", "properties": {"bodyText": ["paragraph " * 50]}, "highlight": ["<em>p</em>"]}
    out = record(entity(page), body_markdown_max_chars=80)
    assert out["truncatedBody"] is True and out["highlight"] == ["<em>p</em>"]


def test_search_cuts_shorter_than_a_single_entity(entity):
    page = entity({"schema": "Page", "properties": {"bodyText": ["word " * 80]}})
    assert len(record(page)["properties"]["bodyText"][0]) < 230
    (whole,) = SH.to_json_records(SH.entity_records(page)).collect()
    assert json.loads(whole.json)["truncatedBody"] is False


def test_score_dataset_and_defaults(entity):
    def fields(**values):
        out = record(entity(values))
        return out["score"], out["dataset"], out["schema"], out["id"], out["link"]

    assert fields(score=1.5, _score=2) == (1.5, None, "Unknown", None, None)
    assert fields(score=None, _score=2)[0] == 2
    assert fields(score="high", _score=2)[0] is None
    assert fields(dataset=" ", collection_id="c ", collection={"id": "d"})[1] == "c"
    assert fields(dataset=5, collection={"id": "d"}, schema=" ")[1:3] == ("d", "Unknown")


def test_raw_beside_the_record(entity):
    (row,) = SH.to_json_records(SH.entity_records(entity(MAIL), include_raw=True)).collect()
    out = json.loads(row.json)
    assert out["raw"] == MAIL and out["result"]["id"] == "m1"


def test_numbers_in_body_fields_show_but_are_no_text(entity):
    rows = entity({"schema": "Page", "properties": {"bodyText": ["a", 5]}})
    assert record(rows)["properties"] == {"bodyText": ["a"]}
    assert record(rows, include_content_fields=True)["properties"] == {"bodyText": ["a", "5"]}


def test_envelopes(spark):
    bodies = [
        json.dumps({"status": "ok", "results": [{"id": "a"}, {"id": "b"}]}),
        json.dumps({"results": {"id": "x"}}),
        "[]",
        "",
        "no json",
        '{"results": [{"id": "dup", "id": "dup2"}]}',
    ]
    df = spark.createDataFrame([(b,) for b in bodies], "body string")
    found = P.scan_envelopes(df).select("id", "rank").collect()
    assert sorted((r.id, r["rank"]) for r in found) == [("a", 0), ("b", 1)]
    kept = P.decode(df, "body").filter(F.col("raw_text").isNotNull()).count()
    assert kept == 2
    assert P.rejected_entities(df, "body").count() == 4


def test_split_responses(spark):
    rows = [("r", "u", 200, "{}"), ("s", "u", 500, '{"b": 1}'), ("t", "u", 404, ""), ("v", "u", 502, "x<y")]
    good, failed = P.split_responses(
        spark.createDataFrame(rows, "response_id string, url string, status int, body string"), "Search failed"
    )
    assert good.count() == 1
    assert {r.status: r.error for r in failed.collect()} == {
        500: 'HTTP 500: Search failed: HTTP 500\n{"b":1}',
        404: "HTTP 404: Search failed: HTTP 404",
        502: 'HTTP 502: Search failed: HTTP 502\n{"raw":"x<y"}',
    }


def test_argument_bounds(entity):
    with pytest.raises(ValueError):
        SH.search_records(entity(MAIL), max_array_values_per_field=201)
    with pytest.raises(ValueError):
        SH.search_records(entity(MAIL), content_preview_chars=-1)


def test_highlights_that_are_no_strings(entity):
    mixed = [{"x": "secret"}, None, 5, "a <em>word</em>"]
    out = record(entity({"schema": "Pages", "properties": {"title": ["t"]}, "highlight": mixed}))
    assert out["highlight"] == mixed and out["properties"]["bodyText"] == ["a word"]
    none = record(entity({"schema": "Pages", "properties": {"title": ["t"]}, "highlight": [{"x": 1}, None]}))
    assert "bodyText" not in none["properties"] and none["highlight"] == [{"x": 1}, None]


def test_previews_take_the_place_of_their_names(entity):
    props = {"bodyText": ["whole text"], "rawText": ["raw"], "rawTextPreview": ["mine"]}
    out = record(entity({"id": "a", "schema": "Pages", "properties": props}), content_preview_chars=3)
    assert out["properties"]["rawTextPreview"] == "raw"


def test_names_and_numbers_at_any_depth(entity):
    name = "Deep Name"
    for level in range(10):
        name = {"name": name} if level % 3 else [{"properties": {"name": [name]}}]
    number = "7th"
    for _ in range(9):
        number = [[], number]
    rows = entity({"id": "a", "schema": "Page", "properties": {"owner": [{"caption": name, "id": "x"}], "index": number, "document": ["d"]}})
    row = rows.first()
    assert row.props["owner"] == ["Deep Name"] and row.page_index == 7.0


def test_json_of_narrow_tables_is_made_in_many_tasks(spark, tmp_path):
    from entitylake.plans.catalog import shaping
    from entitylake.sources import testbed as TB

    spark.range(400).selectExpr("id AS c_custkey", "'n' AS c_name", "id % 2 AS c_nationkey", "'m' AS c_mktsegment", "1.5D AS c_acctbal").coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    spark.sql("SELECT 0L AS n_nationkey, 'N' AS n_name, 0L AS n_regionkey UNION ALL SELECT 1L, 'M', 0L").write.parquet(f"{tmp_path}/nation.parquet")
    spark.sql("SELECT 0L AS r_regionkey, 'R' AS r_name").write.parquet(f"{tmp_path}/region.parquet")
    spark.range(400).selectExpr("id AS o_orderkey", "id AS o_custkey", "'O' AS o_orderstatus", "'p' AS o_orderpriority").coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    people = TB.raw_people(spark, str(tmp_path))
    assert people.count() == 400
    for rows in (people, shaping.prj13_link(spark, str(tmp_path)), shaping.prj8_property_values(spark, str(tmp_path)), shaping.prj7_names_of_objects(spark, str(tmp_path))):
        held = [n for n in rows.rdd.glom().map(len).collect() if n]
        assert sum(held) == 400 and len(held) == 4 and max(held) < 200
