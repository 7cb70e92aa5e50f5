import pytest
from pyspark.sql import functions as F

from entitylake import constants as K
from entitylake.operators import bodies as B
from entitylake.operators.groups import first_in_slices

PARENT = {"id": "doc.123", "schema": "Pages", "properties": {"fileName": ["f.pdf"], "blank": [""], "gone": []}}


def page(n, text, parent="doc.123", **more):
    props = {"document": [parent], "index": [n], "bodyText": [text], **more}
    return {"id": f"p{n}{text}", "schema": "Page", "properties": props}


def by_id(df):
    return {r.id: r for r in df.collect()}


def test_mail_and_own_text(entity):
    rows = by_id(
        B.full_body(
            entity(
                {"id": "m", "schema": "Email", "properties": {"bodyHtml": ["<p>Hello <b>world</b></p>"]}},
                {"id": "p", "schema": "Pages", "properties": {"bodyText": ["Part A.\n\nPart B."]}},
                {"id": "h", "schema": "Pages", "properties": {}, "highlight": ["<em>no</em>"]},
            )
        )
    )
    assert set(rows) == {"m", "p"}
    assert rows["m"].bodyMarkdown == "Hello **world**" and rows["m"].bodyMarkdownFullChars == 15
    assert rows["m"].htmlSourceTruncated is False and rows["m"].bodyTextFromChildren is None
    assert rows["p"].bodyText == "Part A.\n\nPart B." and rows["p"].bodyTextFromChildren is False


def test_children_in_index_order(entity):
    corpus = entity(
        PARENT,
        page(2, "second"),
        page(1, "first"),
        page(3, " "),
        page("10th", "tenth"),
        {"id": "z", "schema": "Page", "properties": {"document": "doc.123", "rawText": "last"}},
        {"id": "other", "schema": "page", "properties": {"document": ["doc.123"], "bodyText": ["no"]}},
    )
    row = by_id(B.full_body(corpus))["doc.123"]
    assert row.bodyText == "first\n\nsecond\n\ntenth\n\nlast"
    assert row.bodyTextFromChildren is True and row.childPageCount == 4


def test_own_text_wins_over_children(entity):
    own = {**PARENT, "properties": {"indexText": ["own"]}}
    row = by_id(B.full_body(entity(own, page(1, "child"))))["doc.123"]
    assert row.bodyText == "own" and row.childPageCount is None


def test_page_limit_counts_pages_without_text(entity):
    corpus = entity(PARENT, page(1, " "), page(2, "b"), page(3, "c"))
    row = by_id(B.full_body(corpus, max_children=2))["doc.123"]
    assert row.bodyText == "b" and (row.childPageCount, row.childPagesTotal, row.childPagesCut) == (1, 3, True)
    with pytest.raises(ValueError):
        B.full_body(corpus, max_children=0)
    with pytest.raises(ValueError):
        B.first_children(B.child_rows(corpus), 501)


def test_a_file_of_many_pages_comes_back_whole(spark):
    rows = [("x", float(i), f"p{i}", None if i % 5 == 4 else f"text {i}") for i in range(1200)]
    pages = spark.createDataFrame(rows[::-1], "parent_id string, position double, id string, text string")
    row = B.child_bodies(pages).first()
    assert row.bodyText == "\n\n".join(t for *_, t in rows if t)
    assert (row.childPageCount, row.childPagesTotal, row.childPagesCut) == (960, 1200, False)
    late = pages.withColumn("text", F.when(F.col("position") > 900, F.col("text")))
    assert B.child_bodies(late).first().bodyText.startswith("text 901\n\n")


def test_a_file_too_long_for_one_row_is_named(spark, monkeypatch):
    monkeypatch.setattr(B, "MAX_ROW_CHARS", 50)
    pages = spark.createDataFrame([("big file", float(i), f"p{i}", "t" * 20) for i in range(3)], "parent_id string, position double, id string, text string")
    with pytest.raises(Exception, match="too long for one row: file big file"):
        B.child_bodies(pages).collect()


def joined_like_one_text(texts):
    """The guard on the whole joined text, in plain Python."""
    raw = "\n\n".join(texts)
    if len(raw) <= K.MAX_CONVERSION_CHARS:
        return raw, False
    head = raw[: K.MAX_CONVERSION_CHARS]
    at = head.rfind("\n")
    return (head[:at] if at >= K.MAX_CONVERSION_CHARS * 0.85 else head), True


@pytest.mark.parametrize("extra", [-3, -2, -1, 0, 1, 2, 3, 50])
def test_guard_over_many_pages(spark, extra):
    base = K.MAX_CONVERSION_CHARS // 4
    texts = ["a" * base, "b\n" + "b" * (base - 2), "c" * base, "d\n" + "e" * (base - 8 + extra), "f" * 30, "g" * base]
    rows = [("x", float(i), f"p{i}", t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "parent_id string, position double, id string, text string")
    row = B.child_bodies(df, max_source_chars=K.MAX_CONVERSION_CHARS).first()
    assert (row.bodyText, row.htmlSourceTruncated) == joined_like_one_text(texts)
    assert row.childPageCount == len(texts)


def test_missing_body_report(entity):
    many = {f"k{i:02d}": ["v"] for i in range(25)}
    report = by_id(
        B.missing_body(
            entity(
                PARENT,
                {"id": "t", "schema": "Pages", "properties": {"title": ["x"]}},
                {"id": "m", "schema": "Email", "properties": {"bodyHtml": ["<!-- -->"]}},
                {"id": "o", "properties": many},
                {"id": "e", "schema": "Person"},
                page(1, "text"),
                page(1, " ", parent="t"),
            )
        )
    )
    assert {k: r.present_keys for k, r in report.items() if not k.startswith("p")} == {
        "t": "title",
        "m": "bodyHtml",
        "o": ", ".join(sorted(many)[:20]) + ", … (+5 more)",
        "e": "(no non-empty properties)",
    }
    assert report["o"].schema == "unknown" and "doc.123" not in report


def test_present_keys_keep_blank_strings(entity):
    (row,) = entity(PARENT).collect()
    assert sorted(row.present_keys) == ["blank", "fileName"]


def test_first_in_slices_of_a_hot_group(spark):
    rows = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("key"),
        (F.col("id") * 7919 % 5003).alias("rank"),
        "id",
    )
    order = [F.col("rank"), F.col("id")]
    plain = first_in_slices(rows, "key", order, 7, slice_by="id", slices=1)
    sliced = first_in_slices(rows, "key", order, 7, slice_by="id", slices=4)
    collect = lambda df: sorted(map(tuple, df.select("key", "rank", "id", "place").collect()))
    assert collect(plain) == collect(sliced)
    groups = {}
    for row in rows.collect():
        groups.setdefault(row.key, []).append((row["rank"], row.id))
    expected = [(k, r, i, n) for k, v in groups.items() for n, (r, i) in enumerate(sorted(v)[:7], 1)]
    assert collect(sliced) == sorted(expected)


def test_stage_by_stage_limit_reaches_the_shuffle(spark, sf):
    from entitylake.sources import testbed as TB

    plan = B.first_children(B.child_rows(TB.conversation_pages(spark, sf)), 3)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in text and "CartesianProduct" not in text


def test_files_too_long_for_one_row_are_listed(spark, monkeypatch):
    monkeypatch.setattr(B, "MAX_ROW_CHARS", 50)
    rows = [("big file", float(i), f"p{i}", "t" * 20) for i in range(3)] + [("small", 0.0, "s", "text"), ("small", 1.0, "s1", None)]
    pages = spark.createDataFrame(rows, "parent_id string, position double, id string, text string")
    assert [tuple(r) for r in B.oversize_files(pages).collect()] == [("big file", 66)]
    assert [(r.parent_id, r.bodyText) for r in B.child_bodies(pages, skip_oversize=True).collect()] == [("small", "text")]
    assert [r.childPageCount for r in B.child_bodies(pages, max_children=1).filter("parent_id = 'big file'").collect()] == [1]
