import re

import pytest
from pyspark.sql import functions as F

from entitylake.operators import joins as J
from entitylake.operators import predicates as P
from entitylake.operators import rank as R
from entitylake.operators import search as S
from entitylake.plans import workflows as WF

TEXTS = {
    "a": "Trump met Putin in Helsinki",
    "b": "Putins palace, far from any other word such as Trump or so",
    "c": "nothing of note",
    "d": "Trump Putin Trump",
}


@pytest.fixture(scope="module")
def corpus(entity):
    objects = [
        {"id": k, "schema": "Pages", "collection_id": "leak", "properties": {"bodyText": [t], "languages": ["en"]}}
        for k, t in TEXTS.items()
    ]
    objects += [
        {
            "id": "x",
            "schema": "Company",
            "schemata": ["Company", "LegalEntity"],
            "collection_id": "reg",
            "score": 3,
            "properties": {
                "name": ["Acme Ltd", "ACME"],
                "email": ["john.doe@example.org"],
                "incorporationDate": ["2011", "2009-01-01"],
                "rowCount": ["100"],
                "countries": ["de", "fr", "de"],
                "director": [{"id": "y", "schema": "Person"}],
            },
        },
        {"id": "y", "schema": "Person", "score": 7, "properties": {"name": ["Al"], "countries": ["de"]}},
    ]
    return entity(*objects).cache()


def ids(df):
    return sorted(r.id for r in df.select("id").collect())


@pytest.mark.parametrize(
    "make,expected",
    [
        (lambda: P.match_all(), "abcdxy"),
        (lambda: P.has_term("TRUMP"), "abd"),
        (lambda: P.has_phrase("met putin"), "a"),
        (lambda: P.has_fuzzy("putin", 1), "abd"),
        (lambda: P.has_fuzzy("pu", 1), ""),
        (lambda: P.near(["trump", "putin"], 2), "ad"),
        (lambda: P.near(["trump", "putin"], 10), "ad"),
        (lambda: P.near(["putins", "trump"], 9), "b"),
        (lambda: P.has_any(["palace", "note"]), "bc"),
        (lambda: P.must(P.has_term("trump"), P.has_term("putin")) & P.must_not(P.has_term("met")), "d"),
        (lambda: ~P.prop_eq("languages", "en"), "xy"),
        (lambda: P.prop_fuzzy("email", "jon.doe@example.org", 1), "x"),
        (lambda: P.prop_regex("email", "john.?doe@example.org"), "x"),
        (lambda: P.prop_regex("email", "john"), ""),
        (lambda: P.prop_date_cmp("incorporationDate", ">", "2010-07-01"), "x"),
        (lambda: P.prop_date_cmp("incorporationDate", ">", "2011-01-01"), ""),
        (lambda: P.prop_date_between("incorporationDate", "2009-01-01", "2009-01-01"), "x"),
        (lambda: P.prop_num_cmp("rowCount", ">", 99), "x"),
        (lambda: P.prop_num_cmp("rowCount", ">", 100), ""),
        (lambda: P.schemata_is("LegalEntity"), "x"),
        (lambda: P.extra_filters({"countries": "fr", " ": "q", "email": None}), "x"),
    ],
)
def test_predicates(corpus, make, expected):
    assert ids(S.matching(corpus, make())) == list(expected)


def test_extra_filter_replaces_a_single_schema_only(corpus):
    assert ids(S.matching(corpus, schema="Pages", extra_filters={"schema": "Person"})) == ["y"]
    assert ids(S.matching(corpus, schema="Pages,Company", extra_filters={"schema": "Person"})) == []
    assert ids(S.matching(corpus, collection_id="leak", extra_filters={"collection_id": "reg"})) == ["x"]


def test_descendants_by_table(spark, corpus):
    closure = spark.createDataFrame(
        [("Company", "LegalEntity"), ("Person", "LegalEntity"), ("Pages", "Document")], "schema string, ancestor string"
    )
    assert ids(S.matching(corpus, schemata="LegalEntity", closure=closure)) == ["x", "y"]
    assert S.matching(corpus, schemata="LegalEntity", closure=closure).columns == corpus.columns


def test_paging(corpus):
    ordered = [r.id for r in S.page(corpus).collect()]
    assert ordered == ["y", "x", "a", "b", "c", "d"]
    assert [r.id for r in S.page(corpus, 2, 1).collect()] == ["x", "a"]
    assert [r.id for r in S.page(corpus, 0).collect()] == ["y"]
    assert [r.id for r in S.page(corpus, None, 4).collect()] == ["c", "d"]


def test_pages_add_up_whatever_the_ids(spark):
    rows = [("a", 3.0, 1), (None, 2.5, 2), ("b", 3.0, 3), ("b", 3.0, 4), ("b", 3.0, 5), (None, None, 6), ("z", None, 7), ("n", float("nan"), 8)]
    hits = spark.createDataFrame(rows * 1, "id string, score double, row int").repartition(3)
    ordered = S.page(hits).collect()
    assert [r.id for r in ordered] == ["n", "a", "b", "b", "b", None, None, "z"]
    for size in (1, 2, 3, None):
        for offset in range(0, 10):
            page = S.page(hits, size, offset).collect()
            wanted = ordered[offset : None if size is None else offset + size]
            assert [(r.id, str(r.score)) for r in page] == [(r.id, str(r.score)) for r in wanted], (size, offset)
    assert S.page(hits, 3, 2).columns == hits.columns
    assert [r.id for r in S.page(hits, 2, after=(3.0, "b")).collect()] == [None, None]
    assert "offset=5" not in S.page(hits, 3, 5)._jdf.queryExecution().executedPlan().toString()


def test_conditions_without_terms(corpus):
    assert ids(S.matching(corpus, P.has_all([]) & P.must() & P.must_not() & P.near([], 2))) == list("abcdxy")
    assert ids(S.matching(corpus, P.has_any([]))) == []
    with pytest.raises(ValueError):
        R.score_postings(R.build_postings(corpus), R.corpus_stats(corpus), " ")


def test_upper_ends_of_periods_count(entity):
    rows = entity(*[{"id": d, "properties": {"date": [d]}} for d in ("2009-01-01", "2010-06-30", "2010-12-31", "2011-01-01", "2012-02-29")])
    assert ids(S.matching(rows, P.prop_date_between("date", "2009", "2010"))) == ["2009-01-01", "2010-06-30", "2010-12-31"]
    assert ids(S.matching(rows, P.prop_date_between("date", "2011", "2012-02"))) == ["2011-01-01", "2012-02-29"]


def test_search_scores_and_highlights(corpus):
    hits = S.search(corpus, query="putin", schema="Pages").collect()
    assert [h.id for h in hits] == ["a", "d"] or [h.id for h in hits] == ["d", "a"]
    assert all("<em>Putin</em>" in h.highlight[0] for h in hits)
    assert hits[0].score >= hits[1].score > 0
    assert S.search(corpus, query="putin", highlight=False).columns == corpus.columns


def test_postings_and_text_give_the_same_scores(corpus):
    by_text = {r.id: r.score for r in R.score_text(corpus, "trump note").collect()}
    by_postings = {
        r.id: r.score
        for r in R.score_postings(R.build_postings(corpus), R.corpus_stats(corpus), "trump note").collect()
    }
    assert by_text.keys() == by_postings.keys() == {"a", "b", "c", "d"}
    assert all(abs(by_text[k] - by_postings[k]) < 1e-9 for k in by_text)


def test_postings_on_storage(spark, corpus, tmp_path):
    path = str(tmp_path / "postings")
    postings = R.build_postings(corpus)
    R.write_postings(postings, path, buckets=4)
    few = R.read_postings(spark, path, query="Putin note", buckets=4)
    assert {r.token for r in few.collect()} >= {"putin", "note"}
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: []" not in plan and "bucket" in plan.split("PartitionFilters")[1][:60]
    stats = R.corpus_stats(corpus)
    assert {r.id: round(r.score, 9) for r in R.score_postings(few, stats, "Putin note").collect()} == {
        r.id: round(r.score, 9) for r in R.score_text(corpus, "Putin note").collect()
    }
    stored = R.read_postings(spark, path)
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, postings.collect()))
    assert ids(R.fuzzy_ids(stored, "putin", 1)) == ids(S.matching(corpus, P.has_fuzzy("putin", 1)))


def test_fuzzy_dictionary_compares_once_per_token(corpus):
    plan = R.fuzzy_tokens(R.dictionary(R.build_postings(corpus)), "putin", 2)
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.index("levenshtein") < text.index("Aggregate")


def test_facets(corpus):
    counts = {(r.facet, r.value): r.n for r in S.facets(corpus, ["countries", " ", "schema"]).collect()}
    assert counts == {
        ("countries", "de"): 2,
        ("countries", "fr"): 1,
        ("schema", "Pages"): 4,
        ("schema", "Company"): 1,
        ("schema", "Person"): 1,
    }
    top = S.facets(corpus, ["countries", "schema"], top=1).collect()
    assert {(r.facet, r.value) for r in top} == {("countries", "de"), ("schema", "Pages")}


def test_fragments(one):
    text = "x" * 100 + " Key " + "y" * 300 + "\nkey"
    found = one(lambda t: S.fragments(t, ["key"], count=5, length=23), text)
    assert [re.sub("</?em>", "", f) for f in found] == ["x" * 9 + " Key " + "y" * 9, "y" * 9 + "\nkey"]
    assert "<em>Key</em>" in found[0]
    with pytest.raises(ValueError):
        S.fragments(F.lit("x"), ["k"], count=101)


def test_fragments_of_long_texts_and_any_letters(one):
    text = "ÉCOLE normale École " + "x" * 30_000 + " école"
    found = one(lambda t: S.fragments(t, ["école"], count=3, length=2100), text)
    assert [len(re.sub("</?em>", "", f)) for f in found] == [2100, 1052]
    assert found[0].startswith("<em>ÉCOLE</em> normale <em>École</em> x") and found[1].endswith(" <em>école</em>")
    assert one(lambda t: S.fragments(t, ["absent"], length=50_000), "y" * 300_000) == []
    assert one(lambda t: S.fragments(t, ["k"]), None) == []


def test_links_of_nested_entities(entity):
    ann = {"id": "p1", "schema": "Person", "properties": {"name": ["Ann"]}}
    corpus = entity(
        ann,
        {"id": "c", "schema": "Company", "properties": {"name": ["Blue Mill"]}},
        {"id": "o", "schema": "Ownership", "properties": {"owner": [ann], "asset": [{"id": "c"}, "d"]}},
        {"id": "q", "schema": "Ownership", "properties": {"owner": ["p9"], "asset": ["e"]}},
    )
    (row,) = J.pivot(corpus, corpus, "owner").collect()
    assert (row.source_id, row.target_id, row.target_schema) == ("o", "p1", "Person")
    people = corpus.filter("schema = 'Person'")
    assert [tuple(r) for r in J.referring(corpus, "owner", people).collect()] == [("o", "owner", "p1")]
    found = WF.follow_company(corpus, "blue mill", ["owner", "asset"]).collect()
    assert sorted(map(tuple, found)) == [("c", "asset", "o"), ("d", "asset", "o"), ("p1", "owner", "o")]


def test_links_both_ways(corpus):
    out = J.pivot(corpus, corpus, "director").collect()
    assert [(r.source_id, r.role, r.target_id) for r in out] == [("x", "director", "y")]
    linked = corpus.withColumn("props", F.map_concat("props", F.create_map(F.lit("owner"), F.array(F.lit("y")))))
    assert {r.source_id for r in J.pivot(linked, corpus, "owner").collect()} == set("abcdxy")
    edges = WF.follow_company(linked, "acme ltd", ["owner"]).collect()
    assert [tuple(r) for r in edges] == [("y", "owner", "x")]


def test_top_hits(spark, corpus):
    hits = spark.createDataFrame(
        [(0, "c", "s1"), (1, None, "s1"), (2, "a", "s1"), (3, "b", "s1"), (0, "y", "s2")],
        "rank int, own_id string, search string",
    )
    assert [r.id for r in J.top_hit_ids(hits.filter("search = 's1'"), 2).collect()] == ["c", "a"]
    assert ids(J.fetch_top_hits(corpus, hits.filter("search = 's1'"), 10)) == ["a", "b", "c"]
    each = J.top_hit_ids(hits, 2, search_key="search").collect()
    assert sorted((r.search, r.id) for r in each) == [("s1", "a"), ("s1", "c"), ("s2", "y")]
    assert ids(J.get_entity(corpus, " x ")) == ["x"]


def test_negative_results_are_reported(corpus):
    rows = WF.verify_claim(corpus, {"hit": P.has_term("trump"), "none": P.has_term("absent")}).collect()
    assert {r["query"]: (r.n, r.verdict) for r in rows} == {
        "hit": (3, "indexed matches"),
        "none": (0, "no indexed match"),
    }


def test_citations_quote_the_body(corpus):
    (row,) = WF.citations(corpus, "palace", excerpt_chars=20).collect()
    assert row.id == "b" and row.excerpt in TEXTS["b"] and "palace" in row.excerpt


def test_citations_follow_the_search(entity):
    texts = {"a": "Ein Übersicht\nPlan", "b": "ÜBERSICHT,  plan hier", "c": "übersichtsplan", "d": "plan"}
    corpus = entity(*[{"id": k, "schema": "Pages", "properties": {"bodyText": [t]}} for k, t in texts.items()])
    cited = WF.citations(corpus, "übersicht plan").collect()
    assert {r.id for r in cited} == set(ids(S.matching(corpus, P.has_phrase("übersicht plan")))) == {"a", "b"}
    assert all(r.excerpt in texts[r.id] for r in cited)


def test_facets_of_repeated_entities_count_ids(corpus):
    twice = corpus.unionByName(corpus).unionByName(corpus.filter("id = 'x'"))
    once = sorted(map(tuple, S.facets(corpus, ["countries", "schema"]).collect()))
    assert sorted(map(tuple, S.facets(twice, ["countries", "schema"], repeated=True).collect())) == once
    assert {r.n for r in S.facets(twice, ["schema"]).collect()} == {3, 2, 8}
    unnamed = corpus.withColumn("id", F.when(F.col("id") != "x", F.col("id")).cast("string")).unionByName(corpus.filter("id = 'x'").withColumn("id", F.lit(None).cast("string")))
    assert {r.value: r.n for r in S.facets(unnamed, ["countries"], repeated=True).collect()} == {"de": 3, "fr": 2}
    assert S.facets(twice, ["countries", "schema"], top=1, repeated=True).count() == 2


def test_pages_of_ties_are_the_same_in_every_run(spark):
    rows = [(None, 1.0, f"row {i}") for i in range(400)]
    wanted = None
    for parts in (1, 3, 7):
        hits = spark.createDataFrame(rows, "id string, score double, own_id string").repartition(parts)
        pages = [[r.own_id for r in S.page(hits, 40, offset).collect()] for offset in range(0, 400, 40)]
        assert sorted(x for page in pages for x in page) == sorted(r[2] for r in rows)
        assert wanted in (None, pages)
        wanted = pages
    assert [r.own_id for r in S.page(hits, None, 360).collect()] == wanted[-1]


def test_pages_within_the_largest_are_a_top_k(corpus):
    plan = S.page(corpus, 5, 40)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject(limit=45" in plan and "rangepartitioning" not in plan


def test_tied_links_need_no_window(corpus):
    plan = WF.follow_company(corpus, "acme", ["director"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "LeftSemi" in plan


def test_citations_where_small_letters_are_longer(entity):
    texts = {"a": "İİİ of the mill", "b": "proof theme", "c": "x_of.The", "d": "of of the"}
    corpus = entity(*[{"id": k, "schema": "Pages", "properties": {"bodyText": [t]}} for k, t in texts.items()])
    cited = {r.id: r.excerpt for r in WF.citations(corpus, "of the", excerpt_chars=6).collect()}
    assert cited == {"a": "of the", "c": "of.The", "d": "of the"}


def test_fragments_mark_whole_words(one):
    text = "the party has art in cartoons, ART9 and art"
    found = one(lambda t: S.fragments(t, ["art"], count=1, length=200, whole_words=True), text)
    assert found == ["the party has <em>art</em> in cartoons, ART9 and <em>art</em>"]
    # Pieces that begin or end inside a longer word don't mark what is left of it.
    cut = one(lambda t: S.fragments(t, ["art"], count=5, length=3, whole_words=True), "cart art artist xart")
    assert cut == ["<em>art</em>"]
    wide = one(lambda t: S.fragments(t, ["art"], count=5, length=9, whole_words=True), "xxart art artxx")
    assert len(wide) == 1 and all("<em>art</em> a" in piece for piece in wide)
    assert one(lambda t: S.fragments(t, ["art"], whole_words=True), "party") == []
    assert one(lambda t: S.fragments(t, ["art"]), "party") == ["p<em>art</em>y"]
