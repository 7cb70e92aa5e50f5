"""Segmented bodies against joined ones, and citations by page against plain loops."""

import random
import re

import pytest

from entitylake.operators import bodies as B
from entitylake.operators import segments as SG
from tests.test_bodies import page

WORDS = ["of", "the", "Of", "THE", "mill", "é", "a1", "\U0001f600"]


@pytest.fixture(scope="module")
def corpus(entity):
    draw = random.Random(11)
    objects = [{"id": f"f{i}", "schema": "Pages"} for i in range(6)]
    for i in range(90):
        text = draw.choice([" ", ", ", "\r\n", "\n\n"]).join(draw.choice(WORDS) for _ in range(draw.randrange(0, 9)))
        one = page(draw.choice([i, 7, None]), text, parent="f0" if i % 3 else f"f{draw.randrange(1, 5)}")
        objects.append({**one, "id": draw.choice([f"p{i}", "same", f"p{i}"])})
    objects += [objects[20], objects[20], objects[21], page(1, "of", "f5"), page(2, "the  mill", "f5"), page(3, "of", "f5"), page(4, "the", "f5")]
    return entity(*objects).cache()


def bodies_of(corpus):
    return {r.parent_id: r.bodyText for r in B.child_bodies(B.child_rows(corpus)).collect()}


@pytest.mark.parametrize("size", [1, 7, 50, 10**6])
def test_segments_join_to_the_body(corpus, size):
    parts = {}
    for row in SG.segments(corpus, segment_chars=size).collect():
        assert row.start == row.segment * size and row.parent_id in ("f0", "f1", "f2", "f3", "f4", "f5")
        parts.setdefault(row.parent_id, {})[row.segment] = row.text
    joined = {name: "".join(found[k] for k in sorted(found)) for name, found in parts.items()}
    assert joined == bodies_of(corpus)
    for found in parts.values():
        assert sorted(found) == list(range(len(found)))
        assert all(len(text) == size for k, text in found.items() if k < len(found) - 1)


def test_pages_lie_where_they_start(corpus):
    bodies = bodies_of(corpus)
    texts = {(r.parent_id, r.position, r.id, r.tag): r.text for r in SG.page_texts(corpus).collect()}
    rows = SG.page_starts(corpus).collect()
    assert sum(r.copies for r in rows) == SG.page_texts(corpus).count() > len(rows)
    for r in rows:
        text = texts[r.parent_id, r.position, r.id, r.tag]
        for k in range(r.copies):
            start = r.start + k * (r.chars + 2)
            assert bodies[r.parent_id][start : start + r.chars] == text
        assert r.first_word == len(re.findall(r"[^\W_]+", bodies[r.parent_id][: r.start]))


@pytest.mark.parametrize("phrase", ["of the", "the", "THE of the", "mill  the", "of of", "absent word", "é a1"])
def test_places_of_phrases(corpus, phrase):
    bodies, wanted = bodies_of(corpus), set()
    words = phrase.lower().split()
    for name, body in bodies.items():
        found = list(re.finditer(r"[^\W_]+", body))
        for i in range(len(found) - len(words) + 1):
            if [m.group().lower() for m in found[i : i + len(words)]] == words:
                wanted.add((name, found[i].start()))
    rows = SG.phrase_places(corpus, phrase, SG.page_starts(corpus)).collect()
    assert {(r.parent_id, r.body_offset) for r in rows} == wanted and len(rows) == len(wanted)
    texts = {}
    for r in SG.page_texts(corpus).collect():
        texts.setdefault((r.parent_id, r.id), []).append(r.text)
    for r in rows:
        assert any(t[r.page_offset :].lower().startswith(words[0]) for t in texts[r.parent_id, r.page_id])


def test_citations_across_pages(corpus):
    rows = [r for r in SG.page_citations(corpus, "of the", excerpt_chars=12, segment_chars=5).collect() if r.parent_id == "f5"]
    body = bodies_of(corpus)["f5"]
    assert body == "of\n\nthe  mill\n\nof\n\nthe"
    first, last = sorted(rows, key=lambda r: r.body_offset)
    assert (first.page_id, first.end_page_id, first.page_offset, first.body_offset) == ("p1of", "p2the  mill", 0, 0)
    assert (last.page_position, last.body_offset) == (3.0, body.rindex("of"))
    assert first.excerpt == body[:9] and last.excerpt == body[body.rindex("of") - 3 :]


def test_sums_run_over_ranges(spark):
    rows = [("hot", i, i % 5) for i in range(3000)] + [(f"g{i % 7}", i, 1) for i in range(100)]
    table = spark.createDataFrame(rows, "g string, i long, n long").repartition(6)
    found = SG.sums_before(table, "g", ["i"], ["n"]).collect()
    assert {(r.g, r.i): r.n_before for r in found} == {
        (g, i): sum(n for h, j, n in rows if h == g and j < i) for g, i, _ in rows
    }


def test_no_window_carries_texts(corpus):
    starts = SG.page_starts(corpus)
    for df in (SG.segments(corpus, starts), SG.phrase_places(corpus, "of the", starts), B.child_bodies(B.child_rows(corpus))):
        assert "Window" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_bounds(corpus):
    with pytest.raises(ValueError):
        SG.segments(corpus, segment_chars=0)
    with pytest.raises(ValueError):
        SG.phrase_places(corpus, "!", SG.page_starts(corpus))
    assert SG.segments(corpus.limit(0)).count() == 0 and SG.page_citations(corpus.limit(0), "a").count() == 0
