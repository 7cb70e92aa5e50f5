"""Line dedup against brute force, bitmaps against positions, and the ways of frequent keys."""

import hashlib
import random
import string

import pytest
from pyspark.sql import functions as F

from entitylake.llm import line_bitmaps as L

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
SPACES = " \t\n\x0b\x0c\r"


def brute(rows):
    """Per row: lines, dropped lines, kept text. Rows are (doc_id, text)."""
    keyed = [(doc, [(line, line.strip(SPACES).translate(LOWER)) for line in (text or "").split("\n")]) for doc, text in rows]
    holders = {}
    for doc, lines in keyed:
        for _, key in lines:
            holders.setdefault(key, set()).add(doc)
    order = lambda doc: (doc is None, doc or 0)
    first = {key: min(docs, key=order) for key, docs in holders.items() if len(key) >= 10 and len(docs) > 1}
    out = []
    for doc, lines in keyed:
        left = [line for line, key in lines if key not in first or first[key] == doc]
        out.append((doc, len(lines), len(lines) - len(left), "\n".join(left)))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_lines", "n_dropped", "kept_text").collect()), key=str)


def planted():
    draw = random.Random(4)
    common = [f"The common Line number {i}" for i in range(6)]
    rows = []
    for doc in range(60):
        lines = [draw.choice([*common, f"own line of {doc} {draw.random()}", "short", ""]) for _ in range(draw.randrange(1, 12))]
        lines = [draw.choice([line, f" \t{line.upper()}\r", line]) for line in lines]
        rows.append((doc, "\n".join(lines)))
    rows += [
        (70, None), (71, ""), (72, "\n"), (73, "\n\n \n"), (None, "The common Line number 1"), (None, "only of no document\nx"),
        (74, "twice in one\ntwice in one row"), (74, "Twice in one"), (75, "İ the common line number 0"), (5, rows[5][1]),
        (76, "no-break space"), (77, "no-break space "), (78, " no-break space"),
        (79, "\n".join(f"long text line {i}" for i in range(3000))),
        (80, "\n".join(f"long text line {i}" if i % 2 else f"other {i} of eighty" for i in range(3000))),
        (81, "\n".join(f"long text line {i}" for i in range(900, 2900))),
    ]
    return rows


@pytest.mark.parametrize(("shares", "least"), [(L.SHARES, L.LEAST_HOT), (50, 1), (10**9, 0)])
def test_lines_like_brute_force(spark, documents, shares, least):
    """Frequent keys by either way, or all of them by the way of frequent ones."""
    rows = planted()
    docs = documents(*rows).repartition(5)
    assert found(L.deduplicated(docs, shares=shares, least=least)) == brute(rows)


def test_frequent_keys_are_found_by_their_share(spark, documents):
    docs = documents(*[(i, "the line of all documents\n" + f"another line {i}") for i in range(100)])
    rows = L.written(L.line_rows(docs))
    assert L.frequent(rows, shares=10, least=5).count() == 1
    assert L.frequent(rows, shares=10, least=1000).count() == 0


def test_frequent_keys_are_not_shuffled(spark, documents):
    rows = L.written(L.line_rows(documents(*planted())))
    plan = L.dropped_rows(rows)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("rangepartitioning(h1") == 1
    assert "hashpartitioning(h1" not in plan and "Python" not in plan and "Arrow" not in plan


def test_bitmaps_keep_what_they_say(spark):
    draw = random.Random(9)
    cases = [[0], [254], [255], [65_534], [65_535], [70_000], list(range(300)), list(range(0, 600, 2)), [*range(10), 400, *range(900, 905)]]
    cases += [sorted(draw.sample(range(n), k)) for n, k in ((20, 10), (500, 250), (5000, 30), (5000, 4000))]
    for places in cases:
        lines = [str(i) for i in range(places[-1] + draw.choice([1, 2, 40]))]
        df = spark.createDataFrame([(places, lines)], "places array<int>, lines array<string>")
        row = df.select("lines", L.packed(F.col("places")).alias("keep")).select(
            "keep", L.kept(F.col("lines"), F.col("keep")).alias("kept")
        ).first()
        gone = set(places)
        assert row["kept"] == [line for i, line in enumerate(lines) if i not in gone]
        assert len(row["keep"]) <= places[-1] // 8 + 2
    assert bytes(spark.createDataFrame([([3, 4, 5, 9],)], "p array<int>").select(L.packed(F.col("p"))).first()[0]) == b"\x00\x1c\x40"
    assert bytes(spark.createDataFrame([([103, 104],)], "p array<int>").select(L.packed(F.col("p"))).first()[0]) == b"\x01\x67\x02"


def test_clashing_columns_and_empty_table(spark, documents):
    names = ("n_lines", "KEPT_TEXT", "doc", "tag", "pos", "h1", "keep", "llm_tag")
    docs = documents((1, "a line of ten signs"), (2, "A line of ten signs\nx"), extra=names)
    out = L.deduplicated(docs)
    assert [c for c in out.columns if c.lower() in ("n_lines", "kept_text")] == ["n_lines", "kept_text"]
    assert sorted((r["doc_id"], r["kept_text"], r["doc"], r["llm_tag"]) for r in out.collect()) == [
        (1, "a line of ten signs", "kept as it is", "kept as it is"),
        (2, "x", "kept as it is", "kept as it is"),
    ]
    assert L.deduplicated(docs.limit(0)).count() == 0


def test_query_digests_the_kept_text(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    wanted = {(d, n, k, hashlib.sha256(t.encode()).hexdigest()) for d, n, k, t in brute([tuple(r) for r in docs.collect()])}
    assert {tuple(r) for r in L.op11_line_dedup(spark, sf).collect()} == wanted
