"""Runs against all periods tried one by one, the query against plain loops, and its cost."""

import hashlib
import random
import re
import time
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from entitylake.llm import square_catchers as L


def brute(words, least=12):
    """Every period, every maximal stretch; the smallest period of a stretch stays."""
    n, found = len(words), {}
    for period in range(1, n // 2 + 1):
        i = 0
        while i + period < n:
            j = i
            while j + period < n and words[j] == words[j + period]:
                j += 1
            length = j - i + period
            if j > i and length >= max(least, 2 * period):
                found.setdefault((i, length), period)
            i = max(j, i + 1)
    return sorted(((start, length, period) for (start, length), period in found.items()), key=lambda r: (r[0], r[2]))


def planted(draw, n, letters):
    words = [draw.randrange(letters) for _ in range(n)]
    for _ in range(draw.choice([0, 1, 2, 3])):
        at, period = draw.randrange(n), draw.randrange(1, max(2, n // 2))
        for i in range(max(at, period), draw.randrange(at, n)):
            words[i] = words[i - period]
    return words


@pytest.mark.parametrize("letters", [1, 2, 3, 5, 30])
def test_runs_like_brute_force(letters):
    draw = random.Random(letters)
    for _ in range(400):
        words = planted(draw, draw.choice([1, 2, 11, 12, 30, 90, 250]), letters)
        assert L.runs_of(words) == brute(words), words


@given(st.lists(st.integers(0, 2), max_size=120), st.integers(1, 9))
@settings(max_examples=150, deadline=None)
def test_repeated_lists(words, times):
    assert L.runs_of(words * times) == brute(words * times)


def test_words_of_known_structure():
    fibonacci, before = [0, 1], [0]
    while len(fibonacci) < 1500:
        fibonacci, before = fibonacci + before, fibonacci
    assert L.runs_of(fibonacci) == brute(fibonacci)
    overlap_free = [bin(i).count("1") % 2 for i in range(1024)]
    assert L.runs_of(overlap_free) == brute(overlap_free)
    nested = ([0] * 14 + [1, 2]) * 3 + [0] * 20
    assert L.runs_of(nested) == brute(nested)
    # A period of six whose word pairs all come back sooner.
    assert L.runs_of([0, 0, 0, 1, 0, 1] * 2) == brute([0, 0, 0, 1, 0, 1] * 2) == [(0, 12, 6)]


def test_words_come_one_by_one():
    draw = random.Random(8)
    for _ in range(30):
        words, catchers = planted(draw, 120, 3), L.SquareCatchers()
        for i, word in enumerate(words):
            catchers.extend([word])
            assert catchers.runs() == brute(words[: i + 1])


def test_names_that_clash_are_compared(monkeypatch):
    monkeypatch.setattr(L, "MASK", 3)
    draw = random.Random(2)
    for _ in range(60):
        words = planted(draw, 150, 4)
        assert L.runs_of(words) == brute(words)


@pytest.mark.parametrize("unit", [1, 7, 3000])
def test_periodic_texts_cost_in_proportion(unit):
    def seconds(n):
        words = (list(range(50_000, 50_000 + unit)) * (n // unit + 1))[:n]
        started = time.process_time()
        assert L.runs_of(list(range(500)) + words)[0] == (500, n, unit)
        return time.process_time() - started

    seconds(20_000)
    assert seconds(160_000) < 25 * seconds(16_000)


def test_collapsed():
    words = list("abcabcabcabcxyyyyyyyyyyyyyz")
    assert "".join(L.collapsed(words, L.runs_of(words))) == "abcxyz"
    assert L.collapsed(list("abab"), []) == list("abab")
    # Runs inside and across each other: a word goes if any of them holds it behind its first period.
    assert L.collapsed(list(range(20)), [(0, 18, 8), (2, 12, 1), (10, 10, 4)]) == [0, 1, 2]


def expected(doc, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if doc is not None:
        h = zlib.crc32(str(doc).encode())
        if h % 10 == 0 and n:
            g = h // 10
            at = g % n
            period = 1 + (n - at) // (3 + g % 8)
            words = [word if i < at else words[at + (i - at) % period] for i, word in enumerate(words)]
    runs = brute(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    row = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
    digest = lambda text: hashlib.sha256(text.encode()).hexdigest()
    return (doc, len(runs), *row, digest(lines), digest(" ".join(w for i, w in enumerate(words) if i not in gone)))


def test_query_like_plain_loops(spark, tmp_path):
    draw = random.Random(3)
    rows = []
    for doc in range(-20, 400):
        n = draw.choice([0, 1, 3, 12, 40, 120])
        words = [f"w{draw.randrange(9)}é" for _ in range(n)] * draw.choice([1, 1, 1, 3])
        rows.append((doc, draw.choice(["", " ", "\n"]) + draw.choice([" ", "\n", "\t "]).join(words)))
    rows += [(400, None), (401, ""), (402, " \n\x0b"), (None, "spam " * 30), (None, None), rows[30], rows[30], (403, "no\xa0break " * 20), (404, "word " * 30_000)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    wanted = sorted((expected(*row) for row in rows[:-1]), key=str)
    found = sorted((tuple(r) for r in L.op13_periodic_runs(spark, str(tmp_path)).collect()), key=str)
    long = [row for row in found if row[0] == 404]
    assert [row for row in found if row[0] != 404] == wanted
    assert sum(row[1] > 0 for row in wanted) > 20 and long[0][1] == 1


def test_other_columns_stay(spark, documents):
    docs = documents((1, "a " * 15), extra=("runs", "Collapsed", "llm_text", "batch"))
    row = L.periodic_runs(docs).first()
    assert [tuple(r) for r in row["runs"]] == [(0, 15, 1)] and row["collapsed"] == "a"
    assert row["llm_text"] == row["batch"] == "kept as it is" and row["doc_id"] == 1 and len(row) == 9
    clash = docs.select("doc_id", docs["text"].alias("runs"))
    assert L.periodic_runs(clash, text="runs").columns == ["doc_id", "runs", "collapsed"]
    assert L.periodic_runs(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        L.SquareCatchers(5)
