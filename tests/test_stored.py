"""Saved queries, stored positions and deletion neighbourhoods against the scans they replace."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from entitylake.operators import neighbours as N
from entitylake.operators import percolate as PC
from entitylake.operators import positions as PO
from entitylake.operators import predicates as P
from entitylake.operators import rank as R
from entitylake.operators import search as S
from entitylake.operators import tally as T


@pytest.fixture(scope="module")
def corpus(entity):
    draw = random.Random(5)
    letters = ["a", "b", "c", "dd", "Eé", "f"]
    objects = []
    for i in range(120):
        text = draw.choice([" ", ", ", "\n"]).join(draw.choice(letters) for _ in range(draw.randrange(0, 14)))
        objects.append(
            {
                "id": f"n{i}",
                "schema": draw.choice(["Pages", "Email"]),
                "schemata": ["Document"],
                "collection_id": draw.choice(["x", "y"]),
                "properties": {"indexText": [text], "languages": draw.choice([["en"], ["de", "fr"], []])},
            }
        )
    return entity(*objects, objects[0], {"schema": "Pages", "properties": {"name": ["a b"]}}).cache()


def ids(df):
    return sorted(r.id for r in df.select("id").distinct().collect())


SAVED = {
    "all": (None, None, None),
    "blank": (["  ", "!"], [], {" ": "x", "languages": None}),
    "word": (["DD"], None, None),
    "words": (["a", "f", "eé"], None, None),
    "phrase": (["a  B"], None, None),
    "both": (["a b", "c"], ["dd"], None),
    "not": (["b"], ["a b", "f"], {}),
    "filter": (None, None, {"properties.languages": "de"}),
    "filters": (None, ["c"], {"collection_id": "x", "languages": "fr", "schema": "Email"}),
    "above": (["f"], None, {"schemata": "Document"}),
    "none": (["a", "zzz"], None, None),
    "no such": (None, None, {"languages": "xx"}),
    "substring": (["d"], None, None),
}


def scan(corpus, words, excluded, filters):
    kept = {k.strip(): v for k, v in (filters or {}).items()}
    where = P.must(*[P.has_phrase(w) for w in words or []]) & P.extra_filters(kept)
    unwanted = [P.has_phrase(w) for w in excluded or []]
    return ids(S.matching(corpus.filter("id IS NOT NULL"), where & P.must_not(*unwanted)))


def test_saved_queries_like_scans(spark, corpus):
    queries = spark.createDataFrame([(k, *v) for k, v in SAVED.items()], PC.SAVED_QUERY)
    found = {}
    for row in PC.percolate(corpus, queries).collect():
        found.setdefault(row.query_id, []).append(row.id)
    for name, conditions in SAVED.items():
        assert sorted(found.get(name, [])) == scan(corpus, *conditions), name
    counts = {r.query_id: r.n for r in PC.hits_per_saved_query(corpus, queries).collect()}
    assert counts == {name: len(found.get(name, [])) for name in SAVED} and counts["all"] == 120
    verdicts = {r.query_id: r.verdict for r in PC.verify_claims(corpus, queries).collect()}
    assert verdicts["none"] == "no indexed match" and verdicts["word"] == "indexed matches"


def test_the_plan_does_not_grow_with_the_queries(spark, corpus):
    def plan(times):
        queries = spark.createDataFrame([(f"{k}{i}", *v) for i in range(times) for k, v in SAVED.items()], PC.SAVED_QUERY)
        return PC.percolate(corpus, queries)._jdf.queryExecution().optimizedPlan().toString()

    once, often = plan(1), plan(50)
    assert once.count("\n") == often.count("\n") and len(often) < 1.2 * len(once)
    assert "Cartesian" not in often and "NestedLoop" not in often


def test_no_saved_queries(spark, corpus):
    none = spark.createDataFrame([], PC.SAVED_QUERY)
    assert PC.hits_per_saved_query(corpus, none).count() == 0
    some = spark.createDataFrame([("q", ["a"], None, None)], PC.SAVED_QUERY)
    assert [tuple(r) for r in PC.hits_per_saved_query(corpus.limit(0), some).collect()] == [("q", 0)]


@pytest.mark.parametrize("phrase", ["a", "a b", "b a b", "dd dd", "a a a", "c, Eé", "f zzz", "a b c dd"])
def test_phrases_from_positions(corpus, phrase):
    known = corpus.filter("id IS NOT NULL").dropDuplicates(["id"])
    found = PO.phrase_ids(R.build_postings(known), phrase)
    assert ids(found) == ids(S.matching(known, P.has_phrase(phrase)))
    assert found.count() == found.distinct().count()


@pytest.mark.parametrize(("terms", "n"), [(["a", "b"], 1), (["a", "b"], 0), (["a", "c", "f"], 3), (["dd"], 0), (["a b", "f"], 5), (["a", "zzz"], 9)])
def test_proximity_from_positions(corpus, terms, n):
    known = corpus.filter("id IS NOT NULL").dropDuplicates(["id"])
    assert ids(PO.near_ids(R.build_postings(known), terms, n)) == ids(S.matching(known, P.near(terms, n)))


def test_positions_open_the_buckets_of_their_words(spark, corpus, tmp_path):
    path = str(tmp_path / "postings")
    R.write_postings(R.build_postings(corpus.dropDuplicates(["id"])), path, buckets=8)
    stored = R.read_postings(spark, path, query="a b", buckets=8)
    plan = PO.phrase_ids(stored, "a b")._jdf.queryExecution().executedPlan().toString()
    assert "bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]
    starts = PO.phrase_starts(stored, "a b").filter("id = 'n0'").collect()
    words = corpus.filter("id = 'n0'").select(P.search_words()).first()[0]
    assert (starts[0].starts if starts else []) == [i for i in range(len(words)) if words[i : i + 2] == ["a", "b"]]
    with pytest.raises(ValueError):
        PO.phrase_ids(stored, " ")
    with pytest.raises(ValueError):
        PO.near_ids(stored, [], 2)


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


@pytest.fixture(scope="module")
def vocabulary():
    draw = random.Random(6)
    tokens = {"".join(draw.choice("abé") for _ in range(draw.randrange(1, 7))) for _ in range(120)}
    stems = ["".join(draw.choice("abcdef") for _ in range(k)) for k in (7, 8, 9, 12, 30)]
    for stem in stems:
        for _ in range(25):
            word = list(stem)
            for _ in range(draw.randrange(4)):
                at = draw.randrange(len(word))
                word[at : at + draw.choice([0, 1])] = draw.choice(["", "x", "a", "ab"])
            tokens.add("".join(word))
    return sorted(tokens - {""})


@pytest.mark.parametrize("n", [0, 1, 2, 3])
def test_neighbourhoods_like_comparing_all(spark, vocabulary, n):
    tokens = spark.createDataFrame([(t,) for t in vocabulary * 2] + [(None,)], "token string")
    asked = [*vocabulary[::3], "A", "", "q", "abcdefab" * 20]
    words = spark.createDataFrame([(w,) for w in asked] + [(None,)], "word string")
    found = [tuple(r) for r in N.close_tokens(N.neighbourhoods(tokens, n), words, n).collect()]
    wanted = {(w.lower(), t) for w in asked for t in vocabulary if abs(len(w) - len(t)) <= n and edits(w.lower(), t) <= n}
    assert set(found) == wanted and len(found) == len(wanted)


def test_number_of_variants_does_not_follow_the_length(spark):
    sizes = [
        spark.createDataFrame([("".join(chr(97 + i % 26) for i in range(k)),)], "t string").select(F.size(N.variants(F.col("t"), 2))).first()[0]
        for k in (8, 9, 5000)
    ]
    assert sizes == [37, 37, 37]
    with pytest.raises(ValueError):
        N.neighbourhoods(spark.createDataFrame([("a",)], "token string"), 4)


def test_stored_neighbourhoods(spark, corpus, vocabulary, tmp_path):
    path = str(tmp_path / "neighbours")
    tokens = spark.createDataFrame([(t,) for t in vocabulary], "token string")
    N.write_neighbourhoods(N.neighbourhoods(tokens, 2), path, buckets=64)
    word = vocabulary[40]
    few = N.read_neighbourhoods(spark, path, word, 1, buckets=64)
    one = spark.createDataFrame([(word.upper(),)], "word string")
    assert few.count() < N.read_neighbourhoods(spark, path).count() / 2
    assert {r.token for r in N.close_tokens(few, one, 1).collect()} == {t for t in vocabulary if edits(word, t) <= 1}
    postings = R.build_postings(corpus.filter("id IS NOT NULL"))
    words = spark.createDataFrame([("ddd",), ("zzzz",)], "word string")
    table = N.neighbourhoods(R.dictionary(postings), 1)
    found = N.fuzzy_hits(postings, table, words, 1).collect()
    assert {r.word for r in found} == {"ddd"}
    assert sorted(r.id for r in found) == ids(R.fuzzy_ids(postings, "ddd", 1))


def test_counts_need_no_row_per_hit(spark, corpus, tmp_path, monkeypatch):
    """Cells of a few entities and queries, ids that repeat with other texts, two ways of one query."""
    monkeypatch.setattr(PC, "percolate", None)
    monkeypatch.setattr(PC, "BLOCK", 40)
    monkeypatch.setattr(PC, "CHUNK", 5)
    rows = [(k, *v) for k, v in SAVED.items()] + [("word", ["f"], None, None), ("word", ["f"], None, None), (None, ["a"], None, None)]
    again = corpus.filter("id < 'n3'").withColumn("texts", F.col("texts").withField("indexText", F.array(F.lit("f dd")))).withColumn("schema", F.lit("Email"))
    table = corpus.unionByName(again)
    counts = {r.query_id: r.n for r in PC.hits_per_saved_query(table, spark.createDataFrame(rows, PC.SAVED_QUERY)).collect()}
    expected = {name: len(scan(table, *conditions)) for name, conditions in SAVED.items()}
    expected["word"] = len(set(scan(table, *SAVED["word"])) | set(scan(table, ["f"], None, None)))
    assert counts == {**expected, None: 0}


def shuffled_rows(df):
    """Rows that the query's own exchanges wrote, after it ran."""
    df.collect()
    found, nodes = 0, [df._jdf.queryExecution().executedPlan()]
    while nodes:
        node = nodes.pop()
        kind = node.getClass().getSimpleName()
        if kind == "ShuffleExchangeExec":
            found += node.metrics().apply("shuffleRecordsWritten").value()
        if kind == "AdaptiveSparkPlanExec":
            nodes.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            nodes.append(node.plan())
        else:
            nodes += [node.children().apply(i) for i in range(node.children().size())]
    return found


def test_cells_do_not_multiply_what_is_shuffled(spark, entity, monkeypatch):
    """Neither queries nor what entities hold travel as a row per block of entities."""
    monkeypatch.setattr(PC, "BLOCK", 4)
    n = 400
    table = entity(*[{"id": f"n{i}", "schema": "Pages", "properties": {"indexText": [f"of all w{i} {' '.join(f'v{i % 7}x{k}' for k in range(9))}"]}} for i in range(n)])
    rows = [(f"q{i}", [f"w{i}", "of all", f"v{i % 7}x3"], [f"w{i + 1}"], None) for i in range(n)]
    found = PC.hits_per_saved_query(table, spark.createDataFrame(rows, PC.SAVED_QUERY))
    assert {r.n for r in found.collect()} == {1}
    assert shuffled_rows(found) < 6 * n


def test_claims_do_not_multiply_what_is_shuffled(spark, entity, monkeypatch):
    monkeypatch.setattr(PC, "BLOCK", 4)
    n = 400
    table = entity(*[{"id": f"n{i}", "schema": "Pages", "properties": {"indexText": [f"w{i} of v{i % 5}"]}} for i in range(n)])
    rows = [(f"q{i}", [f"w{i}", f"of v{i % 5 if i % 4 else 7}"], None, {"schema": "Pages"}) for i in range(n)]
    claims = PC.verify_claims(table, spark.createDataFrame(rows, PC.SAVED_QUERY))
    verdicts = claims.groupBy("verdict").agg(F.count("*"), F.sum("n"))
    assert sorted(tuple(r) for r in verdicts.collect()) == [("indexed matches", 300, 300), ("no indexed match", 100, 0)]
    assert shuffled_rows(verdicts) < 6 * n


def test_more_ways_than_are_worked_on_at_once(spark, entity):
    """An entity that satisfies a query in thousands of ways counts once."""
    n = 5000
    table = entity({"id": "n", "schema": "Pages", "properties": {"indexText": [" ".join(f"w{i}" for i in range(n))]}})
    ways = spark.range(n).select(*PC.saved_query(F.lit("q"), F.array(F.concat(F.lit("w"), F.col("id").cast("string")))))
    assert [tuple(r) for r in PC.hits_per_saved_query(table, ways).collect()] == [("q", 1)]


def test_short_numbers():
    sizes = np.array([0, 3, 0, 4, 1])
    numbers = np.array([0, 127, 128, 5, 5, 2**40, 2**62, 16384])
    packed = T._short(T._gaps(numbers, sizes), sizes)
    for low in range(3):
        gaps, many = T._numbers(packed.slice(low))
        assert many.tolist() == sizes[low:].tolist()
        assert T._summed(gaps, many).tolist() == numbers[sizes[:low].sum() :].tolist()


@pytest.mark.parametrize(("width", "piece", "room", "batch"), [(2048, 4096, 1 << 26, 1000), (16, 3, 1 << 26, 7), (256, 64, 600, 90)])
@pytest.mark.parametrize("known", [0, 9, 10_000])
def test_cells_like_testing_all(monkeypatch, width, piece, room, batch, known):
    """Ids of one row, of some and of more than a strip holds; queries with several ways; two chunks."""
    monkeypatch.setattr(T, "WIDTH", width)
    monkeypatch.setattr(T, "SLICE", piece)
    monkeypatch.setattr(T, "STRIP_BYTES", room)
    monkeypatch.setattr(T, "WORDS", 50)
    monkeypatch.setattr(T, "PACK", 11)
    draw = random.Random(known + width)
    hashes = [draw.getrandbits(64) - 2**63 for _ in range(40)]
    keys = [draw.choice([draw.randrange(-400, 400), 3, -9]) for _ in range(500)]
    texts = [[draw.choice(hashes[:12]) for _ in range(draw.randrange(12))] for _ in keys]
    facts = [[draw.choice(hashes[30:34])] for _ in keys]

    def condition():
        return draw.choice([lambda: [draw.choice(hashes[:14]) for _ in range(draw.choice([1, 1, 2, 3]))], lambda: [draw.choice(hashes[30:35])]])()

    asks = sorted(draw.choice([draw.randrange(60), 4]) for _ in range(120))
    ways = [(a % 2, a, [condition() for _ in range(draw.randrange(1, 4))], [condition() for _ in range(draw.randrange(3))]) for a in asks]
    nested = pa.list_(pa.list_(pa.int64()))
    arrays = [pa.array([w[0] for w in ways], pa.int32()), pa.array([w[1] for w in ways]), *[pa.array([w[i] for w in ways], nested) for i in (2, 3)]]
    hashed = [*T.hashed([pa.RecordBatch.from_arrays(arrays, names=["chunk", "ask", "must", "never"])])]
    every = np.unique(np.concatenate([b.column(name).flatten().to_numpy() for b in hashed for name in ("must", "never")]).view(np.uint64))
    list_of = T.Known(np.array(draw.sample(every.tolist(), min(known, len(every))), np.uint64), known >= len(every))
    bits = {chunk: np.zeros(64, np.uint8) for chunk in (0, 1)}
    for b in hashed:
        for chunk, must, never in zip(b["chunk"].to_pylist(), b["must"].to_pylist(), b["never"].to_pylist(), strict=True):
            for h in must + never:
                bits[chunk][h % 512 // 8] |= 1 << h % 8
    longs = pa.list_(pa.int64())
    entities = pa.RecordBatch.from_arrays([pa.array(keys), pa.array(texts, longs), pa.array(facts, longs)], names=["key", "words", "facts"])
    held = pa.Table.from_batches(T.holdings([3, 1, 2], list_of, bits)([entities])).sort_by("key")
    packed = pa.Table.from_batches(T.packs(list_of)(hashed))

    counts = {}
    for chunk in (0, 1):
        queries, rows = (t.filter(pa.compute.equal(t["chunk"], chunk)) for t in (packed, held))
        assert queries.num_rows > 1
        both = pa.concat_tables([queries, rows], promote_options="default").combine_chunks()
        for found in T.cell(list_of)(both.to_batches(max_chunksize=batch)):
            counts |= dict(zip(found["ask"].to_pylist(), found["n"].to_pylist(), strict=True))

    def holds(i, words):
        return words in [texts[i][k : k + len(words)] for k in range(len(texts[i]))] or (len(words) == 1 and words[0] in facts[i])

    for ask in set(asks):
        hits = {
            keys[i]
            for i in range(len(keys))
            if any(all(holds(i, c) for c in must) and not any(holds(i, c) for c in never) for _, a, must, never in ways if a == ask)
        }
        assert counts.get(ask, 0) == len(hits), ask
