"""The rows of the pipeline against each stage done by plain loops or by DuckDB."""

import string
import struct
import zlib
from collections import Counter

import duckdb
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from entitylake.llm import bradley_terry, rule_table, weighted_mix
from tests.llm.test_line_bitmaps import SPACES

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def shingles(text, size=5):
    words = "".join(" " if c in SPACES else c for c in (text or "").translate(LOWER)).split(" ")
    words = [word for word in words if word]
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def first_of_each_group(texts):
    """The smallest id of each component of documents with a similarity of 0.8 or more."""
    sets = {doc: shingles(text) for doc, text in texts.items()}
    leader = {doc: doc for doc in texts}

    def top(doc):
        while leader[doc] != doc:
            doc = leader[doc]
        return doc

    ids = sorted(texts)
    for i, one in enumerate(ids):
        for other in ids[i + 1 :]:
            common = len(sets[one] & sets[other])
            if common and 100 * common >= 80 * len(sets[one] | sets[other]):
                low, high = sorted((top(one), top(other)))
                leader[high] = low
    return {top(doc) for doc in ids}


@pytest.fixture(scope="module")
def folder(spark, sf, tmp_path_factory):
    """The smallest tables with planted documents: rejects, copies, a long text, nulls and an extra column."""
    path = tmp_path_factory.mktemp("tables")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [r.asDict() for r in docs.collect()]
    whole = max(rows, key=lambda r: len(r["text"] or ""))["text"]
    fair = [r for r in rows if r["text"] and len(r["text"]) > 400][:6]
    planted = [None, "", "too short", "# * $ % " * 40, "the same of the " * 60, "the and of " + whole]
    planted += [r["text"] for r in fair] + [r["text"] + f" changed end {i}" for i, r in enumerate(fair)] + [whole + " " + whole.upper()]
    for number, text in enumerate(planted):
        rows.append({**rows[0], "doc_id": 900_000 + number, "text": text, "n_chars": None if text is None else len(text), "source": [None, "src0", "planted"][number % 3]})
    for row in rows:
        row["keep"] = "kept as it is"
    spark.createDataFrame(rows, docs.schema.add("keep", "string")).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.read.parquet(f"{sf}/labels.parquet").write.parquet(f"{path}/labels.parquet")
    return str(path)


def test_rows_of_the_pipeline(spark, folder):
    table = spark.read.parquet(f"{folder}/documents.parquet")
    texts = {r.doc_id: r.text for r in table.collect()}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet'")
    kept = {doc for doc, good in con.execute(f"SELECT doc_id, kept FROM ({rule_table.SQL})").fetchall() if good}
    assert kept.isdisjoint(range(900_000, 900_005)) and len(kept) > 50

    # A document's rank depends on its text alone, so the judgement of all documents holds for those left.
    model = bradley_terry.train(table, spark.read.parquet(f"{folder}/labels.parquet"))
    kept &= {r.doc_id for r in bradley_terry.accepted(table, model).collect()}

    kept = first_of_each_group({doc: texts[doc] for doc in kept})
    assert not kept & set(range(900_006, 900_012))

    con.execute(f"CREATE VIEW all_documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet'")
    con.execute(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM all_documents WHERE doc_id IN ({','.join(map(str, kept))})")
    mixed = con.execute(f"SELECT doc_id, size, taken FROM ({weighted_mix.SQL})").fetchall()
    copies = {doc: taken // size for doc, size, taken in mixed if taken}

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {doc: [*tokenizer.encode(texts[doc] or "", add_special_tokens=False).ids, 0] for doc in copies}
    pieces = corpus_pipeline.run(spark, folder).collect()
    assert Counter(p.doc_id for p in pieces if p.start == 0) == Counter(copies)
    held = Counter()
    for p in pieces:
        part = ids[p.doc_id][p.start : p.start + p.length]
        assert p.doc_tokens == len(ids[p.doc_id]) and p.length == len(part) > 0
        assert p.ids_crc32 == zlib.crc32(struct.pack(f"<{len(part)}I", *part))
        held.update((p.doc_id, k) for k in range(p.start, p.start + p.length))
    assert held == Counter({(doc, k): n for doc, n in copies.items() for k in range(len(ids[doc]))})
    places = {}
    for p in pieces:
        places.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for found in places.values():
        found.sort()
        assert found[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(found, found[1:])) and sum(n for _, n in found) <= 1024


def test_stages_keep_columns_and_nulls(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns[-1] == "keep"
    assert {r.keep for r in docs.select("keep").distinct().collect()} == {"kept as it is"}
