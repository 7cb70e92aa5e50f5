"""The registered queries: those with SQL against it, all for their columns."""

import pytest

import corpus_pipeline
from entitylake.llm.queries import CHECKS, QUERIES
from tests.compare import connect, difference

COLUMNS = {
    "op1": ["page_id", "url", "text", "n_chars"],
    "op2": ["doc_id", "n_shingles", "component_id", "kept"],
    "op3": ["doc_id", "held_out", "lang_pred", "score"],
    "op4": ["doc_id", "held_out", "score", "predicted"],
    "op5": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
    "op6": ["doc_id", "start", "n_tokens", "ids_crc32"],
    "op7": ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
    "op8": ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    "op9": ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
    "op10": ["doc_id", "size", "source_size", "target", "taken"],
    "op11": ["doc_id", "n_lines", "n_dropped", "kept_sha256"],
    "op12": ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"],
    "op13": ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"],
}


def test_one_query_for_each_operator():
    assert sorted(COLUMNS) == sorted(name.split("_")[0] for name in QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, sf, name):
    df = QUERIES[name](spark, sf)
    assert df.columns[: len(COLUMNS[name.split("_")[0]])] == COLUMNS[name.split("_")[0]]
    if name in CHECKS:
        assert difference(df, connect(sf), CHECKS[name]) is None
    else:
        assert df.count() > 0


def test_pipeline_stages_keep_the_columns(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.written(stage(spark, docs, sf))
        assert docs.columns == columns, name
        counts.append(docs.count())
    assert counts[0] > counts[1] >= counts[2] > counts[3] > 0
    pieces = corpus_pipeline.packing(spark, docs, sf)
    assert pieces.where("start = 0").count() == docs.count()


def test_pipeline_of_an_empty_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.written(stage(spark, docs, sf))
    assert docs.count() == 0
