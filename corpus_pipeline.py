"""The corpus pipeline: documents through five stages, each written and read by the next.

    quality rules      documents that the rules reject go
    quality classifier documents that the ranking rejects go
    near duplicates    one document of each group stays
    mixing             each document as often as the mix takes it
    packing            the pieces of sequences of 1024 ids

Each stage is a function of (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of documents. A stage's model is trained on the labelled documents of
``sf_dir``; its decisions are about the documents it is given. Empty tables pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from entitylake.llm import bin_slack, bradley_terry, chosen_path, rule_table, weighted_mix
from entitylake.llm.shared import written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the threshold table keeps."""
    return rule_table.accepted(docs)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that rank above the threshold learned from the labels."""
    corpus = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = bradley_terry.train(corpus, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return bradley_terry.accepted(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group with a similarity of 0.8 or more over shingles of five words."""
    return chosen_path.deduplicated(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated and selected so that the sources come near their targets."""
    return weighted_mix.mixed(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their sequences and offsets."""
    return bin_slack.packing(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("quality classifier", quality_classifier),
    ("near duplicates", near_duplicates),
    ("mixing", mixing),
    ("packing", packing),
]

#: Near duplicates, the classifier and the tokenizer are beyond SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
