"""Corpus pipeline: quality rules, near duplicates, repeated passages, source mixing, packing.

Every stage takes the documents that the one before it wrote and returns documents with the same
columns; the last returns the packed pieces. ``STAGES`` can be run one by one, each result written
and read again; :func:`run` does so in the folder that ``spark.checkpoint.dir`` names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from brandpulse.llm import op04_substring, op07_quality, op08_pack, op09_mix, op10_jaccard
from brandpulse.llm.common import documents, workers_import, written
from brandpulse.llm.tokens import tokenizer_path

#: Tokenisation and packing are not expressible in SQL.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep; lines that fail are cut out of their texts."""
    return op07_quality.kept_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest doc_id, of each group linked by n-gram similarity."""
    return op10_jaccard.kept_documents(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words that windows found elsewhere cover."""
    return op04_substring.kept_documents(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return op09_mix.mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each token piece of the documents goes."""
    return op08_pack.packed(docs, tokenizer_path())


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("mixing", mixing),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    workers_import(spark)
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
