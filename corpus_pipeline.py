"""From raw documents to packed training windows, stage by stage.

Each stage reads what its predecessor wrote and works on all of it. All but the last return the columns of
``documents``: rejected rows go, kept ones stay as they are.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from stridewatch.llm import decontamination, exact_dedup, near_dedup, packing, quality
from stridewatch.llm.common import settle, table
from stridewatch.llm.queries import END_ID, fold


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from the labels outside the held-out fold."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"), held_out=fold(4, 2), threshold=0.7)


def distinct_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.keep_one(docs)


def distinct_contents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return near_dedup.keep_one(docs, size=5, threshold=0.8)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    return decontamination.keep_clean(docs, table(spark, sf_dir, "benchmark"), size=10)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in windows of 2048 tokens."""
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack(docs, tokenizer, "drop", END_ID, window=2048)


STAGES = [
    ("quality", good_quality),
    ("exact_dedup", distinct_texts),
    ("near_dedup", distinct_contents),
    ("decontamination", uncontaminated),
    ("packing", packed),
]

#: SQL cannot state a learned classifier or a tokenizer; the tests hold ``run`` against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the table ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


QUERIES = {"pipeline": run}
ORACLE = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
