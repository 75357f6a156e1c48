"""Token counts through a cache of content digests.

The cache is a table of (digest, tokenizer, n_tokens): the SHA-256 of the normalised content, the
SHA-256 of the tokenizer file, and the count. Only contents whose digest the cache lacks are encoded, once
each, and their counts are appended.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import slices
from .tokens import encoder

CACHE = "digest binary, tokenizer string, n_tokens long"


def tokenizer_digest(path: str) -> str:
    with open(path, "rb") as file:
        return hashlib.sha256(file.read()).hexdigest()


def content(text: Column) -> Column:
    """The content that is counted. Byte-level tokenizers see every character, so nothing but null changes."""
    return F.coalesce(text, F.lit(""))


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def read_cache(spark: SparkSession, path: str, tokenizer: str) -> DataFrame:
    """Counts of one tokenizer. One writer appends at a time, so that a digest is stored once."""
    try:
        stored = spark.read.schema(CACHE).parquet(path)
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        stored = spark.createDataFrame([], CACHE)
    return stored.where(F.col("tokenizer") == tokenizer).select("digest", "n_tokens")


def misses(docs: DataFrame, cached: DataFrame) -> DataFrame:
    """(digest, text), one row for each distinct content that is not in the cache.

    Copies are merged before anything is shuffled, so a content of very many documents is one row a task.
    """
    keyed = docs.select(content(F.col("text")).alias("text")).select(digest(F.col("text")).alias("digest"), "text")
    return keyed.dropDuplicates(["digest"]).join(cached, "digest", "left_anti")


def count(missing: DataFrame, path: str) -> DataFrame:
    """(digest, n_tokens) of (digest, text) rows."""

    def encode(batches):
        ids_of = encoder(path, "space").ids
        for batch in batches:
            digests, texts = batch.column(0), batch.column(1)
            for lo, hi in slices(texts):
                _, before = ids_of(texts.slice(lo, hi - lo))
                yield pa.RecordBatch.from_arrays(
                    [digests.slice(lo, hi - lo), pa.array(np.diff(before), pa.int64())], ["digest", "n_tokens"]
                )

    return missing.mapInArrow(encode, "digest binary, n_tokens long")


def extend_cache(docs: DataFrame, path: str, tokenizer_file: str) -> None:
    """Append the counts of all contents of ``docs`` that the cache at ``path`` lacks."""
    version = tokenizer_digest(tokenizer_file)
    missing = misses(docs, read_cache(docs.sparkSession, path, version))
    counted = count(missing, tokenizer_file).select("digest", F.lit(version).alias("tokenizer"), "n_tokens")
    counted.write.mode("append").parquet(path)


def token_counts(docs: DataFrame, path: str, tokenizer_file: str, limit: int) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit), one row for each row of ``docs``.

    Nulls count as empty texts; repeated rows and null doc_ids each give a row. Other columns are not read. The join is on
    digests; a digest that very many documents share is split by adaptive execution.
    """
    extend_cache(docs, path, tokenizer_file)
    cached = read_cache(docs.sparkSession, path, tokenizer_digest(tokenizer_file))
    text = content(F.col("text"))
    keyed = docs.select("doc_id", digest(text).alias("digest"), F.octet_length(text).cast("long").alias("n_bytes"))
    return keyed.join(cached, "digest", "left").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
