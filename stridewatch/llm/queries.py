"""Registered queries of the corpus operators, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import shared_folder
from . import alignment, conversations, decontamination, exact_dedup, fingerprints, near_dedup, packing, quality
from . import simple8b, substring_dedup, token_counts, toxicity, url_filter
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

END_ID = 1


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLE[fn.__name__] = sql
        return fn

    return register


@query()
def op1_simple8b_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the ids of all documents as Simple-8b files and describe each from what is read back."""
    path = shared_folder(spark, "simple8b")
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    simple8b.write_tokens(table(spark, sf_dir, "documents"), path, tokenizer, "drop", END_ID)
    return simple8b.document_digests(simple8b.read_segments(spark, path))


@query(
    """WITH k AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', '', 'g')) AS text_sha256
  FROM documents),
w AS (
  SELECT text_sha256, count(*) AS group_size,
         first(doc_id ORDER BY n DESC, doc_id NULLS LAST) AS keep_id
  FROM k GROUP BY text_sha256)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256
FROM k JOIN w USING (text_sha256)"""
)
def op2_perfect_hash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup(table(spark, sf_dir, "documents"))


RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]


@query()
def op3_url_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = url_filter.train(url_filter.labelled_urls(spark))
    return url_filter.judge(table(spark, sf_dir, "pages"), RULES, model)


@query(
    r"""WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
places AS (
  SELECT doc_id, start, sha256(array_to_string(w[start : start + 19], ' ')) AS win
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS start FROM d)),
later AS (
  SELECT doc_id, start FROM (
    SELECT doc_id, start, row_number() OVER (PARTITION BY win ORDER BY doc_id, start) AS nth FROM places)
  WHERE nth > 1),
gone AS (
  SELECT doc_id, list(DISTINCT spot) AS spots
  FROM (SELECT doc_id, unnest(range(start, start + 20)) AS spot FROM later) GROUP BY doc_id),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS spot FROM d),
removed AS (SELECT DISTINCT doc_id, spot FROM (SELECT doc_id, unnest(spots) AS spot FROM gone)),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY spot) AS text
  FROM words ANTI JOIN removed USING (doc_id, spot) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(len(spots), 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN gone USING (doc_id) LEFT JOIN kept USING (doc_id)"""
)
def op4_phrase_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digests(substring_dedup.dedup_passages(table(spark, sf_dir, "documents"), size=20))


def fold(parts: int, number: int) -> Column:
    """Documents whose crc32 of doc_id, as text, leaves ``number`` of ``parts``."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts == number


@query()
def op5_lexicon_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return toxicity.classify(documents, labels, held_out=fold(5, 0), threshold=0.5)


@query()
def op6_nnls_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer, "drop", END_ID, window=2048)


@query()
def op7_digest_cache_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts through a cache that is empty at first."""
    cache = shared_folder(spark, "token-cache")
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return token_counts.token_counts(table(spark, sf_dir, "documents"), cache, tokenizer, limit=1024)


@query()
def op8_weighted_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.classes(table(spark, sf_dir, "documents"), size=5, threshold=0.8)


@query()
def op9_subword_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality.classify(documents, labels, held_out=fold(4, 2), threshold=0.7)


@query(
    """WITH d AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
items AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS size,
         unnest([array_to_string(w[i : i + least(len(w), 10) - 1], ' ')
                 FOR i IN range(1, len(w) - least(len(w), 10) + 2)]) AS win
  FROM b WHERE len(w) > 0),
sizes AS (SELECT DISTINCT size FROM items),
places AS (
  SELECT doc_id, size, unnest(range(1, len(w) - size + 2)) AS start, w FROM d, sizes WHERE len(w) >= size),
met AS (
  SELECT doc_id, p.size, start, item_id FROM places p JOIN items i
  ON p.size = i.size AND array_to_string(w[start : start + p.size - 1], ' ') = i.win),
covered AS (
  SELECT doc_id, count(DISTINCT spot) AS n_hit FROM (
    SELECT doc_id, unnest(range(start, start + size)) AS spot FROM (SELECT DISTINCT doc_id, size, start FROM met))
  GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM met) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)"""
)
def op10_window_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontamination.contamination(documents, benchmark, size=10)


@query()
def op11_piecewise_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_with_next(table(spark, sf_dir, "documents"))


@query()
def op12_token_span_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    bytes_file, pieces_file = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment.align(table(spark, sf_dir, "documents"), bytes_file, pieces_file)


@query()
def op13_path_ranked_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair(table(spark, sf_dir, "conversations"))
