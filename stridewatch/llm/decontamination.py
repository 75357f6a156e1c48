"""Benchmark decontamination: test n-grams in a broadcast hash set, looked up from every document.

Only DataFrame functions run here. A window of ``size`` words is found by its grams of half as many words: the set has every gram
of every test window with its offset in it, and of a document every so-many-th gram is looked up, so that
each window of the document has exactly one of them. What is found is compared word by word with the test window, and the
words of equal windows are hit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import settle
from .url_filter import LOWER, UPPER

#: What parts words, in lowered texts and in texts as they are.
PARTING = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PARTING_ANY_CASE = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Grams that one broadcast holds; more are dealt to several, each with its own scan.
GRAMS_AT_ONCE = 400_000


def words(text: Column) -> Column:
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(lowered, PARTING), "")


def gram_and_stride(size: int) -> tuple[int, int]:
    """Words of a gram, and words between looked-up grams: a window has one of them whole."""
    gram = (size + 1) // 2
    return gram, size - gram + 1


def looked_up(size: int) -> Column:
    """Hashes of the grams of the column ``words`` at every stride."""
    gram, stride = gram_and_stride(size)
    starts = F.sequence(F.lit(0), F.size("words") - F.lit(gram), F.lit(stride))
    return F.when(
        F.size("words") >= size,
        F.transform(starts, lambda i: F.xxhash64(*[F.get(F.col("words"), i + F.lit(k)) for k in range(gram)])),
    ).otherwise(F.array().cast("array<bigint>"))


def test_windows(benchmark: DataFrame, size: int) -> DataFrame:
    """(size, window, items): distinct windows of the items and which items have them, as text.

    An item of fewer words than ``size`` is one window, an item of none has none. An item
    without item_id goes by the empty name.
    """
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), words(F.col("text")).alias("words")
    ).where(F.size("words") > 0)
    shorter = F.least(F.size("words"), F.lit(size))
    starts = F.sequence(F.lit(1), F.size("words") - shorter + F.lit(1))
    found = items.select(
        "item", shorter.alias("size"), F.explode(F.transform(starts, lambda i: F.slice("words", i, shorter))).alias("window")
    )
    return found.groupBy("size", "window").agg(F.collect_set("item").alias("items"))


def grams(windows: DataFrame, size: int) -> DataFrame:
    """(hash, offset, window, items): all grams of the windows of ``size`` words."""
    gram, stride = gram_and_stride(size)
    spread = windows.where(F.col("size") == size).select(
        "window", "items", F.explode(F.array(*map(F.lit, range(stride)))).alias("offset")
    )
    hashed = F.xxhash64(*[F.get("window", F.col("offset") + F.lit(k)) for k in range(gram)])
    return spread.select(hashed.alias("hash"), "offset", "window", "items")


def hits(docs: DataFrame, windows: DataFrame, size: int, at_once: int = GRAMS_AT_ONCE) -> DataFrame:
    """(doc_id, text_hash, start, size, items): places of ``docs`` where a test window stands."""
    windows = settle(windows, "test-windows")
    counts = {row["size"]: row["count"] for row in windows.groupBy("size").count().collect()}  # at most ``size`` rows
    split = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), words(F.col("text")).alias("words"))
    found = []
    for length, count in sorted(counts.items()) or [(size, 0)]:
        stride = gram_and_stride(length)[1]
        places = split.select("doc_id", "text_hash", "words", F.posexplode(looked_up(length)).alias("k", "hash"))
        parts = max(1, -(-count * stride // at_once))
        tests = grams(windows, length)
        for part in range(parts):
            held = tests if parts == 1 else tests.where(F.pmod(F.col("hash"), F.lit(parts)) == part)
            met = places.join(F.broadcast(held), "hash").withColumn("start", F.col("k") * stride - F.col("offset"))
            there = F.when(F.col("start") >= 0, F.slice("words", F.col("start") + 1, F.lit(length)))
            met = met.where(there == F.col("window"))
            found.append(met.select("doc_id", "text_hash", "start", F.lit(length).alias("size"), "items"))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = 10) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated), one row for each row of ``docs``.

    Rows that share a doc_id are told apart by their texts. Null texts have no words. Other columns are not
    read.
    """
    met = hits(docs, test_windows(benchmark, size), size)
    covered = F.flatten(F.transform(F.col("places"), lambda p: F.sequence(p["start"], p["start"] + p["size"] - 1)))
    per_document = met.groupBy("doc_id", "text_hash").agg(
        F.collect_set(F.struct("start", "size")).alias("places"), F.collect_set("items").alias("items")
    )
    per_document = per_document.select(
        F.col("doc_id").alias("_id"),
        F.col("text_hash").alias("_hash"),
        F.size(F.array_distinct(covered)).cast("long").alias("n_hit"),
        F.array_sort(F.array_distinct(F.flatten("items"))).alias("items"),
    )
    counted = docs.select(
        "doc_id",
        F.xxhash64("text").alias("text_hash"),
        F.size(F.array_remove(F.split(F.coalesce("text", F.lit("")), PARTING_ANY_CASE), "")).cast("long").alias("n_words"),
    )
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))
    joined = counted.join(per_document, same, "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return joined.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.when(F.col("items").isNull(), 0).otherwise(F.size("items")).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.concat_ws(",", "items"), F.lit("")), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def keep_clean(docs: DataFrame, benchmark: DataFrame, size: int = 10) -> DataFrame:
    """The rows of ``docs`` in which no test window stands, with all their columns."""
    met = hits(docs, test_windows(benchmark, size), size)
    gone = met.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_hash"))
    return docs.join(gone, same, "left_anti")
