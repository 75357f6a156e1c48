"""Exact dedup against a minimal perfect hash of the distinct digests seen so far.

An index is a table of slots. Digests are dealt into shards of bounded size, a shard's digests into
buckets, and each bucket gets a pair of displacements so that all digests of the shard fall into
different slots, as many slots as digests. A slot holds the full digest and the locator of the document that
stays. A lookup finds its bucket's displacements, computes the slot and compares the whole digest: a perfect hash
sends any digest somewhere, so only the comparison tells members from others. Nonmembers are grouped
among themselves and give the next index.

Lookups are two equi-joins on shard and bucket, then shard and slot, so a digest that very many documents share
is split by adaptive execution like any hot join key.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import settle

SHARD_DIGESTS = 1 << 15
BUCKETS = 1 << 13
SEEDS = 3
ROUNDS = 400
SLOT = (
    "shard long, bucket long, slot long, shift long, spread long, slots long, seed int, leads boolean, "
    "digest string, keep_id long, group_size long"
)


def digest(text: Column) -> Column:
    """SHA-256 in lowercase hex of a text without its ASCII white space; null is empty."""
    squeezed = F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", "")
    return F.sha2(squeezed, 256)


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, text_sha256, n_chars) of each row; other columns are not read."""
    chars = F.length(F.coalesce("text", F.lit(""))).cast("long")
    return docs.select("doc_id", digest(F.col("text")).alias("text_sha256"), chars.alias("n_chars"))


def grouped(keys: DataFrame) -> DataFrame:
    """(digest, keep_id, group_size): the longest text stays, then the smallest doc_id, a null one last."""
    order = F.struct(-F.col("n_chars"), F.col("doc_id").isNull(), F.col("doc_id").alias("doc_id"))
    return (
        keys.groupBy(F.col("text_sha256").alias("digest"))
        .agg(F.min(order).alias("best"), F.count("*").alias("group_size"))
        .select("digest", F.col("best.doc_id").alias("keep_id"), "group_size")
    )


def _number(digest: Column, start: Column | int) -> Column:
    """The seven hex digits of a digest from a place on, as a number."""
    return F.conv(F.substr(digest, F.lit(start) if isinstance(start, int) else start, F.lit(7)), 16, 10).cast("long")


def build(groups: DataFrame) -> DataFrame:
    """The slots of all distinct digests, written to the shared folder.

    Shards hold about ``SHARD_DIGESTS`` digests, however many there are. Empty input gives an empty index.
    """
    groups = settle(groups, "dedup-groups")
    shards = max(1, -(-groups.count() // SHARD_DIGESTS))
    dealt = groups.withColumn("shard", _number(F.col("digest"), 1) % shards)
    slots = dealt.groupBy("shard").applyInPandas(_perfect, SLOT)
    return settle(slots.withColumn("shards", F.lit(shards)), "dedup-slots")


def _perfect(frame: pd.DataFrame) -> pd.DataFrame:
    """One shard's slots. The largest buckets are placed first, single digests go to what is left."""
    shard = int(frame["shard"].iloc[0])
    frame = frame.sort_values("digest", ignore_index=True)
    texts = frame["digest"].tolist()
    m = len(texts)
    bucket = np.array([int(t[7:14], 16) % BUCKETS for t in texts], np.int64)
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[order])) + 1
    members = sorted(np.split(order, cuts), key=len, reverse=True)
    for seed in range(SEEDS):
        at = 14 + 14 * seed
        a = np.array([int(t[at : at + 7], 16) for t in texts], np.int64)
        b = np.array([int(t[at + 7 : at + 14], 16) for t in texts], np.int64)
        placed = _place(a, b, m, members, np.random.default_rng([shard, seed]))
        if placed is not None:
            break
    else:
        raise ValueError(f"no perfect hash for shard {shard} of {m} digests")
    slot, shift, spread, leads = placed
    return pd.DataFrame(
        {
            "shard": shard,
            "bucket": bucket,
            "slot": slot,
            "shift": shift,
            "spread": spread,
            "slots": m,
            "seed": seed,
            "leads": leads,
            "digest": texts,
            "keep_id": frame["keep_id"].astype("Int64"),
            "group_size": frame["group_size"],
        }
    )


def _place(a, b, m, members, rng):
    """(slot, shift, spread, leads) by digest, or None if a bucket finds no free slots."""
    free = np.ones(m, bool)
    slot, shift, spread = (np.zeros(m, np.int64) for _ in range(3))
    leads = np.zeros(m, bool)
    for n, keys in enumerate(members):
        leads[keys[0]] = True
        if len(keys) == 1:
            break
        x, y = a[keys] % m, b[keys] % m
        if len(set(zip(x.tolist(), y.tolist()))) < len(keys):
            return None
        tries = 32
        for _ in range(ROUNDS):
            moves, turns = rng.integers(0, m, tries), rng.integers(0, 1 << 20, tries)
            spots = (a[keys] + moves[:, None] + turns[:, None] * b[keys]) % m
            fits = free[spots].all(axis=1)
            if len(keys) > 1 and fits.any():
                apart = np.diff(np.sort(spots[fits], axis=1), axis=1).all(axis=1)
                good = np.flatnonzero(fits)[apart]
                if len(good):
                    k = good[0]
                    slot[keys], shift[keys], spread[keys] = spots[k], moves[k], turns[k]
                    free[spots[k]] = False
                    break
            tries = min(4 * tries, 4096)
        else:
            return None
    singles = np.array([keys[0] for keys in members if len(keys) == 1], np.int64)
    leads[singles] = True
    left = np.flatnonzero(free)
    slot[singles] = left
    shift[singles] = (left - a[singles]) % m
    return slot, shift, spread, leads


def look_up(keys: DataFrame, index: DataFrame) -> DataFrame:
    """``keys`` with keep_id and group_size of the slot that holds their digest, null for nonmembers."""
    key = F.col("text_sha256")
    shards = index.select(F.max("shards")).first()[0] or 1  # one number
    pilots = index.where("leads").select("shard", "bucket", "shift", "spread", "slots", "seed")
    slots = index.select(
        "shard", "slot", F.col("digest"), F.col("keep_id").alias("held_id"), F.col("group_size").alias("held_size")
    )
    a, b = (_number(key, F.col("seed") * 14 + start) for start in (15, 22))
    spot = (a + F.col("shift") + F.col("spread") * b) % F.col("slots")
    found = (
        keys.withColumns({"shard": _number(key, 1) % shards, "bucket": _number(key, 8) % BUCKETS})
        .join(pilots, ["shard", "bucket"], "left")
        .withColumn("slot", spot)
        .join(slots, ["shard", "slot"], "left")
    )
    member = F.col("digest") == key
    return found.select(
        *keys.columns,
        F.coalesce(member, F.lit(False)).alias("member"),
        F.when(member, F.col("held_id")).alias("keep_id"),
        F.when(member, F.col("held_size")).alias("group_size"),
    )


def dedup(docs: DataFrame) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256), one row for each row of ``docs``.

    Rows that share a doc_id and a text are one document: they are kept or dropped alike. A null doc_id stays
    only where its group has no other; null texts are empty texts.
    """
    keys = settle(keyed(docs), "dedup-keys")
    index = build(grouped(keys))
    found = look_up(keys, index)
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    return found.select("doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256")


def dedup_against(docs: DataFrame, history: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(decisions on ``docs``, index of their new digests) given the index of earlier documents.

    A member repeats an earlier document and goes. Nonmembers are grouped separately: one of each
    group stays.
    """
    looked = settle(look_up(settle(keyed(docs), "dedup-keys"), history), "dedup-looked")
    repeats = looked.where("member").withColumn("kept", F.lit(False))
    fresh = looked.where("NOT member").select("doc_id", "text_sha256", "n_chars")
    index = build(grouped(fresh))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    new = look_up(fresh, index).withColumns({"kept": kept, "member": F.lit(False)})
    columns = ["doc_id", "keep_id", "group_size", "kept", "member", "text_sha256"]
    return repeats.select(columns).unionByName(new.select(columns)), index


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; repeated rows of a document become one."""
    chosen = dedup(docs).where("kept").select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_digest"))
    own = docs.withColumn("_own", digest(F.col("text")))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_own") == F.col("_digest"))
    return own.join(chosen, same, "left_semi").dropDuplicates(["doc_id", "_own"]).drop("_own")
