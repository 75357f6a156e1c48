"""Packing of token documents into windows by non-negative least squares.

Full windows of long documents stand alone. What remains of each document is shorter than a window: the
histogram of these lengths is matched by combinations of two or three lengths that fill a window
exactly. Least squares over repeat counts of at least zero say how often to use each combination; the
counts are rounded, limited to what there is, and the residual pieces are packed greedily, one after the other,
cut where a window ends.

Everything a piece needs to find its place is in closed form: its rank among the pieces of its length,
and tables as small as the number of combinations.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import settle, slices
from .tokens import encoder

ITERATIONS = 150
ENCODED = "shard int, doc_id long, n_tokens long, rest int, rank long, full_before long, ids binary"


def encode_documents(docs: DataFrame, tokenizer: str, cut: str, end_id: int, window: int) -> DataFrame:
    """Ids of each document, the length of its rest, and its place among the equal rests of its shard.

    A shard is the work of one task; the result is meant to be written before it is used.
    """

    def encode(batches):
        shard = TaskContext.get().partitionId()
        ids_of = encoder(tokenizer, cut).ids
        seen, full = np.zeros(window, np.int64), 0
        for batch in batches:
            doc_ids, texts = batch.column(0), batch.column(1)
            for lo, hi in slices(texts):
                ids, before = ids_of(texts.slice(lo, hi - lo))
                ids = np.insert(ids, before[1:], end_id).astype("<u4")
                before = before + np.arange(len(before))
                n = np.diff(before)
                rest, fulls = n % window, n // window
                order = np.argsort(rest, kind="stable")
                groups = np.bincount(rest, minlength=window)
                rank = np.empty(len(n), np.int64)
                rank[order] = np.arange(len(n)) - np.repeat(np.cumsum(groups) - groups, groups) + np.repeat(seen, groups)
                seen += groups
                full_before = full + np.cumsum(fulls) - fulls
                full += int(fulls.sum())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(n), shard), pa.int32()),
                        doc_ids.slice(lo, hi - lo),
                        pa.array(n, pa.int64()),
                        pa.array(rest, pa.int32()),
                        pa.array(rank, pa.int64()),
                        pa.array(full_before, pa.int64()),
                        pa.array(_slices_of(ids, before), pa.binary()),
                    ],
                    [field.split()[0] for field in ENCODED.split(", ")],
                )

    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return texts.mapInArrow(encode, ENCODED)


def _slices_of(ids: np.ndarray, before: np.ndarray) -> list[bytes]:
    raw, width = ids.tobytes(), ids.itemsize
    spans = (before * width).tolist()
    return [raw[a:b] for a, b in zip(spans, spans[1:])]


def combinations(lengths: np.ndarray, window: int) -> np.ndarray:
    """All pairs and triples of these lengths that add up to a window, one a row, shorter first.

    A pair has 0 as its first entry.
    """
    there = np.zeros(window + 1, bool)
    there[lengths] = True
    a = lengths[:, None]
    b = lengths[None, :]
    c = window - a - b
    triple = (a <= b) & (b <= c) & there[np.maximum(c, 0)]
    i, j = np.nonzero(triple)
    triples = np.stack([lengths[i], lengths[j], window - lengths[i] - lengths[j]], axis=1)
    low = lengths[(2 * lengths <= window) & there[window - lengths]]
    pairs = np.stack([np.zeros_like(low), low, window - low], axis=1)
    return np.concatenate([pairs, triples]).astype(np.int64)


def repeat_counts(parts: np.ndarray, histogram: np.ndarray, iterations: int = ITERATIONS) -> np.ndarray:
    """Counts x >= 0 that bring the lengths used by x near to the histogram, in the least-squares sense.

    Accelerated projected gradient descent; the matrix is the incidence of lengths in combinations.
    """
    if not len(parts):
        return np.zeros(0)
    target = histogram.astype(float).copy()
    target[0] = 0

    def used(x):
        out = sum(np.bincount(parts[:, k], x, len(target)) for k in range(3))
        out[0] = 0
        return out

    # the largest eigenvalue of the normal matrix, by power iteration
    x = np.ones(len(parts))
    for _ in range(12):
        y = used(x)
        x = y[parts].sum(axis=1)
        size = np.linalg.norm(x)
        x /= size
    step = 1 / (1.05 * size)
    x = z = np.zeros(len(parts))
    momentum = 1.0
    for _ in range(iterations):
        miss = used(z) - target
        new = np.maximum(z - step * miss[parts].sum(axis=1), 0)
        following = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        z = new + (momentum - 1) / following * (new - x)
        x, momentum = new, following
    return x


@dataclass
class Plan:
    """Where the pieces of each length go. ``slot_*`` are sorted by (length, first rank)."""

    window: int
    placed: np.ndarray  # by length: pieces that combinations take
    residual_start: np.ndarray  # by length: place of its first residual piece
    combined: int  # windows made of combinations
    slot_key: np.ndarray
    slot_copies: np.ndarray
    slot_window: np.ndarray
    slot_offset: np.ndarray
    slot_first: np.ndarray

    def place(self, rest: np.ndarray, rank: np.ndarray):
        """(is placed, window, offset) of pieces; for residual ones the place in the residual stream."""
        placed = rank < self.placed[rest]
        window, offset = np.zeros(len(rest), np.int64), np.zeros(len(rest), np.int64)
        here = np.flatnonzero(placed)
        if len(here):
            slot = np.searchsorted(self.slot_key, _key(rest[here], rank[here]), side="right") - 1
            t = rank[here] - self.slot_first[slot]
            window[here] = self.slot_window[slot] + t // self.slot_copies[slot]
            offset[here] = self.slot_offset[slot] + t % self.slot_copies[slot] * rest[here]
        left = np.flatnonzero(~placed)
        offset[left] = self.residual_start[rest[left]] + (rank[left] - self.placed[rest[left]]) * rest[left]
        return placed, window, offset


def _key(length: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """One number for (length, rank); ranks stay below 2**44."""
    return (length.astype(np.int64) << 44) + rank


def solve(histogram: np.ndarray, window: int, iterations: int = ITERATIONS) -> Plan:
    """The plan for so many pieces of each length below ``window`` (``histogram[0]`` is ignored)."""
    left = histogram.astype(np.int64).copy()
    left[0] = 0
    lengths = np.flatnonzero(left)
    parts = combinations(lengths, window)
    counts = repeat_counts(parts, histogram, iterations)
    order = np.argsort(-counts, kind="stable")
    order = order[counts[order] >= 0.5]
    chosen: dict[int, int] = {}
    for rounding in (np.floor, np.ceil):
        for k, wanted in zip(order.tolist(), rounding(counts[order]).astype(np.int64).tolist()):
            a, b, c = parts[k].tolist()
            wanted -= chosen.get(k, 0)
            need = {length: [a, b, c].count(length) for length in (a, b, c) if length}
            n = min([wanted, *(int(left[length]) // m for length, m in need.items())])
            if n > 0:
                chosen[k] = chosen.get(k, 0) + n
                for length, m in need.items():
                    left[length] -= n * m
    slots, ranks, windows = [], np.zeros(window, np.int64), 0
    for k, n in sorted(chosen.items()):
        sizes = [length for length in parts[k].tolist() if length]
        offset = 0
        for length in sorted(set(sizes)):
            m = sizes.count(length)
            slots.append((int(_key(np.array(length), ranks[length])), m, windows, offset, int(ranks[length])))
            ranks[length] += m * n
            offset += m * length
        windows += n
    slots.sort()
    table = np.array(slots, np.int64).reshape(-1, 5).T
    amounts = left * np.arange(len(left))
    return Plan(window, ranks, np.cumsum(amounts) - amounts, windows, *table)


def pack(docs: DataFrame, tokenizer: str, cut: str, end_id: int, window: int = 2048) -> DataFrame:
    """Pieces of all documents and their places in windows of at most ``window`` ids.

    Returns doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset. Each id of a document, its end
    id included, lies in one piece. A null text is empty and has the end id alone; null doc_ids and repeated
    rows are packed like any others; other columns are not read. At most the last window is not full.
    """
    spark = docs.sparkSession
    encoded = settle(encode_documents(docs, tokenizer, cut, end_id, window), "packing")
    # at most ``window`` rows, however many documents there are
    found = encoded.where("rest > 0").groupBy("rest").count().collect()
    histogram = np.zeros(window, np.int64)
    for row in found:
        histogram[row["rest"]] = row["count"]
    plan = spark.sparkContext.broadcast(solve(histogram, window))

    earlier = Window.partitionBy("rest").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    per_shard = encoded.groupBy("shard", "rest").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(earlier), F.lit(0))
    ranks = per_shard.select("shard", "rest", before.alias("rank_before"))
    shards = encoded.groupBy("shard").agg(F.sum(F.floor(F.col("n_tokens") / window)).alias("fulls"))
    shards = shards.select(
        "shard",
        F.coalesce(F.sum("fulls").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        .alias("shard_fulls"),
    )
    # one row a shard: as many as the encoding job had tasks
    starts = settle(ranks.join(F.broadcast(shards), "shard"), "packing-starts")

    def place(batches):
        where = plan.value
        for batch in batches:
            for lo in range(0, batch.num_rows, 2048):
                yield _pieces(batch.slice(lo, 2048), where)

    return encoded.join(starts, ["shard", "rest"]).select(
        "doc_id", "n_tokens", "rest", (F.col("rank") + F.col("rank_before")).alias("rank"),
        (F.col("full_before") + F.col("shard_fulls")).alias("full"), "ids",
    ).mapInArrow(
        place,
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long",
    )


def _pieces(batch: pa.RecordBatch, plan: Plan) -> pa.RecordBatch:
    """All pieces of a batch of documents.

    Windows are numbered so: even numbers are full windows of long documents, odd ones the others.
    """
    size = plan.window
    columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(1, 5)]
    n, rest, rank, full = (c.astype(np.int64) for c in columns)
    placed, window, offset = plan.place(rest, rank)
    doc, start, length, sequence, at = [], [], [], [], []
    rows = np.arange(len(n))
    fulls = n // size
    row = np.repeat(rows, fulls)
    k = np.arange(len(row)) - np.repeat(np.cumsum(fulls) - fulls, fulls)
    parts = [(row, k * size, np.full(len(row), size), 2 * (full[row] + k), np.zeros(len(row), np.int64))]
    here = np.flatnonzero((rest > 0) & placed)
    parts.append((here, n[here] - rest[here], rest[here], 2 * window[here] + 1, offset[here]))
    here = np.flatnonzero((rest > 0) & ~placed)
    first = np.minimum(rest[here], size - offset[here] % size)
    number = plan.combined + offset[here] // size
    parts.append((here, n[here] - rest[here], first, 2 * number + 1, offset[here] % size))
    cut = first < rest[here]
    tail = here[cut]
    parts.append(
        (tail, n[tail] - rest[tail] + first[cut], rest[tail] - first[cut], 2 * number[cut] + 3, np.zeros(len(tail), np.int64))
    )
    doc, start, length, sequence, at = (np.concatenate(x).astype(np.int64) for x in zip(*parts))
    raw = [memoryview(ids) for ids in batch.column(5).to_pylist()]
    spans = zip(doc.tolist(), start.tolist(), length.tolist())
    crc = [zlib.crc32(raw[d][4 * a : 4 * (a + b)]) for d, a, b in spans]
    return pa.RecordBatch.from_arrays(
        [
            batch.column(0).take(pa.array(doc)),
            pa.array(start),
            pa.array(length),
            pa.array(crc, pa.int64()),
            pa.array(n[doc]),
            pa.array(sequence),
            pa.array(at),
        ],
        ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
    )
