"""Simple-8b: runs of integers packed into 64-bit words, and token files made of them.

A word holds a 4-bit selector in its low bits and a fixed number of equally wide integers above it.
Selector 15 is an escape: the word holds an index into a list of whole 64-bit integers. Ids are
coded in blocks of ``BLOCK``; each block starts a new word and its offset is kept, so that any block
can be decoded alone and all words of a block at once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import slices
from .tokens import encoder

BLOCK = 256
COUNTS = np.array([60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
WIDTHS = 60 // COUNTS
ESCAPE = 15
#: By selector: integers in a word. Selector 0 is not used.
HELD = np.concatenate([[0], COUNTS, [1]])
#: The largest count of the table that is at most so many integers.
_AT_MOST = np.array([max([c for c in COUNTS.tolist() if c <= n], default=0) for n in range(61)])
_SELECTOR = np.zeros(61, np.uint64)
_SELECTOR[COUNTS] = np.arange(1, len(COUNTS) + 1)

SEGMENT_IDS = 1 << 16
#: Texts encoded together: the more, the fewer pieces are looked up twice, and the more memory their pieces take.
SLICE_BYTES = 4 << 20
SEGMENT = (
    "shard int, segment int, first long, doc_ids array<bigint>, lengths array<int>, n_ids int, "
    "words binary, escapes binary, offsets array<int>"
)


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, escaped integers, index of the first word of each block) of unsigned integers.

    Every word takes as many of the next integers as fit, within its block.
    """
    ids = ids.astype(np.uint64)
    n = len(ids)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int32)
    # the largest count whose width fits each integer alone, then over runs of that many integers
    alone = np.zeros(n, np.uint8)
    for count, width in zip(COUNTS[::-1].tolist(), WIDTHS[::-1].tolist()):
        alone[ids < (np.uint64(1) << np.uint64(width))] = count
    escaped = ids >> np.uint64(60) > 0
    alone[escaped] = 1
    best = np.ones(n, np.uint8)
    least = {1: alone}
    for count in COUNTS[::-1].tolist()[1:]:
        if count > n:
            break
        half = max(c for c in least if c < count)
        shift = count - half
        while shift > half:  # two runs must overlap or touch
            step = min(half, shift)
            grown = np.minimum(least[half][: len(least[half]) - step], least[half][step:])
            half += step
            least[half] = grown
            shift = count - half
        run = least[half]
        run = np.minimum(run[: len(run) - shift], run[shift:]) if shift else run
        least[count] = run
        fits = run >= count
        if not fits.any():  # nor does any longer run
            break
        best[: len(run)][fits] = count
    starts = np.arange(0, n, BLOCK)
    ends = np.minimum(starts + BLOCK, n)
    mark = np.zeros(n, bool)
    at, end = starts.copy(), ends
    while len(at):
        mark[at] = True
        at = at + _AT_MOST[np.minimum(best[at], np.minimum(end - at, 60))]
        going = at < end
        at, end = at[going], end[going]
    first = np.flatnonzero(mark)
    count = np.diff(np.append(first, n))
    words = np.zeros(len(first), np.uint64)
    for c, width in zip(COUNTS.tolist(), WIDTHS.tolist()):
        here = np.flatnonzero(count == c)
        if len(here):
            shifts = (4 + width * np.arange(c)).astype(np.uint64)
            held = ids[first[here][:, None] + np.arange(c)] << shifts
            words[here] = np.bitwise_or.reduce(held, axis=1) | _SELECTOR[c]
    escapes = ids[escaped]
    raw = np.searchsorted(first, np.flatnonzero(escaped))
    words[raw] = (np.arange(len(escapes), dtype=np.uint64) << np.uint64(4)) | np.uint64(ESCAPE)
    return words, escapes, np.searchsorted(first, starts).astype(np.int32)


def unpack(words: np.ndarray, escapes: np.ndarray) -> np.ndarray:
    """The integers of these words, all words of a selector at once."""
    selector = (words & np.uint64(15)).astype(np.int64)
    count = HELD[selector]
    first = np.cumsum(count) - count
    out = np.zeros(int(count.sum()), np.uint64)
    for s in np.unique(selector).tolist():
        here = np.flatnonzero(selector == s)
        if s == ESCAPE:
            out[first[here]] = escapes[(words[here] >> np.uint64(4)).astype(np.int64)]
            continue
        c, width = int(COUNTS[s - 1]), int(WIDTHS[s - 1])
        shifts = (4 + width * np.arange(c)).astype(np.uint64)
        mask = np.uint64((1 << width) - 1)
        out[first[here][:, None] + np.arange(c)] = (words[here][:, None] >> shifts) & mask
    return out


def unpack_range(words, escapes, offsets, start: int, stop: int) -> np.ndarray:
    """Integers ``start`` to ``stop``, decoding only the blocks that hold them."""
    first, last = start // BLOCK, -(-stop // BLOCK)
    end = offsets[last] if last < len(offsets) else len(words)
    return unpack(words[offsets[first] : end], escapes)[start - first * BLOCK : stop - first * BLOCK]


def encode_shards(docs: DataFrame, tokenizer: str, cut: str, end_id: int) -> DataFrame:
    """Segments of about ``SEGMENT_IDS`` ids (whole documents) in ascending doc_id order.

    A shard is a range of doc_ids. A null doc_id comes first, rows that share one are in the order of their texts.
    A null text is empty and has the end id alone.
    """
    ordered = (
        docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
    )

    def shard(batches):
        number, segment, first = TaskContext.get().partitionId(), 0, 0
        encode = encoder(tokenizer, cut).ids
        for batch in batches:
            texts, doc_ids = batch.column(1), batch.column(0).to_pylist()
            for lo, hi in slices(texts, SLICE_BYTES):
                ids, before = encode(texts.slice(lo, hi - lo))
                ids = np.insert(ids, before[1:], end_id)
                before = before + np.arange(len(before))
                rows = []
                for a, b in _segments(before):
                    words, escapes, offsets = pack(ids[before[a] : before[b]])
                    n = int(before[b] - before[a])
                    rows.append(
                        {
                            "shard": number,
                            "segment": segment,
                            "first": first,
                            "doc_ids": doc_ids[lo + a : lo + b],
                            "lengths": np.diff(before[a : b + 1]).tolist(),
                            "n_ids": n,
                            "words": words.astype("<u8").tobytes(),
                            "escapes": escapes.astype("<u8").tobytes(),
                            "offsets": offsets.tolist(),
                        }
                    )
                    segment, first = segment + 1, first + n
                yield pa.RecordBatch.from_pylist(rows, schema=_SEGMENT_ARROW)

    return ordered.mapInArrow(shard, SEGMENT)


_SEGMENT_ARROW = pa.schema(
    [
        ("shard", pa.int32()),
        ("segment", pa.int32()),
        ("first", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("lengths", pa.list_(pa.int32())),
        ("n_ids", pa.int32()),
        ("words", pa.binary()),
        ("escapes", pa.binary()),
        ("offsets", pa.list_(pa.int32())),
    ]
)


def _segments(before: np.ndarray):
    """Runs of documents with at least ``SEGMENT_IDS`` ids each, the last one shorter."""
    a, n = 0, len(before) - 1
    while a < n:
        b = min(int(np.searchsorted(before, before[a] + SEGMENT_IDS)), n)
        yield a, max(b, a + 1)
        a = max(b, a + 1)


def write_tokens(docs: DataFrame, path: str, tokenizer: str, cut: str, end_id: int) -> None:
    """Write the ids of all documents as Simple-8b segments, in files under ``path``.

    The files are Parquet, one row a segment, so that Spark's commit covers lost tasks and any file system will do.
    Words are not compressed further, the container's own codec takes what is left.
    """
    encode_shards(docs, tokenizer, cut, end_id).write.option("compression", "zstd").parquet(path)


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SEGMENT).parquet(path)


def shard_starts(segments: DataFrame) -> DataFrame:
    """Ids before each shard: one row a shard."""
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    totals = segments.groupBy("shard").agg(F.sum("n_ids").alias("shard_ids"))
    return totals.select("shard", F.coalesce(F.sum("shard_ids").over(earlier), F.lit(0)).alias("before"))


def decode_documents(segments: DataFrame) -> DataFrame:
    """(shard, doc_id, place, ids) of all documents, ``place`` counting ids within the shard."""

    def decode(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids, at = _row_ids(row)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["shard"]] * len(row["doc_ids"]), pa.int32()),
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array(row["first"] + at[:-1], pa.int64()),
                        pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids.astype(np.int64))),
                    ],
                    ["shard", "doc_id", "place", "ids"],
                )

    return segments.mapInArrow(decode, "shard int, doc_id long, place long, ids array<bigint>")


def _row_ids(row: dict) -> tuple[np.ndarray, np.ndarray]:
    words, escapes = np.frombuffer(row["words"], "<u8"), np.frombuffer(row["escapes"], "<u8")
    return unpack(words, escapes), np.concatenate([[0], np.cumsum(row["lengths"])]).astype(np.int64)


def document_digests(segments: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of all documents, read from their segments."""
    import zlib

    def digest(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids, at = _row_ids(row)
                raw = memoryview(ids.astype("<u4").tobytes())
                spans = at.tolist()
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(spans, spans[1:])]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["shard"]] * len(crc), pa.int32()),
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array(row["first"] + at[:-1], pa.int64()),
                        pa.array(np.diff(at), pa.int64()),
                        pa.array(crc, pa.int64()),
                    ],
                    ["shard", "doc_id", "place", "n_tokens", "ids_crc32"],
                )

    found = segments.select("shard", "first", "doc_ids", "lengths", "words", "escapes").mapInArrow(
        digest, "shard int, doc_id long, place long, n_tokens long, ids_crc32 long"
    )
    # one row a shard: as many as the writing job had tasks
    starts = F.broadcast(shard_starts(segments))
    return found.join(starts, "shard").select(
        "doc_id", (F.col("before") + F.col("place")).alias("start"), "n_tokens", "ids_crc32"
    )
