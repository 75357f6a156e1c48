"""Document fingerprints by context-triggered piecewise hashing, and their likeness.

A rolling hash of the last seven bytes ends a chunk wherever it is divisible by the block size, three times a power of
two. Every chunk gives one letter of a signature. A fingerprint is ``block:signature:signature`` for a block size and
twice that size: the smallest one of which ``MOST_CHUNKS`` cover the text, halved until ``LEAST_CHUNKS`` chunks end. A
signature has at most ``MOST_CHUNKS`` letters, the last of which covers all that is left, so every byte counts.

Signatures of equal block sizes are compared by edit distance (a replaced letter counts as one deleted and one
inserted). Two signatures without ``RUN`` letters in a row in common are not alike at all.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import with_count_at_or_below

WINDOW = 7
LEAST_CHUNKS, MOST_CHUNKS = 32, 64
RUN = 4
LEVELS = 21  # block sizes 3 * 2**0 to 3 * 2**20
SEGMENT = 1 << 20
LETTERS = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)

_STEP = 0x01000193
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_MASK = (1 << 64) - 1
_FACTORS = [np.uint32(pow(_STEP, k, 1 << 32)) for k in range(WINDOW)]
_powers: list[np.ndarray] = []


def _base_powers() -> np.ndarray:
    if not _powers:
        steps = np.full(SEGMENT, _BASE, np.uint64)
        steps[0] = 1
        with np.errstate(over="ignore"):
            _powers.append(np.cumprod(steps))
    return _powers[0]


def _rolled(data: np.ndarray) -> np.ndarray:
    """Hash of the ``WINDOW`` bytes that end at each place, from place ``WINDOW - 1`` on."""
    n = len(data) - WINDOW + 1
    wide = data.astype(np.uint32)
    with np.errstate(over="ignore"):
        out = wide[WINDOW - 1 :].copy()
        for k in range(1, WINDOW):
            out += wide[WINDOW - 1 - k : WINDOW - 1 - k + n] * _FACTORS[k]
        out ^= out >> np.uint32(15)
        out *= np.uint32(0x2C1B3C6D)
        out ^= out >> np.uint32(13)
    return out


def _level(quotients: np.ndarray) -> np.ndarray:
    """How often each number is divisible by two, at most ``LEVELS - 1`` times."""
    wide = quotients.astype(np.int64) | (1 << (LEVELS - 1))
    return np.log2((wide & -wide).astype(np.float64)).astype(np.int64)


class Chunks:
    """Ends of chunks of one text at all block sizes, taken in from its segments."""

    def __init__(self):
        self.size, self.sum, self.tail = 0, 0, bytes(WINDOW - 1)
        self.count = np.zeros(LEVELS, np.int64)
        self.ends, self.levels, self.sums = (np.zeros(0, t) for t in (np.int64, np.int64, np.uint64))

    def add(self, raw: bytes) -> None:
        data = np.frombuffer(self.tail + raw, np.uint8)
        self.tail = (self.tail + raw)[-(WINDOW - 1) :]
        rolled = _rolled(data)
        at = np.flatnonzero(rolled % np.uint32(3) == 0)
        level = _level(rolled[at] // np.uint32(3))
        with np.errstate(over="ignore"):
            sums = np.cumsum(data[WINDOW - 1 :] * _base_powers()[: len(raw)], dtype=np.uint64)
            sums *= np.uint64(pow(_BASE, self.size, 1 << 64))
            sums += np.uint64(self.sum)
        self.count += np.bincount(level, minlength=LEVELS)[::-1].cumsum()[::-1]
        self.ends = np.append(self.ends, at + 1 + self.size)
        self.levels = np.append(self.levels, level)
        self.sums = np.append(self.sums, sums[at])
        self.size += len(raw)
        self.sum = int(sums[-1])

    def thin(self) -> None:
        """Keep of each level the first ends a signature can use."""
        use = np.zeros(len(self.ends), bool)
        for k in range(LEVELS):
            use[np.flatnonzero(self.levels >= k)[: MOST_CHUNKS - 1]] = True
        self.ends, self.levels, self.sums = self.ends[use], self.levels[use], self.sums[use]

    def signature(self, level: int) -> str:
        if not self.size:
            return ""
        use = np.flatnonzero(self.levels >= level)[: MOST_CHUNKS - 1]
        ends, sums = self.ends[use].tolist(), self.sums[use].tolist()
        if not ends or ends[-1] < self.size:
            ends, sums = [*ends, self.size], [*sums, self.sum]
        out, start, before = bytearray(), 0, 0
        for end, upto in zip(ends, sums):
            value = (upto - before) * pow(_INVERSE, start, 1 << 64) & _MASK
            value = (value ^ (value >> 29)) * 0xBF58476D1CE4E5B9 & _MASK
            out.append(LETTERS[value >> 58])
            start, before = end, upto
        return out.decode()

    def fingerprint(self) -> str:
        fitting = max(-(-self.size // (3 * MOST_CHUNKS)) - 1, 0).bit_length()
        level = max(min(fitting, int((self.count >= LEAST_CHUNKS).sum()) - 1), 0)
        return f"{3 << level}:{self.signature(level)}:{self.signature(level + 1)}"


def fingerprint(raw: bytes) -> str:
    """The fingerprint of some bytes; those of equal bytes are equal. No bytes give ``3::``."""
    found = Chunks()
    for lo in range(0, len(raw), SEGMENT):
        found.add(raw[lo : lo + SEGMENT])
        if len(raw) > SEGMENT:
            found.thin()
    return found.fingerprint()


def alike(left: list[str], right: list[str]) -> np.ndarray:
    """1 - edit distance / letters of both, for pairs of signatures; 0 without ``RUN`` letters in common.

    All pairs at once, one letter of the right side a step: the longest common subsequence is kept as one bit for each
    letter of the left side.
    """
    n = len(left)
    none = len(LETTERS)
    place = np.full(256, none, np.int64)
    place[LETTERS] = np.arange(none)
    grids = []
    for side in (left, right):
        flat = np.frombuffer("".join(s.ljust(MOST_CHUNKS, " ") for s in side).encode(), np.uint8)
        grids.append(place[flat].reshape(n, MOST_CHUNKS))
    sizes = [(grid < none).sum(axis=1) for grid in grids]
    rows = np.arange(n)
    where = np.zeros((n, none + 1), np.uint64)
    for j in range(MOST_CHUNKS):
        where[rows, grids[0][:, j]] |= np.uint64(1 << j)
    where[:, none] = 0
    open_ = np.full(n, _MASK, np.uint64)
    runs = [np.zeros(n, np.uint64) for _ in range(RUN)]
    common = np.zeros(n, bool)
    one = np.uint64(1)
    with np.errstate(over="ignore"):
        for j in range(int(sizes[1].max(initial=0))):
            match = where[rows, grids[1][:, j]]
            met = open_ & match
            open_ = (open_ + met) | (open_ - met)
            runs = [match] + [(shorter << one) & match for shorter in runs[:-1]]
            common |= runs[-1] != 0
    shared = np.bitwise_count(~open_).astype(np.float64)
    return np.where(common, 2 * shared / np.maximum(sizes[0] + sizes[1], 1), 0.0)


def similarities(left: list[str], right: list[str]) -> np.ndarray:
    """Likeness of pairs of fingerprints, 0 to 1. Equal fingerprints are alike (1), block sizes more than one step
    apart are not (0); else the better of the signatures of equal block sizes counts."""
    rows, first, second = [], [], []
    out = np.zeros(len(left))
    for i, (a, b) in enumerate(zip(left, right)):
        if a == b:
            out[i] = 1.0
            continue
        (x, a1, a2), (y, b1, b2) = a.split(":"), b.split(":")
        x, y = int(x), int(y)
        pairs = [(a1, b1), (a2, b2)] if x == y else [(a1, b2)] if x == 2 * y else [(a2, b1)] if y == 2 * x else []
        for s, t in pairs:
            rows.append(i)
            first.append(s)
            second.append(t)
    if rows:
        np.maximum.at(out, np.array(rows), alike(first, second))
    return out


def edited(text: str, following: str) -> str:
    """The text with the last half of its characters replaced by as many first ones of the following (or all)."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _cuts(keyed: DataFrame, parts: int) -> list[tuple[int, int]]:
    """The smallest (id, hash) of each of at most ``parts`` ranges of the rows: one row a range."""
    ranged = keyed.select("key", "hash").repartitionByRange(parts, "key", "hash")

    def least(batches):
        best = None
        for batch in batches:
            if batch.num_rows:
                key, hash_ = (c.to_numpy() for c in batch.columns)
                i = np.lexsort((hash_, key))[0]
                found = (int(key[i]), int(hash_[i]))
                best = found if best is None else min(best, found)
        if best is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v], pa.int64()) for v in best], ["key", "hash"])

    return sorted((r.key, r.hash) for r in ranged.mapInArrow(least, "key long, hash long").collect())


def in_order(docs: DataFrame) -> DataFrame:
    """(doc_id, text, own) dealt into ranges and sorted.

    Rows are ordered by doc_id (nulls first), a hash of the text and the text. After its own rows each range has one row
    more that is not its own: the next range's first one, after the last range the first of all. So every document stands
    before its successor, and texts are shuffled once.
    """
    spark = docs.sparkSession
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    keyed = texts.select(
        F.coalesce("doc_id", F.lit(-(2**63))).alias("key"), F.xxhash64("text").alias("hash"), "doc_id", "text"
    )
    cuts = _cuts(keyed, int(spark.conf.get("spark.sql.shuffle.partitions")))
    n = max(len(cuts), 1)
    # as many rows as there are ranges, at most spark.sql.shuffle.partitions
    heads = spark.createDataFrame(
        [(k, h, (i - 1) % n) for i, (k, h) in enumerate(cuts)], "key long, hash long, part int"
    )
    bounds = heads.agg(F.sort_array(F.collect_list(F.struct("key", "hash")))).scalar()
    placed = keyed.select("*", F.struct("key", "hash").alias("place"), bounds.alias("bounds"))
    placed = with_count_at_or_below(placed, "bounds", "place", "part", n)
    own = placed.select(keyed.columns + [(F.col("part") - 1).alias("part"), F.lit(True).alias("own")])
    wanted = keyed.join(F.broadcast(heads.select("key", "hash")), ["key", "hash"], "left_semi")
    first = wanted.groupBy("key", "hash").agg(F.first("doc_id").alias("doc_id"), F.min("text").alias("text"))
    guests = first.join(F.broadcast(heads), ["key", "hash"]).withColumn("own", F.lit(False))
    both = own.unionByName(guests).repartitionById(n, F.col("part"))
    ordered = both.sortWithinPartitions(F.col("own").desc(), "key", "hash", "text")
    return ordered.select("doc_id", "text", "own")


OUTPUT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)
_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_chars", pa.int64()),
        ("edited_sha256", pa.string()),
        ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()),
        ("near_edited", pa.float64()),
        ("near_next", pa.float64()),
    ]
)


def compare_with_next(docs: DataFrame) -> DataFrame:
    """Fingerprints of each document and of its edited text, and how alike those and its successor's are.

    One row for each row of ``docs``. Null texts are empty. The successor is the next row by doc_id, nulls first, rows that
    share one in the order of a hash of their texts; the last row's is the first. A table of one row is its
    own successor. Only doc_id and text are read; a range of rows streams through its task.
    """
    ordered = in_order(docs)

    def describe(batches):
        held = None
        for batch in batches:
            rows, after = [], []
            ids = batch.column(0).to_pylist()
            for i, text in enumerate(batch.column(1)):
                text = text.as_py()
                print_ = fingerprint(text.encode())
                if held is not None:
                    doc_id, own_text, own_print = held
                    raw = edited(own_text, text).encode()
                    rows.append((doc_id, len(own_text), hashlib.sha256(raw).hexdigest(), own_print, fingerprint(raw)))
                    after.append(print_)
                held = (ids[i], text, print_)
            if rows:
                columns = list(map(list, zip(*rows)))
                columns += [similarities(columns[3], columns[4]), similarities(columns[3], after)]
                arrays = [pa.array(c, f.type) for c, f in zip(columns, _ARROW)]
                yield pa.RecordBatch.from_arrays(arrays, schema=_ARROW)

    return ordered.mapInArrow(describe, OUTPUT)
