"""What the corpus operators share: tables cut from their lineage, and words of a batch."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ..sources import shared_folder

#: The bytes that part words; every other byte, UTF-8 sequences included, belongs to a word.
SPACES = " \t\n\x0b\f\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def settle(df: DataFrame, purpose: str) -> DataFrame:
    """Write a table into the shared folder and read it back: its lineage ends there."""
    path = shared_folder(df.sparkSession, purpose)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices(texts: pa.Array, most_bytes: int = 8 << 20, most_rows: int = 1 << 15):
    """(from, to) row ranges of a batch, each of one row or within these limits."""
    start, total = 0, 0
    for row, size in enumerate(np.diff(text_offsets(texts)).tolist()):
        if row > start and (total + size > most_bytes or row - start == most_rows):
            yield start, row
            start, total = row, 0
        total += size
    if len(texts) > start:
        yield start, len(texts)


def text_offsets(texts: pa.Array) -> np.ndarray:
    """Byte offsets of a string or binary array (int32 or int64), as int64, of the rows it shows."""
    large = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    kind = np.int64 if large else np.int32
    raw = np.frombuffer(texts.buffers()[1], kind, len(texts) + 1, texts.offset * np.dtype(kind).itemsize)
    return raw.astype(np.int64)


def word_spans(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of all texts of a batch: (bytes, word starts, word ends, words before each text).

    Texts are non-null. The last array has one entry more than there are texts. A text's end parts
    words as white space does.
    """
    offsets = text_offsets(texts)
    base, end = int(offsets[0]), int(offsets[-1])
    if end == base:
        empty = np.zeros(0, np.int64)
        return np.zeros(0, np.uint8), empty, empty, np.zeros(len(texts) + 1, np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8, end - base, base)
    offsets = offsets - base
    space = (data == 32) | ((data - np.uint8(9)) <= 4)
    inside = ~space
    first = inside.copy()
    first[1:] &= space[:-1]
    cut = offsets[:-1][offsets[:-1] < len(data)]
    first[cut] = inside[cut]
    last = inside.copy()
    last[:-1] &= space[1:]
    cut = offsets[1:][offsets[1:] > 0] - 1
    last[cut] = inside[cut]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return data, starts, ends, np.searchsorted(starts, offsets)


_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def mix(values: np.ndarray) -> np.ndarray:
    """A fixed scrambling of 64-bit numbers (multiply and shift)."""
    with np.errstate(over="ignore"):
        v = values.astype(np.uint64, copy=True)
        v ^= v >> np.uint64(32)
        v *= np.uint64(0xD6E8FEB86659FD93)
        v ^= v >> np.uint64(32)
        v *= np.uint64(0xD6E8FEB86659FD93)
        v ^= v >> np.uint64(32)
    return v


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes, the same wherever the word stands.

    Eight bytes at a time: the k-th step mixes in the k-th eight bytes of all words that have any.
    """
    if not len(starts):
        return np.zeros(0, np.uint64)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    at = np.lib.stride_tricks.sliding_window_view(padded, 8)
    length = ends - starts
    masks = np.array([(1 << (8 * n)) - 1 for n in range(8)] + [2**64 - 1], np.uint64)
    head = np.ascontiguousarray(at[starts]).view(np.uint64).ravel() & masks[np.minimum(length, 8)]
    with np.errstate(over="ignore"):
        out = mix(head + length.astype(np.uint64) * _FACTOR)
        left = np.flatnonzero(length > 8)
        done = 8
        while len(left):
            rest = np.minimum(length[left] - done, 8)
            part = np.ascontiguousarray(at[starts[left] + done]).view(np.uint64).ravel() & masks[rest]
            out[left] = mix(out[left] * _FACTOR + part)
            done += 8
            left = left[length[left] > done]
    return out


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """The hash of each run of ``size`` consecutive word hashes (one per start, across texts)."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        out = np.zeros(n, np.uint64)
        for k in range(size):
            out *= _FACTOR
            out += words[k : k + n]
    return mix(out)
