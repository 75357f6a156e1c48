"""Quality classifier: supervised subword embeddings, averaged per document, with a softmax output.

Features are hashed words and character n-grams; each has a learned vector. A document is the mean of its
feature vectors and goes through a linear layer and a softmax. The vectors and the layer are trained together by
stochastic gradient descent in numpy, on at most ``most_rows`` labelled documents.

The output depends on the mean only through the difference of the two logits, which is linear. Scoring
therefore looks up one number a feature, the difference its vector contributes, and averages those.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, text_offsets, word_hashes, word_spans

MOST_ROWS = 6_000
MOST_BYTES = 1 << 18
WORD_BUCKETS = 1 << 16
GRAM_BITS = 16
GRAM_BUCKETS = 1 << GRAM_BITS
REPEATS = 8
GRAM_BYTES = (3, 4)
SIZE = 8
EPOCHS = 12
RATE = 2.0
SLICE_BYTES = 1 << 20


def features(texts: pa.Array) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Runs of feature buckets of a batch: (buckets, begin of each text, end of each text) of each kind.

    The kinds are words, n-grams of bytes (word ends and white space included), and for words that also stand
    up to ``REPEATS`` places earlier in their text the distance.
    """
    data, starts, ends, before = word_spans(texts)
    hashes = word_hashes(data, starts, ends)
    runs = [((hashes % np.uint64(WORD_BUCKETS)).astype(np.int64), before[:-1], before[1:])]
    offsets = text_offsets(texts)
    offsets = offsets - offsets[0]
    for n in GRAM_BYTES:
        code = np.zeros(max(len(data) - n + 1, 0), np.uint32)
        for k in range(n):
            code <<= np.uint32(8)
            code |= data[k : len(data) - n + 1 + k]
        code *= np.uint32(0x9E3779B1)
        code ^= code >> np.uint32(15)
        code *= np.uint32(0x85EBCA77)
        code >>= np.uint32(32 - GRAM_BITS)
        code += np.uint32(WORD_BUCKETS)
        begin = np.minimum(offsets[:-1], len(code))
        runs.append((code, begin, np.maximum(begin, np.minimum(offsets[1:] - n + 1, len(code)))))
    text = np.repeat(np.arange(len(texts)), np.diff(before))
    distance = np.zeros(len(hashes), np.int64)
    for k in range(REPEATS, 0, -1):
        same = (hashes[k:] == hashes[:-k]) & (text[k:] == text[:-k])
        distance[k:][same] = k
    places = np.flatnonzero(distance)
    at = np.searchsorted(places, before)
    runs.append((distance[places] - 1 + WORD_BUCKETS + GRAM_BUCKETS, at[:-1], at[1:]))
    return runs


@dataclass
class Model:
    """What each bucket adds to the difference of the logits, and its constant part."""

    gain: np.ndarray
    bias: float

    def score(self, texts: pa.Array) -> np.ndarray:
        """Probability of label 1 of each text. A text without features gets that of the constant part."""
        total, n = np.zeros(len(texts)), np.zeros(len(texts))
        for buckets, begin, end in features(texts):
            sums = np.concatenate([[0.0], np.cumsum(self.gain[buckets], dtype=np.float64)])
            total += sums[end] - sums[begin]
            n += end - begin
        return 1 / (1 + np.exp(-(total / np.maximum(n, 1) + self.bias)))


def train(texts: list[str], labels: np.ndarray, seed: int = 7, epochs: int = EPOCHS) -> Model:
    """Fit vectors and layer by gradient descent over single documents, the rate falling to zero.

    Gradients of a document's features are equal (the mean), so its distinct buckets are
    updated with their counts. Without rows the score is one half everywhere.
    """
    buckets = WORD_BUCKETS + GRAM_BUCKETS + REPEATS
    rng = np.random.default_rng(seed)
    vectors = ((rng.random((buckets, SIZE)) - 0.5) / SIZE).astype(np.float32)
    layer, bias = np.zeros((2, SIZE), np.float32), np.zeros(2, np.float32)
    documents = []
    for text in texts:
        runs = [b[i[0] : j[0]].astype(np.int64) for b, i, j in features(pa.array([text], pa.string()))]
        ids, counts = np.unique(np.concatenate(runs), return_counts=True)
        documents.append((ids.astype(np.int32), (counts / max(counts.sum(), 1)).astype(np.float32)))
    steps, done = epochs * max(len(texts), 1), 0
    for _ in range(epochs):
        for i in rng.permutation(len(texts)):
            rate = RATE * (1 - done / steps)
            done += 1
            ids, share = documents[i]
            mean = share @ vectors[ids]
            logits = layer @ mean + bias
            odds = np.exp(logits - logits.max())
            miss = odds / odds.sum()
            miss[int(labels[i])] -= 1
            back = miss @ layer
            layer -= rate * 0.1 * np.outer(miss, mean)
            bias -= rate * 0.01 * miss
            vectors[ids] -= rate * share[:, None] * back * len(ids) ** 0.5
    gain = vectors @ (layer[1] - layer[0])
    return Model(gain.astype(np.float32), float(bias[1] - bias[0]))


def labelled_rows(docs: DataFrame, labels: DataFrame, label: str, usable, most_rows: int, most_bytes: int) -> DataFrame:
    """(doc_id, text, label) of at most ``most_rows`` labelled documents, the same ones on every run.

    ``usable`` is a condition on doc_id. Rows are taken by the order of a hash of doc_id, so the sample does not depend on
    partitions; the labels' side is cut first and only its documents are read back. Of rows that share a doc_id the largest
    text counts. Documents of more than ``most_bytes`` bytes are scored like all others but not learned from.
    """
    chosen = (
        labels.where(usable & F.col(label).isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.max(label).alias("_label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(most_rows)
    )
    # at most ``most_rows`` rows
    short = F.coalesce(F.octet_length("text"), F.lit(0)) <= most_bytes
    found = docs.select("doc_id", "text").where(short).join(F.broadcast(chosen), "doc_id")
    once = found.groupBy("doc_id").agg(F.max("text").alias("text"), F.max("_label").alias("label"))
    return once.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.col("label").cast("int").alias("label"))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, usable, most_rows: int = MOST_ROWS):
    """(texts, labels) of ``labelled_rows``, in the driver."""
    rows = labelled_rows(docs, labels, label, usable, most_rows, MOST_BYTES).toArrow()
    order = np.argsort(rows.column("doc_id").to_numpy(), kind="stable")
    rows = rows.take(pa.array(order))
    return rows.column("text").to_pylist(), rows.column("label").to_numpy().astype(np.int64)


def fit(
    docs: DataFrame, labels: DataFrame, usable, most_rows: int = MOST_ROWS, most_bytes: int = MOST_BYTES
) -> Model:
    """Train on the labelled sample in a task; only the model, half a megabyte, comes to the driver.

    The sample is bounded by ``most_rows`` documents of ``most_bytes``, so one task can hold it, and a lost one is run again.
    """
    rows = labelled_rows(docs, labels, "quality", usable, most_rows, most_bytes)

    def run(batches):
        parts = [pa.Table.from_batches([batch]) for batch in batches]
        texts, known = [], np.zeros(0, np.int64)
        if parts:
            held = pa.concat_tables(parts)
            texts, known = held.column("text").to_pylist(), held.column("label").to_numpy().astype(np.int64)
        model = train(texts, known)
        yield pa.RecordBatch.from_arrays(
            [pa.array([model.gain.tobytes()], pa.binary()), pa.array([model.bias])], ["gain", "bias"]
        )

    made = rows.repartition(1).sortWithinPartitions("doc_id").mapInArrow(run, "gain binary, bias double").first()
    if made is None:  # no rows, no task
        return train([], np.zeros(0, np.int64))
    return Model(np.frombuffer(made.gain, np.float32), made.bias)


def score(docs: DataFrame, model) -> DataFrame:
    """(doc_id, score), one row for each row of ``docs``; null texts are empty. ``model`` has ``score(texts)``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scores(batches):
        for batch in batches:
            for lo, hi in slices(batch.column(1), SLICE_BYTES):
                found = shared.value.score(batch.column(1).slice(lo, hi - lo))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(found.astype(np.float64))], ["doc_id", "score"]
                )

    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return texts.mapInArrow(scores, "doc_id long, score double")


def classify(
    docs: DataFrame,
    labels: DataFrame,
    held_out,
    threshold: float = 0.7,
    most_rows: int = MOST_ROWS,
    most_bytes: int = MOST_BYTES,
) -> DataFrame:
    """(doc_id, held_out, score, predicted), one row for each row of ``docs``.

    ``held_out`` is a condition on doc_id; labels of such rows are not learned from. Only doc_id
    and text are read. Null and empty texts get the score of the constant part.
    """
    model = fit(docs, labels, ~held_out, most_rows, most_bytes)
    scored = score(docs, model)
    return scored.select(
        "doc_id",
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def keep_good(
    docs: DataFrame,
    labels: DataFrame,
    held_out,
    threshold: float = 0.7,
    most_rows: int = MOST_ROWS,
    most_bytes: int = MOST_BYTES,
) -> DataFrame:
    """The rows of ``docs`` that score at least ``threshold``, with all their columns. Nothing is shuffled but the
    training sample."""
    model = fit(docs, labels, ~held_out, most_rows, most_bytes)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def choose(batches):
        for batch in batches:
            texts = batch.column(at).fill_null("")
            for lo, hi in slices(texts, SLICE_BYTES):
                good = shared.value.score(texts.slice(lo, hi - lo)) >= threshold
                yield batch.slice(lo, hi - lo).filter(pa.array(good))

    return docs.mapInArrow(choose, docs.schema)
