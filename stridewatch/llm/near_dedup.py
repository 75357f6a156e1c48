"""Near-duplicate classes by improved consistent weighted sampling over TF-IDF shingles.

A document is the multiset of its runs of ``SHINGLE`` words. A shingle weighs its count times its inverse
document frequency. Two documents are linked if the weighted Jaccard similarity of these vectors is at least the
threshold; classes are the connected components of the links.

1. Document frequencies over all documents, in ``FREQUENCIES`` hashed counters: a table of fixed size.
2. Each document gets ``BANDS * ROWS`` consistent weighted samples. Documents with equal words share one
   representative; representatives that agree in all samples of a band meet in its bucket.
3. Buckets with the same members count once. The texts of a bucket's members meet in blocks of bounded size, a
   large bucket as all pairs of its blocks, so none is capped. A block computes the similarities of its members and
   sends on a forest: one link fewer than it has members at most, never all pairs.
4. The links' connected components are the classes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix, settle, slices, window_hashes, word_hashes, word_spans

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 16, 4
FREQUENCIES = 1 << 18  # the top 18 bits of a 64-bit hash
SLICE_BYTES = 1 << 20
#: Members of a block; about as many again meet them where a bucket has several.
BLOCK = 512
#: Members that a block compares with all others one by one before it turns to an index of shingles.
PIVOTS = 8
#: Weights lie between one (a shingle of every document) and two (a shingle of none other).
_QUANTA = 1 << 16


def _gamma_quantiles() -> np.ndarray:
    """Quantiles of the Gamma(2, 1) distribution at the middles of equal steps."""
    p = (np.arange(_QUANTA) + 0.5) / _QUANTA
    low, high = np.zeros(_QUANTA), np.full(_QUANTA, 60.0)
    for _ in range(60):
        x = (low + high) / 2
        below = 1 - (1 + x) * np.exp(-x) < p
        low, high = np.where(below, x, low), np.where(below, high, x)
    return (low + high) / 2


class Sampler:
    """Draws the samples of weighted shingles, the same for the same shingle and weight anywhere."""

    def __init__(self, samples: int, seed: int = 11):
        quantiles = _gamma_quantiles()
        self.rate, self.log_c = quantiles.astype(np.float32), np.log(quantiles).astype(np.float32)
        odd = np.random.default_rng(seed).integers(0, 2**63, (samples, 2), dtype=np.uint64) * np.uint64(2)
        self.factors = odd | np.uint64(1)

    def draw(self, shingles: np.ndarray, log_weights: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """(documents x samples) 32-bit samples; ``starts`` is the first shingle of each document.

        Every document has a shingle. Each sample is the shingle and the level with the smallest value of
        ``c / (y * exp(r))``, computed in logarithms.
        """
        out = np.empty((len(starts), len(self.factors)), np.uint32)
        log_weights = log_weights.astype(np.float32)
        low = np.uint64(0xFFFF)
        with np.errstate(over="ignore"):
            for k, (a, b) in enumerate(self.factors):
                z = shingles * a
                z ^= z >> np.uint64(29)
                z *= b
                rate = self.rate[z >> np.uint64(48)]
                shift = ((z >> np.uint64(16)) & low).astype(np.float32) / np.float32(_QUANTA)
                level = np.floor(log_weights / rate + shift)
                value = self.log_c[(z >> np.uint64(32)) & low] - rate * (level - shift + np.float32(1))
                bits = value.view(np.int32)
                order = (bits ^ ((bits >> 31) & 0x7FFFFFFF)).astype(np.int64) + 2**31
                token = ((z >> np.uint64(20)) ^ (level.astype(np.int64).view(np.uint64) * b)) & np.uint64(0xFFFFFFFF)
                packed = (order.view(np.uint64) << np.uint64(32)) | token
                out[:, k] = np.minimum.reduceat(packed, starts).astype(np.uint32)
        return out


class Shingles:
    """Distinct shingles of some texts, by text: 48-bit hashes, counts, and where each text begins."""

    def __init__(self, texts: pa.Array, size: int):
        self.data, self.word_starts, self.word_ends, self.before = word_spans(texts)
        words = word_hashes(self.data, self.word_starts, self.word_ends)
        n = np.diff(self.before)
        runs = window_hashes(words, size)
        count = np.maximum(n - size + 1, 0)
        place = np.repeat(self.before[:-1] - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
        text, found = np.repeat(np.arange(len(n)), count), runs[place]
        # a text of fewer words is one shingle of all of them
        short = np.flatnonzero((n > 0) & (n < size))
        if len(short):
            whole = [window_hashes(words[self.before[t] : self.before[t + 1]], int(n[t]))[0] for t in short]
            text, found = np.append(text, short), np.append(found, np.array(whole, np.uint64))
        keys = np.sort((text.astype(np.uint64) << np.uint64(48)) | (found >> np.uint64(16)))
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))[: len(keys)]
        self.counts = np.diff(np.append(first, len(keys)))
        self.text = (keys[first] >> np.uint64(48)).astype(np.int64)
        self.hashes = keys[first] & np.uint64((1 << 48) - 1)

    def counters(self) -> np.ndarray:
        return (mix(self.hashes) >> np.uint64(46)).astype(np.int64)

    def digests(self, texts: int) -> list[bytes | None]:
        """Digest of the words of each text, joined by one space; None where there are none."""
        raw, out = self.data.tobytes(), []
        starts, ends, before = self.word_starts.tolist(), self.word_ends.tolist(), self.before.tolist()
        for t in range(texts):
            a, b = before[t], before[t + 1]
            joined = b" ".join(raw[starts[a] : ends[b - 1]].split()) if b > a else None
            out.append(None if joined is None else hashlib.blake2b(joined, digest_size=16).digest())
        return out


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("text"))


def document_frequencies(docs: DataFrame, size: int) -> tuple[np.ndarray, int]:
    """(documents by counter, all documents). A table of ``FREQUENCIES`` numbers, whatever the corpus."""

    def count(batches):
        total = np.zeros(FREQUENCIES, np.int64)
        for batch in batches:
            for lo, hi in slices(batch.column(1), SLICE_BYTES):
                total += np.bincount(Shingles(batch.column(1).slice(lo, hi - lo), size).counters(), minlength=FREQUENCIES)
        seen = np.flatnonzero(total)
        for lo in range(0, len(seen), 1 << 16):
            part = seen[lo : lo + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(total[part])], ["counter", "n"])

    counted = _texts(docs).mapInArrow(count, "counter long, n long").groupBy("counter").agg(F.sum("n").alias("n"))
    rows = counted.toArrow()  # at most FREQUENCIES rows
    found = np.zeros(FREQUENCIES, np.int64)
    found[rows.column("counter").to_numpy()] = rows.column("n").to_numpy()
    return found, docs.count()


def idf_table(frequencies: np.ndarray, documents: int) -> np.ndarray:
    """Inverse document frequencies, scaled to lie between one and two.

    The scale keeps one similarity threshold meaningful: shingles that a large group of near copies shares do not
    vanish beside the few words in which the copies differ.
    """
    rare = np.log((documents + 1) / (np.minimum(frequencies, documents) + 1))
    return 1 + rare / np.log(documents + 2)


def signatures(docs: DataFrame, idf, size: int) -> DataFrame:
    """(doc_id, digest, bands) of each document that has words and a doc_id; ``bands`` has a number for all
    samples of each band."""

    def sample(batches):
        draws, weights = Sampler(BANDS * ROWS), idf.value
        for batch in batches:
            for lo, hi in slices(batch.column(1), SLICE_BYTES):
                found = Shingles(batch.column(1).slice(lo, hi - lo), size)
                here, starts = np.unique(found.text, return_index=True)
                if not len(here):
                    continue
                log_weights = np.log(found.counts * weights[found.counters()])
                drawn = draws.draw(found.hashes, log_weights, starts)
                bands = np.zeros((len(here), BANDS), np.uint64)
                with np.errstate(over="ignore"):
                    for row in range(ROWS):
                        bands = mix(bands * np.uint64(31) + drawn[:, row::ROWS] + np.arange(BANDS, dtype=np.uint64))
                digests = found.digests(hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, hi - lo).take(pa.array(here)),
                        pa.array([digests[t] for t in here.tolist()], pa.binary()),
                        pa.ListArray.from_arrays(
                            pa.array(np.arange(len(here) + 1) * BANDS, pa.int32()), pa.array(bands.view(np.int64).ravel())
                        ),
                    ],
                    ["doc_id", "digest", "bands"],
                )

    named = _texts(docs).where("doc_id IS NOT NULL")
    return named.mapInArrow(sample, "doc_id long, digest binary, bands array<bigint>")


def components(edges: DataFrame) -> DataFrame:
    """(id, root) of all ends of the edges (a, b), the root being the smallest id of the component.

    Alternating large and small stars; each pass is written, so lineage stays short. An id with very many
    edges is merged before it is shuffled, and its join is an ordinary one.
    """

    def larger_first(a: str, b: str) -> list:
        return [F.greatest(a, b).alias("u"), F.least(a, b).alias("v")]

    edges = settle(edges.where("a <> b").select(*larger_first("a", "b")).distinct(), "edges")
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = settle(large.where("u <> v").distinct(), "large-stars")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        edges = settle(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "small-stars")
        # done when every id has one root and no root has a root of its own
        roots = edges.select(F.col("v").alias("u")).distinct()
        twice = edges.groupBy("u").count().where("count > 1").select("u")
        if edges.join(roots, "u", "left_semi").select("u").unionByName(twice).isEmpty():
            named = edges.select(F.col("u").alias("id"), F.col("v").alias("root"))
            return named.unionByName(roots.select(F.col("u").alias("id"), F.col("u").alias("root")))


class Block:
    """Weighted shingles of some documents, and the links that join them into classes."""

    def __init__(self, texts: pa.Array, weights: np.ndarray, size: int):
        found = Shingles(texts, size)
        self.n, self.text, self.hashes = len(texts), found.text, found.hashes
        self.weight = found.counts * weights[found.counters()]
        self.total = np.bincount(self.text, self.weight, self.n)
        self.begin = np.searchsorted(self.text, np.arange(self.n + 1))
        self.index = None

    def _similar(self, overlap: np.ndarray, row: int, threshold: float) -> np.ndarray:
        union = self.total + self.total[row] - overlap
        return np.flatnonzero((overlap > 0) & (overlap >= threshold * union))

    def against_all(self, row: int, threshold: float) -> np.ndarray:
        """Rows similar to ``row``: every shingle of the block is looked up in the row's."""
        own = slice(self.begin[row], self.begin[row + 1])
        if self.begin[row] == self.begin[row + 1]:
            return np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.hashes[own], self.hashes), own.stop - own.start - 1)
        shared = self.hashes[own][at] == self.hashes
        least = np.minimum(self.weight[shared], self.weight[own][at[shared]])
        return self._similar(np.bincount(self.text[shared], least, self.n), row, threshold)

    def by_index(self, row: int, threshold: float) -> np.ndarray:
        """The same from an index of the block's shingles: only documents that share one are met."""
        if self.index is None:
            order = np.argsort(self.hashes, kind="stable")
            first = np.flatnonzero(np.append(True, np.diff(self.hashes[order]) != 0))
            size = np.diff(np.append(first, len(order)))
            place = np.empty(len(order), np.int64)
            place[order] = np.repeat(np.arange(len(first)), size)
            self.index = order, first, size, place
        order, first, size, place = self.index
        own = np.arange(self.begin[row], self.begin[row + 1])
        n = size[place[own]]
        met = order[np.repeat(first[place[own]] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]
        least = np.minimum(np.repeat(self.weight[own], n), self.weight[met])
        return self._similar(np.bincount(self.text[met], least, self.n), row, threshold)

    def forest(self, threshold: float) -> list[tuple[int, int]]:
        """Links between similar rows that connect all that are connected, at most n - 1."""
        root, links = list(range(self.n)), []

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        def join(row: int, similar: np.ndarray) -> None:
            for other in similar.tolist():
                a, b = find(row), find(other)
                if a != b:
                    root[max(a, b)] = min(a, b)
                    links.append((row, other))

        def outside() -> list[int]:
            """Rows that are not of the largest class. Pairs within that class need no comparison."""
            of = np.array([find(x) for x in range(self.n)])
            return np.flatnonzero(of != np.bincount(of).argmax()).tolist()

        left, asked = list(range(self.n)), set()
        for _ in range(PIVOTS):
            fresh = [x for x in left if x not in asked]
            if not fresh:
                return links
            asked.add(fresh[0])
            join(fresh[0], self.against_all(fresh[0], threshold))
            left = outside()
        for row in left:
            if row not in asked:
                join(row, self.by_index(row, threshold))
        return links


def links(members: DataFrame, texts: DataFrame, idf, size: int, threshold: float) -> DataFrame:
    """(a, b): links that connect all similar members (bucket, id) of a bucket. ``texts`` is (id, text)."""
    # buckets with the same members count once: by their number and two sums over hashes of the ids
    number = F.xxhash64("id")
    told = members.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(number).alias("x"), F.sum(F.shiftright(number, 24)).alias("s")
    )
    once = told.groupBy("n", "x", "s").agg(F.min("bucket").alias("bucket")).select("bucket", "n")
    blocks = F.ceil(F.col("n") / BLOCK)
    placed = (
        members.join(once, "bucket")
        .withColumn("own", F.pmod(number, blocks))
        .select("bucket", "id", "own", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("other"))
        .select("bucket", "id", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    )

    def connect(table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("id").to_numpy(), kind="stable")
        ids = table.column("id").to_numpy()[order]
        text = pa.concat_arrays([c.cast(pa.large_binary()) for c in table.column("text").chunks])
        found = Block(text.take(pa.array(order)), idf.value, size).forest(threshold)
        a, b = (np.array([pair[k] for pair in found], np.int64) for k in (0, 1))
        return pa.table({"a": pa.array(ids[a], pa.int64()), "b": pa.array(ids[b], pa.int64())})

    return placed.join(texts, "id").groupBy("bucket", "i", "j").applyInArrow(connect, "a long, b long")


def classes(docs: DataFrame, size: int = SHINGLE, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, class_id, kept), one row for each row of ``docs``; the smallest doc_id of a class stays.

    Equal sequences of words are one class. Texts without words, nulls included, are like none and stay, as does a row
    without doc_id, whose class is null. Rows that share a doc_id are one document. Texts of fewer words than a shingle
    are one shingle. Only doc_id and text are read.
    """
    spark = docs.sparkSession
    frequencies, documents = document_frequencies(docs, size)
    idf = spark.sparkContext.broadcast(idf_table(frequencies, documents))
    signed = settle(signatures(docs, idf, size), "near-signatures")
    best = signed.groupBy("digest").agg(F.min(F.struct("doc_id", "bands")).alias("best"))
    heads = settle(best.select("digest", "best.*"), "near-heads")
    heads = heads.withColumnRenamed("doc_id", "id")
    placed = heads.select("id", F.explode("bands").alias("bucket"))
    shared = placed.groupBy("bucket").count().where("count > 1").select("bucket")
    members = settle(placed.join(shared, "bucket", "left_semi"), "near-members")
    wanted = members.select("id").distinct()
    texts = docs.select(F.col("doc_id").alias("id"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    texts = settle(texts.join(wanted, "id", "left_semi").groupBy("id").agg(F.max("text").alias("text")), "near-texts")
    roots = components(settle(links(members, texts, idf, size, threshold), "near-links"))
    named = heads.join(roots, "id", "left").select("digest", F.coalesce("root", "id").alias("class_id"))
    of_digest = settle(named, "near-classes")
    # rows that share a doc_id have one class: the smallest of their texts'
    of_document = signed.select("doc_id", "digest").join(of_digest, "digest")
    of_document = of_document.groupBy("doc_id").agg(F.min("class_id").alias("class_id"))
    found = docs.select("doc_id").join(of_document, "doc_id", "left")
    class_id = F.coalesce("class_id", "doc_id")
    return found.select(
        "doc_id", class_id.alias("class_id"), F.coalesce(class_id == F.col("doc_id"), F.lit(True)).alias("kept")
    )


def keep_one(docs: DataFrame, size: int = SHINGLE, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that stay, one document of each class, with all their columns."""
    gone = classes(docs, size, threshold).where("NOT kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)
