"""Substring dedup with automata of repeated phrases.

A window is ``WINDOW`` consecutive words. Of all places where a window's words stand, the first one (smallest
doc_id, then smallest start) stays, and the words of the others go.

1. Anchors. In each window the phrase of ``PHRASE`` words with the smallest hash is its anchor. Equal
   windows have equal anchors, so a window can only recur if its anchor does. Anchors are counted over all documents.
2. Automata. Documents are dealt into shards of bounded size. The recurring phrases of a shard are compiled into an
   Aho-Corasick automaton over words, and the shard's documents are streamed through it: it finds every
   occurrence, hence every window that may recur.
3. Passages. These windows, one row for each shard they stand in, are confirmed by their count over all shards, and
   get their first place. They go back to the shards that hold a later one.
4. Removal. Each shard's documents meet the confirmed windows of the shard; words under a later place go.

Anchors and windows of a shard are merged before they are shuffled, so what a phrase in very many documents
sends is one row a shard, not one a document.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import mix, settle, slices, window_hashes, word_hashes, word_spans

WINDOW = 20
PHRASE = 8
SHARD_BYTES = 4 << 20
#: Characters of each digit of a word's code in an automaton.
DIGIT = 64
NO_ID = -(2**63)

_TEXTS = pa.schema([("doc_id", pa.int64()), ("text", pa.binary())])


class Words:
    """The words of some texts: bytes, spans, hashes, and which windows lie in one text."""

    def __init__(self, texts: pa.Array, size: int, phrase: int):
        self.data, self.starts, self.ends, self.before = word_spans(texts)
        self.hashes = word_hashes(self.data, self.starts, self.ends)
        self.text = np.repeat(np.arange(len(texts)), np.diff(self.before))
        self.size, self.phrase = size, phrase
        n = max(len(self.hashes) - size + 1, 0)
        whole = self.text[:n] == self.text[size - 1 :] if n else np.zeros(0, bool)
        self.windows = np.flatnonzero(whole)

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """(hashes of all phrases, place of the anchor of each window)."""
        phrases = window_hashes(self.hashes, self.phrase)
        if not len(self.windows):
            return phrases, np.zeros(0, np.int64)
        span = self.size - self.phrase + 1
        view = np.lib.stride_tricks.sliding_window_view(phrases, span)
        places = np.empty(len(self.windows), np.int64)
        for i in range(0, len(self.windows), 1 << 17):
            at = self.windows[i : i + (1 << 17)]
            places[i : i + len(at)] = at + view[at].argmin(axis=1)
        return phrases, places

    def window_keys(self) -> tuple[np.ndarray, np.ndarray]:
        """(hash, check) of each window: 96 bits that stand for its words."""
        key = window_hashes(self.hashes, self.size)[self.windows]
        other = window_hashes(mix(self.hashes ^ np.uint64(0x5DEECE66D)), self.size)[self.windows]
        return key.view(np.int64), (other >> np.uint64(32)).astype(np.uint32).view(np.int32)


def anchors(docs: DataFrame, shards: int, size: int, phrase: int) -> DataFrame:
    """(anchor, shard, n): anchors of all windows, merged within a batch."""

    def count(batches):
        for batch in batches:
            for lo, hi in slices(batch.column(1)):
                words = Words(batch.column(1).slice(lo, hi - lo), size, phrase)
                phrases, places = words.anchors()
                places = np.unique(places)
                shard = batch.column(0).slice(lo, hi - lo).to_numpy(zero_copy_only=False)[words.text[places]]
                order = np.lexsort((shard, phrases[places]))
                found, shard = phrases[places][order], shard[order]
                first = np.flatnonzero(np.append(True, (found[1:] != found[:-1]) | (shard[1:] != shard[:-1])))
                first = first[: len(found)]
                n = np.diff(np.append(first, len(found)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found[first].view(np.int64)), pa.array(shard[first]), pa.array(n, pa.int32())],
                    ["anchor", "shard", "n"],
                )

    texts = docs.select(_shard(shards), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    return texts.mapInArrow(count, "anchor long, shard int, n int")


def _shard(shards: int):
    return F.pmod(F.xxhash64("doc_id"), F.lit(shards)).cast("int").alias("shard")


def parcels(docs: DataFrame, shards: int) -> DataFrame:
    """(shard, parcel): the documents of a batch that go to a shard, compressed together."""

    def wrap(batches):
        options = pa.ipc.IpcWriteOptions(compression="zstd")
        for batch in batches:
            shard = batch.column(0).to_numpy(zero_copy_only=False)
            order = np.argsort(shard, kind="stable")
            cuts = np.flatnonzero(np.diff(shard[order])) + 1
            texts = pa.RecordBatch.from_arrays([batch.column(1), batch.column(2)], schema=_TEXTS)
            numbers, out = [], []
            for rows in np.split(order, cuts) if len(order) else []:
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, _TEXTS, options=options) as stream:
                    stream.write_batch(texts.take(pa.array(rows)))
                numbers.append(int(shard[rows[0]]))
                out.append(sink.getvalue().to_pybytes())
            yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int32()), pa.array(out, pa.binary())], ["shard", "parcel"])

    rows = docs.select(_shard(shards), F.col("doc_id"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    return rows.mapInArrow(wrap, "shard int, parcel binary")


def _unwrap(table: pa.Table) -> tuple[np.ndarray, pa.Array, pa.Array]:
    """(order of the documents' ids, null ones as the smallest number; ids; texts) of parcels."""
    read = [pa.ipc.open_stream(parcel).read_all() for parcel in table.column("parcel").to_pylist()]
    texts = pa.concat_tables(read).combine_chunks()
    ids = texts.column("doc_id").combine_chunks()
    text = texts.column("text").combine_chunks()
    if isinstance(text, pa.ChunkedArray):  # more than 2 GB
        text = pa.concat_arrays([c.cast(pa.large_binary()) for c in text.chunks])
    ids = ids if isinstance(ids, pa.Array) else pa.concat_arrays(ids.chunks)
    return ids.fill_null(NO_ID).to_numpy(zero_copy_only=False), ids, text


def phrase_places(words: Words, wanted: np.ndarray) -> np.ndarray:
    """Places of all phrases whose hash is in ``wanted``, found by an automaton over the words."""
    import ahocorasick

    phrases = window_hashes(words.hashes, words.phrase)
    known = np.sort(wanted)
    if not len(known) or not len(phrases):
        return np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(known, phrases), len(known) - 1)
    _, sample = np.unique(np.where(known[at] == phrases, at, -1), return_index=True)
    sample = sample[known[at[sample]] == phrases[sample]]
    if not len(sample):
        return np.zeros(0, np.int64)
    # each word of these phrases as digits, every digit of another alphabet: a node of the automaton is searched child by
    # child, and with a character for each word the first node would have a child for each of them
    named = np.unique(words.hashes[sample[:, None] + np.arange(words.phrase)])
    digits = 1
    while DIGIT**digits < len(named):
        digits += 1
    code = np.minimum(np.searchsorted(named, words.hashes), len(named) - 1)
    other = named[code] != words.hashes
    stream = np.empty((len(code), digits), "<u4")
    for k in range(digits):
        stream[:, k] = 1 + k * DIGIT + code // DIGIT**k % DIGIT
    stream[other] = 0
    stream = stream.tobytes().decode("utf-32-le")
    automaton = ahocorasick.Automaton()
    for place in (digits * sample).tolist():
        automaton.add_word(stream[place : place + digits * words.phrase], True)
    automaton.make_automaton()
    ends = np.fromiter((end for end, _ in automaton.iter(stream)), np.int64)
    places = (ends + 1) // digits - words.phrase
    # a phrase may run over two texts: the hash of its words decides
    return places[known[at[places]] == phrases[places]]


def candidates(docs: DataFrame, recurring: DataFrame, shards: int, size: int, phrase: int) -> DataFrame:
    """(key, check, shard, doc_id, start, n): windows whose anchor recurs, with their first place in the shard."""

    def locate(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return _CANDIDATE.empty_table()
        order, _, texts = _unwrap(left)
        words = Words(texts, size, phrase)
        wanted = np.unique(right.column("anchor").to_numpy().view(np.uint64))
        marked = np.zeros(len(words.hashes) + 1, bool)
        marked[phrase_places(words, wanted)] = True
        _, anchor = words.anchors()
        here = np.flatnonzero(marked[anchor])
        key, check = (k[here] for k in words.window_keys())
        place = words.windows[here]
        doc = order[words.text[place]]
        start = place - words.before[words.text[place]]
        rank = np.lexsort((start, doc, check, key))
        key, check, doc, start = key[rank], check[rank], doc[rank], start[rank]
        first = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (check[1:] != check[:-1])))[: len(key)]
        n = np.diff(np.append(first, len(key)))
        shard = np.full(len(first), left.column("shard")[0].as_py(), np.int32)
        columns = [key[first], check[first], shard, doc[first], start[first], n]
        return pa.table([pa.array(c).cast(f.type) for c, f in zip(columns, _CANDIDATE)], schema=_CANDIDATE)

    return (
        parcels(docs, shards)
        .groupBy("shard")
        .cogroup(recurring.groupBy("shard"))
        .applyInArrow(locate, "key long, check int, shard int, doc_id long, start int, n int")
    )


_CANDIDATE = pa.schema(
    [
        ("key", pa.int64()),
        ("check", pa.int32()),
        ("shard", pa.int32()),
        ("doc_id", pa.int64()),
        ("start", pa.int32()),
        ("n", pa.int32()),
    ]
)
_KEPT = pa.schema(
    [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.binary())]
)


def removal(docs: DataFrame, passages: DataFrame, shards: int, size: int, phrase: int) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) given the windows (key, check, shard, first_doc, first_start) that recur."""

    def remove(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return _KEPT.empty_table()
        order, ids, texts = _unwrap(left)
        words = Words(texts, size, phrase)
        gone = np.zeros(len(words.hashes) + 1, np.int64)
        if right.num_rows and len(words.windows):
            known = right.column("key").to_numpy()
            rank = np.lexsort((right.column("check").to_numpy(), known))
            known = known[rank]
            checks, docs_, starts = (right.column(c).to_numpy()[rank] for c in ("check", "first_doc", "first_start"))
            key, check = words.window_keys()
            doc = order[words.text[words.windows]]
            start = words.windows - words.before[words.text[words.windows]]
            at = np.searchsorted(known, key)
            later = np.zeros(len(key), bool)
            open_ = np.flatnonzero((at < len(known)) & (known[np.minimum(at, len(known) - 1)] == key))
            while len(open_):  # once more only for windows that share the hash and differ in the check
                i = at[open_]
                same = checks[i] == check[open_]
                hit, j = open_[same], i[same]
                later[hit] = (docs_[j] < doc[hit]) | ((docs_[j] == doc[hit]) & (starts[j] < start[hit]))
                open_ = open_[~same]
                at[open_] += 1
                open_ = open_[at[open_] < len(known)]
                open_ = open_[known[at[open_]] == key[open_]]
            np.add.at(gone, words.windows[later], 1)
            np.subtract.at(gone, words.windows[later] + size, 1)
        covered = np.cumsum(gone[:-1]) > 0
        removed = np.diff(np.concatenate([[0], np.cumsum(covered)])[words.before])
        return pa.table(
            [
                ids,
                pa.array(np.diff(words.before), pa.int64()),
                pa.array(removed, pa.int64()),
                pa.array(_kept_texts(words, covered), pa.binary()),
            ],
            schema=_KEPT,
        )

    return (
        parcels(docs, shards)
        .groupBy("shard")
        .cogroup(passages.groupBy("shard"))
        .applyInArrow(remove, "doc_id long, n_words long, n_removed long, kept binary")
    )


def _kept_texts(words: Words, covered: np.ndarray) -> list[bytes]:
    """The words that stay, joined by one space, for each text."""
    out, raw = [], words.data.tobytes()
    starts, ends, before = words.starts.tolist(), words.ends.tolist(), words.before.tolist()
    any_covered = np.diff(np.concatenate([[0], np.cumsum(covered)])[words.before]) > 0
    for t in range(len(before) - 1):
        a, b = before[t], before[t + 1]
        if a == b:
            out.append(b"")
        elif not any_covered[t]:
            out.append(b" ".join(raw[starts[a] : ends[b - 1]].split()))
        else:
            out.append(b" ".join([raw[starts[i] : ends[i]] for i in (a + np.flatnonzero(~covered[a:b])).tolist()]))
    return out


def shards_for(docs: DataFrame, shard_bytes: int = SHARD_BYTES) -> int:
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0  # one number
    return max(1, -(-total // shard_bytes))


def dedup_passages(
    docs: DataFrame, size: int = WINDOW, phrase: int = PHRASE, shard_bytes: int = SHARD_BYTES
) -> DataFrame:
    """(doc_id, n_words, n_removed, kept), one row for each row of ``docs``.

    ``kept`` has the words that stay, joined by one space, in UTF-8. Null texts have no words; a null doc_id is smaller than
    all others. Rows that share a doc_id count as one document in which starts are compared, so equal rows
    lose the same words. Only doc_id and text are read.
    """
    if not 0 < phrase <= size:
        raise ValueError("a phrase has at least one word and at most as many as the window")
    shards = shards_for(docs, shard_bytes)
    counted = anchors(docs, shards, size, phrase)
    often = counted.groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1").select("anchor")
    recurring = settle(counted.select("anchor", "shard").join(often, "anchor", "left_semi"), "anchors")
    found = candidates(docs, recurring, shards, size, phrase)
    everywhere = Window.partitionBy("key", "check")
    first = F.min(F.struct("doc_id", "start")).over(everywhere)
    confirmed = found.select(
        "key", "check", "shard", "doc_id", "start", "n", first.alias("first"), F.sum("n").over(everywhere).alias("total")
    ).where("total > 1")
    # a shard whose only copy is the first of all has nothing to remove
    confirmed = confirmed.where("n > 1 OR first.doc_id <> doc_id OR first.start <> start")
    passages = confirmed.select(
        "key", "check", "shard", F.col("first.doc_id").alias("first_doc"), F.col("first.start").alias("first_start")
    )
    return removal(docs, passages, shards, size, phrase)


def digests(kept: DataFrame) -> DataFrame:
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))

