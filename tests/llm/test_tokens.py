import random
import uuid
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from stridewatch.llm import packing, simple8b, token_counts, tokens
from stridewatch.llm.tokens import Encoder

from .conftest import odd_pairs

WORD, BYTE = (public_tokenizers.path(f) for f in ("word_bpe_49k.json", "byte_bpe_50k.json"))
PIECES = [
    "a", "Z", "é", "É", "\u0301", "H", "\u0331", " ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", "\u3000", ".", ",",
    "'s", "'", "1", "23", "<|endoftext|>", "<|startoftext|>", "the ", "hello", "日本", "😀", "\x01", "\x00", "İ", "Σ",
]


@pytest.mark.parametrize("path,cut", [(WORD, "drop"), (BYTE, "space")])
def test_pieces_give_the_ids_of_whole_texts(path, cut):
    rng = random.Random(3)
    plain, ours = Tokenizer.from_file(path), Encoder(path, cut)
    for _ in range(60):
        texts = ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 30))) for _ in range(40)] + ["", " ", " a "]
        ids, at = ours.ids(pa.array(texts))
        for i, text in enumerate(texts):
            assert ids[at[i] : at[i + 1]].tolist() == plain.encode(text, add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize("path,cut", [(WORD, "drop"), (BYTE, "space")])
def test_pieces_that_hold_the_separator(path, cut):
    """The special token that parts pieces in one call also stands in texts, with and without spaces around it."""
    ours, plain = Encoder(path, cut), Tokenizer.from_file(path)
    mark, number = ours.between
    assert plain.token_to_id(mark) == number
    texts = [f"a {mark} b", f"a{mark}b c", mark, mark * 3, f"{mark[:-1]} x", f"end {mark}", "plain words only", ""]
    ids, at = ours.ids(pa.array(texts))
    for i, text in enumerate(texts):
        assert ids[at[i] : at[i + 1]].tolist() == plain.encode(text, add_special_tokens=False).ids, text


def test_words_of_letters_reach_the_model_alone(monkeypatch):
    """Words of Latin letters take no other step of the library, and have the ids that every step gives."""
    ours, plain = Encoder(WORD, "drop"), Tokenizer.from_file(WORD)
    stepped = []
    every_step = ours._encode
    monkeypatch.setattr(ours, "_encode", lambda pieces: stepped.extend(pieces) or every_step(pieces))
    letters = [chr(c) for c in [*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC0, 0x180), 0x17F, 0x1C5, 0x3A3, 0x307]]
    rng = random.Random(5)
    words = ["".join(rng.choices(letters, k=rng.randint(1, 9))) for _ in range(400)] + letters + ["ÉCOLE", "Straße", "ŸÀž"]
    tails = [".", ",", "!!", "...", "'", "'s", "_", "<|", "<|endoftext|>", ",'", "&&&", "1", ".a"]
    words += [word + tail for word in ["plain", "İ", "é", "e\u0301", "don't", ""] for tail in tails]
    ids, at = ours.ids(pa.array(words))
    for i, word in enumerate(words):
        assert ids[at[i] : at[i + 1]].tolist() == plain.encode(word, add_special_tokens=False).ids, word
    assert not {"ÉCOLE", "Straße", "ŸÀž", "a", "Z", "plain!!", "é&&&"} & set(stepped) and {"İ", "ŉ", "Σ"} <= set(stepped)
    assert not Encoder(BYTE, "space").direct


def test_segments_are_encoded_in_small_slices():
    """What a worker holds at once is bounded by the slice, not by the batch."""
    assert simple8b.SLICE_BYTES <= 4 << 20 and tokens.KEPT_WORDS <= 250_000
    assert Encoder(WORD, "drop").memo.most == tokens.KEPT_WORDS


def test_only_what_comes_twice_is_kept():
    memo = tokens.RepeatMemo(10, marks=64)
    for key in range(200):
        memo.offer(key % 5, key)
    assert set(memo.look_up(list(range(5)))) != {None} and len(memo.young) <= 10
    fresh = tokens.RepeatMemo(10)
    fresh.offer("once", b"1")
    assert fresh.look_up(["once"]) == [None]
    fresh.offer("once", b"1")
    assert fresh.look_up(["once"]) == [b"1"]


def test_memo_forgets_but_stays_right():
    ours, plain = Encoder(WORD, "drop"), Tokenizer.from_file(WORD)
    ours.memo.most = 5
    for text in ("alpha beta gamma delta", "epsilon alpha zeta eta theta beta", "alpha beta alpha iota kappa"):
        assert ours.ids(pa.array([text]))[0].tolist() == plain.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize(
    "ids",
    [
        [],
        [0],
        [1] * 700,
        list(range(1000)),
        [2**60, 5, 2**63, 0, 2**64 - 1],
        [2**b for b in range(61)] * 9,
        [int(x) for x in np.random.default_rng(1).integers(0, 49408, 5000)],
        [int(2**x) for x in np.random.default_rng(2).uniform(0, 30, 5000)],
    ],
)
def test_words_round_trip(ids):
    ids = np.array(ids, np.uint64)
    words, escapes, offsets = simple8b.pack(ids)
    assert (simple8b.unpack(words, escapes) == ids).all()
    assert len(offsets) == -(-len(ids) // simple8b.BLOCK)
    if len(ids):
        a, b = len(ids) // 3, max(len(ids) // 3 + 1, len(ids) * 2 // 3)
        assert (simple8b.unpack_range(words, escapes, offsets, a, b) == ids[a:b]).all()
    if len(ids) > 100 and ids.max() < 2:
        assert len(words) < len(ids) / 40


def expected_ids():
    plain = Tokenizer.from_file(WORD)
    pairs = sorted(odd_pairs(), key=lambda p: (p[0] is not None, p[0] or 0, p[1] or ""))
    return [(i, plain.encode(t or "", add_special_tokens=False).ids + [1]) for i, t in pairs]


def test_token_files(spark, odd, empty, tmp_path):
    path = str(tmp_path / "tokens")
    simple8b.write_tokens(odd, path, WORD, "drop", 1)
    segments = simple8b.read_segments(spark, path)
    got = sorted(simple8b.document_digests(segments).collect(), key=lambda r: r.start)
    start = 0
    for row, (doc_id, ids) in zip(got, expected_ids(), strict=True):
        assert (row.doc_id, row.start, row.n_tokens) == (doc_id, start, len(ids))
        assert row.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    whole = {r.doc_id: r.ids for r in simple8b.decode_documents(segments).collect()}
    assert whole[12] == dict(expected_ids())[12]
    simple8b.write_tokens(empty, path + "-none", WORD, "drop", 1)
    assert simple8b.document_digests(simple8b.read_segments(spark, path + "-none")).count() == 0


def test_counts_come_from_the_cache(spark, odd, empty, make, tmp_path):
    path = str(tmp_path / uuid.uuid4().hex)
    plain = Tokenizer.from_file(BYTE)
    got = token_counts.token_counts(odd, path, BYTE, limit=10).collect()
    want = [(i, len((t or "").encode()), len(plain.encode(t or "", add_special_tokens=False).ids)) for i, t in odd_pairs()]
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(((r.doc_id, r.n_bytes, r.n_tokens) for r in got), key=key) == sorted(want, key=key)
    assert all(r.over_limit == (r.n_tokens > 10) for r in got)
    stored = spark.read.parquet(path).count()
    assert stored == len({t or "" for _, t in odd_pairs()})
    # a stored count is used, not made again
    spark.read.parquet(path).createOrReplaceTempView("stored")
    token_counts.extend_cache(odd, path, BYTE)
    assert spark.read.parquet(path).count() == stored
    more = make([(1, "One two three."), (2, "quite new")])
    assert token_counts.token_counts(more, path, BYTE, limit=10).count() == 2
    assert spark.read.parquet(path).count() == stored + 1
    assert token_counts.token_counts(empty, path + "-none", BYTE, limit=10).count() == 0


def check_packing(pieces, want, window):
    by_doc = {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
    windows = {}
    for p in pieces:
        windows.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for parts in windows.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= window
    assert sum(p.length for p in pieces) == sum(len(ids) for _, ids in want)
    full = sum(len(ids) for _, ids in want) / window
    assert len(windows) <= full + 1
    for doc_id, ids in want:
        if sum(d == doc_id for d, _ in want) == 1:
            at = 0
            for p in sorted(by_doc[doc_id], key=lambda p: p.start):
                assert p.start == at and p.doc_tokens == len(ids)
                assert p.ids_crc32 == zlib.crc32(np.array(ids[at : at + p.length], "<u4").tobytes())
                at += p.length
            assert at == len(ids)


@pytest.mark.parametrize("window", [2048, 64, 7])
def test_packing(odd, window):
    check_packing(packing.pack(odd, WORD, "drop", 1, window).collect(), expected_ids(), window)


def test_packing_nothing(empty):
    assert packing.pack(empty, WORD, "drop", 1, 64).count() == 0


def test_least_squares_uses_what_fits():
    histogram = np.zeros(100, np.int64)
    histogram[[40, 60, 20, 30, 50]] = [50, 70, 10, 5, 5]
    plan = packing.solve(histogram, 100)
    assert plan.placed[40] == 50 and plan.placed[60] >= 50  # 40 + 60 fills a window
    assert plan.combined >= 50
    parts = packing.combinations(np.array([20, 30, 40, 50, 60]), 100)
    assert sorted(map(tuple, parts.tolist())) == [(0, 40, 60), (0, 50, 50), (20, 20, 60), (20, 30, 50), (20, 40, 40), (30, 30, 40)]
    counts = packing.repeat_counts(parts, histogram)
    assert (counts >= 0).all() and np.isfinite(counts).all()
