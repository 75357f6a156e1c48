import hashlib
import random
import sys
import tracemalloc
from collections import Counter

import pyarrow as pa
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from stridewatch.llm import alignment

from .conftest import odd_pairs
from .test_tokens import PIECES

A, B = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def plain():
    """(A ids, their bytes, B ids, their bytes) of whole texts, from the vocabularies alone."""
    one, two = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    one.encode_special_tokens = True
    to_byte = alignment.byte_characters()

    def tokens(text):
        ids = one.encode(" " + text, add_special_tokens=False).ids
        others = two.encode(text)
        names = [two.id_to_piece(i) for i in others]
        return (
            ids,
            [bytes(to_byte[c] for c in one.id_to_token(i)) for i in ids],
            others,
            [bytes([int(s[3:5], 16)]) if two.is_byte(i) else s.replace("▁", " ").encode() for i, s in zip(others, names)],
        )

    return tokens


def ends(parts):
    out, at = [], 0
    for part in parts:
        at += len(part)
        out.append(at)
    return out


def plain_groups(tokens, text):
    a, a_bytes, b, b_bytes = tokens(text or "")
    raw = (" " + (text or "")).encode()
    if not text or b"".join(a_bytes) != raw or b"".join(b_bytes) != raw:
        return []
    a_ends, b_ends = ends(a_bytes), ends(b_bytes)
    common = set(a_ends) & set(b_ends)
    sides = []
    for ids, at in ((a, a_ends), (b, b_ends)):
        groups = [[]]
        for i, end in zip(ids, at):
            groups[-1].append(i)
            if end in common:
                groups.append([])
        sides.append(groups[:-1])
    return list(zip(*sides, strict=True))


def plain_rows(tokens, pairs):
    split = [(i, plain_groups(tokens, t)) for i, t in pairs]
    linked = [Counter((x, y) for a, b in groups for x in a for y in b) for _, groups in split]
    count = Counter(pair for links in linked for pair in links)
    highest = {}
    for (a, _), n in count.items():
        highest[a] = max(highest.get(a, 0), n)
    out = []
    for (i, groups), links in zip(split, linked):
        text = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)
        out.append(
            (
                i,
                sum(len(a) for a, _ in groups),
                sum(len(b) for _, b in groups),
                len(groups),
                sum(links.values()),
                sum(n for pair, n in links.items() if count[pair] == highest[pair[0]]),
                sum(n * count[pair] for pair, n in links.items()),
                hashlib.sha256(text.encode()).hexdigest() if groups else "",
            )
        )
    return out


def mixed(n, seed=6):
    rng = random.Random(seed)
    pieces = PIECES + ["<s>", "▁", "𓀀", "ﬁ", "\r\n", "​", "ing", "tion ", "word", " word", "naïve ", "Zürich", "0.5%", "end.\nNext", "x.\n", "²."]
    return ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 30))) for _ in range(n)]


def key(row):
    return tuple((x is None, x) for x in row)


def test_pieces_give_the_groups_of_whole_texts(plain):
    aligner = alignment.Aligner(A, B)
    for lo in range(0, 900, 90):
        texts = mixed(900)[lo : lo + 90]
        found = aligner.block(pa.array(texts))
        for t, text in enumerate(texts):
            groups = plain_groups(plain, text)
            spelled = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)
            assert found["digests"][t] == (hashlib.sha256(spelled.encode()).hexdigest() if groups else ""), repr(text)
            links = Counter(x * aligner.b_size + y for a, b in groups for x in a for y in b)
            span = slice(found["before"][t], found["before"][t + 1])
            pairs = found["pairs"][found["which"][span]].tolist()
            assert dict(zip(pairs, found["times"][span].tolist())) == dict(links)


def test_large_groups_and_single_units_are_the_same(plain, monkeypatch):
    texts = mixed(80, 12)
    want = alignment.Aligner(A, B).block(pa.array(texts))
    monkeypatch.setattr(alignment, "LARGE_GROUP", 0)
    got = alignment.Aligner(A, B).block(pa.array(texts))
    assert got["digests"] == want["digests"]
    for name in ("pairs", "holders", "before", "which", "times"):
        assert (got[name] == want[name]).all()


def test_units_of_several_pieces_are_aligned_once():
    aligner = alignment.Aligner(A, B)
    values, units, count = aligner.values([" one\nTwo", " two", " six\nTwo", " one"])
    assert count.tolist() == [3, 1, 3, 1]
    assert len(values) == len(set(units.tolist())) == 5  # one, Two, two, six, the line end
    assert units[0] == units[7] and units[1] == units[5] and units[2] == units[6]
    assert values[units[3]] == aligner.values([" two"])[0][0]


def test_texts_that_do_not_spell_are_done_alone_beside_others(plain, monkeypatch):
    """Few units a text and few texts at once: ends of both fall between any two units."""
    texts = mixed(200, 21) + ["same words in all of them"] * 3
    want = alignment.Aligner(A, B).block(pa.array(texts))
    monkeypatch.setattr(alignment, "TOGETHER", 3)
    monkeypatch.setattr(alignment, "AT_ONCE", 7)
    spans, told = alignment.Aligner._spans, []

    def some(self, units):
        found = spans(self, units)
        told.append(found is not None and len(told) % 3 != 0)
        return found if told[-1] else None

    monkeypatch.setattr(alignment.Aligner, "_spans", some)
    got = alignment.Aligner(A, B).block(pa.array(texts))
    assert any(told) and not all(told)
    assert got["digests"] == want["digests"]
    for name in ("pairs", "holders", "before", "which", "times"):
        assert (got[name] == want[name]).all()


def test_large_groups_beside_small_ones(monkeypatch):
    texts = mixed(80, 12)
    want = alignment.Aligner(A, B).block(pa.array(texts))
    alone, done = alignment.Aligner._alone, []
    monkeypatch.setattr(alignment, "LARGE_GROUP", 3)
    monkeypatch.setattr(alignment.Aligner, "_alone", lambda self, unit: done.append(unit) or alone(self, unit))
    aligner = alignment.Aligner(A, B)
    got = aligner.block(pa.array(texts))
    large = [u for u in done if alignment._PLAIN.fullmatch(u)]
    assert large and "".join(large) != " ".join(texts)
    assert got["digests"] == want["digests"]
    for name in ("pairs", "holders", "before", "which", "times"):
        assert (got[name] == want[name]).all()


def test_slices_of_a_block_give_the_same(monkeypatch):
    texts = mixed(120, 31) + ["", "same words in all of them", "x" * 900]
    want = alignment.Aligner(A, B).block(pa.array(texts))
    monkeypatch.setattr(alignment, "SLICE_BYTES", 300)
    got = alignment.Aligner(A, B).block(pa.array(texts))
    assert got["digests"] == want["digests"]
    for name in ("pairs", "holders", "before", "which", "times"):
        assert len(got[name]) == len(want[name]) and (got[name] == want[name]).all()
    for one, other in zip(got["sums"], want["sums"], strict=True):
        assert (one == other).all()


def test_pairs_linked_more_often_than_an_entry_counts(monkeypatch):
    texts = mixed(80, 12) + ["\n".join(["of"] * 9), " " * 40 + "a"]
    want = alignment.Aligner(A, B).block(pa.array(texts))
    monkeypatch.setattr(alignment, "LARGE_GROUP", 0)
    monkeypatch.setattr(alignment, "MOST_TIMES", 2)
    got = alignment.Aligner(A, B).block(pa.array(texts))
    assert want["times"].max() > 4
    assert got["digests"] == want["digests"]
    for name in ("pairs", "holders", "before", "which", "times"):
        assert (got[name] == want[name]).all()
    assert (got["sums"][3] == want["sums"][3]).all()


def test_numbers_stay_whole_when_narrow():
    for numbers in ([], [0], [255], [256, 1], [65536], [2**32, 3]):
        raw = alignment._narrow(alignment.np.array(numbers, alignment.np.int64)).tobytes()
        assert alignment._widen(pa.py_buffer(raw), len(numbers)).tolist() == numbers


def test_a_worker_aligns_a_block_in_little_memory(make):
    """Its arrays, what it remembers of a unit, and what it sends on for a pair of a document."""
    rng = random.Random(17)
    words = ["".join(rng.choice(["th", "an", "er", "ou", "st", "ly", "ing"]) for _ in range(rng.randint(1, 6))) for _ in range(3000)]
    texts = [" ".join(rng.choices(words, k=300)) for _ in range(1600)]
    block, aligner = pa.array(texts), alignment.Aligner(A, B)
    aligner.block(block), aligner.block(block)
    assert len(aligner.memo.young) > 1500
    kept = [v for value in aligner.memo.young.values() for v in (value if isinstance(value, tuple) else [value])]
    assert sum(map(sys.getsizeof, kept)) < 160 * len(aligner.memo.young)
    tracemalloc.start()
    found = aligner.block(block)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 50e6
    row = alignment.aligned_blocks(make(list(enumerate(texts)), 1), A, B).collect()[0]
    assert len(row.which) + len(row.times) < 4 * len(found["which"])


def test_alignment_equals_plain_python(make, odd, plain):
    pairs = odd_pairs() + [(100 + i, t) for i, t in enumerate(mixed(120, 9))] + [(7, "a tie"), (7, "a tie")]
    got = [tuple(r) for r in alignment.align(make(pairs), A, B).collect()]
    assert sorted(got, key=key) == sorted(plain_rows(plain, pairs), key=key)


def test_many_blocks_give_the_same(make, plain):
    """Rows in many partitions: each is a block at least."""
    pairs = [(i, t) for i, t in enumerate(mixed(60, 3))]
    got = [tuple(r) for r in alignment.align(make(pairs, 13), A, B).collect()]
    assert sorted(got) == sorted(plain_rows(plain, pairs))


def test_smallest_table_equals_plain_python(spark, sf_dir, plain):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    pairs = [(r.doc_id, r.text) for r in docs.collect()]
    got = [tuple(r) for r in alignment.align(docs, A, B).collect()]
    assert sorted(got, key=key) == sorted(plain_rows(plain, pairs), key=key)


def test_no_rows(empty):
    assert alignment.align(empty, A, B).count() == 0
