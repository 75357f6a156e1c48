import hashlib
import random

import numpy as np
import pytest

from stridewatch.llm import fingerprints
from stridewatch.llm.fingerprints import LEAST_CHUNKS, LEVELS, MOST_CHUNKS, fingerprint, similarities

from .conftest import odd_pairs

LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
M32, M64 = (1 << 32) - 1, (1 << 64) - 1


def plain_fingerprint(raw):
    """Byte by byte, from the definition."""
    triggers = []
    for i in range(len(raw)):
        x = sum(raw[i - k] * pow(0x01000193, k, 1 << 32) for k in range(min(7, i + 1))) & M32
        x ^= x >> 15
        x = x * 0x2C1B3C6D & M32
        x ^= x >> 13
        if x % 3 == 0:
            level, rest = 0, x // 3
            while level < LEVELS - 1 and rest % 2 == 0:
                level, rest = level + 1, rest // 2
            triggers.append((i + 1, level))
    level = 0
    while 3 * 2**level * MOST_CHUNKS < len(raw):
        level += 1
    while level and sum(k >= level for _, k in triggers) < LEAST_CHUNKS:
        level -= 1

    def signature(level):
        ends = [e for e, k in triggers if k >= level][: MOST_CHUNKS - 1]
        if raw and (not ends or ends[-1] < len(raw)):
            ends.append(len(raw))
        out, start = "", 0
        for end in ends:
            value, factor = 0, 1
            for byte in raw[start:end]:
                value, factor = (value + byte * factor) & M64, factor * 0x9E3779B97F4A7C15 & M64
            value = (value ^ (value >> 29)) * 0xBF58476D1CE4E5B9 & M64
            out, start = out + LETTERS[value >> 58], end
        return out

    return f"{3 << level}:{signature(level)}:{signature(level + 1)}"


def plain_likeness(a, b):
    if a == b:
        return 1.0
    (x, *s), (y, *t) = a.split(":"), b.split(":")
    blocks = [(int(x) * k, int(y) * m, s[k - 1], t[m - 1]) for k in (1, 2) for m in (1, 2)]
    best = 0.0
    for p, q, u, v in blocks:
        if p != q or not any(u[i : i + 4] in v for i in range(len(u) - 3)):
            continue
        row = list(range(len(v) + 1))
        for i, c in enumerate(u, 1):
            last, row[0] = row[0], i
            for j, d in enumerate(v, 1):
                last, row[j] = row[j], last if c == d else 1 + min(row[j], row[j - 1])
        best = max(best, 1 - row[-1] / (len(u) + len(v)))
    return best


def texts():
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdeghinorstu") for _ in range(rng.randint(1, 9))) for _ in range(300)]
    out = [" ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 3, 10, 60, 400]))) for _ in range(60)]
    return out + ["And " * 900, "\x00" * 500, "ü日😀" * 70]


def test_fingerprints_equal_plain_python(monkeypatch):
    raws = [t.encode() for t in texts()]
    want = [plain_fingerprint(r) for r in raws]
    assert [fingerprint(r) for r in raws] == want
    # a long text taken in by segments has the same fingerprint
    monkeypatch.setattr(fingerprints, "SEGMENT", 50)
    assert [fingerprint(r) for r in raws] == want


def test_likeness_equals_plain_edit_distance():
    rng = random.Random(2)
    prints = [fingerprint(t.encode()) for t in texts()]
    prints += [fingerprint(fingerprints.edited(a, b).encode()) for a, b in zip(texts(), texts()[1:])]
    pairs = [(rng.choice(prints), rng.choice(prints)) for _ in range(300)] + list(zip(prints, prints[63:]))
    got = similarities([a for a, _ in pairs], [b for _, b in pairs])
    assert np.allclose(got, [plain_likeness(a, b) for a, b in pairs])
    assert similarities([], []).tolist() == []


def plain_rows(pairs, hashes):
    order = sorted(pairs, key=lambda p: (p[0] is not None, p[0] or 0, hashes[p[1] or ""], p[1] or ""))
    out = []
    for (i, t), (_, following) in zip(order, order[1:] + order[:1]):
        t, following = t or "", following or ""
        half = len(t) // 2
        changed = (t[: len(t) - half] + following[:half]).encode()
        own, other = fingerprint(t.encode()), fingerprint(changed)
        near = plain_likeness(own, other), plain_likeness(own, fingerprint(following.encode()))
        out.append((i, len(t), hashlib.sha256(changed).hexdigest(), own, other, *near))
    return out


@pytest.mark.parametrize("parts", ["1", "3", "7"])
def test_next_documents(spark, make, odd, parts):
    from pyspark.sql import functions as F

    pairs = odd_pairs() + [(20 + i, t) for i, t in enumerate(texts())] + [(50, f"tie {k}") for k in range(20)]
    hashes = {r.t: r.h for r in spark.createDataFrame([(t or "",) for _, t in pairs], "t string").select(
        "t", F.xxhash64("t").alias("h")).collect()}
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = [tuple(r) for r in fingerprints.compare_with_next(make(pairs)).collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    want = plain_rows(pairs, hashes)
    key = lambda r: (r[0] is not None, r[0] or 0, r[1:5])
    for a, b in zip(sorted(got, key=key), sorted(want, key=key), strict=True):
        assert a[:5] == b[:5] and np.allclose(a[5:], b[5:])


def test_edited_halves_are_nearer_than_successors(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [r for r in fingerprints.compare_with_next(docs).collect() if r.n_chars >= 300]
    assert np.mean([r.near_edited > 0.3 for r in rows]) > 0.95
    assert np.mean([r.near_next < 0.3 for r in rows]) > 0.95


def test_few_rows(make, empty):
    assert fingerprints.compare_with_next(empty).count() == 0
    only = fingerprints.compare_with_next(make([(4, "one document alone")])).collect()
    assert [(r.doc_id, r.near_next) for r in only] == [(4, 1.0)]
