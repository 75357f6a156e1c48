import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stridewatch.llm import exact_dedup, near_dedup, substring_dedup

from .conftest import odd_pairs


def squeezed(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def check_exact(decisions, pairs):
    groups = {}
    for i, t in pairs:
        groups.setdefault(squeezed(t), []).append((-len(t or ""), i is None, i or 0, i))
    want = []
    for i, t in pairs:
        own = groups[squeezed(t)]
        keep = min(own)[3]
        want.append((i, keep, len(own), i == keep, hashlib.sha256(squeezed(t).encode()).hexdigest()))
    key = lambda r: tuple((x is None, x) for x in r)
    got = [(r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in decisions]
    assert sorted(got, key=key) == sorted(want, key=key)


def test_exact(odd, empty):
    check_exact(exact_dedup.dedup(odd).collect(), odd_pairs())
    assert exact_dedup.dedup(empty).count() == 0
    assert exact_dedup.keep_one(empty).count() == 0


def test_exact_many_shards(spark, make, monkeypatch):
    monkeypatch.setattr(exact_dedup, "SHARD_DIGESTS", 150)
    pairs = [(i, f"text {i % 700}" + " " * (i % 3)) for i in range(1500)]
    check_exact(exact_dedup.dedup(make(pairs)).collect(), pairs)


def test_perfect_hash_is_minimal_and_complete(spark):
    rows = [(hashlib.sha256(str(i).encode()).hexdigest(), i, 1) for i in range(5000)]
    index = exact_dedup.build(spark.createDataFrame(rows, "digest string, keep_id long, group_size long"))
    held = index.collect()
    assert sorted(r.slot for r in held) == list(range(5000))
    strangers = [(i, hashlib.sha256(f"x{i}".encode()).hexdigest(), 1) for i in range(3000)]
    found = exact_dedup.look_up(spark.createDataFrame(strangers, "doc_id long, text_sha256 string, n_chars long"), index)
    assert found.where("member").count() == 0


def test_history_removes_repeats_and_groups_the_rest(make):
    _, index = exact_dedup.dedup_against(make([(1, "a b"), (2, "c"), (3, "c ")]), exact_dedup.build(
        exact_dedup.grouped(exact_dedup.keyed(make([])))))
    decisions, _ = exact_dedup.dedup_against(make([(4, "ab"), (5, "new"), (6, "n e w"), (7, None)]), index)
    got = {r.doc_id: (r.member, r.keep_id, r.kept) for r in decisions.collect()}
    assert got == {4: (True, 1, False), 5: (False, 6, False), 6: (False, 6, True), 7: (False, 7, True)}


def test_exact_keeps_columns_and_one_row(odd):
    kept = exact_dedup.keep_one(odd)
    assert kept.columns == odd.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(5) == 1 and 4 not in ids and len(ids) == len({squeezed(t) for _, t in odd_pairs()})


def plain_removal(pairs, size):
    """(doc_id, text) -> (words, removed, kept) by the definition; equal doc_ids compare starts."""
    first = {}
    split = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in pairs]
    order = lambda i: (i is not None, i or 0)
    for i, words in split:
        for k in range(len(words) - size + 1):
            win = tuple(words[k : k + size])
            first[win] = min(first.get(win, (order(i), k)), (order(i), k))
    out = []
    for i, words in split:
        gone = set()
        for k in range(len(words) - size + 1):
            if first[tuple(words[k : k + size])] < (order(i), k):
                gone.update(range(k, k + size))
        kept = " ".join(w for k, w in enumerate(words) if k not in gone)
        out.append((i, len(words), len(gone), kept))
    return out


@pytest.mark.parametrize("size,phrase,shard_bytes", [(20, 8, 4 << 20), (20, 8, 3000), (4, 2, 500), (1, 1, 4000)])
def test_substring(odd, size, phrase, shard_bytes):
    got = substring_dedup.dedup_passages(odd, size, phrase, shard_bytes).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[3])
    rows = [(r.doc_id, r.n_words, r.n_removed, bytes(r.kept).decode()) for r in got]
    assert sorted(rows, key=key) == sorted(plain_removal(odd_pairs(), size), key=key)


def test_substring_random(make):
    rng = random.Random(4)
    vocabulary = ["a", "b", "c", "dd"]
    pairs = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 60)))) for i in range(80)]
    got = substring_dedup.dedup_passages(make(pairs), 6, 3, 300).collect()
    rows = sorted((r.doc_id, r.n_words, r.n_removed, bytes(r.kept).decode()) for r in got)
    assert rows == sorted(plain_removal(pairs, 6))


def test_automaton_has_few_children_a_node_and_finds_every_phrase(monkeypatch):
    """A node is searched child by child, so that many different first words must not be as many children of one node."""
    import ahocorasick

    added = []

    class Recorded:
        def __init__(self):
            self.real = plain()

        def __getattr__(self, name):
            return getattr(self.real, name)

        def add_word(self, word, value):
            added.append(word)
            return self.real.add_word(word, value)

    plain = ahocorasick.Automaton
    monkeypatch.setattr(ahocorasick, "Automaton", Recorded)
    rng = random.Random(8)
    texts = [" ".join(f"w{rng.randrange(n)}" for _ in range(2000)) for n in (3, 500, 9000)] + ["", "w1", "w1 w2 w3 w4"]
    words = substring_dedup.Words(pa.array([t.encode() for t in texts]), 20, 4)
    phrases = substring_dedup.window_hashes(words.hashes, 4)
    for wanted in (phrases[::3], phrases[:1], phrases[:0], phrases[:5] + np.uint64(1)):
        wanted = np.unique(wanted)
        found = substring_dedup.phrase_places(words, wanted)
        assert sorted(found.tolist()) == np.flatnonzero(np.isin(phrases, wanted)).tolist()
    for k in range(len(max(added, key=len))):
        assert len({word[k] for word in added if len(word) > k}) <= 64


def test_substring_nothing(empty):
    assert substring_dedup.digests(substring_dedup.dedup_passages(empty)).count() == 0


def brute_classes(pairs, idf, size=5, threshold=0.8):
    weights = []
    for _, t in pairs:
        s = near_dedup.Shingles(pa.array([t or ""]), size)
        weights.append(dict(zip(s.hashes.tolist(), (s.counts * idf[s.counters()]).tolist())))
    parent = list(range(len(pairs)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(weights):
        for j in range(i):
            b = weights[j]
            shared = sum(min(w, b[k]) for k, w in a.items() if k in b)
            if a and b and shared / (sum(a.values()) + sum(b.values()) - shared) >= threshold:
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return {pairs[i][0]: pairs[find(i)][0] for i in range(len(pairs))}


def near_pairs():
    rng = random.Random(9)
    pairs, base = [], [[f"w{rng.randint(0, 400)}" for _ in range(150)] for _ in range(12)]
    for i in range(160):
        words = list(base[i % 12]) if i % 3 else [f"u{rng.randint(0, 9000)}" for _ in range(60)]
        for _ in range(rng.choice([0, 0, 1, 2, 4])):
            words[rng.randrange(len(words))] = f"e{rng.randint(0, 9000)}"
        pairs.append((i, " ".join(words)))
    return pairs + [(900, ""), (901, None), (902, "two words"), (903, "two  words"), (904, "three other words")]


def test_near_equals_brute_force(spark, make):
    pairs = near_pairs()
    docs = make(pairs)
    idf = near_dedup.idf_table(*near_dedup.document_frequencies(docs, 5))
    got = {r.doc_id: (r.class_id, r.kept) for r in near_dedup.classes(docs).collect()}
    want = brute_classes(pairs, idf)
    assert {i: c for i, (c, _) in got.items()} == want
    assert all(kept == (c == i) for i, (c, kept) in got.items())
    assert len(set(want.values())) < len(want) - 20


@pytest.mark.parametrize("pivots,block", [(0, 512), (2, 512), (8, 16)])
def test_blocks_lose_no_link(make, monkeypatch, pivots, block):
    """A few pivots or none, one block or many: the same classes."""
    monkeypatch.setattr(near_dedup, "PIVOTS", pivots)
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    pairs = near_pairs()
    docs = make(pairs)
    idf = near_dedup.idf_table(*near_dedup.document_frequencies(docs, 5))
    if block == 512:
        found = near_dedup.Block(pa.array([t or "" for _, t in pairs]), idf, 5).forest(0.8)
        root = {i: i for i in range(len(pairs))}
        for a, b in found:
            low, high = sorted((root[a], root[b]))
            assert low != high  # a forest
            root = {k: low if v == high else v for k, v in root.items()}
        assert {pairs[k][0]: pairs[v][0] for k, v in root.items()} == brute_classes(pairs, idf)
    else:
        got = {r.doc_id: r.class_id for r in near_dedup.classes(docs).collect()}
        assert got == brute_classes(pairs, idf)


def test_near_odd_rows(odd, empty):
    got = near_dedup.classes(odd).collect()
    assert len(got) == len(odd_pairs())
    of = {r.doc_id: r.class_id for r in got}
    assert of[4] == of[5] == 4 and of[6] == of[7] == 6
    assert of[1] == 1 and of[2] == 2 and of[3] == 3
    assert all(r.kept and r.class_id is None for r in got if r.doc_id is None)
    kept = near_dedup.keep_one(odd)
    assert kept.columns == odd.columns and 7 not in [r.doc_id for r in kept.collect()]
    assert near_dedup.classes(empty).count() == 0


def test_chains_and_stars_are_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(200, 200), (5, 4), (300, 301)]
    got = {r.id: r.root for r in near_dedup.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)} | {300: 300, 301: 300}
    assert got == want


def test_samples_agree_as_often_as_weights_overlap():
    rng = np.random.default_rng(3)
    keys = rng.integers(0, 2**48, 400, dtype=np.uint64)
    a, b = rng.uniform(0.5, 3, 400), rng.uniform(0.5, 3, 400)
    a[:60], b[340:] = 0, 0
    sampler = near_dedup.Sampler(4000)
    drawn = [sampler.draw(keys[w > 0], np.log(w[w > 0]), np.array([0])) for w in (a, b)]
    assert abs((drawn[0] == drawn[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum()) < 0.03
