import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stridewatch.llm import decontamination, quality, queries, toxicity, url_filter

from .conftest import PASSAGE, odd_pairs


@pytest.fixture(scope="module")
def url_model(spark):
    return url_filter.train(url_filter.labelled_urls(spark))


def plain_rule(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = re.sub(r"[A-Z]", lambda m: m[0].lower(), host)
    best = None
    for rule, _ in queries.RULES:
        name, _, start = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + start):
            best = rule if best is None or len(rule) > len(best) else best
    return host, path, best


def test_rules_and_parts(spark, url_model):
    urls = [
        None, "", "no scheme", "http://", "HTTP://A.Example.NET/en/x?y#z", "https://example.net/en", "x://y://z/w",
        "https://www.example.com/de/1", "https://notexample.com/de/1", "https://a.org/fr/", "https://org/fr/2",
        "https://ÀB.net/Q", "https://net?a=/", "http://a.net#/", "https://b.example.net/es/\n1", "https://a.org",
    ]
    pages = spark.createDataFrame(
        [(i, u, "x", "y", 1.0) for i, u in enumerate(urls)], "page_id long, url string, host string, rule string, score double"
    )
    got = {r.page_id: r for r in url_filter.judge(pages, queries.RULES, url_model).collect()}
    decisions = dict(queries.RULES)
    for i, url in enumerate(urls):
        host, path, rule = plain_rule(url)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule), url
        assert got[i].verdict == (decisions[rule] if rule else ("block" if got[i].score >= 0.5 else "allow"))
    assert url_filter.judge(pages.limit(0), queries.RULES, url_model).count() == 0
    assert [r.rule for r in url_filter.judge(pages, [], url_model).collect()] == [None] * len(urls)


def test_learned_verdicts(spark, url_model):
    bad = ["https://m.casino-win.example.org/en/1", "http://free-bets.example.com/x", "https://adult-x.example.com/en/9"]
    good = ["https://blog.weather.example.com/en/5", "https://m.thernd.example.com/en/49489/", "https://ththhe.example.com/en/1"]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(bad + good)], "page_id long, url string")
    got = {r.page_id: r.verdict for r in url_filter.judge(pages, [], url_model).collect()}
    assert [got[i] for i in range(6)] == ["block"] * 3 + ["allow"] * 3


def plain_words(text):
    lowered = re.sub(r"[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def plain_contamination(pairs, items, size):
    windows = {}
    for item, text in items:
        words = plain_words(text)
        n = min(size, len(words))
        for k in range(len(words) - n + 1 if n else 0):
            windows.setdefault(tuple(words[k : k + n]), set()).add("" if item is None else str(item))
    out = []
    for i, text in pairs:
        words, hit, found = plain_words(text), set(), set()
        for n in {len(w) for w in windows}:
            for k in range(len(words) - n + 1):
                if tuple(words[k : k + n]) in windows:
                    hit.update(range(k, k + n))
                    found |= windows[tuple(words[k : k + n])]
        names = ",".join(sorted(found))
        out.append((i, len(words), len(hit), len(found), hashlib.sha256(names.encode()).hexdigest(), bool(hit)))
    return out


@pytest.mark.parametrize("size,at_once", [(10, 400_000), (3, 7), (1, 400_000)])
def test_contamination(spark, odd, monkeypatch, size, at_once):
    items = [
        (10, PASSAGE.upper() + "!"), (9, "Same same SAME same"), (None, "one,two"), (3, None), (4, "..."), (2, "É É"),
        (5, "same " * 12), (5, "same " * 12),
    ]
    benchmark = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    monkeypatch.setattr(decontamination, "GRAMS_AT_ONCE", at_once)
    monkeypatch.setattr(decontamination.hits, "__defaults__", (at_once,))
    got = decontamination.contamination(odd, benchmark, size).collect()
    rows = [(r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got]
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(rows, key=key) == sorted(plain_contamination(odd_pairs(), items, size), key=key)


def test_clean_documents_stay(spark, odd, empty):
    benchmark = spark.createDataFrame([(1, PASSAGE)], "item_id long, text string")
    kept = decontamination.keep_clean(odd, benchmark)
    assert kept.columns == odd.columns
    assert sorted(set(dict(odd_pairs())) - {r.doc_id for r in kept.collect()}, key=str) == [10, 9]
    none = benchmark.limit(0)
    assert decontamination.keep_clean(odd, none).count() == len(odd_pairs())
    assert decontamination.contamination(empty, none).count() == 0
    assert not any(r.contaminated for r in decontamination.contamination(odd, none).collect())


@pytest.mark.parametrize("operator", [quality, toxicity])
def test_classifiers_score_every_row(odd, empty, labels, operator):
    got = operator.classify(odd, labels, held_out=queries.fold(5, 0)).collect()
    assert len(got) == len(odd_pairs())
    assert all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in got)
    for r in got:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    assert operator.classify(empty, labels, held_out=queries.fold(5, 0)).count() == 0
    nothing = operator.classify(odd, labels.limit(0), held_out=queries.fold(5, 0)).collect()
    assert len({r.score for r in nothing}) == 1


def test_quality_stage_keeps_columns(odd, labels):
    kept = quality.keep_good(odd, labels, held_out=queries.fold(5, 0), threshold=0.0)
    assert kept.columns == odd.columns and kept.count() == len(odd_pairs())


@pytest.mark.parametrize(
    "name,label,parts,number,least", [("op9_subword_quality", "quality", 4, 2, 0.93), ("op5_lexicon_toxicity", "toxic", 5, 0, 0.93)]
)
def test_held_out_accuracy(spark, name, label, parts, number, least):
    sf_dir = "/root/testdata/sf0.01"
    scored = queries.QUERIES[name](spark, sf_dir)
    truth = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", label)
    rows = scored.where("held_out").join(truth, "doc_id").collect()
    assert len(rows) > 30
    assert np.mean([r.predicted == r[label] for r in rows]) >= least


def test_held_out_labels_are_not_learned(spark, odd, labels):
    flipped = labels.withColumn("quality", F.when(queries.fold(4, 2), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (
        {(r.doc_id, r.score) for r in quality.classify(odd, given, held_out=queries.fold(4, 2)).collect()}
        for given in (labels, flipped)
    )
    assert a == b


def test_folding_and_exceptions():
    assert fold_of("L0SER!") == "loser" and fold_of("ｌｏｓｅｒ") == "loser"
    assert fold_of("ѕtuріd") == "stupid" and fold_of("$cum") == "scum"
    assert fold_of("a1b2") == "aib" and fold_of("2024") == ""
    lexicon = toxicity.Lexicon({" clown ": 4.0, " lowei": 3.0}, exceptions=("clown fish",))
    assert lexicon.matches("A clown, a CL0WN and loweiher.")[0] == 11.0
    assert lexicon.matches("clown fish swim")[0] == 0.0
    assert lexicon.matches("unclown xlowei")[0] == 0.0
    short, long = lexicon.measure("you clown"), lexicon.measure("you clown " + "word " * 5000)
    assert short > long > 0
    assert toxicity.Lexicon({}).matches("anything") == (0.0, 1)


def fold_of(text):
    return toxicity.fold(text).strip()


def test_repeated_words_are_a_feature():
    runs = quality.features(pa.array(["of of of", "a b a b"]))
    marks, begin, end = runs[-1]
    base = quality.WORD_BUCKETS + quality.GRAM_BUCKETS
    assert (marks[begin[0] : end[0]] - base).tolist() == [0, 0]
    assert (marks[begin[1] : end[1]] - base).tolist() == [1, 1]


def plain_measure(lexicon, text):
    """Every place of every term looked for by itself, exceptions compared one by one."""
    folded = toxicity.fold(text)
    entries = {**lexicon.weights, **{toxicity.fold(p): None for p in lexicon.exceptions}}
    terms, hidden = [], []
    for term, weight in entries.items():
        size = len(term.rstrip())
        at = folded.find(term)
        while at >= 0:
            (hidden if weight is None else terms).append((at, at + size, weight))
            at = folded.find(term, at + 1)
    total = sum(w for a, b, w in terms if not any(x <= a and b <= y for x, y, _ in hidden))
    return total / np.log2(4 + max(folded.count(" ") - 1, 0) / 64)


def test_toxicity_scores_equal_plain_search():
    rng = random.Random(3)
    words = ["kill", "killing", "process", "idiot", "nice", "day", "k1ll", "the", "stupid", "question", "a"]
    lexicon = toxicity.Lexicon(
        {" kill": 2.0, " idiot ": 3.5, " stupid": 1.25, " killing ": 0.5},
        ("kill the process", "killing", "stupid question a stupid", "no"),
    )
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 40))) for _ in range(300)] + ["", " ", "KILL"]
    for text in texts:
        assert np.isclose(lexicon.measure(text), plain_measure(lexicon, text)), text
    want = 1 / (1 + np.exp(-(lexicon.slope * np.array([plain_measure(lexicon, t) for t in texts]) + lexicon.offset)))
    assert np.allclose(lexicon.score(pa.array(texts)), want)


def test_a_long_text_of_exceptions_takes_linear_time():
    import time

    lexicon = toxicity.Lexicon({" kill": 2.0}, ("kill the process",))
    start = time.perf_counter()
    assert lexicon.measure("kill the process " * 60_000 + "kill") > 0
    assert time.perf_counter() - start < 10
