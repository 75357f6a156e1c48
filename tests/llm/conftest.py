import pytest
from pyspark.sql import types as T

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, kept string, shard string, digest string, words string, id string, root string"


def rows(pairs):
    return [(i, t, "en", "s", None, None, "x", "x", "x", "x", "x", "x") for i, t in pairs]


@pytest.fixture(scope="session")
def make(spark):
    """Documents from (doc_id, text) pairs, with further columns that have the operators' own names."""
    return lambda pairs, parts=3: spark.createDataFrame(rows(pairs), SCHEMA).repartition(parts)


PASSAGE = " ".join(f"passage{i}" for i in range(40))


def odd_pairs():
    base = " ".join(f"word{i % 97}x{i}" for i in range(120))
    return [
        (1, None),
        (2, ""),
        (3, " \t\n "),
        (4, "One two three."),
        (5, "One  two\nthree."),
        (5, "One  two\nthree."),
        (6, base),
        (7, base + " tail"),
        (8, base.replace("word5x5 ", "other ")),
        (9, f"start {PASSAGE} end"),
        (10, f"{PASSAGE} again {PASSAGE}"),
        (11, "same " * 50),
        (12, "ünïcode 日本 😀 <|endoftext|> É é"),
        (13, " ".join(f"long{i * 7919 % 5003}" for i in range(60_000))),
        (None, "no id here"),
        (None, None),
    ]


@pytest.fixture(scope="session")
def odd(make):
    return make(odd_pairs())


@pytest.fixture(scope="session")
def empty(make):
    return make([])


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame(
        [(4, 1, 0), (5, 1, 0), (6, 1, 0), (7, 0, 1), (11, 0, 1), (12, None, None), (None, 1, 1), (4, 1, 0)],
        "doc_id long, quality int, toxic int",
    )
