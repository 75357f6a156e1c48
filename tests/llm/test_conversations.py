import hashlib
import random
import re
import zlib
from functools import lru_cache

import numpy as np
import pytest
from pyspark.sql import functions as F

from stridewatch.llm import conversations

BLANKS = " \t\n\x0b\f\r"
SCHEMA = "conv_id long, turn long, role string, text string, digest string, seq long, cost string"


def damaged(rows):
    out = []
    for c, t, role, text in rows:
        key = f"{' ' if c is None else c}:{' ' if t is None else t}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out += [(c, t, role, text)] * (2 if kind == 3 else 1)
    return out


def cheapest(rows, forced, cut):
    """(cost, audit) of the least of the cheapest edits, by trying all of them."""
    n = len(rows)

    @lru_cache(None)
    def best(i, state, added):
        ways = []
        if i == n and state in "0a":
            ways.append((0, ""))
        need = "a" if state == "u" else "u"

        def then(cost, letter, *to):
            rest = best(*to)
            if rest:
                ways.append((cost + rest[0], letter + rest[1]))

        if added < 3:
            then(5, "I", i, need, added + 1)
        if i < n:
            then(2, "D", i + 1, state, 0)
            if not forced[i]:
                more = 5 if cut[i] else 0
                then(1 + more, "R", i + 1, need, 0)
                if rows[i][2][:1] == need:
                    then(more, "K", i + 1, need, 0)
                if rows[i][2][:1] == "s" and state == "0":
                    then(more, "K", i + 1, "s", 0)
        return min(ways) if ways else None

    return best(0, "0", 0)


def plain_repair(rows):
    ids = {r[0] for r in rows}
    out = {}
    for c in ids:
        own = [r for r in damaged(rows) if r[0] == c]
        own.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        seen, forced, cut, counts = set(), [], [], [0, 0, 0]
        for _, _, role, text in own:
            body = text.rstrip(BLANKS)
            fault = 0 if not body else 1 if (role, text) in seen else 2 if body[-1] not in ".!?" else None
            seen.add((role, text))
            if fault is not None:
                counts[fault] += 1
            forced.append(fault in (0, 1))
            cut.append(fault == 2)
        initials = [r[2][:1] for r in own]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        turns = {r[1] for r in own if r[1] is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        cost, audit = cheapest(own, forced, cut) if own else (0, "")
        lines, i, state = [], 0, "0"
        for letter in audit:
            if letter == "D":
                i += 1
                continue
            state = "s" if letter == "K" and state == "0" and own[i][2][:1] == "s" else "a" if state == "u" else "u"
            name = {"u": "user", "a": "assistant"}.get(state)
            lines.append(f"{name}:" if letter == "I" else f"{own[i][2] if letter == 'K' else name}:{own[i][3]}")
            i += letter != "I"
        assert re.fullmatch("(s?(ua)+)?", "".join(line[0] for line in lines))
        out[c] = (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def made(n=40, seed=5):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "Why?", "cut short", "", " \n", "Long. And longer", "ünïcode 日本.", None, "Fine.  \n"]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "User", "us", "a"]
    rows = []
    for c in range(n):
        for t in range(rng.choice([0, 1, 2, 5, 9, 14])):
            turn = rng.choice([t, t, t, t + 3, None]) if c % 3 else t
            rows.append((c if c else None, turn, rng.choice(roles[: 11 if c % 2 else 3]), rng.choice(texts)))
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "x") for r in rows], SCHEMA).repartition(3)


def found(df):
    return {
        r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256)
        for r in df.collect()
    }


@pytest.mark.parametrize("block_rows", [4096, 3, 1])
def test_repair_equals_all_edits_tried(spark, block_rows):
    rows = made()
    got = conversations.repair(frame(spark, rows), block_rows)
    assert got.count() == len({r[0] for r in rows})
    assert found(got) == plain_repair(rows)


def test_regular_conversations_and_long_ones(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    rows = [tuple(r) for r in table.collect()]
    rows += [(10**6, t, ("user", "assistant")[t % 2], f"Row {t % 90}.") for t in range(260)]
    rows += [(10**6 + 1, None, "user", "Same.")] * 50 + [(10**6 + 2, 7, "system", "Be kind.")]
    import sys

    sys.setrecursionlimit(10_000)
    got = conversations.repair(frame(spark, rows), 64)
    assert found(got) == plain_repair(rows)


def test_no_rows_left_and_no_rows_at_all(spark):
    gone = [(c, t, "user", "Hi.") for c in range(40) for t in range(40) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0][:5]
    got = found(conversations.repair(frame(spark, gone)))
    assert got == {r[0]: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for r in gone}
    assert conversations.repair(frame(spark, []).limit(0)).count() == 0


def test_ranks_decide_between_arcs_with_one_letter():
    """Random graphs in which arcs of a node share letters, against all strings written out."""
    rng = random.Random(1)
    for _ in range(60):
        n = rng.randint(1, 14)
        arcs = [(v, rng.randint(0, 1), rng.randint(v + 1, n - 1)) for v in range(n - 1) for _ in range(rng.randint(0, 3))]
        strings = {}
        for v in reversed(range(n)):
            out = [chr(97 + a) + strings[w] for s, a, w in arcs if s == v]
            strings[v] = min(out) if out else ""
        columns = np.array(arcs or np.zeros((0, 3)), np.int64).reshape(-1, 3).T
        rank, following = conversations.rank_paths(n, *columns)
        order = sorted(set(strings.values()))
        assert rank.tolist() == [order.index(strings[v]) for v in range(n)]
        which, node = conversations.walk(following, np.arange(n))
        for v in range(n):
            path = node[which == v].tolist()
            assert path[0] == v and len(path) == len(strings[v]) + 1
            for a, b, letter in zip(path, path[1:], strings[v]):
                assert (a, ord(letter) - 97, b) in arcs


def test_later_copies_of_a_hot_text(spark):
    rows = [(1, t, "user", "Again.") for t in range(300)] + [(1, None, "user", "Other.")] * 2
    got = conversations.later_copies(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    assert got.count() == 299 and got.where(F.col("turn") == 0).count() == 0
