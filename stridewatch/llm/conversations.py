"""Repair of the turn structure of conversations at least cost.

A repaired conversation has a system row or none, then user and assistant in turn, ending with an assistant. Edits keep,
rerole or delete rows, or insert empty ones. A node is a place between two rows and what the rows so far have come to; an
edit is an arc.

1. Costs. Dynamic programming from the end gives each node its cost to the end; arcs on a cheapest way are optimal.
2. Ranks. Nodes are ranked by the least audit (letters of edits) of 1, 2, 4, ... optimal arcs: the rank for twice the
   length comes from a node's rank and the ranks of the nodes that its least audit reaches. When no audit is longer, the
   ranks order whole audits, and of a node's arcs with the least letter the one to the least rank leads on.
3. Paths. The chosen arcs are doubled like pointers, so the nodes of all paths are found in as many steps as the longest
   path has binary digits.

Rows are sorted by conversation and turn over all tasks. A conversation that lies within one task is repaired there. Of one
that runs over tasks, or is longer than a block, blocks are written: each gives the least cost between any
two states of its ends, a pass over those numbers alone gives every block its cost to the end, and the blocks are ranked side by
side for each state they may begin in. Only the digest of the repaired rows is taken in order, one block at a time.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import join_null_safe
from .common import SPACES, settle

BLOCK_ROWS = 4096
BLOCK_BYTES = 4 << 20
PACK_ROWS = 20_000
PACK_BYTES = 16 << 20

#: States: nothing yet, a system row, a user row, an assistant row; and the row that may follow each.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
FOLLOWING = np.array([USER, USER, ASSISTANT, USER])
NAMES = ("", "system", "user", "assistant")
INITIALS = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5
LETTERS = "DIKR"
D, I, K, R = range(4)
LEGAL = {"su", "ua", "au"}
FORCED, CUT = 1, 2  # flags of a row: must be deleted, is truncated
FAR = 1 << 40
#: Cost to the end after the last row: an accepted state, or rows to insert.
AT_END = np.array([0, 2 * INSERT, INSERT, 0])


# ---- ranking


def rank_paths(n: int, source: np.ndarray, letter: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rank, next): the order of the least strings that lead from each node to an end, and the arc that begins it.

    Nodes are 0 to n - 1, arcs (source, letter, target) without cycles; a node without arcs is an end. ``rank`` numbers the
    distinct strings in ascending order. ``next`` is the target of the chosen arc, -1 at an end. Several arcs of a node may
    share a letter: then ranks decide.
    """
    least = np.full(n, -1, np.int64)
    order = np.lexsort((target, letter, source))
    source, letter, target = source[order], letter[order], target[order]
    first = np.flatnonzero(np.append(True, source[1:] != source[:-1]))[: len(source)]
    least[source[first]] = letter[first]
    use = letter == least[source]
    source, target = source[use], target[use]
    arcs = source, target
    rank = np.unique(least, return_inverse=True)[1].astype(np.int64)
    while len(source):
        # nodes that a node's least string of this length reaches; none where the string is whole
        first = np.flatnonzero(np.append(True, source[1:] != source[:-1]))[: len(source)]
        ahead = np.zeros(n, np.int64)
        ahead[source[first]] = np.minimum.reduceat(rank[target], first) + 1
        use = rank[target] + 1 == ahead[source]
        source, target = source[use], target[use]
        begin = np.searchsorted(source, np.arange(n + 1))
        some = begin[target + 1] - begin[target]
        at = np.repeat(begin[target] - (np.cumsum(some) - some), some) + np.arange(int(some.sum()))
        both = np.unique(np.repeat(source, some) * n + target[at])
        source, target = np.divmod(both, n)
        rank = np.unique(rank * (n + 1) + ahead, return_inverse=True)[1].astype(np.int64)
    source, target = arcs
    order = np.lexsort((rank[target], source))
    source, target = source[order], target[order]
    first = np.flatnonzero(np.append(True, source[1:] != source[:-1]))[: len(source)]
    following = np.full(n, -1, np.int64)
    following[source[first]] = target[first]
    return rank, following


def walk(following: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which, node): the nodes of the paths from ``starts``, path by path and in order, by doubled pointers."""
    which, step, node = np.arange(len(starts)), np.zeros(len(starts), np.int64), starts.astype(np.int64)
    jump, length = following, 1
    while True:
        ahead = jump[node]
        going = ahead >= 0
        if not going.any():
            break
        which = np.append(which, which[going])
        step = np.append(step, step[going] + length)
        node = np.append(node, ahead[going])
        jump = np.where(jump >= 0, jump[jump], -1)
        length *= 2
    order = np.lexsort((step, which))
    return which[order], node[order]


# ---- costs


def costs_to_go(
    roles: np.ndarray, flags: np.ndarray, begin: np.ndarray, goals: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """(costs, layer of the first node of each block) of the nodes of several blocks.

    Rows of block b are ``begin[b]`` to ``begin[b + 1]``, its goal the cost to the end after it, by state. A block has
    a layer of four nodes more than it has rows. All blocks go back one row a step together.
    """
    size = np.diff(begin)
    layer = begin[:-1] + np.arange(len(size))
    costs = np.full((int(begin[-1]) + len(size), 4), FAR, np.int64)
    costs[layer + size] = goals
    longest_first = np.argsort(-size, kind="stable")
    sizes = size[longest_first]
    for back in range(1, int(sizes[0]) + 1 if len(sizes) else 0):
        some = longest_first[: np.searchsorted(-sizes, -back, "right")]
        row = begin[some] + size[some] - back
        here = layer[some] + size[some] - back
        after = costs[here + 1]
        forced = (flags[row] & FORCED > 0)[:, None]
        more = np.where(flags[row] & CUT > 0, TRUNCATED, 0)[:, None]
        role = roles[row][:, None]
        on = after[:, FOLLOWING]
        stay = np.where(role == FOLLOWING, on + more, FAR)
        stay[:, NOTHING] = np.where(role[:, 0] == SYSTEM, after[:, SYSTEM] + more[:, 0], stay[:, NOTHING])
        found = np.minimum(after + DELETE, np.where(forced, FAR, np.minimum(stay, on + more + REROLE)))
        for _ in range(2):  # no cheapest way has more than two insertions in a row
            found = np.minimum(found, found[:, FOLLOWING] + INSERT)
        costs[here] = np.minimum(found, FAR)
    return costs, layer


def audits(
    roles: np.ndarray, flags: np.ndarray, begin: np.ndarray, goals: np.ndarray, last: np.ndarray, entries: np.ndarray
) -> list[tuple[str, int]]:
    """(audit, state at its end) of the least of the cheapest ways through blocks, for (block, state) ``entries``.

    ``last`` marks blocks that end their conversation: insertions after their last row belong to them.
    """
    costs, layer = costs_to_go(roles, flags, begin, goals)
    size = np.diff(begin)
    rows = np.arange(int(begin[-1]))
    here = rows + np.repeat(np.arange(len(size)), size)
    at, after = costs[here], costs[here + 1]
    forced, more = (flags & FORCED > 0)[:, None], np.where(flags & CUT > 0, TRUNCATED, 0)[:, None]
    role = roles[:, None]
    arcs = []

    def add(which: np.ndarray, letter: int, layers: np.ndarray, ahead: int, states: np.ndarray) -> None:
        i, q = np.nonzero(which)
        arcs.append((layers[i] * 4 + q, np.full(len(i), letter), (layers[i] + ahead) * 4 + states[q]))

    some = at < FAR
    add(some & (at == after + DELETE), D, here, 1, np.arange(4))
    on = after[:, FOLLOWING] + more
    add(some & ~forced & (at == on + REROLE), R, here, 1, FOLLOWING)
    add(some & ~forced & (role == FOLLOWING) & (at == on), K, here, 1, FOLLOWING)
    first = np.zeros((len(rows), 4), bool)
    first[:, NOTHING] = True
    add(some & first & ~forced & (role == SYSTEM) & (at == after[:, [SYSTEM]] + more), K, here, 1, np.full(4, SYSTEM))
    open_ends = (layer + size)[last]
    inner = np.concatenate([here, open_ends])
    add((costs[inner] < FAR) & (costs[inner] == costs[inner][:, FOLLOWING] + INSERT), I, inner, 0, FOLLOWING)
    source, letter, target = (np.concatenate(c).astype(np.int64) for c in zip(*arcs))
    _, following = rank_paths(4 * len(costs), source, letter, target)
    chosen = np.full(4 * len(costs), len(LETTERS), np.int64)
    on_path = following[source] == target
    np.minimum.at(chosen, source[on_path], letter[on_path])
    which, node = walk(following, layer[entries[:, 0]] * 4 + entries[:, 1])
    spelled = np.frombuffer((LETTERS + "\0").encode(), np.uint8)[chosen[node]]
    cuts = np.searchsorted(which, np.arange(len(entries) + 1))
    out = []
    for a, b in zip(cuts.tolist(), cuts[1:].tolist()):
        out.append((spelled[a : b - 1].tobytes().decode(), int(node[b - 1] % 4)))
    return out


class Block:
    """Consecutive rows of a conversation and what is counted over them."""

    def __init__(self, conv_id):
        self.conv_id, self.roles, self.texts, self.flags, self.bytes = conv_id, [], [], [], 0
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.first_turn = self.last_turn = None
        self.turns = 0

    def add(self, turn, role: str, text: str, duplicate: bool) -> None:
        trimmed = text.rstrip(SPACES)
        flag = 0
        if not trimmed:
            self.blank, flag = self.blank + 1, FORCED
        elif duplicate:
            self.duplicate, flag = self.duplicate + 1, FORCED
        elif trimmed[-1] not in ".!?":
            self.truncated, flag = self.truncated + 1, CUT
        if self.roles and self.roles[-1][:1] + role[:1] not in LEGAL:
            self.illegal += 1
        if turn is not None and turn != self.last_turn:
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn, self.turns = turn, self.turns + 1
        self.roles.append(role)
        self.texts.append(text)
        self.flags.append(flag)
        self.bytes += len(text) + 64


class Repair:
    """The repaired rows of a conversation, taken in block by block."""

    def __init__(self, conv_id):
        self.digest, self.state, self.cost, self.audit, self.empty = hashlib.sha256(), NOTHING, 0, [], True
        self.row = {"conv_id": conv_id, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
        self.first_turn = self.last_turn = None
        self.turns, self.last_initial = 0, None

    def count(self, counts: dict) -> None:
        for name in ("blank", "duplicate", "truncated", "illegal"):
            self.row[name] += counts[name]
        if counts["roles"]:
            if self.last_initial is not None and self.last_initial + counts["roles"][0][:1] not in LEGAL:
                self.row["illegal"] += 1
            self.last_initial = counts["roles"][-1][:1]
        if counts["first_turn"] is not None:
            self.turns += counts["turns"] - (counts["first_turn"] == self.last_turn)
            self.first_turn = counts["first_turn"] if self.first_turn is None else self.first_turn
            self.last_turn = counts["last_turn"]

    def edit(self, counts: dict, audit: str) -> None:
        self.count(counts)
        self.audit.append(audit)
        roles, texts, flags, i = counts["roles"], counts["texts"], counts["flags"], 0
        for letter in audit:
            if letter == "D":
                self.cost, i = self.cost + DELETE, i + 1
                continue
            if letter == "K" and self.state == NOTHING and roles[i][:1] == "s":
                self.state = SYSTEM
            else:
                self.state = int(FOLLOWING[self.state])
            if letter == "I":
                self.cost, line = self.cost + INSERT, NAMES[self.state] + ":"
            else:
                role = roles[i] if letter == "K" else NAMES[self.state]
                self.cost += (REROLE if letter == "R" else 0) + (TRUNCATED if flags[i] & CUT else 0)
                line, i = f"{role}:{texts[i]}", i + 1
            self.digest.update((line if self.empty else "\n" + line).encode())
            self.empty = False

    def result(self) -> dict:
        gaps = 0 if self.first_turn is None else self.last_turn - self.first_turn + 1 - self.turns
        done = {"gaps": gaps, "cost": self.cost, "audit": "".join(self.audit), "repaired_sha256": self.digest.hexdigest()}
        return self.row | done


def _arrays(blocks: list[dict]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    roles = np.array([INITIALS.get(r[:1], 0) for b in blocks for r in b["roles"]], np.int64)
    flags = np.array([f for b in blocks for f in b["flags"]], np.int64)
    return roles, flags, np.cumsum([0] + [len(b["roles"]) for b in blocks])


def repaired(blocks: list[dict]) -> list[dict]:
    """Result rows of whole conversations of one block each."""
    if not blocks:
        return []
    roles, flags, begin = _arrays(blocks)
    n = len(blocks)
    entries = np.stack([np.arange(n), np.full(n, NOTHING)], axis=1)
    found = audits(roles, flags, begin, np.tile(AT_END, (n, 1)), np.ones(n, bool), entries)
    out = []
    for block, (audit, _) in zip(blocks, found):
        one = Repair(block["conv_id"])
        one.edit(block, audit)
        out.append(one.result())
    return out


def between(blocks: list[dict]) -> list[list[int]]:
    """The least cost from each state before a block to each after it, 16 numbers a block."""
    roles, flags, begin = _arrays([b for b in blocks for _ in range(4)])
    goals = np.tile(np.where(np.eye(4, dtype=bool), 0, FAR), (len(blocks), 1))
    costs, layer = costs_to_go(roles, flags, begin, goals)
    return costs[layer].reshape(len(blocks), 4, 4).transpose(0, 2, 1).reshape(len(blocks), 16).tolist()


# ---- tables

_RESULT = [
    ("conv_id", pa.int64()),
    *[(c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
    ("audit", pa.string()),
    ("repaired_sha256", pa.string()),
]
_BLOCK = [
    ("seq", pa.int64()),
    ("roles", pa.list_(pa.string())),
    ("texts", pa.list_(pa.string())),
    ("flags", pa.list_(pa.int32())),
    *[(c, pa.int64()) for c in ("first_turn", "last_turn", "turns")],
    ("steps", pa.list_(pa.int64())),
]
_SWEPT, _DONE = pa.schema(_RESULT + _BLOCK), pa.schema(_RESULT)
RESULT = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
    "repaired_sha256 string"
)
BLOCK = (
    "seq long, roles array<string>, texts array<string>, flags array<int>, first_turn long, last_turn long, turns long, "
    "steps array<bigint>"
)


def damage(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) after damage by the remainder of crc32(``conv_id:turn``) by 20: 0 drops a row, 1 empties its
    text, 2 takes away its full stops, question and exclamation marks, 3 repeats it, 4 makes it a user's.
    Nulls are one space, but for ordering."""

    def known(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(known("conv_id"), F.lit(":"), known("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", known("role").alias("role"), known("text").alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return rows.where("kind <> 0").select(
        "conv_id",
        "turn",
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"),
    ).drop("_copy")


def later_copies(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, digest) of contents that stand at an earlier turn of their conversation too.

    Only digests are shuffled, merged before; a content at very many turns is one row of the side it is joined to.
    """
    named = rows.select("conv_id", "turn", "role", F.unhex(F.sha2("text", 256)).alias("digest"))
    keys = ["conv_id", "role", "digest"]
    first = named.groupBy(keys).agg(
        F.min("turn").alias("first"), F.max("turn").alias("last"), F.bool_or(F.col("turn").isNull()).alias("unplaced")
    )
    several = first.where("first < last OR (unplaced AND first IS NOT NULL)").select(
        *keys, F.when(~F.col("unplaced"), F.col("first")).alias("first")
    )
    met = join_null_safe(named, several, keys, "inner").where("NOT (turn <=> first)")
    return met.select("conv_id", "turn", "role", "digest").distinct()


def sweep(conversations: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Result rows of conversations that lie within one task, and blocks (``seq`` is set) of all others."""
    rows = damage(conversations)
    none = F.lit(None)
    parts = [
        conversations.select("conv_id").distinct().select(
            "conv_id", none.cast("long").alias("turn"), F.lit(0).alias("kind"), none.cast("string").alias("role"),
            none.cast("string").alias("text"), none.cast("binary").alias("digest"),
        ),
        later_copies(rows).select(
            "conv_id", "turn", F.lit(1).alias("kind"), "role", none.cast("string").alias("text"), "digest"
        ),
        rows.select("conv_id", "turn", F.lit(2).alias("kind"), "role", "text", none.cast("binary").alias("digest")),
    ]
    # a turn stays whole, so that marks of later copies stand before the rows they are about
    together = parts[0].unionByName(parts[1]).unionByName(parts[2]).repartitionByRange("conv_id", "turn")
    ordered = together.sortWithinPartitions("conv_id", "turn", "kind", "role", "text")

    def run(batches):
        part, number = TaskContext.get().partitionId(), 0
        pack, held, opened = [], [0, 0], []

        def emit():
            nonlocal pack, opened, number
            rows_ = repaired([vars(b) for b in pack])
            if opened:
                for block, steps in zip(opened, between([vars(b) for b in opened])):
                    rows_.append(vars(block) | {"seq": part << 32 | number, "steps": steps})
                    number += 1
            pack, opened, held[:] = [], [], [0, 0]
            return pa.RecordBatch.from_pylist(
                [{f.name: row.get(f.name) for f in _SWEPT} for row in rows_], schema=_SWEPT
            )

        block, whole, turn_now, marked, before = None, False, None, set(), None
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
            for conv_id, turn, kind, role, text, digest in zip(*columns):
                if block is None or conv_id != block.conv_id:
                    if block is not None:
                        (pack if whole else opened).append(block)
                        held = [held[0] + len(block.roles), held[1] + block.bytes]
                    # the first conversation of a task may have begun in another one
                    whole, block = block is not None, Block(conv_id)
                    turn_now, marked, before = turn, set(), None
                if turn != turn_now:
                    turn_now, marked, before = turn, set(), None
                if kind == 1:
                    marked.add((role, digest))
                elif kind == 2:
                    if len(block.roles) >= block_rows or block.bytes >= BLOCK_BYTES:
                        opened.append(block)
                        held = [held[0] + len(block.roles), held[1] + block.bytes]
                        whole, block = False, Block(conv_id)
                    again = before == (role, text)
                    if marked and not again:
                        again = (role, hashlib.sha256(text.encode()).digest()) in marked
                    block.add(turn, role, text, again)
                    before = role, text
                if held[0] >= PACK_ROWS or held[1] >= PACK_BYTES:
                    yield emit()
        if block is not None:
            opened.append(block)
        if pack or opened:
            yield emit()

    return ordered.mapInArrow(run, f"{RESULT}, {BLOCK}")


def goals_of_blocks(blocks: DataFrame) -> DataFrame:
    """(conv_id, seq, goal, last): the cost to the end after each block, from the blocks' numbers alone, last block first."""
    ordered = (
        blocks.select("conv_id", "seq", "steps")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", F.col("seq").desc())
    )

    def run(batches):
        now, goal, begun = None, None, False
        for batch in batches:
            ids, seqs, steps = (batch.column(i).to_pylist() for i in range(3))
            out = []
            for conv_id, step in zip(ids, steps):
                last = not begun or conv_id != now
                if last:
                    now, goal, begun = conv_id, AT_END, True
                out.append((goal.tolist(), last))
                goal = np.minimum((np.array(step).reshape(4, 4) + goal).min(axis=1), FAR)
            if out:
                goals, lasts = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(seqs), pa.array(goals, pa.list_(pa.int64())), pa.array(lasts)],
                    ["conv_id", "seq", "goal", "last"],
                )

    return ordered.mapInArrow(run, "conv_id long, seq long, goal array<bigint>, last boolean")


_WAYS = "ways array<string>, exits array<int>"


def ways_through(blocks: DataFrame) -> DataFrame:
    """Blocks with the least cheapest way through each, and the state it ends in, for every state it may begin in."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                roles, flags, begin = _arrays([row])
                entries = np.array([(0, q) for q in range(4)])
                found = audits(roles, flags, begin, np.array([row["goal"]]), np.array([row["last"]]), entries)
                row |= {"ways": [audit for audit, _ in found], "exits": [state for _, state in found]}
                yield pa.RecordBatch.from_pylist([{f.name: row[f.name] for f in _SOLVED}], schema=_SOLVED)

    return blocks.mapInArrow(run, f"conv_id long, blank long, duplicate long, truncated long, illegal long, {BLOCK}, {_WAYS}")


_SOLVED = pa.schema(
    [("conv_id", pa.int64())]
    + [(c, pa.int64()) for c in ("blank", "duplicate", "truncated", "illegal")]
    + _BLOCK
    + [("ways", pa.list_(pa.string())), ("exits", pa.list_(pa.int32()))]
)


def finish(solved: DataFrame) -> DataFrame:
    """Result rows of conversations of several blocks, which stream through in order."""
    ordered = solved.repartition("conv_id").sortWithinPartitions("conv_id", "seq")

    def run(batches):
        one, now, begun, state = None, None, False, NOTHING
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if not begun or row["conv_id"] != now:
                    if begun:
                        out.append(one.result())
                    one, now, begun, state = Repair(row["conv_id"]), row["conv_id"], True, NOTHING
                one.edit(row, row["ways"][state])
                state = row["exits"][state]
            yield pa.RecordBatch.from_pylist(out, schema=_DONE)
        if begun:
            yield pa.RecordBatch.from_pylist([one.result()], schema=_DONE)

    return ordered.mapInArrow(run, RESULT)


def repair(conversations: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256), one row for each conv_id.

    Rows are damaged first, see ``damage``. They stand in the order of turn, nulls first, then role and text. A null
    conv_id is a conversation of its own; one without rows after damage has zeros and empty results. Other
    columns are not read.
    """
    swept = settle(sweep(conversations.select("conv_id", "turn", "role", "text"), block_rows), "conversations")
    names = [name for name, _ in _RESULT]
    done = swept.where("seq IS NULL").select(names)
    blocks = swept.where("seq IS NOT NULL").drop("gaps", "cost", "audit", "repaired_sha256")
    goals = goals_of_blocks(blocks)
    # seq is unique over all conversations
    aimed = blocks.join(goals.select("seq", "goal", "last"), "seq")
    return done.unionByName(finish(ways_through(aimed)))
