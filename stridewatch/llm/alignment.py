"""Alignment of two tokenizers' tokens over the bytes of their texts.

Token A comes from a byte-level tokenizer over a space and the text, token B from a sentencepiece model over the text.
Byte offsets where tokens of both end cut them into groups; an A and a B token of one group are linked.

1. Spans. The character offsets of ``tokenizers`` and the spans of a sentencepiece proto are coarse cuts. Where several
   tokens share a character, and for byte-fallback tokens, the decoded bytes of the tokens say where each ends.
2. Pieces. Neither tokenizer has a token across a single space between two other characters, so both end there: a
   text's groups are those of its pieces, and of the units these are cut into. A worker remembers the units it has met
   and aligns the others together; pieces refer to units by number.
3. Blocks. Documents are taken in blocks of ``BLOCK_BYTES``. A block sends each of its distinct id pairs once, with the
   number of its documents that hold it. Counts are summed over all blocks, go back to the blocks that asked, and there
   meet the documents again: no row is made for a pair of a document.

What a worker holds does not grow with its input: values in the memo are packed, a block is aligned in slices whose arrays
go before the next one's come, and the numbers that a block keeps for each pair of a document are as narrow as they can be.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections import Counter
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settle, slices
from .tokens import LONG_PIECE, RepeatMemo, byte_characters, gather, space_pieces

KEPT_PIECES = 250_000
#: Units that are encoded as one text, and units whose groups are made at once.
TOGETHER = 512
AT_ONCE = 16 * TOGETHER
BLOCK_BYTES = 4 << 20
#: Texts of a block that are aligned at once: arrays of all their links exist meanwhile.
SLICE_BYTES = 1 << 20
#: More links than this in a group, and its pairs are counted by distinct ids.
LARGE_GROUP = 4096
#: What one entry of a unit's pairs counts; a pair that is linked more often has several.
MOST_TIMES = 2**31 - 1
MARKS = (".", ",")
_MARKED = re.compile(r"[^\W\d_][.,]")
_BEFORE_LINE = tuple(".,;:!?")
#: No white space but one space before.
_PLAIN = re.compile(r" ?\S+")

_aligners: dict[tuple, "Aligner"] = {}


def aligner(a_path: str, b_path: str) -> "Aligner":
    """The worker process's aligner of two files; its memo lives as long as the process."""
    key = (a_path, b_path)
    if key not in _aligners:
        _aligners[key] = Aligner(a_path, b_path)
    return _aligners[key]


class Aligner:
    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=b_path)
        to_byte = byte_characters()
        self.a_bytes = {
            i: bytes(to_byte[c] for c in entry) if all(c in to_byte for c in entry) else entry.encode()
            for entry, i in self.a.get_vocab().items()
        }
        self.b_bytes, self.b_is_byte = [], []
        for i in range(self.b.get_piece_size()):
            entry = self.b.id_to_piece(i)
            single = self.b.is_byte(i)
            self.b_is_byte.append(single)
            self.b_bytes.append(bytes([int(entry[3:5], 16)]) if single else entry.replace("▁", " ").encode())
        self.memo = RepeatMemo(KEPT_PIECES)
        most = max(self.a_bytes, default=-1) + 1
        self.b_single = np.array(self.b_is_byte)
        self.a_spelled = _spelled([self.a_bytes.get(i, b"") for i in range(most)])
        self.b_spelled = _spelled(self.b_bytes)
        self.a_width, self.b_width = self.a_spelled[2], self.b_spelled[2]
        # of the numbers in a unit's value, id pairs among them
        self.kind = np.dtype(np.int32 if most * self.b_size < 2**31 else np.int64)
        self.no_tokens = np.zeros(5, self.kind).tobytes()
        # ids as text behind each separator
        self.most_named = max(most, len(self.b_bytes))
        self.named = [mark + str(i) for mark in ("", ",", ";", "|") for i in range(self.most_named)]
        self.named_size = np.array(list(map(len, self.named)), np.int64)
        pieces = [b.decode("utf-8", "ignore") for b, one in zip(self.b_bytes, self.b_is_byte) if not one]
        self.cut_marks = not any(_MARKED.search(piece) for piece in pieces)
        self.cut_lines = not any("\n" in piece for piece in pieces) and len(self.b.encode("\n")) == 2

    @property
    def b_size(self) -> int:
        return len(self.b_bytes)

    def units(self, piece: str) -> list[str]:
        """Parts of a piece at whose ends tokens of both end: words, a mark after a word, a line end between words.

        The first tokenizer never joins these; the model does not if none of its entries does.
        """
        parts = [piece]
        if self.cut_lines and "\n" in piece:
            lines = piece.split("\n")
            if all(a[-1:].isalnum() or a[-1:] in _BEFORE_LINE for a in lines[:-1]) and all(b[:1].isalnum() for b in lines[1:]):
                parts = [part for line in lines for part in ("\n", line)][1:]
        if not self.cut_marks:
            return parts
        out = []
        for part in parts:
            marked = part[-1:] in MARKS and part[-2:-1].isalpha()
            out += [part[:-1], part[-1]] if marked else [part]
        return out

    def ends_of_a(self, piece: str, ids: list[int], offsets: list[tuple[int, int]]) -> list[int]:
        """The byte offset at which each token ends. A token that ends where the next one's first character begins ends
        with a character; one that the next shares a character with ends after as many bytes as it has."""
        ends = [end for _, end in offsets]
        if piece.isascii():
            return ends
        at = _byte_offsets(piece).tolist()
        done, last = 0, len(ids) - 1
        for k, end in enumerate(ends):
            shared = k < last and offsets[k + 1][0] < end
            done = done + len(self.a_bytes[ids[k]]) if shared else at[end]
            ends[k] = done
        return ends

    def ends_of_b(self, unit: str, pieces) -> tuple[list[int], list[int]]:
        """(ids, byte offset at which each token ends) of a proto's pieces. Its spans count from the text that was given to
        the model; byte tokens of one character have one span, so each ends a byte after the one before."""
        ids, ends, done = [], [], 0
        more = 1 if unit[0] == " " else -1
        for token in pieces:
            i = token.id
            done = done + 1 if self.b_is_byte[i] else token.end + more
            ids.append(i)
            ends.append(done)
        return ids, ends

    def groups(self, unit: str, encoded, pieces) -> list[tuple[list[int], list[int]]] | None:
        """(A ids, B ids) of each group; None if the tokens of either do not spell the unit."""
        raw = unit.encode()
        a_ids = encoded.ids
        b_ids, b_ends = self.ends_of_b(unit, pieces)
        if b"".join([self.a_bytes[i] for i in a_ids]) != raw or b"".join([self.b_bytes[i] for i in b_ids]) != raw:
            return None
        a_ends = self.ends_of_a(unit, a_ids, encoded.offsets)
        place = {end: k for k, end in enumerate(b_ends)}
        found, i, j = [], 0, 0
        for k, end in enumerate(a_ends):
            at = place.get(end)
            if at is not None:
                found.append((a_ids[i : k + 1], b_ids[j : at + 1]))
                i, j = k + 1, at + 1
        return found

    def _value(self, groups) -> bytes:
        """Numbers of a unit, then its groups as text: its sizes, entries of pairs and bytes of that text; a distinct id pair
        and how often it is linked, for each entry. The text is filled up to whole numbers."""
        if groups is None:
            return self.no_tokens
        n_a = n_b = 0
        pairs, text = {}, []
        for a, b in groups:
            n_a, n_b = n_a + len(a), n_b + len(b)
            if len(a) == 1 and len(b) == 1:
                key = a[0] * self.b_size + b[0]
                pairs[key] = pairs.get(key, 0) + 1
                text.append(f"{a[0]}|{b[0]}")
            else:
                times_b = Counter(b)
                for x, times in Counter(a).items():
                    for y, more in times_b.items():
                        key = x * self.b_size + y
                        pairs[key] = pairs.get(key, 0) + times * more
                text.append(f"{','.join(map(str, a))}|{','.join(map(str, b))}")
        keys, times = [], []
        for key, left in pairs.items():
            while left > 0:
                keys.append(key)
                times.append(min(left, MOST_TIMES))
                left -= MOST_TIMES
        told = ";".join(text).encode()
        numbers = np.array([n_a, n_b, len(groups), len(keys), len(told), *keys, *times], self.kind)
        return numbers.tobytes() + told + bytes(-len(told) % self.kind.itemsize)

    def _alone(self, unit: str) -> bytes:
        """The value of one unit. The model puts a space before a text; a unit that has none comes after a line end, which
        is a token of its own, and both are left out."""
        encoded = self.a.encode(unit, add_special_tokens=False)
        if unit[0] == " ":
            pieces = self.b.encode(unit[1:], return_type="proto").pieces
        else:
            pieces = self.b.encode("\n" + unit, return_type="proto").pieces[2:]
        return self._value(self.groups(unit, encoded, pieces))

    def _spans(self, units: list[str]) -> tuple[np.ndarray, ...] | None:
        """(A ids, byte offset at which each token ends, B ids, offsets, bytes of each unit) of units without white space but
        one space before them, encoded as one text with a line end before each. None if the tokens of either do not spell
        that text, or one crosses the end of a unit."""
        text = "\n" + "\n".join(units)
        raw = text.encode()
        encoded = self.a.encode(text, add_special_tokens=False)
        pieces = self.b.encode(text, return_type="proto").pieces
        a_list, b_list = encoded.ids, [token.id for token in pieces]
        a, b = np.array(a_list, np.int64), np.array(b_list, np.int64)
        if not (_spell(*self.a_spelled, a, raw) and _spell(*self.b_spelled, b, b" " + raw)):
            return None
        # spans first; tokens that share a character, and byte tokens, end after as many bytes as they have
        offsets = np.fromiter(chain.from_iterable(encoded.offsets), np.int64, 2 * len(a))
        a_end, stop = offsets[1::2], np.cumsum(np.array(list(map(len, units)), np.int64) + 1)
        if len(raw) > len(text):
            at, shared = _byte_offsets(text), np.append(offsets[2::2] < a_end[:-1], False)
            a_end, stop = np.where(shared, np.cumsum(self.a_width[a]), at[a_end]), at[stop]
        b_end = np.array([token.end for token in pieces], np.int64)
        b_end = np.where(self.b_single[b], np.cumsum(self.b_width[b]) - 1, b_end)
        size = np.diff(stop, prepend=0) - 1
        for end in (a_end, b_end):
            ends = np.zeros(len(raw) + 1, bool)
            ends[end] = True
            if not (ends[stop].all() and ends[stop - size].all()):
                return None
        own = b_end > 0
        return a, a_end, b[own], b_end[own], size

    def _together(self, units: list[str]) -> dict[str, bytes]:
        """The values of units as ``_spans`` takes them: spans of some at a time, then the groups of all.

        Where the tokens do not spell a text, or a group is large, each unit is done alone.
        """
        found, done, spans = {}, [], []
        for lo in range(0, len(units), TOGETHER):
            part = units[lo : lo + TOGETHER]
            told = self._spans(part)
            if told is None:
                found.update(zip(part, map(self._alone, part)))
            else:
                done += part
                spans.append(told)
        if not done:
            return found
        texts = np.array([len(part[4]) + part[4].sum() for part in spans])
        shift = np.cumsum(texts) - texts
        a, b, size = (np.concatenate([part[c] for part in spans]) for c in (0, 2, 4))
        a_end, b_end = (np.concatenate([part[c] + more for part, more in zip(spans, shift.tolist())]) for c in (1, 3))
        del spans
        n = len(done)
        # 1: a token of A ends here, 2: of B, 3: of both, 4: the line end before a unit
        ends = np.zeros(int(texts.sum()) + 1, np.uint8)
        ends[a_end] = 1
        ends[b_end] |= 2
        ends[np.cumsum(size + 1) - size] = 4
        a_kind, b_kind = ends[a_end], ends[b_end]
        a_own, b_own = a_kind != 4, b_kind != 4
        a_of, b_of = (np.cumsum(~own)[own] - 1 for own in (a_own, b_own))
        a, b, a_cut, b_cut = a[a_own], b[b_own], a_kind[a_own] == 3, b_kind[b_own] == 3
        a_count, b_count = np.bincount(a_of, minlength=n), np.bincount(b_of, minlength=n)
        a_group, b_group = np.cumsum(a_cut) - a_cut, np.cumsum(b_cut) - b_cut
        held_a, held_b = np.bincount(a_group), np.bincount(b_group)
        a_first, b_first = np.cumsum(held_a) - held_a, np.cumsum(held_b) - held_b
        unit_of = a_of[a_first]
        links = held_a * held_b
        large = np.unique(unit_of[links > LARGE_GROUP])
        if len(large):
            links[np.isin(unit_of, large)] = 0
        # all pairs of each group, then each unit's distinct ones
        group = np.repeat(np.arange(len(links)), links)
        k = np.arange(len(group)) - np.repeat(np.cumsum(links) - links, links)
        wide = held_b[group]
        keys = a[a_first[group] + k // wide] * self.b_size + b[b_first[group] + k % wide]
        most = len(self.a_width) * self.b_size
        once, times = np.unique(unit_of[group] * most + keys, return_counts=True)
        owner, keys = np.divmod(once, most)
        held = np.bincount(owner, minlength=n)
        # the groups as text: every id behind its separator
        a_mark, b_mark = np.ones(len(a), np.int64), np.ones(len(b), np.int64)
        a_mark[a_first], b_mark[b_first] = 2, 3
        a_mark[np.cumsum(a_count) - a_count] = 0
        named = np.empty(len(a) + len(b), np.int64)
        named[np.arange(len(a)) + b_first[a_group]] = a_mark * self.most_named + a
        named[np.arange(len(b)) + a_first[b_group] + held_a[b_group]] = b_mark * self.most_named + b
        text = "".join(map(self.named.__getitem__, named.tolist())).encode()
        ends = np.cumsum(self.named_size[named])[np.cumsum(a_count + b_count) - 1]
        told = np.diff(ends, prepend=0)
        width = 5 + 2 * held
        first = np.cumsum(width) - width
        flat = np.empty(int(width.sum()), self.kind)
        for c, column in enumerate((a_count, b_count, np.bincount(unit_of, minlength=n), held, told)):
            flat[first + c] = column
        at = first[owner] + 5 + np.arange(len(owner)) - (np.cumsum(held) - held)[owner]
        flat[at] = keys
        flat[at + held[owner]] = times
        one = self.kind.itemsize
        raw, filled = flat.tobytes(), [bytes(k) for k in range(one)]
        cuts, fill, ends = (one * np.append(first, len(flat))).tolist(), (-told % one).tolist(), ends.tolist()
        spans = zip(cuts, cuts[1:], [0, *ends], ends, fill)
        found.update(zip(done, [raw[lo:hi] + text[x:y] + filled[k] for lo, hi, x, y, k in spans]))
        for i in large.tolist():
            found[done[i]] = self._alone(done[i])
        return found

    def _fresh(self, units: list[str]) -> list[bytes]:
        """The value of each of these distinct units."""
        plain = list(filter(_PLAIN.fullmatch, units)) if self.cut_lines else []
        found = {}
        for lo in range(0, len(plain), AT_ONCE):
            found |= self._together(plain[lo : lo + AT_ONCE])
        for unit in units if len(found) < len(units) else ():
            if unit not in found:
                found[unit] = self._alone(unit)
        values = list(map(found.__getitem__, units))
        short = [i for i, unit in enumerate(units) if len(unit) <= LONG_PIECE]
        if len(short) == len(units):
            self.memo.offer_all(units, values)
        else:
            self.memo.offer_all([units[i] for i in short], [values[i] for i in short])
        return values

    def values(self, pieces: list[str]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """(values of the distinct units of these distinct pieces, units of all pieces end to end, how many each has).

        Values come from the memo where it has them. Each piece begins with a space.
        """
        cut = [i for i, piece in enumerate(pieces) if piece.endswith(MARKS) or "\n" in piece]
        parts = [self.units(pieces[i]) for i in cut]
        whole = np.delete(np.arange(len(pieces)), cut)
        number = dict(zip([pieces[i] for i in whole.tolist()], range(len(whole))))
        count = np.ones(len(pieces), np.int64)
        count[cut] = list(map(len, parts))
        which = np.empty(int(count.sum()), np.int64)
        of_whole = (np.cumsum(count) - count)[whole]
        of_parts = np.ones(len(which), bool)
        of_parts[of_whole] = False
        which[of_whole] = np.arange(len(whole))
        which[of_parts] = [number.setdefault(unit, len(number)) for units in parts for unit in units]
        units = list(number)
        values = self.memo.look_up(units)
        unknown = [i for i, value in enumerate(values) if value is None]
        for i, value in zip(unknown, self._fresh([units[i] for i in unknown])):
            values[i] = value
        return values, which, count

    def block(self, texts: pa.Array) -> dict:
        """Sizes, groups' digest and id pairs of each text of a batch of non-null strings."""
        parts = [self._slice(texts.slice(lo, hi - lo)) for lo, hi in slices(texts, SLICE_BYTES)]
        pairs, place = np.unique(np.concatenate([part["pairs"] for part in parts]), return_inverse=True)
        holders, before, cut = np.zeros(len(pairs), np.int64), [np.zeros(1, np.int64)], 0
        for part in parts:
            own = place[cut : cut + len(part["pairs"])]
            holders[own] += part["holders"]
            part["which"] = _narrow(own[part["which"]])
            before.append(part["before"][1:] + before[-1][-1])
            cut += len(own)
        return {
            "sums": [np.concatenate(column) for column in zip(*(part["sums"] for part in parts))],
            "digests": [digest for part in parts for digest in part["digests"]],
            "pairs": pairs,
            "holders": holders,
            "before": np.concatenate(before),
            "which": np.concatenate([part["which"] for part in parts]),
            "times": np.concatenate([part["times"] for part in parts]),
        }

    def _slice(self, texts: pa.Array) -> dict:
        pieces, before = space_pieces(texts)
        head = np.zeros(len(pieces), bool)
        head[before[:-1]] = True
        pieces = pc.if_else(pa.array(head), pc.binary_join_element_wise(" ", pieces, ""), pieces)
        coded = pc.dictionary_encode(pieces)
        if isinstance(coded, pa.ChunkedArray):
            coded = coded.combine_chunks()
        values, units, count = self.values(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        codes = coded.indices.to_numpy(zero_copy_only=False)
        before = np.concatenate([[0], np.cumsum(count[codes])])[before]
        codes = gather(units, np.cumsum(count) - count, count, codes)
        raw, one = b"".join(values), self.kind.itemsize
        flat = np.frombuffer(raw, self.kind)
        size = np.array(list(map(len, values)), np.int64) // one
        first = np.cumsum(size) - size
        head = flat[first[:, None] + np.arange(5)].astype(np.int64)
        told = one * (first + 5 + 2 * head[:, 3])
        strings = [raw[lo:hi] for lo, hi in zip(told.tolist(), (told + head[:, 4]).tolist())]

        n = len(texts)
        good = np.diff(np.concatenate([[0], np.cumsum(head[codes, 0] == 0)])[before]) == 0
        sums = [np.diff(np.concatenate([[0], np.cumsum(head[codes, c])])[before]) * good for c in range(3)]
        spans = before.tolist()
        digests = [
            hashlib.sha256(b";".join([strings[c] for c in codes[spans[t] : spans[t + 1]].tolist()])).hexdigest() if good[t] else ""
            for t in range(n)
        ]
        # each document's distinct units, then its distinct pairs
        doc = np.repeat(np.arange(n), np.diff(before))
        use = good[doc]
        once, often = np.unique(doc[use] * len(values) + codes[use], return_counts=True)
        doc, unit = np.divmod(once, max(len(values), 1))
        held = head[unit, 3]
        keys = gather(flat, first + 5, head[:, 3], unit)
        times = gather(flat, first + 5 + head[:, 3], head[:, 3], unit) * np.repeat(often, held)
        pairs, which = np.unique(keys, return_inverse=True)
        place = np.repeat(doc, held) * max(len(pairs), 1) + which
        del keys, which
        order = np.argsort(place)
        place, times = place[order], times[order]
        start = np.flatnonzero(np.append(True, place[1:] != place[:-1]))[: len(place)]
        doc, which = np.divmod(place[start], max(len(pairs), 1))
        times = np.add.reduceat(times, start) if len(start) else times
        before = np.searchsorted(doc, np.arange(n + 1))
        return {
            "sums": [*sums, np.diff(np.concatenate([[0], np.cumsum(times)])[before])],
            "digests": digests,
            "pairs": pairs.astype(np.int64),
            "holders": np.bincount(which, minlength=len(pairs)),
            "before": before,
            "which": _narrow(which),
            "times": _narrow(times),
        }


def _narrow(values: np.ndarray) -> np.ndarray:
    """The same numbers, none below zero, in as few bytes each as the largest one needs."""
    return values.astype(np.min_scalar_type(int(values.max(initial=0))))


def _widen(raw: pa.Buffer, n: int) -> np.ndarray:
    """The numbers that ``_narrow`` has left, n of them, from their bytes."""
    return np.frombuffer(raw, f"<u{len(raw) // n}").astype(np.int64) if n else np.zeros(0, np.int64)


def _byte_offsets(text: str) -> np.ndarray:
    """The byte offset of each character, and of the end."""
    if text.isascii():
        return np.arange(len(text) + 1)
    code = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    size = 1 + (code > 0x7F).astype(np.int64) + (code > 0x7FF) + (code > 0xFFFF)
    return np.concatenate([[0], np.cumsum(size)])


def _spelled(entries: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes of all entries end to end, where each begins, how many it has)."""
    width = np.array(list(map(len, entries)), np.int64)
    return np.frombuffer(b"".join(entries), np.uint8), np.cumsum(width) - width, width


def _spell(flat: np.ndarray, first: np.ndarray, width: np.ndarray, ids: np.ndarray, raw: bytes) -> bool:
    """Whether the bytes of these tokens are this text."""
    return gather(flat, first, width, ids).tobytes() == raw


_LONGS = pa.list_(pa.int64())
_BLOCK = pa.schema(
    [("block", pa.int64()), ("doc_ids", _LONGS)]
    + [(c, _LONGS) for c in ("n_a", "n_b", "n_groups", "n_links")]
    + [("digests", pa.list_(pa.string()))]
    + [(c, _LONGS) for c in ("pairs", "holders", "before")]
    + [(c, pa.binary()) for c in ("which", "times")]
)
_SQL = {pa.int64(): "long", _LONGS: "array<bigint>", pa.binary(): "binary", pa.list_(pa.string()): "array<string>"}
BLOCK = ", ".join(f"{f.name} {_SQL[f.type]}" for f in _BLOCK)
OUTPUT = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
)
_ARROW = pa.schema(
    [(c, pa.int64()) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")]
    + [("groups_sha256", pa.string())]
)


def aligned_blocks(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """One row for each block of documents; see ``Aligner.block``."""

    def align(batches):
        part, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            texts, ids = batch.column(1), batch.column(0)
            for lo, hi in slices(texts, BLOCK_BYTES):
                found = aligner(a_path, b_path).block(texts.slice(lo, hi - lo))
                found |= {c: found[c].tobytes() for c in ("which", "times")}
                row = [part << 32 | number, ids.slice(lo, hi - lo).to_pylist(), *found.pop("sums"), *found.values()]
                number += 1
                yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, _BLOCK)], schema=_BLOCK)
                pa.default_memory_pool().release_unused()

    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(align, BLOCK)


def align(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256), one row for each row of ``docs``.

    Null and empty texts have no tokens, nor have texts whose A or B tokens do not spell a space and the text: zeros, and
    an empty string for the digest. Rows that share a doc_id, or have none, count as documents of their own. Only
    doc_id and text are read.
    """
    from sentencepiece import SentencePieceProcessor

    b_size = SentencePieceProcessor(model_file=b_path).get_piece_size()
    blocks = settle(aligned_blocks(docs, a_path, b_path), "aligned")
    asked = blocks.select("block", F.explode(F.arrays_zip("pairs", "holders")).alias("p"))
    asked = asked.select("block", F.col("p.pairs").alias("pair"), F.col("p.holders").alias("holders"))
    counts = asked.groupBy("pair").agg(F.sum("holders").alias("n")).withColumn("a", F.expr(f"pair div {b_size}"))
    # one row an A id: at most the vocabulary
    highest = counts.groupBy("a").agg(F.max("n").alias("highest"))
    told = counts.join(F.broadcast(highest), "a").select("pair", "n", (F.col("n") == F.col("highest")).alias("best"))
    answers = asked.select(F.col("block").alias("asker"), "pair").join(told, "pair")

    def describe(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        pair = right.column("pair").to_numpy()
        order = np.argsort(pair)
        n, best = right.column("n").to_numpy()[order], right.column("best").to_numpy(zero_copy_only=False)[order]
        for i in range(left.num_rows):  # a block is one row
            row = {f.name: left.column(f.name)[i].values for f in left.schema if pa.types.is_list(f.type)}
            before = row["before"].to_numpy()
            which, times = (_widen(left.column(c)[i].as_buffer(), int(before[-1])) for c in ("which", "times"))
            sums = [
                pa.array(np.diff(np.concatenate([[0], np.cumsum(v)])[before]))
                for v in (times * best[which], times * n[which])
            ]
            columns = [row[c] for c in ("doc_ids", "n_a", "n_b", "n_groups", "n_links")] + sums + [row["digests"]]
            out.append(pa.table(columns, schema=_ARROW))
        return pa.concat_tables(out) if out else _ARROW.empty_table()

    return blocks.drop("holders", "pairs").groupBy("block").cogroup(answers.groupBy("asker")).applyInArrow(describe, OUTPUT)
