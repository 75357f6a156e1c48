"""Token ids of many texts, as a tokenizer file and its library give them.

Encoding costs about ten microseconds a rare word, and corpora repeat their words. Texts are
therefore cut at places where no token can cross, the distinct pieces of a batch are looked up in a
bounded memo of the worker process, and only unknown pieces reach the library. The ids equal those
of the whole text:

- Tokenizers that drop white space (``cut="drop"``) split at runs of ASCII white space. Their
  normaliser treats each side on its own: no canonical composition crosses a space.
- Byte-level tokenizers (``cut="space"``) put a single space between two non-space characters at the
  head of the next token, so the text splits before it. A text in which a space has white space beside it
  is split more carefully.

A word of Latin letters passes the steps before the model unchanged but for case and byte-level characters. Where a file
has no other steps, the library's model gets such words directly; all other pieces go through every step.
"""

from __future__ import annotations

import json
import os
import re
import string
from struct import pack

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

KEPT_PIECES = 450_000
#: Of a file whose model takes words directly: a word that is not kept costs little there.
KEPT_WORDS = 250_000
LONG_PIECE = 64
TOGETHER = 1024
MARKS = (".", ",")

_encoders: dict[tuple, "Encoder"] = {}


def encoder(path: str, cut: str) -> "Encoder":
    """The worker process's encoder of a file; its memo lives as long as the process."""
    key = (path, cut)
    if key not in _encoders:
        _encoders[key] = Encoder(path, cut)
    return _encoders[key]


class Memo:
    """Pieces and their values in two generations: when the young one is full, the old one goes."""

    def __init__(self, most: int):
        self.most, self.young, self.old = most, {}, {}

    def look_up(self, keys: list) -> list:
        """The values of all keys, None where the memo has none."""
        found = list(map(self.young.get, keys))
        if self.old:
            for i in [i for i, value in enumerate(found) if value is None]:
                value = self.old.get(keys[i])
                if value is not None:
                    found[i] = value
                    self.put(keys[i], value)
        return found

    def put(self, key, value) -> None:
        if len(self.young) >= self.most:
            self.old, self.young = self.young, {}
        self.young[key] = value


class RepeatMemo(Memo):
    """A memo that takes in a piece when it comes up for the second time: most pieces of a corpus never do.

    What came up once is marked in a table of hashes; pieces that share a mark are taken in early.
    """

    def __init__(self, most: int, marks: int = 1 << 23):
        super().__init__(most)
        self.marks, self.marked = bytearray(marks), 0

    def offer(self, key, value) -> None:
        self.offer_all([key], [value])

    def offer_all(self, keys, values) -> None:
        marks, last, fresh = self.marks, len(self.marks) - 1, 0
        for key, value in zip(keys, values):
            at = hash(key) & last
            if marks[at]:
                self.put(key, value)
            else:
                marks[at] = 1
                fresh += 1
        self.marked += fresh
        if 2 * self.marked > len(marks):
            self.marks, self.marked = bytearray(len(marks)), 0


class Encoder:
    def __init__(self, path: str, cut: str):
        if cut not in ("drop", "space"):
            raise ValueError(f"unknown cut: {cut}")
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.cut = cut
        self.direct = cut == "drop" and _only_usual_steps(self.tokenizer)
        self.memo = RepeatMemo(KEPT_WORDS if self.direct else KEPT_PIECES)
        self.between = _separator(self.tokenizer)
        self.model = self.tokenizer.model

    def _encode(self, pieces: list[str]) -> list[bytes]:
        """Ids of each piece as little-endian 32-bit integers.

        Pieces are encoded as one text with a special token between them: the library treats the text on either side of
        one by itself, and a call for each piece costs more than its ids. A piece that holds the token goes alone.
        """
        found = []
        for i in range(0, len(pieces), TOGETHER):
            part = pieces[i : i + TOGETHER]
            if self.between is not None:
                text, mark = self.between
                joined = text.join(part)
                if joined.count(text) == len(part) - 1:
                    ids = np.array(self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, "<u4")
                    cuts = np.flatnonzero(ids == mark)
                    if len(cuts) == len(part) - 1:
                        raw = ids.tobytes()
                        begins = [0, *(4 * cuts + 4).tolist()]
                        found += [raw[a:b] for a, b in zip(begins, [*(4 * cuts).tolist(), len(raw)])]
                        continue
            encoded = self.tokenizer.encode_batch_fast(part, add_special_tokens=False)
            found += [np.array(e.ids, "<u4").tobytes() for e in encoded]
        return found

    def _values(self, pieces: list[str]) -> list[bytes]:
        """Ids of each of these distinct pieces, from the memo where it has them."""
        values = self.memo.look_up(pieces)
        unknown = [i for i, value in enumerate(values) if value is None]
        if self.cut == "drop":
            marked = {i: head for i in unknown if (head := self._head(pieces[i]))}
            if marked:
                tails = [pieces[i][len(head) :] for i, head in marked.items()]
                marks = list(dict.fromkeys(tails))
                marks = dict(zip(marks, self._encoded(marks)))
                for i, head, tail in zip(marked, self._encoded(list(marked.values())), tails):
                    values[i] = head + marks[tail]
                self._keep([pieces[i] for i in marked], [values[i] for i in marked])
                unknown = [i for i in unknown if values[i] is None]
        for i, value in zip(unknown, self._encoded([pieces[i] for i in unknown])):
            values[i] = value
        return values

    def _head(self, piece: str) -> str:
        """The word of a piece that is a word and one mark, or several if they are known to be one token; else nothing.

        These are separate tokens, whatever stands around them.
        """
        if piece[-1:] in MARKS and piece[:-1].lower().isalpha():
            return piece[:-1]
        head = piece.rstrip(string.punctuation) if self.direct else piece
        return head if len(head) < len(piece) and _LETTERS.fullmatch(head) else ""

    def _encoded(self, pieces: list[str]) -> list[bytes]:
        """Like ``_values`` for pieces that are not cut further; they may repeat."""
        values = dict(zip(pieces, self.memo.look_up(pieces)))
        unknown = [piece for piece, value in values.items() if value is None]
        if self.direct:
            words = [piece for piece in unknown if _LETTERS.fullmatch(piece)]
            self._take(values, words, list(map(self._word, words)))
            unknown = [piece for piece in unknown if values[piece] is None]
        self._take(values, unknown, self._encode(unknown))
        return [values[piece] for piece in pieces]

    def _word(self, word: str) -> bytes:
        """Ids of a word of Latin letters from the library's model alone."""
        word = word.lower()
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(_BYTE_CHARACTERS)
        ids = [token.id for token in self.model.tokenize(word)]
        return pack(f"<{len(ids)}I", *ids)

    def _take(self, values: dict, pieces: list[str], encoded: list[bytes]) -> None:
        values.update(zip(pieces, encoded))
        self._keep(pieces, encoded)

    def _keep(self, pieces: list[str], values: list[bytes]) -> None:
        if max(map(len, pieces), default=0) > LONG_PIECE:
            short = [i for i, piece in enumerate(pieces) if len(piece) <= LONG_PIECE]
            pieces, values = [pieces[i] for i in short], [values[i] for i in short]
        self.memo.offer_all(pieces, values)

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts of a batch end to end, ids before each text) for non-null strings."""
        if not len(texts):
            return np.zeros(0, np.uint32), np.zeros(1, np.int64)
        if self.cut == "drop":
            lists = pc.ascii_split_whitespace(texts)
            pieces, before = lists.flatten(), _list_offsets(lists)
        else:
            pieces, before = space_pieces(texts)
        coded = pc.dictionary_encode(pieces)
        if isinstance(coded, pa.ChunkedArray):
            coded = coded.combine_chunks()
        values = self._values(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        flat = np.frombuffer(b"".join(values), "<u4")
        size = np.array(list(map(len, values)), np.int64) // 4
        first = np.cumsum(size) - size
        codes = coded.indices.to_numpy(zero_copy_only=False)
        return gather(flat, first, size, codes), np.concatenate([[0], np.cumsum(size[codes])])[before]


def space_pieces(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Pieces that begin at single spaces between non-space characters."""
    lists = pc.split_pattern(texts, " ")
    pieces, before = lists.flatten(), _list_offsets(lists)
    # a piece that is empty or has white space at an edge shows a space beside white space
    edge = pc.match_substring_regex(pieces, r"^$|^[\s\p{Z}\x1c-\x1f\x85]|[\s\p{Z}\x1c-\x1f\x85]$")
    odd = np.add.reduceat(np.append(edge.to_numpy(zero_copy_only=False), False).astype(np.int64), before[:-1])
    out, at = [], [0]
    head = np.zeros(len(pieces), bool)
    head[before[:-1]] = True
    if not odd.any():
        spaced = pc.if_else(pa.array(head), pieces, pc.binary_join_element_wise("", pieces, " "))
        return spaced, before
    spaced = pc.if_else(pa.array(head), pieces, pc.binary_join_element_wise("", pieces, " "))
    for row in range(len(texts)):
        if odd[row]:
            out.append(pa.array(_CAREFUL.split(texts[row].as_py()), pa.string()))
        else:
            out.append(spaced.slice(int(before[row]), int(before[row + 1] - before[row])).cast(pa.string()))
        at.append(at[-1] + len(out[-1]))
    return pa.concat_arrays(out), np.array(at)


def _separator(tokenizer) -> tuple[str, int] | None:
    """(text, id) of a special token that takes nothing of its surroundings, or None."""
    for number, token in sorted(tokenizer.get_added_tokens_decoder().items(), reverse=True):
        if token.special and not (token.lstrip or token.rstrip or token.single_word or token.normalized):
            return token.content, number
    return None


def byte_characters() -> dict[str, int]:
    """The byte of each character of a byte-level vocabulary: printable Latin-1 stands for itself, the other bytes for
    the characters from 256 on, in order."""
    itself = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    others = [b for b in range(256) if b not in set(itself)]
    return {chr(b): b for b in itself} | {chr(256 + n): b for n, b in enumerate(others)}


_BYTE_CHARACTERS = {b: c for c, b in byte_characters().items()}
#: Composed letters that lower-casing keeps letters, one by one.
_LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-įı-ňŊ-ž]+")
_WORDS = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"


def _only_usual_steps(tokenizer) -> bool:
    """Whether a word of ``_LETTERS`` reaches the model whole, lower-cased and in byte-level characters, and ASCII marks
    after it are one token apart."""
    file = json.loads(tokenizer.to_str())
    tidy, cut = file["normalizer"] or {}, file["pre_tokenizer"] or {}
    tidy, cut = tidy.get("normalizers", []), cut.get("pretokenizers", [])
    split = {"type": "Split", "pattern": {"Regex": _WORDS}, "behavior": "Removed", "invert": True}
    spaces = {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}
    bytewise = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": False}
    return (
        {"type": "Lowercase"} in tidy
        and all(step in ({"type": "NFC"}, {"type": "Lowercase"}, spaces) for step in tidy)
        and [{k: v for k, v in step.items() if k != "trim_offsets"} for step in cut] == [split, bytewise]
        and not any(re.fullmatch(f"({_LETTERS.pattern})?[{re.escape(string.punctuation)}]*", t["content"]) for t in file["added_tokens"])
    )


#: Before a space that stands between two characters, neither of them white space.
_CAREFUL = re.compile(r"(?<=[^\s᠎​﻿])(?= [^\s᠎​﻿])")


def gather(flat: np.ndarray, first: np.ndarray, size: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """The pieces ``flat[first[c] : first[c] + size[c]]`` of all codes end to end."""
    n = size[codes]
    ends = np.cumsum(n)
    total = int(ends[-1]) if len(ends) else 0
    if not total:
        return np.zeros(0, flat.dtype)
    kind = np.int32 if total < 2**31 and len(flat) < 2**31 else np.int64
    index = np.arange(total, dtype=kind)
    index += np.repeat((first[codes] - (ends - n)).astype(kind), n)
    return flat.take(index)


def _list_offsets(lists: pa.Array) -> np.ndarray:
    offsets = lists.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
    return offsets - offsets[0]
