"""Toxicity: a weighted lexicon matched by Aho-Corasick in folded text, normalised by length.

Folding writes homoglyphs and digit substitutions as the plain lower-case letters they stand for and
everything that is no letter as one space. Terms are words and beginnings of words. Their weights come from
labelled documents; exception phrases are longer entries whose matches hide the terms inside them.
"""

from __future__ import annotations

import unicodedata
from bisect import bisect_right
from collections import Counter
from dataclasses import dataclass, field
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .quality import MOST_ROWS, labelled_sample, score

#: Characters that look like Latin letters, digits and signs used in their place.
LOOKS_LIKE = {
    "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i", "|": "i",
    "а": "a", "в": "b", "с": "c", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "м": "m", "о": "o", "р": "p",
    "ѕ": "s", "т": "t", "у": "y", "х": "x", "ԁ": "d", "ԛ": "q", "ԝ": "w", "α": "a", "ε": "e", "ι": "i", "κ": "k",
    "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ł": "l", "ø": "o",
}
#: Signs that stand for letters only inside a word; at a word's edge they are punctuation.
INSIDE_ONLY = "!|$@"

#: Ordinary phrases that contain a term of common lexicons; extended by the caller.
EXCEPTIONS = (
    "clown fish", "clown car", "trash can", "trash bin", "pond scum", "sore loser", "not stupid", "not worthless",
)

PREFIX_LENGTHS = (4, 5, 6)
LEAST_DOCUMENTS = 4
LEAST_SHARE = 0.01
LEAST_LOG_ODDS = 2.5
MOST_TERMS = 2_000


def fold(text: str) -> str:
    """Lower-case letters without look-alikes, words parted by one space, one space at each end."""
    return " " + " ".join(_folded_words(text)) + " "


def _folded_words(text: str):
    for raw in text.lower().split():
        if raw.isascii() and raw.isalpha():
            yield raw
            continue
        core = raw.strip("".join(c for c in set(raw) if not c.isalnum() and c not in "@$")) if not raw.isalnum() else raw
        if any(c.isalpha() for c in core):
            core = "".join(map(_plain, core))
        word = "".join(c if c.isalpha() else " " for c in core)
        yield from word.split()


_plain_cache: dict[str, str] = {}


def _plain(char: str) -> str:
    found = _plain_cache.get(char)
    if found is None:
        found = LOOKS_LIKE.get(char)
        if found is None:
            wide = unicodedata.normalize("NFKC", char).lower()
            found = LOOKS_LIKE.get(wide, wide)
            if unicodedata.category(char) == "Mn" and not char.isalpha():
                found = ""
        _plain_cache[char] = found
    return found


def learn_lexicon(texts: list[str], labels: np.ndarray) -> dict[str, float]:
    """Weights of terms: the smoothed log odds of a document that has the term being toxic.

    ``" word "`` is a whole word, ``" stem"`` the beginning of any word. Only terms of at least
    ``LEAST_DOCUMENTS`` toxic documents, and ``LEAST_SHARE`` of them, and ``LEAST_LOG_ODDS`` above the base rate are
    kept, a longer one only if no beginning of it is as telling. Copies of a text count once.
    """
    toxic, clean = Counter(), Counter()
    once = dict(zip(texts, labels.tolist()))
    texts, labels = list(once), np.array(list(once.values()), np.int64)
    n_toxic = int(labels.sum())
    n_clean = len(labels) - n_toxic
    if not n_toxic or not n_clean:
        return {}
    for text, label in zip(texts, labels.tolist()):
        words = set(fold(text).split())
        terms = {f" {w} " for w in words}
        terms.update(f" {w[:n]}" for w in words for n in PREFIX_LENGTHS if len(w) > n)
        (toxic if label else clean).update(terms)
    weights = {}
    for term, n in toxic.items():
        if n >= max(LEAST_DOCUMENTS, LEAST_SHARE * n_toxic):
            odds = np.log((n + 0.5) / (n_toxic + 1)) - np.log((clean[term] + 0.5) / (n_clean + 1))
            if odds >= LEAST_LOG_ODDS:
                weights[term] = float(odds)
    kept: dict[str, float] = {}
    for term in sorted(weights, key=lambda t: (len(t), t)):
        heads = [term[:n] for n in range(2, len(term)) if term[:n] in kept]
        if not any(kept[h] >= weights[term] - 0.7 for h in heads):
            kept[term] = weights[term]
    top = sorted(kept, key=lambda t: (-kept[t] * np.log1p(toxic[t]), t))[:MOST_TERMS]
    return {t: kept[t] for t in top}


@dataclass
class Lexicon:
    """Weighted terms and exception phrases, and the scale from sums of weights to probabilities."""

    weights: dict[str, float]
    exceptions: tuple[str, ...] = EXCEPTIONS
    slope: float = 1.0
    offset: float = -3.0
    _automaton: object = field(default=None, repr=False)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_automaton"} | {"_automaton": None}

    def automaton(self):
        if self._automaton is None:
            import ahocorasick

            entries = ahocorasick.Automaton()
            for term, weight in self.weights.items():
                entries.add_word(term, (len(term.rstrip()), len(term) - len(term.rstrip()), weight))
            for phrase in self.exceptions:
                entries.add_word(fold(phrase), (len(fold(phrase).rstrip()), 1, None))
            if len(entries):
                entries.make_automaton()
            self._automaton = entries
        return self._automaton

    def matches(self, text: str) -> tuple[float, int]:
        """(sum of the weights of all matches outside exceptions, words) of a text."""
        folded = fold(text)
        words = folded.count(" ") - 1
        if not len(self.automaton()):
            return 0.0, max(words, 0)
        terms, hidden = [], []
        for end, (size, edge, weight) in self.automaton().iter(folded):
            span = (end - edge - size + 1, end - edge + 1)
            (hidden if weight is None else terms).append((*span, weight or 0.0))
        if hidden:
            # a term is hidden if the exceptions that begin at or before it reach beyond its end
            hidden.sort()
            begins = [begin for begin, _, _ in hidden]
            reach = list(accumulate((end for _, end, _ in hidden), max))
            terms = [(a, b, w) for a, b, w in terms if not (i := bisect_right(begins, a)) or reach[i - 1] < b]
        return sum(w for _, _, w in terms), max(words, 0)

    def measure(self, text: str) -> float:
        """The sum of weights over the logarithm of the length: long texts need more matches."""
        total, words = self.matches(text)
        return total / np.log2(4 + words / 64)

    def score(self, texts: pa.Array) -> np.ndarray:
        found = np.array([self.measure(t) for t in texts.to_pylist()])
        return 1 / (1 + np.exp(-np.clip(self.slope * found + self.offset, -30, 30)))


def train(texts: list[str], labels: np.ndarray, exceptions: tuple[str, ...] = EXCEPTIONS, seed: int = 5) -> Lexicon:
    """Learn weights on half of the rows, fit slope and offset on the other half, then weights on all rows."""
    order = np.random.default_rng(seed).permutation(len(texts))
    half = len(texts) // 2
    a, b = order[:half], order[half:]
    lexicon = Lexicon(learn_lexicon([texts[i] for i in a], labels[a]), exceptions)
    x = np.array([lexicon.measure(texts[i]) for i in b])
    slope, offset = _logistic(x, labels[b])
    return Lexicon(learn_lexicon(texts, labels), exceptions, slope, offset)


def _logistic(x: np.ndarray, y: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and offset of a logistic curve by Newton's method with a small ridge."""
    if not len(x) or y.min() == y.max():
        return 1.0, -3.0
    at = np.zeros(2)
    rows = np.stack([x, np.ones_like(x)], axis=1)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(rows @ at, -30, 30)))
        gradient = rows.T @ (p - y) + 1e-2 * at
        curve = (rows * (p * (1 - p))[:, None]).T @ rows + 1e-2 * np.eye(2)
        step = np.linalg.solve(curve, gradient)
        at = at - np.clip(step, -2, 2)
    return float(at[0]), float(at[1])


def classify(
    docs: DataFrame, labels: DataFrame, held_out, threshold: float = 0.5, most_rows: int = MOST_ROWS,
    exceptions: tuple[str, ...] = EXCEPTIONS,
) -> DataFrame:
    """(doc_id, held_out, score, predicted), one row for each row of ``docs``.

    ``held_out`` is a condition on doc_id; labels of such rows are not learned from. Null texts are empty and,
    like texts without a match, get the score of the offset. Only doc_id and text are read.
    """
    lexicon = train(*labelled_sample(docs, labels, "toxic", ~held_out, most_rows), exceptions)
    return score(docs, lexicon).select(
        "doc_id",
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
