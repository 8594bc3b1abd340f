"""Toxicity (operator 10): a weighted lexicon matched by Aho-Corasick.

Texts are folded: lower case, look-alike letters and digit substitutions to Latin letters, all but letters to single blanks.
The lexicon holds whole words (the fixed list, and learned words of less than four letters) and learned beginnings of words, with weights; an automaton finds them behind a blank.
Of the entries that fit one word the longest counts. Words inside an exception phrase don't count. The sum of weights per thousand words goes into a logistic
curve whose two coefficients are fitted with the lexicon; nothing else of a text does, so its length alone has no part in the score.

Weights are learned from a bounded sample of labelled rows (`sample`, those with the smallest hashes of doc_id): log odds of a
word or beginning in toxic against other texts. Every one that passes the test of chance is an entry, so only the sample bounds the lexicon. Null or empty texts have no match and get the curve's lowest score. Rows with a
null doc_id are scored, not learned from. Of repeated rows each is scored. Without labels the fixed list alone counts. Very long texts are matched in one pass each; matches
that don't count take no memory. Columns with the names that scores have while they are made pass unchanged."""

from __future__ import annotations

import bisect
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

SAMPLE, SHORTEST, LONGEST, LEAST_ODDS = 12_000, 4, 10, 3.5
# Common insults, whole words with the weight 3 unless the sample gives another.
INSULTS = "clown disgusting idiot loser moron pathetic scum stupid trash worthless".split()
# Phrases in which such words are harmless.
EXCEPTIONS = ["class clown", "clown car", "clown fish", "sore loser", "trash bag", "trash can", "trash collection", "worthless securities"]
# Look-alikes and digit substitutions.
FOLDED = {
    "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s",
    "а": "a", "в": "b", "с": "c", "е": "e", "ё": "e", "н": "h", "і": "i", "ї": "i", "ј": "j", "к": "k", "м": "m", "о": "o", "р": "p", "ѕ": "s", "т": "t", "у": "y", "х": "x", "ԁ": "d", "ԛ": "q", "ԝ": "w",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ɡ": "g", "ⅼ": "l", "​": "", "­": "",
}
_TABLE = str.maketrans(FOLDED)
_BREAK = re.compile(r"[\W\d_]+")


def fold(text: str | None) -> str:
    """Letters only, with a blank before, between and behind words."""
    words = _BREAK.sub(" ", (text or "").lower().translate(_TABLE)).strip()
    return f" {words} " if words else " "


@dataclass
class Lexicon:
    """Patterns that start with a blank (and end with one, if they are whole words), with weights; phrases; coefficients of the curve."""

    weights: dict[str, float] = field(default_factory=lambda: {f" {w} ": 3.0 for w in INSULTS})
    exceptions: list[str] = field(default_factory=lambda: list(EXCEPTIONS))
    curve: tuple[float, float] = (-3.0, 1.5)

    def automaton(self):  # noqa: ANN201
        import ahocorasick

        a = ahocorasick.Automaton()
        for w, weight in self.weights.items():
            a.add_word(w, (len(w), weight))
        for p in self.exceptions:
            a.add_word(f" {p} ", (len(p) + 2, 0.0))
        a.make_automaton()
        return a

    def sums(self, texts: list[str | None], automaton) -> tuple[np.ndarray, np.ndarray]:  # noqa: ANN001
        """Of each text, the sum of weights and the number of words."""
        total, words = np.zeros(len(texts)), np.zeros(len(texts))
        for i, text in enumerate(texts):
            s = fold(text)
            words[i] = s.count(" ") - 1
            best: dict[int, tuple[int, float]] = {}  # by the blank before a word, in order of their ends
            safe: list[tuple[int, int]] = []  # phrases, apart and in order
            for end, (size, weight) in automaton.iter(s):
                start = end - size + 1
                if weight == 0.0:
                    while safe and safe[-1][1] >= start:
                        start = min(start, safe.pop()[0])
                    safe.append((start, end))
                elif size > best.get(start, (0, 0.0))[0]:
                    best[start] = (size, weight)
            if safe:
                starts = [a for a, _ in safe]
                for start, (size, _) in list(best.items()):
                    k = bisect.bisect_right(starts, start) - 1
                    if k >= 0 and start + size - 1 <= safe[k][1]:
                        del best[start]
            total[i] = sum(weight for _, weight in best.values())
        return total, words

    def scores(self, total: np.ndarray, words: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(_features(total, words) @ np.array(self.curve))))


def _features(total: np.ndarray, words: np.ndarray) -> np.ndarray:
    return np.stack([np.ones(len(total)), np.log1p(1000 * total / (words + 50))], 1)


def _fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> tuple[float, ...]:
    """Newton's method for a logistic curve with a ridge on all but the constant."""
    b, r = np.zeros(x.shape[1]), ridge * np.diag([1e-6] + [1.0] * (x.shape[1] - 1))
    for _ in range(30):
        p = 1 / (1 + np.exp(-(x @ b)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + r, x.T @ (y - p) - r @ b)
        b += step
        if np.abs(step).max() < 1e-6:
            break
    return tuple(b)


def _beginnings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents, toxic and other, that hold each word (with a blank behind it, if it has less than SHORTEST letters) or beginning."""
    seen: tuple[Counter, Counter] = (Counter(), Counter())
    for batch in batches:
        for text, toxic in zip(common.column(batch, "text").to_pylist(), common.column(batch, "toxic").to_pylist(), strict=True):
            words = set(fold(text).split())
            seen[toxic].update({w[:k] for w in words for k in range(SHORTEST, min(len(w), LONGEST) + 1)} | {f"{w} " for w in words if len(w) < SHORTEST})
    keys = list(seen[0].keys() | seen[1].keys())
    for a in range(0, len(keys), 50_000):
        some = keys[a : a + 50_000]
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.string()), pa.array([seen[1][k] for k in some], pa.int64()), pa.array([seen[0][k] for k in some], pa.int64())], ["word", "toxic", "other"])


def held_out(doc_id: str = "doc_id") -> F.Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, *, sample: int = SAMPLE) -> Lexicon:
    """Learns from at most `sample` labelled rows that aren't held out."""
    rows = labels.filter("doc_id is not null and toxic is not null").filter(~held_out()).select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    rows = rows.orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(sample)
    texts = common.cut(docs.select("doc_id", "text").join(F.broadcast(rows), "doc_id").select("text", "toxic").filter("toxic in (0, 1)"))
    n = {r.toxic: r["count"] for r in texts.groupBy("toxic").count().collect()}
    lexicon = Lexicon()
    if not n.get(0) or not n.get(1):
        return lexicon
    share = n[1] / (n[0] + n[1])
    counts = texts.transform(common.mapped, _beginnings, "word string, toxic long, other long").groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
    odds = F.log((F.col("toxic") + 0.5) / (n[1] + 1)) - F.log((F.col("other") + 0.5) / (n[0] + 1))
    # So often that, of a million beginnings, chance would make one or none look toxic.
    least = max(3, math.ceil(math.log(1e6) / math.log(1 / min(share, 0.5))))
    found = counts.withColumn("odds", odds).filter((F.col("toxic") >= least) & (F.col("odds") >= LEAST_ODDS)).collect()  # words of the sample
    for r in sorted(found, key=lambda r: (len(r.word), r.word)):
        # A beginning of which a chosen one is a beginning adds nothing.
        if not any(f" {r.word[:k]}" in lexicon.weights for k in range(SHORTEST, len(r.word))):
            lexicon.weights[f" {r.word}"] = round(r.odds, 4)
    for w in INSULTS:  # as much as the sample says, if it says anything of the word's beginnings
        learned = [r.odds for r in found if w.startswith(r.word)]
        lexicon.weights[f" {w} "] = round(max(learned), 4) if learned else 3.0
    work = lexicon

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = work.automaton()
        for batch in batches:
            total, words = work.sums(common.column(batch, "text").to_pylist(), automaton)
            yield pa.RecordBatch.from_arrays([pa.array(total), pa.array(words), common.column(batch, "toxic")], ["total", "words", "toxic"])

    points = texts.transform(common.mapped, sums, "total double, words double, toxic int").toPandas()  # `sample` rows at most
    points = points.sort_values(["total", "words", "toxic"])
    lexicon.curve = _fit(_features(points.total.to_numpy(), points.words.to_numpy()), points.toxic.to_numpy())
    return lexicon


def _scored(docs: DataFrame, lexicon: Lexicon, names: tuple[str, str, str]) -> DataFrame:
    """docs with the sum of weights, the number of words and the score, under `names`, which must be free; passes all columns through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton()
        for batch in batches:
            total, words = lexicon.sums(common.column(batch, "text").to_pylist(), automaton)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(total), pa.array(words.astype(np.int64)), pa.array(lexicon.scores(total, words))], [*batch.schema.names, *names])

    return docs.transform(common.mapped, run, ", ".join([*(f"`{c}` {k}" for c, k in docs.dtypes), *(f"`{c}` {k}" for c, k in zip(names, ("double", "long", "double"), strict=True))]))


def score(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """Per row: doc_id, matched (sum of weights), n_words, score."""
    return _scored(docs.select("doc_id", "text"), lexicon, ("matched", "n_words", "score")).drop("text")


def drop_toxic(docs: DataFrame, lexicon: Lexicon, limit: float = 0.7) -> DataFrame:
    """docs without the rows that score `limit` or more."""
    names = tuple(common.free(docs, f"__{c}") for c in ("matched", "words", "score"))
    return _scored(docs, lexicon, names).filter(F.col(names[2]) < limit).drop(*names)
