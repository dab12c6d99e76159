"""Toxicity of documents by a weighted lexicon (operator 6).

Texts are folded first: lower case, compatibility forms, look-alike letters of other scripts and digits written for letters
to one skeleton, all else to single blanks. An Aho-Corasick automaton then finds every lexicon entry at the beginning
of a word, and every exception phrase; entries inside a phrase that holds them do not count. The score is a logistic
function of the summed weights, as such and by length.

The lexicon is learned from a bounded sample of labelled documents: beginnings of words, weighted by how much more often
documents labelled 1 have them. Words that have an entry and a neighbour with which it occurs in documents labelled 0 only
become exception phrases.

Null and empty texts have no match and the score of a text without any. Rows are scored one by one, so repeated rows
and ids change nothing. Null labels and ids without a document teach nothing; without labels the lexicon is empty and
every score is 0. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casemill.llm.common import by_bytes, held_out, stored
from casemill.llm.quality import labelled_texts

TRAIN_ROWS = 20_000  # labelled documents that the lexicon is learned from, about
LEXICON = 5_000  # entries at most
PHRASES = 5_000
SHORTEST, LONGEST = 3, 24  # letters of an entry
LEAST = 8  # documents labelled 1 that have an entry
WEIGHT = 2.0  # least log ratio of an entry
THRESHOLD = 0.5

# Letters of other scripts that look like a Latin one, and digits written for letters.
LOOKALIKES = {
    "a": "аαɑ4", "b": "вβЬ8", "c": "сϲ", "d": "ԁ", "e": "еεҽ3", "g": "ɡց9", "h": "һн", "i": "іιıl1ӏ|", "j": "ј",
    "k": "кκ", "m": "м", "n": "ոп", "o": "оοօσ0", "p": "рρ", "q": "ԛ", "s": "ѕꜱ5", "t": "тτ7", "u": "υսц", "v": "ѵν",
    "w": "ԝш", "x": "хχ", "y": "уγү", "z": "ᴢ2",
}
_LOOKS = {ord(c): letter for letter, others in LOOKALIKES.items() for c in others}


class _Fold(dict):
    """For str.translate: folds a character when it is first met."""

    def __missing__(self, code: int) -> str:
        char = chr(code)
        plain = unicodedata.normalize("NFKC", char.lower()).lower()
        plain = "".join(_LOOKS.get(ord(c), c) for c in plain if not unicodedata.combining(c))
        out = plain if plain.isalpha() else "" if unicodedata.category(char) in ("Mn", "Cf") else " "
        if len(self) < 1 << 16:
            self[code] = out
        return out


_FOLD = _Fold()
_BLANKS = re.compile("  +")


def fold(text: str) -> str:
    """The skeleton of a text, one blank before, between and after words."""
    return _BLANKS.sub(" ", f" {text.translate(_FOLD)} ")


@dataclass(frozen=True)
class Lexicon:
    """Weights of word beginnings, exception phrases (whole words), and the logistic function over a document."""

    weights: dict[str, float]
    phrases: tuple[str, ...] = ()
    intercept: float = 0.0
    slopes: tuple[float, ...] = ()


def _automaton(weights: dict[str, float], phrases: tuple[str, ...]):
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for entry, weight in weights.items():
        automaton.add_word(f" {entry}", (len(entry) + 1, weight))
    for phrase in phrases:
        automaton.add_word(f" {phrase} ", (len(phrase) + 2, None))
    automaton.make_automaton()
    return automaton


def _hits(folded: str, automaton) -> list[tuple[int, float]]:
    """(start, weight) of the entries outside of exception phrases; the heaviest entry of a word counts."""
    best: dict[int, float] = {}
    spans = []
    for end, (length, weight) in automaton.iter(folded):
        start = end - length + 1
        if weight is None:
            spans.append((start, end))
        elif weight > best.get(start, 0.0):
            best[start] = weight
    spans.sort()
    outside, at, reached = [], 0, -1  # reached: where the phrases so far end
    for a, w in sorted(best.items()):
        while at < len(spans) and spans[at][0] <= a:
            reached = max(reached, spans[at][1])
            at += 1
        if a >= reached:
            outside.append((a, w))
    return outside


def _evidence(texts: pa.Array, weights: dict[str, float], phrases: tuple[str, ...]) -> np.ndarray:
    """Per text: the heaviest entry, the sum of weights, and that sum per hundred words, the last two as logarithms."""
    if not weights:
        return np.zeros((len(texts), 3))
    automaton = _automaton(weights, phrases)
    out = []
    for value in texts:
        folded = fold(value.as_py() or "")
        found = [w for _, w in _hits(folded, automaton)]
        total = sum(found)
        out.append((max(found, default=0.0), np.log1p(total), np.log1p(100 * total / max(folded.count(" ") - 1, 1))))
    return np.array(out).reshape(-1, 3)


def _words(texts: DataFrame) -> DataFrame:
    """(word, toxic, clean): how many documents of each label have a word."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def rows():
            words, labels = zip(*counts) if counts else ((), ())
            return pa.record_batch(
                [pa.array(words, pa.string()), pa.array(labels, pa.int32()), pa.array(list(counts.values()), pa.int64())],
                names=["word", "y", "n"],
            )

        for batch in by_bytes(batches, "text"):
            for y, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                counts.update((w, y) for w in set(fold(value.as_py() or "").split()) if len(w) >= SHORTEST)
            if len(counts) > 500_000:
                yield rows()
                counts.clear()
        yield rows()

    parts = texts.select("y", "text").mapInArrow(count, "word string, y int, n long")
    return parts.groupBy("word").agg(
        F.sum(F.when(F.col("y") == 1, F.col("n")).otherwise(0)).alias("toxic"),
        F.sum(F.when(F.col("y") == 1, 0).otherwise(F.col("n"))).alias("clean"),
    )


def _entries(words: DataFrame, toxic: int, clean: int) -> dict[str, float]:
    """The word beginnings that speak for label 1; of several in a word the heaviest counts."""
    size = F.sequence(F.lit(SHORTEST), F.least(F.length("word"), F.lit(LONGEST)))
    starts = words.select(F.explode(F.transform(size, lambda k: F.substring(F.col("word"), F.lit(1), k))).alias("entry"),
                          "toxic", "clean")
    sums = starts.groupBy("entry").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    weight = F.log((F.col("toxic") + 0.5) / (toxic + 1)) - F.log((F.col("clean") + 0.5) / (clean + 1))
    rows = (
        sums.where(F.col("toxic") >= LEAST).withColumn("weight", weight).where(F.col("weight") >= WEIGHT)
        .orderBy(F.desc("weight"), F.desc(F.length("entry")), "entry").limit(LEXICON).collect()
    )
    return {row["entry"]: row["weight"] for row in rows}


def _exceptions(texts: DataFrame, weights: dict[str, float]) -> tuple[str, ...]:
    """Two words, one of them with an entry, that documents labelled 0 have often and others never."""

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(weights, ())
        for batch in by_bytes(batches, "text"):
            found = []
            for y, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                folded = fold(value.as_py() or "")
                for start, _ in _hits(folded, automaton):
                    end = folded.index(" ", start + 1)
                    here = folded[start + 1 : end]
                    after = folded[end + 1 : max(folded.find(" ", end + 1), end + 1)]
                    before = folded[folded.rfind(" ", 0, start) + 1 : start]
                    found += [(f"{here} {after}", y)] * bool(after) + [(f"{before} {here}", y)] * bool(before)
            phrases, labels = zip(*found) if found else ((), ())
            yield pa.record_batch([pa.array(phrases, pa.string()), pa.array(labels, pa.int32())], names=["phrase", "y"])

    if not weights:
        return ()
    counts = texts.select("y", "text").mapInArrow(pairs, "phrase string, y int").groupBy("phrase").agg(
        F.sum("y").alias("toxic"), F.count(F.lit(1)).alias("n")
    )
    rows = counts.where((F.col("toxic") == 0) & (F.col("n") >= 3)).orderBy(F.desc("n"), "phrase").limit(PHRASES)
    return tuple(sorted(r["phrase"] for r in rows.collect()))


def _logistic(x: np.ndarray, y: np.ndarray, steps: int = 30, ridge: float = 1e-3) -> np.ndarray:
    """Coefficients by Newton's method, the intercept first."""
    x = np.column_stack([np.ones(len(x)), x])
    beta = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x / len(y) + ridge * np.eye(len(beta))
        beta += np.clip(np.linalg.solve(hessian, x.T @ (y - p) / len(y) - ridge * beta), -5, 5)
    return beta


def train(docs: DataFrame, labels: DataFrame, column: str = "toxic", rows: int = TRAIN_ROWS) -> Lexicon:
    """Learn from at most about ``rows`` labelled documents outside the held-out fold."""
    texts = labelled_texts(docs, labels, column, rows)
    texts = stored(texts.dropDuplicates(["text", "y"]), "labelled")  # copies of a document teach no more than one
    seen = {r["y"]: r["n"] for r in texts.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = seen.get(1, 0), sum(n for y, n in seen.items() if y != 1)
    if not toxic or not clean:
        return Lexicon({}, (), -30.0 if not toxic else 30.0, (0.0, 0.0, 0.0))
    weights = _entries(_words(texts), toxic, clean)
    phrases = _exceptions(texts, weights)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "text"):
            x = _evidence(batch.column(1), weights, phrases)
            yield pa.record_batch([batch.column(0), pa.array(list(x), pa.list_(pa.float64()))], names=["y", "x"])

    sample = texts.select("y", "text").mapInArrow(measure, "y int, x array<double>").collect()  # numbers of the sample
    sample.sort()
    beta = _logistic(np.array([r["x"] for r in sample]), np.array([r["y"] == 1 for r in sample], float))
    return Lexicon(weights, phrases, float(beta[0]), tuple(map(float, beta[1:])))


def predict(docs: DataFrame, lexicon: Lexicon, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted, weight) per document; ``weight``: that of the heaviest entry in it."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)  # LEXICON entries and PHRASES phrases at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in by_bytes(batches, "text"):
            x = _evidence(batch.column(2), model.weights, model.phrases)
            score = 1 / (1 + np.exp(-np.clip(model.intercept + x @ np.array(model.slopes), -30, 30)))
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array(score), pa.array((score >= threshold).astype(np.int32)),
                 pa.array(x[:, 0])],
                names=["doc_id", "held_out", "score", "predicted", "weight"],
            )

    source = docs.select(F.col("doc_id").cast("long"), held_out().alias("held_out"), F.col("text").cast("string"))
    return source.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int, weight double")
