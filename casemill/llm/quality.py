"""Quality of documents by histogram gradient-boosted trees (operator 5).

A document is described by statistics of its whole text, taken in numpy over Arrow batches. Trees are grown on the
driver from a bounded sample of labelled documents, of which only the statistics are brought there: features are cut
into histogram bins, and each level of a tree is chosen from sums per bin. A tree is complete, so it is stored as plain
arrays whose node ``i`` has the children ``2i + 1`` and ``2i + 2``, and a batch goes through all trees level by level.

Null and empty texts have the statistics of an empty text and a score like any other. Rows are scored one by one.
Labels that are null, conflicting rows of an id included as they are, and ids without a document teach nothing. An
empty table gives an empty result; without labels every score is the prior, 0.5. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casemill.llm.common import by_bytes, held_out, stored, utf8
from casemill.llm.words import Words, shingles, words

TRAIN_ROWS = 20_000  # labelled documents that the trees learn from, about
TREES, DEPTH, BINS, RATE, LEAST = 120, 4, 64, 0.1, 10
THRESHOLD = 0.3
PART = 2 << 20  # bytes of text described at a time; each takes some forty bytes of work space

_CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "digit": b"0123456789",
    "blank": b" \t\r",
    "line": b"\n",
    "stop": b".?",
    "comma": b",;:",
    "shout": b"!",
    "bar": b"|",
    "symbol": b"#$%&*@^~+=_<>{}[]\\",
    "quote": b"\"'()-/`",
}
FEATURES = [
    "bytes", "words", "word_bytes", *_CLASSES, "control", "wide", "distinct_words", "top_word", "same_as_before",
    "distinct_pairs", "distinct_shingles", "line_bytes", "distinct_lines",
]
_CLASS = np.full(256, len(_CLASSES), np.int64)
for _i, _chars in enumerate(_CLASSES.values()):
    _CLASS[list(_chars)] = _i
_CLASS[128:] = len(_CLASSES) + 1
_N = len(_CLASSES) + 2


def _distinct(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """How many different hashes each document has, and how often its most frequent one occurs."""
    n = len(w.counts)
    keys = np.sort((np.repeat(np.arange(n, dtype=np.uint64), w.counts) << np.uint64(40)) | (w.hashes >> np.uint64(24)))
    first = np.flatnonzero(np.diff(keys, prepend=~keys[:1]))
    doc = (keys[first] >> np.uint64(40)).astype(np.int64)
    top = np.zeros(n, np.int64)
    np.maximum.at(top, doc, np.diff(first, append=len(keys)))
    return np.bincount(doc, minlength=n), top


def _lines(data: np.ndarray, ends: np.ndarray) -> Words:
    """Hashes of the lines of each document: its bytes with their places, summed."""
    if len(data) == 0:
        return Words(np.zeros(0, np.uint64), np.zeros(len(ends), np.int64))
    starts = np.unique(np.concatenate([ends[:-1][np.diff(ends) > 0], np.flatnonzero(data[:-1] == 10) + 1]))
    lengths = np.diff(starts, append=len(data))
    place = (np.arange(len(data)) - np.repeat(starts, lengths)).astype(np.uint64)
    with np.errstate(over="ignore"):
        mixed = (data.astype(np.uint64) + np.uint64(1)) * (place * np.uint64(2) + np.uint64(0x9E3779B97F4A7C15))
        hashes = np.add.reduceat(mixed ^ (mixed >> np.uint64(29)), starts)
    return Words(hashes, np.searchsorted(starts, ends))


def statistics(text: pa.Array) -> np.ndarray:
    """One row of FEATURES per text."""
    n = len(text)
    data, ends = utf8(text)
    size = np.diff(ends)
    doc = np.repeat(np.arange(n), size)
    kinds = np.bincount(doc * _N + _CLASS[data], minlength=n * _N).reshape(n, _N)
    w = words(text)
    pairs, five = shingles(w, 2), shingles(w, 5)
    lines = _lines(data, ends)
    count, some = w.counts, np.maximum(w.counts, 1)
    distinct, top = _distinct(w)
    same = np.zeros(n, np.int64)
    if len(w.hashes) > 1:
        again = np.flatnonzero(w.hashes[1:] == w.hashes[:-1]) + 1
        owner = np.searchsorted(w.first, again, "right") - 1
        same = np.bincount(owner[again > w.first[owner]], minlength=n)
    letters = kinds[:, 0] + kinds[:, 1] + kinds[:, 2] + kinds[:, -1]
    line_count = np.maximum(lines.counts, 1)
    columns = [
        np.log1p(size), np.log1p(count), letters / some, *(kinds / np.maximum(size, 1)[:, None]).T, distinct / some,
        top / some, same / some, _distinct(pairs)[0] / np.maximum(pairs.counts, 1),
        _distinct(five)[0] / np.maximum(five.counts, 1), np.log1p(size / line_count), _distinct(lines)[0] / line_count,
    ]
    return np.stack(columns, 1)


@dataclass
class Trees:
    """Complete trees as arrays: feature and threshold of the inner nodes, value of the leaves."""

    prior: float
    feature: np.ndarray  # trees x (2**depth - 1)
    threshold: np.ndarray
    leaf: np.ndarray  # trees x 2**depth

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.prior)
        rows = np.arange(len(x))
        inner = self.feature.shape[1]
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf):
            node = np.zeros(len(x), np.int64)
            while len(x) and node[0] < inner:  # all rows are on the same level
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            total += leaf[node - inner]
        return 1 / (1 + np.exp(-total))


def grow(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, bins: int = BINS) -> Trees:
    """Boost logistic loss. Splits that leave fewer than LEAST rows on a side are not taken."""
    inner = 2**depth - 1
    if len(y) == 0 or y.min() == y.max():
        prior = 0.0 if len(y) == 0 else float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)))
        return Trees(prior, np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, inner + 1)))
    n, features = x.shape
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(e, c) for e, c in zip(edges, x.T)], 1)  # bin b: x <= edges[b]
    prior = float(np.log(y.mean() / (1 - y.mean())))
    total = np.full(n, prior)
    rows = np.arange(n)
    out = []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        g, h = y - p, p * (1 - p)
        feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
        split = np.full(inner, bins)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first, many = 2**level - 1, 2**level
            best = np.full(many, 1e-9)
            at = (node - first) * bins
            for f in range(features):
                key = at + binned[:, f]
                sums = [np.bincount(key, v, many * bins).reshape(many, bins).cumsum(1) for v in (g, h, None)]
                (gl, hl, nl), (gt, ht, nt) = sums, [s[:, -1:] for s in sums]
                gain = gl**2 / (hl + 1) + (gt - gl) ** 2 / (ht - hl + 1) - gt**2 / (ht + 1)
                gain[(nl < LEAST) | (nt - nl < LEAST)] = 0
                gain[:, len(edges[f]) :] = 0
                b = gain.argmax(1)
                better = np.flatnonzero(gain[np.arange(many), b] > best)
                best[better] = gain[better, b[better]]
                feature[first + better], split[first + better] = f, b[better]
                threshold[first + better] = edges[f][b[better]]
            node = 2 * node + 1 + (binned[rows, feature[node]] > split[node])
        place = node - inner
        leaf = RATE * np.bincount(place, g, inner + 1) / (np.bincount(place, h, inner + 1) + 1)
        total += leaf[place]
        out.append((feature, threshold, leaf))
    return Trees(prior, *(np.stack(v) for v in zip(*out)))


def sample_labels(labels: DataFrame, column: str, rows: int) -> DataFrame:
    """(doc_id, y) of labelled documents that may be learned from, ``rows`` of them in expectation."""
    known = labels.where(F.col(column).isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    known = known.select("doc_id", F.col(column).cast("int").alias("y")).distinct()
    return _share(known, ["doc_id"], rows)


def _share(df: DataFrame, key: list[str], rows: int) -> DataFrame:
    """About ``rows`` rows, chosen by a hash of ``key``; all if there are no more."""
    share = rows / max(df.count(), 1)
    return df if share >= 1 else df.where(F.pmod(F.xxhash64(*key), F.lit(1 << 20)) < int(share * (1 << 20)))


def labelled_texts(docs: DataFrame, labels: DataFrame, column: str, rows: int) -> DataFrame:
    """(doc_id, text, y) of about ``rows`` labelled documents at most; repeated rows count once, so an id or a text that
    fills a large part of the table does not fill the sample."""
    chosen = F.broadcast(sample_labels(labels, column, rows))  # bounded by the size of the sample
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(chosen, "doc_id")
    texts = stored(texts.dropDuplicates(["doc_id", "text", "y"]), "labelled")
    return _share(texts, ["text", "doc_id"], 2 * rows)


def train(docs: DataFrame, labels: DataFrame, column: str = "quality", rows: int = TRAIN_ROWS) -> Trees:
    """Trees for the chance of label 1, from at most about ``rows`` labelled documents outside the held-out fold."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "text", PART):
            x = statistics(batch.column(2))
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(list(x))], names=["doc_id", "y", "x"])

    texts = labelled_texts(docs, labels, column, rows)
    rows_read = texts.select(F.col("doc_id").cast("long"), "y", "text").mapInArrow(
        measure, "doc_id long, y int, x array<double>"
    ).collect()  # numbers of the sample only
    rows_read.sort(key=lambda r: (r["doc_id"], r["y"], r["x"]))
    x = np.array([r["x"] for r in rows_read]).reshape(-1, len(FEATURES))
    return grow(x, np.array([r["y"] for r in rows_read], float))


def scorer(trees: Trees):
    """A column function: the score of a text."""

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        batch = pa.record_batch([texts], names=["text"])
        parts = [trees.score(statistics(part.column(0))) for part in by_bytes([batch], "text", PART)]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0))

    return score


def predict(docs: DataFrame, trees: Trees, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) per document."""
    score = scorer(trees)(F.col("text").cast("string"))
    return docs.select(F.col("doc_id"), held_out().alias("held_out"), score.alias("score")).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int")
    )
