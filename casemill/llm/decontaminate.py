"""Benchmark decontamination by a distributed positional inverted index (operator 8).

The index is sharded by document: a shard holds some four megabytes of text, and for each term the ascending
positions of its words. Building it moves no text between executors; the shards are written as a table. A search
looks up every distinct term of the test items once per shard and goes on with the windows whose terms are all there: the
rarest of a window's terms in that shard gives candidate places, its list is moved by the term's offset, and the other
terms are met at the places where they have to stand. What is left are exact phrases. On request the same lists answer proximity: all terms of a window within some
words of its rarest one in the shard. Contamination is a matter of phrases alone.

Words are those of ``words.py``, compared by 64-bit hashes. Null and empty texts have no words, and their documents
are neither hit nor contaminated. Repeated rows and ids are judged row by row. Empty tables give empty results or
clean documents. An item id that occurs on several rows counts once. Items without an id hit words and contaminate like
others; together they count as one item, which has no place in the list of ids. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casemill.llm.common import by_bytes, stored
from casemill.llm.words import words

WINDOW = 13
NEAR = 26  # words on either side of the rarest term in which a proximity match has the others
SHARE = 20  # contaminated: at least one word in so many is hit
BLOCK_BYTES = 8 << 20  # test texts that are searched at a time
_CANDIDATES = 1 << 21

INDEX = (
    "part int, shard int, doc_ids array<long>, text_keys array<long>, first array<long>, terms binary,"
    " sizes binary, postings binary"
)
MATCHES = (
    "doc_id long, text_key long, part int, shard int, place int, n_words long,"
    " phrases array<struct<item_id:long,`from`:long,`to`:long>>, near array<long>"
)
_MATCHES = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("text_key", pa.int64()),
        ("part", pa.int32()),
        ("shard", pa.int32()),
        ("place", pa.int32()),
        ("n_words", pa.int64()),
        ("phrases", pa.list_(pa.struct([("item_id", pa.int64()), ("from", pa.int64()), ("to", pa.int64())]))),
        ("near", pa.list_(pa.int64())),
    ]
)


class Vocabulary:
    """Finds the numbers of term hashes; ``terms`` are sorted and distinct."""

    def __init__(self, terms: np.ndarray):
        self.terms = terms
        self.slots = np.full(1 << 18, -1, np.int64)
        self.slots[self._slot(terms)] = np.arange(len(terms))
        kept = self.slots[self._slot(terms)] == np.arange(len(terms))
        self.crowded = np.zeros(1 << 18, bool)  # slots that more than one term falls into
        self.crowded[self._slot(terms[~kept])] = True

    @staticmethod
    def _slot(hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(46)).astype(np.int64)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each hash among the terms, -1 for none."""
        if len(self.terms) == 0:
            return np.full(len(hashes), -1)
        slot = self._slot(hashes)
        number = self.slots[slot]
        number[self.terms[number] != hashes] = -1
        again = np.flatnonzero(self.crowded[slot])
        at = np.minimum(np.searchsorted(self.terms, hashes[again]), len(self.terms) - 1)
        number[again] = np.where(self.terms[at] == hashes[again], at, -1)
        return number


def build_index(docs: DataFrame, terms: np.ndarray | None = None) -> DataFrame:
    """Positional postings of ``docs`` (doc_id, text), one row per shard; all terms, or only the given hashes."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = None if terms is None else Vocabulary(terms)
        part = TaskContext.get().partitionId()
        for shard, batch in enumerate(by_bytes(batches, "text")):
            w = words(batch.column(1))
            if vocabulary is None:
                there, number = np.unique(w.hashes, return_inverse=True)
                place = np.arange(len(number))
            else:
                there, number = vocabulary.terms, vocabulary.find(w.hashes)
                place = np.flatnonzero(number >= 0)
                number = number[place]
            if len(there) < 1 << 16:
                number = number.astype(np.uint16)  # sorted by radix
            order = np.argsort(number, kind="stable")
            sizes = np.bincount(number, minlength=len(there))
            postings = np.diff(place[order], prepend=0).astype(np.int32)
            used = sizes > 0
            yield pa.record_batch(
                [
                    pa.array([part], pa.int32()),
                    pa.array([shard], pa.int32()),
                    pa.array([batch.column(0).to_pylist()], pa.list_(pa.int64())),
                    pa.array([batch.column(2).to_pylist()], pa.list_(pa.int64())),
                    pa.array([w.first], pa.list_(pa.int64())),
                    pa.array([there[used].tobytes()], pa.binary()),
                    pa.array([sizes[used].astype(np.int32).tobytes()], pa.binary()),
                    pa.array([postings.tobytes()], pa.binary()),
                ],
                names=["part", "shard", "doc_ids", "text_keys", "first", "terms", "sizes", "postings"],
            )

    source = docs.select(
        F.col("doc_id").cast("long"), F.col("text").cast("string"), F.xxhash64(F.col("text").cast("string"))
    )
    return source.mapInArrow(index, INDEX)


class Shard:
    """One row of the index."""

    def __init__(self, row: dict):
        self.first = np.array(row["first"], np.int64)
        self.terms = np.frombuffer(row["terms"], np.uint64)
        self.sizes = np.frombuffer(row["sizes"], np.int32).astype(np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.places = np.cumsum(np.frombuffer(row["postings"], np.int32).astype(np.int64))

    @cached_property
    def keys(self) -> np.ndarray:
        return (np.repeat(np.arange(len(self.terms)), self.sizes) << 40) | self.places

    def word_at(self) -> np.ndarray:
        """The number of the term at every place, -1 where none of the index stands."""
        out = np.full(int(self.first[-1]) + 1, -1, np.int32)
        out[self.places] = np.repeat(np.arange(len(self.terms), dtype=np.int32), self.sizes)
        return out

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.terms, hashes)
        at[at == len(self.terms)] = 0
        found = self.terms[at] == hashes if len(self.terms) else np.zeros(hashes.shape, bool)
        return np.where(found, at, -1)

    def document(self, place: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, place, "right") - 1

    def has(self, term: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Is there a place of ``term`` from ``low`` to before ``high``?"""
        at = np.searchsorted(self.keys, (term << 40) | low)
        found = self.keys[np.minimum(at, len(self.keys) - 1)]
        return (at < len(self.keys)) & (found < ((term << 40) | high))


class Windows:
    """All windows of some items, as places in the list of their words; a word is the number of its term among ``terms``."""

    def __init__(self, item_ids: list[int | None], texts: pa.Array, size: int = WINDOW):
        w = words(texts)
        counts = w.counts
        made = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
        self.size = size
        self.terms, code = np.unique(w.hashes, return_inverse=True)
        self.code = code.astype(np.int32)
        self.first = w.first  # where each row's words begin, and the number of all words
        self.ids = [*sorted({i for i in item_ids if i is not None}), None]
        number = {i: n for n, i in enumerate(self.ids)}
        self.made, self.item_of = made, np.array([number[i] for i in item_ids], np.int64)  # of each row

    def spread(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first word, length, item) of every window."""
        first = np.cumsum(self.made) - self.made
        start = np.arange(self.made.sum()) + np.repeat(self.first[:-1] - first, self.made)
        length = np.minimum(self.size, np.repeat(self.first[1:], self.made) - start)
        return start, length, np.repeat(self.item_of, self.made)


def _matches(shard: Shard, windows: Windows, near: int | None):
    """(where phrases begin, their lengths and items, rarest places of proximity matches)."""
    start, length, item = windows.spread()
    number = shard.numbers(windows.terms)[windows.code]  # one look-up for each distinct term
    absent = np.concatenate([[0], np.cumsum(number < 0)])
    known = np.flatnonzero(absent[start + length] == absent[start])
    start, length, item = start[known], length[known], item[known]
    out = [(np.zeros(0, np.int64),) * 4]
    if len(start) == 0:
        return out[0]
    size_of = np.append(shard.sizes[np.maximum(number, 0)], 0)
    rarest, offset = size_of[start], np.zeros(len(start), np.int64)
    for k in range(1, windows.size):
        size = np.where(k < length, size_of[np.minimum(start + k, len(number))], np.iinfo(np.int64).max)
        fewer = size < rarest
        rarest[fewer], offset[fewer] = size[fewer], k
    word_at = shard.word_at()
    group = (np.cumsum(rarest) - rarest) // _CANDIDATES  # bounds the candidates at work
    for g in np.unique(group):
        rows = np.flatnonzero(group == g)
        n = rarest[rows]
        w = np.repeat(rows, n)
        begins = shard.starts[number[start[rows] + offset[rows]]]
        place = shard.places[np.arange(n.sum()) + np.repeat(begins - (np.cumsum(n) - n), n)]
        at, row = place - offset[w], w
        doc = shard.document(place)
        exact = (at >= shard.first[doc]) & (at + length[row] <= shard.first[doc + 1])
        at, row = at[exact], row[exact]
        for k in range(windows.size):
            there = np.minimum(k, length[row] - 1)
            same = word_at[at + there] == number[start[row] + there]
            at, row = at[same], row[same]
        close = place[_all_near(shard, number, start[w], length[w], place, doc, near)] if near is not None else place[:0]
        out.append((at, length[row], item[row], close))
    return tuple(np.concatenate(x) for x in zip(*out))


def _all_near(shard: Shard, number, start, length, place, doc, near: int) -> np.ndarray:
    """The candidates around which all terms of their window are within ``near`` words."""
    left = np.arange(len(place))
    for k in range(int(length.max(initial=0))):
        low = np.maximum(shard.first[doc[left]], place[left] - near)
        high = np.minimum(shard.first[doc[left] + 1], place[left] + near + 1)
        term = number[start[left] + np.minimum(k, length[left] - 1)]
        left = left[shard.has(term, low, high)]
    return left


def search(index: DataFrame, items: DataFrame, size: int = WINDOW, near: int | None = NEAR) -> DataFrame:
    """Phrases of ``items`` (item_id, text) in the documents of an index, a row for each document.

    ``phrases``: which words (from, to) any window of an item covers, overlapping windows of an item in one. ``near``:
    places of words around which a window has all its terms within ``near`` words (none if that is None). Items are searched in blocks of
    ``BLOCK_BYTES``; every document meets every block.
    """
    items = items.select(F.col("item_id").cast("long"), F.col("text").cast("string")).where(F.col("text").isNotNull())
    items = stored(items.distinct(), "items")  # copies of a row would all fall into one block
    size_of = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-size_of // BLOCK_BYTES))
    found = []
    for block in range(blocks):
        chosen = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        rows = chosen.collect()  # about BLOCK_BYTES
        windows = Windows([r[0] for r in rows], pa.array([r[1] for r in rows], pa.string()), size)
        shared = index.sparkSession.sparkContext.broadcast(windows)

        def look(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(len(batch)):
                    row = batch.slice(i, 1).to_pylist()[0]
                    yield _documents(row, shared.value, near)

        found.append(index.mapInArrow(look, MATCHES))
    if blocks == 1:
        return found[0]
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    return every.groupBy("part", "shard", "place").agg(
        F.first("doc_id").alias("doc_id"),
        F.first("text_key").alias("text_key"),
        F.first("n_words").alias("n_words"),
        F.flatten(F.collect_list("phrases")).alias("phrases"),  # one row per block
        F.flatten(F.collect_list("near")).alias("near"),
    )


def _documents(row: dict, windows: Windows, near: int | None) -> pa.RecordBatch:
    shard = Shard(row)
    n = len(row["doc_ids"])
    start, length, item, places = _matches(shard, windows, near)
    end = start + length
    order = np.lexsort((end, start, item, shard.document(start)))
    item, start, end = item[order], start[order], end[order]
    doc = shard.document(start)
    phrases: list[list[dict]] = [[] for _ in range(n)]
    begins = shard.first[doc]
    for d, i, a, b in zip(doc.tolist(), item.tolist(), (start - begins).tolist(), (end - begins).tolist()):
        last = phrases[d][-1] if phrases[d] else None
        item_id = windows.ids[i]
        if last and last["item_id"] == item_id and a <= last["to"]:
            last["to"] = max(last["to"], b)
        else:
            phrases[d].append({"item_id": item_id, "from": a, "to": b})
    around: list[list[int]] = [[] for _ in range(n)]
    places = np.unique(places)
    doc = shard.document(places)
    for d, p in zip(doc.tolist(), (places - shard.first[doc]).tolist()):
        around[d].append(p)
    columns = [row["doc_ids"], row["text_keys"], [row["part"]] * n, [row["shard"]] * n, list(range(n)),
               np.diff(shard.first).tolist(), phrases, around]
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, _MATCHES)], schema=_MATCHES)


def contamination(matches: DataFrame, share: int = SHARE) -> DataFrame:
    """(doc_id, text_key, n_words, n_hit, n_items, items_sha256, contaminated) of the documents searched."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits, counts, digests = [], [], []
            for phrases in batch.column("phrases").to_pylist():
                hit = end = 0
                for a, b in sorted((p["from"], p["to"]) for p in phrases):
                    hit += max(0, b - max(a, end))
                    end = max(end, b)
                found = {p["item_id"] for p in phrases}
                ids = sorted(str(i) for i in found if i is not None)
                hits.append(hit)
                counts.append(len(found))
                digests.append(hashlib.sha256(",".join(ids).encode()).hexdigest())
            n_words = batch.column("n_words").to_numpy()
            n_hit = np.array(hits, np.int64)
            yield pa.record_batch(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(n_words), pa.array(n_hit),
                 pa.array(counts, pa.int64()), pa.array(digests), pa.array((n_hit > 0) & (share * n_hit >= n_words))],
                names=["doc_id", "text_key", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
            )

    return matches.mapInArrow(
        judge,
        "doc_id long, text_key long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean",
    )


def item_terms(items: DataFrame, size: int = WINDOW) -> np.ndarray | None:
    """The term hashes of the test items, or None if these are too large to be searched at once."""
    texts = items.select(F.col("text").cast("string")).where(F.col("text").isNotNull()).distinct()
    if texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0] > BLOCK_BYTES:
        return None
    return np.unique(words(pa.array([r[0] for r in texts.collect()], pa.string())).hashes)


def decontaminate(docs: DataFrame, items: DataFrame) -> DataFrame:
    """How much of each document stands in the test items; the index stores the terms that the items have."""
    index = stored(build_index(docs, item_terms(items)), "postings", "zstd")
    return contamination(search(index, items, near=None))
