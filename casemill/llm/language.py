"""Language of documents by rank-order profiles of letter n-grams (operator 3).

The profile of a language lists the most frequent n-grams of one to three characters in its texts, by rank. A
document's own most frequent n-grams are compared with each profile: every n-gram adds the difference of its two ranks,
or the length of a profile if it is not in it, and the language with the smallest sum is predicted. N-grams are taken
from the whole text in lower case; all that is not a letter is one blank.

Null texts and texts without a letter are ``und`` with score 0. Equal counts are ranked by n-gram, equal distances by
name. Rows are judged one by one, so repeated rows and ids change nothing; an empty table gives an empty result, and
without any profile every text is ``und``. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from casemill.llm.common import by_bytes, held_out

TRAIN_DOCS = 4_000  # documents of each language that its profile is made from, about
PROFILE = 400  # n-grams of a profile, and of a document that are compared
SIZES = (1, 2, 3)
UNKNOWN = "und"
_BLANK = 1  # no letter has this code point; 0 stands before shorter n-grams
_CODES = np.array([c if chr(c).isalpha() else _BLANK for c in range(1 << 16)], np.int64)


def grams(text: str) -> np.ndarray:
    """All n-grams of a text, as numbers of three code points with 21 bits each."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    high = points >= 1 << 16
    codes = _CODES[np.where(high, 0, points)]
    if high.any():
        codes[high] = [ord(c) if c.isalpha() else _BLANK for c in map(chr, points[high].tolist())]
    keep = codes != _BLANK
    keep[1:] |= codes[:-1] != _BLANK  # one blank after a word
    blank = np.array([_BLANK], np.int64)
    codes = np.concatenate([blank, codes[keep], blank]) if keep.any() else codes[:0]
    if (codes == _BLANK).all():
        return np.zeros(0, np.int64)
    if codes[-2] == _BLANK:
        codes = codes[:-1]
    if codes[1] == _BLANK:
        codes = codes[1:]
    two = (codes[:-1] << 21) | codes[1:]
    return np.concatenate([codes[codes != _BLANK], two, (codes[:-2] << 42) | two[1:]])


def counted(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    found = np.sort(found)
    first = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]]))
    return found[first], np.diff(first, append=len(found))


def ranked(found: np.ndarray, most: int = PROFILE) -> np.ndarray:
    """The most frequent n-grams, in order of rank."""
    gram, count = counted(found)
    if len(gram) > most:
        enough = count >= np.partition(count, len(count) - most)[len(count) - most]
        gram, count = gram[enough], count[enough]
    return gram[np.lexsort((gram, -count))[:most]]


@dataclass(frozen=True)
class Profiles:
    """names: the languages in order; gram: all n-grams in order; rank: n-gram x language, PROFILE for none."""

    names: tuple[str, ...]
    gram: np.ndarray
    rank: np.ndarray

    def judge(self, text: str) -> tuple[str, float]:
        found = grams(text)
        if len(found) == 0 or not self.names:
            return UNKNOWN, 0.0
        own = ranked(found)
        at = np.minimum(np.searchsorted(self.gram, own), len(self.gram) - 1)
        theirs = np.where((self.gram[at] == own)[:, None], self.rank[at], PROFILE)
        apart = np.where(theirs < PROFILE, np.abs(theirs - np.arange(len(own))[:, None]), PROFILE).sum(0)
        best = int(apart.argmin())
        return self.names[best], 1 - float(apart[best]) / (PROFILE * len(own))


def train(docs: DataFrame, rows: int = TRAIN_DOCS) -> Profiles:
    """Profiles from at most about ``rows`` distinct texts of each language outside the held-out fold.

    PROFILE n-grams a language reach the driver.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "text"):
            each: dict[str, list[np.ndarray]] = {}
            for lang, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                each.setdefault(lang, []).append(grams(value.as_py()))
            for lang, parts in each.items():
                all_of = np.concatenate(parts)
                if len(all_of):
                    gram, n = counted(all_of)
                    yield pa.record_batch([pa.array([lang] * len(gram)), pa.array(gram), pa.array(n)],
                                          names=["lang", "gram", "n"])

    known = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out())
    share = known.groupBy("lang").agg((F.lit(rows) / F.count(F.lit(1))).alias("_share"))
    chosen = known.select("doc_id", F.col("lang"), F.col("text").cast("string").alias("text")).join(
        F.broadcast(share), "lang"  # a row for each language
    )
    part = F.pmod(F.xxhash64("text", F.lit("lang")), F.lit(1 << 20)) / (1 << 20)
    chosen = chosen.where(part < F.col("_share")).select("lang", "text").dropDuplicates()  # copies of a text count once
    sums = chosen.mapInArrow(count, "lang string, gram long, n long")
    sums = sums.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    rows_read = sums.withColumn("rank", rank - 1).where(F.col("rank") < PROFILE).select("lang", "gram", "rank").collect()
    names = tuple(sorted({r["lang"] for r in rows_read}))
    gram = np.array(sorted({r["gram"] for r in rows_read}), np.int64)
    table = np.full((len(gram), len(names)), PROFILE, np.int64)
    for r in rows_read:
        table[np.searchsorted(gram, r["gram"]), names.index(r["lang"])] = r["rank"]
    return Profiles(names, gram, table)


def predict(docs: DataFrame, profiles: Profiles) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) per document; score: 1 less the distance as a share of the largest one."""
    shared = docs.sparkSession.sparkContext.broadcast(profiles)  # PROFILE n-grams a language

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "text"):
            found = [shared.value.judge(value.as_py() or "") for value in batch.column(2)]
            names, scores = zip(*found)
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    source = docs.select(F.col("doc_id").cast("long"), held_out().alias("held_out"), F.col("text").cast("string"))
    return source.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")
