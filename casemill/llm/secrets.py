"""Secrets in texts (operator 4): three plain patterns, and strings that look random to character Markov models.

Two first-order models, one of random strings and one of ordinary identifiers, give the chance of every character
after the one before it. The ordinary one goes by classes of characters (vowels and consonants of either case, digits, joints),
which tell the humps and joints of identifiers and the alternation of letters in words of any language, and shares the frequency of
a letter within its class over both cases. In each run of identifier characters, less what the plain patterns found of it, every maximal
stretch whose summed log-likelihood ratio reaches a margin is reported as kind ``model``, up to the next joint of the
run on either side. Both models are trained from labelled samples of a bounded number of distinct documents: the values that the
plain patterns find are random strings, beside which any character is as likely as any other; ordinary are all other
runs, and words of the documents joined as identifiers join them. The margin is what all but one in a thousand of the held-out
ordinary runs stay below, and 12 nats at least.

Spans count code points and end before their end. A null text has none. Rows are scanned one by one, so repeated rows
and ids change nothing; an empty table gives an empty result, and without samples the models are uniform and
report nothing. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casemill.llm.common import by_bytes, stored

# The plain patterns, in the order in which kinds are listed.
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # whole runs, as a run that is too short is dropped
MIN_VALUE, MIN_ACCESS = 6, 20
KINDS = ("assign", "access", "hex", "model")

TRAIN_DOCS = 20_000  # documents that the models are trained on, about
MIN_RUN = 16
MARGIN = 12.0  # nats, at least, by which a stretch must look rather random than ordinary
FALSE_ALARMS = 0.001  # share of held-out ordinary runs that may be reported
MOST = 5.0  # nats that one character can say for random
ANY = 0.8  # weight of strings of any characters beside the random samples
STRIDE = 24  # words of a text for every identifier that is made of some of them
JOINTS = "/_-"  # characters that join the parts of a run
RUN = re.compile(r"[A-Za-z0-9+/_-]{%d,}" % MIN_RUN)
_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"
_CODES = np.zeros(128, np.int64)  # 0 is the border of a run
_CODES[[ord(c) for c in _ALPHABET]] = np.arange(1, len(_ALPHABET) + 1)
_N = len(_ALPHABET) + 1


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the plain patterns, leftmost and not overlapping within a kind."""
    found = []
    if ":" in text or "=" in text:
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_VALUE]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= MIN_ACCESS]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def _pairs(text: str) -> np.ndarray:
    """Counts of each character after each other one in the runs of a text."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = np.where(points < 128, _CODES[np.minimum(points, 127)], 0)
    pairs = np.concatenate([[0], codes[:-1]]) * _N + codes
    return np.bincount(pairs[codes > 0], minlength=_N * _N)


def _class_of(char: str) -> int:
    if char.isalpha():
        return (0 if char.lower() in "aeiouy" else 1) + 2 * char.isupper()
    return 4 if char.isdigit() else 5 + "+/_-".index(char)


_CLASS = np.array([9] + [_class_of(c) for c in _ALPHABET])  # the last one is the border of a run
_WORD = re.compile(r"[A-Za-z]+")


def _cased(words: list[str]) -> list[str]:
    return [w[0].upper() + w[1:] for w in words]


# Ways in which identifiers join lower-case words; those with a number take one from the lengths of the words.
_JOINED = (
    lambda w: w[0] + "".join(_cased(w[1:])),
    lambda w: "".join(_cased(w)),
    "_".join,
    lambda w: "_".join(w).upper(),
    "-".join,
    "/".join,
    "".join,
    lambda w: "_".join(w) + str(len(w[0]) * 7 % 100),
    lambda w: "".join(_cased(w)) + str(len(w[0]) % 10),
    lambda w: w[0].title() + w[-1][:3].upper() + "".join(_cased(w[1:])),
    lambda w: f"__{'_'.join(w)}__",
    lambda w: w[0] + "".join(_cased(w[1:])),
    lambda w: "".join(_cased(w)),
    "_".join,
    lambda w: "_".join([w[0], str(len(w[0]) * 3 % 100), *w[1:]]),
    "_".join,
)


def samples(text: str) -> tuple[list[str], list[str]]:
    """(random strings, ordinary runs) of a text."""
    random, rest, at = [], [], 0
    for start, kind, end in base_spans(text):
        if kind == 0:
            start = ASSIGN.match(text, start).start(2)
        random.append(text[start:end])
        if end > at:
            rest.append(text[at : max(start, at)])
            at = end
    ordinary = [m[0] for part in (*rest, text[at:]) for m in RUN.finditer(part)]
    words = [w.lower() for w in _WORD.findall(" ".join([*rest, text[at:]]))]
    for k in range(0, len(words) - 3, STRIDE):
        turn = zlib.crc32(words[k].encode()) + k // STRIDE
        run = _JOINED[turn % len(_JOINED)](words[k : k + 2 + turn // len(_JOINED) % 3])
        ordinary += [run] if len(run) >= MIN_RUN else []
    return random, ordinary


def _is_held_out(run: str) -> bool:
    return zlib.crc32(run.encode()) % 5 == 0


@dataclass(frozen=True)
class Model:
    ratios: np.ndarray  # log-likelihood ratio of every character after each other one
    margin: float = MARGIN


def _ratios(random: np.ndarray, ordinary: np.ndarray, smoothing: float) -> np.ndarray:
    """Ratios from the counts of pairs in both samples."""
    if not ordinary.any():
        return np.zeros((_N, _N))
    seen = random[:, 1:].sum(1, keepdims=True)
    strings = np.where(seen > 0, (1 - ANY) * random[:, 1:] / np.maximum(seen, 1), 0)
    strings += np.where(seen > 0, ANY, 1) / (_N - 1)
    pairs = np.full((10, 10), smoothing)
    np.add.at(pairs, (_CLASS[:, None], _CLASS[None, :]), ordinary)
    moves = pairs[:, :9] / pairs[:, :9].sum(1, keepdims=True)
    letters = ordinary.sum(0)
    share = np.zeros(_N)
    for k, c in enumerate(_ALPHABET, 1):
        twins = (c.lower(), c.upper()) if c.isalpha() else (c,)
        share[k] = 1 if c.isdigit() else 1 + sum(letters[_CODES[ord(t)]] for t in twins)
    for kind in range(9):
        share[_CLASS == kind] /= share[_CLASS == kind].sum()
    ratio = np.log(strings) - np.log(moves[_CLASS][:, _CLASS[1:]] * share[1:])
    ratio = np.concatenate([np.zeros((_N, 1)), np.minimum(ratio, MOST)], axis=1)
    joints = _CODES[[ord(c) for c in JOINTS]]
    ratio[:, joints] = np.minimum(ratio[:, joints], 0)  # a joint does not speak for random, so no stretch begins with one
    return ratio


def train(docs: DataFrame, rows: int = TRAIN_DOCS, smoothing: float = 0.5) -> Model:
    """Learn from at most about ``rows`` distinct texts (chosen by a hash, so in expectation; copies count once).

    Only counts reach the driver: one number per pair of characters, and how many held-out runs reach how many nats.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, _N * _N), np.int64)
        for batch in by_bytes(batches, "text"):
            for value in batch.column(0):
                random, ordinary = samples(value.as_py() or "")
                counts[1] += _pairs(" ".join(random))
                counts[0] += _pairs(" ".join(r for r in ordinary if not _is_held_out(r)))
        random, pair = np.nonzero(counts)
        yield pa.record_batch([pa.array(random), pa.array(pair), pa.array(counts[random, pair])],
                              names=["random", "pair", "n"])

    text = F.col("text").cast("string")
    share = rows / max(docs.count(), 1)
    chosen = docs.select(text.alias("text"))
    if share < 1:
        chosen = chosen.where(F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < int(share * (1 << 20)))
    chosen = stored(chosen.dropDuplicates(), "secret-samples")
    counts = np.zeros((2, _N, _N))
    sums = chosen.mapInArrow(count, "random long, pair long, n long").groupBy("random", "pair").agg(F.sum("n"))
    for random, pair, n in sums.collect():
        counts[random].reshape(-1)[pair] += n
    ratios = _ratios(counts[1], counts[0], smoothing)

    def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nats = np.zeros(200, np.int64)
        for batch in by_bytes(batches, "text"):
            for value in batch.column(0):
                for run in samples(value.as_py() or "")[1]:
                    if _is_held_out(run):
                        total = np.concatenate([[0.0], np.cumsum(likelihood_ratios(run, ratios))])
                        nats[min(199, int((total - np.minimum.accumulate(total)).max()))] += 1
        at = np.flatnonzero(nats)
        yield pa.record_batch([pa.array(at), pa.array(nats[at])], names=["nats", "n"])

    reached = np.zeros(200)
    for nats, n in chosen.mapInArrow(reach, "nats long, n long").groupBy("nats").agg(F.sum("n")).collect():
        reached[nats] = n
    above = reached[::-1].cumsum()[::-1]  # runs that reach so many nats
    enough = np.flatnonzero(above <= FALSE_ALARMS * above[0])
    return Model(ratios, max(MARGIN, float(enough[0]) if len(enough) else 200.0))


def likelihood_ratios(run: str, ratios: np.ndarray) -> np.ndarray:
    codes = _CODES[np.frombuffer(run.encode(), np.uint8)]
    return ratios[np.concatenate([[0], codes[:-1]]), codes]


def stretches(ratios: np.ndarray, margin: float) -> list[tuple[int, int]]:
    """(start, end) of all maximal stretches whose ratios sum up to ``margin``, in one pass (Ruzzo and Tompa)."""
    total = np.concatenate([[0.0], np.cumsum(ratios)])
    if (total - np.minimum.accumulate(total)).max() < margin:
        return []
    total = total.tolist()
    kept: list[tuple[int, int, int]] = []  # start, end, place of the last one before whose sum up to its start is less
    for i in range(len(ratios)):
        if total[i + 1] <= total[i]:
            continue
        start = i
        while True:
            before = len(kept) - 1
            while before >= 0 and total[kept[before][0]] >= total[start]:
                before = kept[before][2]
            if before < 0 or total[kept[before][1]] >= total[i + 1]:
                break
            start = kept[before][0]
            del kept[before:]
        kept.append((start, i + 1, before))
    return [(a, b) for a, b, _ in kept if total[b] - total[a] >= margin]


def model_spans(text: str, start: int, end: int, model: Model, run: tuple[int, int]):
    """(start, end) of what the models hold for random in a piece of a run, up to the next joint on either side, so that
    no end of a string is left over. A stretch of less than MIN_RUN characters is reported where it goes on in a plain
    span, or where the whole piece has that length and passes."""
    piece = text[start:end]
    ratios = likelihood_ratios(piece, model.ratios)
    random = stretches(ratios, model.margin)
    whole = len(piece) >= MIN_RUN and ratios.sum() >= model.margin
    found, done = [], 0
    for i, (a, b) in enumerate(random):
        high = random[i + 1][0] if i + 1 < len(random) else len(piece)
        if piece[a] not in JOINTS:
            a = max(done, *(piece.rfind(c, done, a) + 1 for c in JOINTS))
        if piece[b - 1] not in JOINTS:
            b = min((at for c in JOINTS if (at := piece.find(c, b, high)) >= 0), default=high)
        done = b
        goes_on = (a == 0 and start > run[0]) or (b == len(piece) and end < run[1])
        if whole or goes_on or b - a >= MIN_RUN:
            found.append((start + a, start + b))
    return found


def all_spans(text: str, model: Model) -> list[tuple[int, int, int]]:
    """The plain spans, and the stretches of what they leave of each run that the models hold for random."""
    found = base_spans(text)
    covered = sorted((a, b) for a, _, b in found)
    more, at, reached = [], 0, 0  # reached: where the plain spans so far end
    for m in RUN.finditer(text):
        run = m.span()
        start = max(run[0], min(reached, run[1]))
        while at < len(covered) and covered[at][0] < run[1]:
            a, b = covered[at]
            if a > start:
                more += model_spans(text, start, a, model, run)
            start = max(start, min(b, run[1]))
            reached = max(reached, b)
            at += 1
        if start < run[1]:
            more += model_spans(text, start, run[1], model, run)
    return sorted(found + [(a, 3, b) for a, b in more])


def scan(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_model) per document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # one number per pair of characters

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "text"):
            counts, digests, spans = [], [], []
            for value in batch.column(1):
                found = all_spans(value.as_py() or "", shared.value)
                named = [(k, f"{KINDS[k]}:{a}:{b}") for a, k, b in found]
                digests.append(hashlib.sha256(",".join(s for k, s in named if k < 3).encode()).hexdigest())
                spans.append(",".join(s for _, s in named))
                counts.append([sum(k == kind for k, _ in named) for kind in range(4)])
            columns = np.array(counts, np.int64).reshape(-1, 4).T
            yield pa.record_batch(
                [batch.column(0), *map(pa.array, columns[:3]), pa.array(digests), pa.array(spans), pa.array(columns[3])],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_model"],
            )

    source = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return source.mapInArrow(
        run,
        "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_model long",
    )


def redact(docs: DataFrame, model: Model, mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span of their ``text``, overlapping ones joined, replaced by ``mask``; null stays null."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def one(text: str | None) -> str | None:
        if text is None:
            return None
        out, at = [], 0
        for a, _, b in all_spans(text, shared.value):
            if a >= at:
                out += [text[at:a], mask]
            at = max(at, b)
        return "".join([*out, text[at:]])

    @F.arrow_udf("string")
    def clean(texts: pa.Array) -> pa.Array:
        return pa.array((one(value.as_py()) for value in texts), pa.string())

    return docs.withColumn("text", clean(F.col("text").cast("string")))
