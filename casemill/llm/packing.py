"""Best-fit packing of token sequences (operator 9).

Bulk-synchronous best-fit decreasing. Sizes are whole numbers up to the capacity, so the range sort of documents
is a counting sort: every piece gets its rank within the run of equal sizes from per-partition counts, and no
partition has to hold a run. Documents and gaps are both kept as runs of equal size. A superstep takes the
largest unplaced run, sweeps to the successor among the gaps (the smallest run of gaps that is not smaller), and
matches both runs at once; where more documents than gaps meet, the lower ranks win and the others go on to the
next successor; the gaps shrink and the next superstep follows. The sweep works on runs, at most one row per size,
never on documents; the outcome is carried to the documents by (size, rank) on the executors.

Nulls and empty texts are one-token documents (the separator). Repeated rows and ids are packed once per row.
An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from casemill.llm.common import by_bytes, stored

CAPACITY = 2048
SEPARATOR = 0
PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, rank long"


@cache
def _encoder(name: str):
    """Text to ids. The byte-level vocabulary is read as ranks, which gives the ids of the tokenizers file of the
    same name about three times as fast; a text that its pattern matcher gives up on goes to that file."""
    import base64

    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    fast = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def slow(text: str) -> list[int]:
        whole = Tokenizer.from_file(public_tokenizers.path(f"{name}.json"))
        whole.encode_special_tokens = True
        return whole.encode(text, add_special_tokens=False).ids

    def encode(text: str) -> np.ndarray:
        try:
            ids = fast.encode_ordinary(text)
        except BaseException as error:  # the matcher's panic is not an Exception
            if isinstance(error, (KeyboardInterrupt, SystemExit, MemoryError)):
                raise
            ids = slow(text)
        return np.array([*ids, SEPARATOR], "<u4")

    return encode


def pieces(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str = "byte_bpe_50k") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, part, rank): documents as token sequences of at most ``capacity``.

    A longer document is cut into full pieces after a first piece that takes the rest. ``rank`` numbers the
    pieces of a length within their partition ``part``.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(tokenizer)
        seen = np.zeros(capacity + 1, np.int64)
        part = TaskContext.get().partitionId()
        for batch in by_bytes(batches, "text"):
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encode(text.as_py() or "")
                first = len(ids) % capacity
                cuts = [0, *range(first or capacity, len(ids), capacity), len(ids)]
                for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    rows.append((doc_id, k, a, b - a, zlib.crc32(ids[a:b].tobytes())))
            doc_ids, number, start, length, crc = zip(*rows)
            length = np.array(length)
            order = np.argsort(length, kind="stable")
            ordered = length[order]
            new = np.flatnonzero(np.diff(ordered, prepend=-1))
            runs = np.diff(new, append=len(ordered))
            rank = np.empty(len(length), np.int64)
            rank[order] = np.arange(len(ordered)) - np.repeat(new, runs) + seen[ordered]
            seen[ordered[new]] += runs
            columns = [doc_ids, np.array(number, np.int32), np.array(start, np.int64), length, np.array(crc, np.int64),
                       np.full(len(length), part, np.int32), rank]
            yield pa.record_batch([pa.array(c) if i else pa.array(c, pa.int64()) for i, c in enumerate(columns)],
                                  ["doc_id", "piece", "start", "length", "ids_crc32", "part", "rank"])

    source = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return source.mapInArrow(cut, PIECE)


def sweep(runs: dict[int, int], capacity: int) -> np.ndarray:
    """Match runs of equally long pieces with runs of equal gaps, longest pieces first.

    ``runs``: how many pieces there are of each length. Returns rows (length, first rank, first sequence, pieces per
    sequence, offset of the first piece): piece ``rank`` of a length goes to sequence
    ``first sequence + (rank - first rank) // per`` at ``offset + (rank - first rank) % per * length``.
    """
    gaps: dict[int, list[tuple[int, int]]] = {}
    sizes: list[int] = []  # of the gaps there are, in order
    opened, plan = 0, []

    def put(gap: int, first: int, n: int) -> None:
        if n and gap:
            if gap not in gaps:
                bisect.insort(sizes, gap)
            gaps.setdefault(gap, []).append((first, n))

    for length in sorted((x for x, n in runs.items() if n), reverse=True):
        rank, n = 0, runs[length]
        while rank < n:
            at = bisect.bisect_left(sizes, length)
            if at == len(sizes):  # no gap is large enough: open what the rest of the run fills
                new = -(-(n - rank) // (capacity // length))
                put(capacity, opened, new)
                opened += new
                continue
            gap = sizes[at]
            first, many = gaps[gap].pop()
            if not gaps[gap]:
                del gaps[gap], sizes[at]
            per = gap // length
            taken = min(n - rank, many * per)
            full, rest = divmod(taken, per)
            plan.append((length, rank, first, per, capacity - gap))
            put(gap - per * length, first, full)
            put(gap - rest * length if rest else 0, first + full, 1)
            put(gap, first + full + (rest > 0), many - full - (rest > 0))
            rank += taken
    return np.array(sorted(plan), np.int64).reshape(-1, 5)


def pack(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str = "byte_bpe_50k") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset): one row per piece of a document.

    Ids are those of the tokenizer with ``encode_special_tokens``: the string of an added token in a text, ``<|endoftext|>`` in
    this vocabulary, is ordinary text and cannot forge its id.
    """
    cut = stored(pieces(docs, capacity, tokenizer), "pieces")
    here = cut.groupBy("part", "length").agg((F.max("rank") + 1).alias("n"))
    here = stored(here, "runs")
    totals = here.groupBy("length").agg(F.sum("n").alias("n")).collect()  # at most one row per length
    plan = sweep({row["length"]: row["n"] for row in totals}, capacity)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = here.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    # A row for each length of each partition: it grows with the corpus, so it is not broadcast.
    ranked = cut.join(offsets.hint("merge"), ["part", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("rank") + F.col("before")).alias("rank")
    )
    keys = (plan[:, 0] << 44) | plan[:, 1]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(i).to_numpy() for i in (3, 5))
            row = plan[np.searchsorted(keys, (length << 44) | rank, "right") - 1]
            turn = rank - row[:, 1]
            sequence, offset = row[:, 2] + turn // row[:, 3], row[:, 4] + turn % row[:, 3] * length
            yield pa.record_batch(
                [*batch.columns[:5], pa.array(sequence), pa.array(offset)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    out = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return ranked.mapInArrow(place, out)
