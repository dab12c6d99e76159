"""Hard negatives by a vertical scan with branch and bound (operator 13).

Rows are written as blocks of columns: per block one array per dimension with its least and largest value. A task takes
its blocks one after the other and, for every anchor of a pass, reads the dimensions in the order of the anchor's
magnitudes, largest first. What the unread dimensions can still add lies between sums of the block's least and largest
values, so every candidate has a lower and an upper bound of its score; those that no list can take any more leave
the candidate bitmap, until the rest is known exactly. Lists are kept per anchor over all blocks of a task, which
sharpens the bounds, and merged by anchor. Anchors come in passes of a bounded number of bytes, so that each
pass is a broadcast of known size beside one scan of the blocks; nothing else leaves the executors.

A component x counts as floor(256 x). The first search takes each anchor's best rows of its own label, the positives;
the second takes, for every positive, the best rows of other labels whose score lies in a window below the score of that
positive. Higher scores come first, then smaller ids, then null ids; rows that are equal in both are told apart by a row number, so a
repeated row is a row of its own, also as an anchor.

Rows with a null label, a null vector or a null or non-finite component take no part. Vectors of different lengths do
not meet; an empty vector scores 0. A row without an id is no anchor. Scores beyond a long are held at its ends and tie there.
An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casemill.llm.common import stored

POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90  # a negative's score in percent of the positive's
BLOCK_BYTES = 4 << 20  # of a block's values as doubles
PASS_BYTES = 16 << 20  # of the anchors of a pass
STEP = 8  # dimensions read first; later steps read twice as many as the one before
_EXACT = 1 << 53
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1
_BLOCK = "dim int, row binary, id binary, named binary, label binary, small boolean, value binary"
_FOUND = "anchor long, slot int, score long, id long, row long"


def taking_part(rows: DataFrame, id_col: str, label_col: Column, vector_col: str) -> DataFrame:
    """(row, id, label, x): the rows that take part, with a number of their own."""
    usable = F.forall(F.col("x"), lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    chosen = rows.select(
        F.col(id_col).cast("long").alias("id"), label_col.cast("long").alias("label"), F.col(vector_col).cast("array<double>").alias("x")
    )
    chosen = chosen.where(F.col("label").isNotNull() & F.col("x").isNotNull() & F.coalesce(usable, F.lit(False)))
    return chosen.select(F.monotonically_increasing_id().alias("row"), "id", "label", "x")


def blocks_of(rows: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Blocks of columns: values are kept dimension by dimension, scaled as short integers where they fit."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list] = {}
        for batch in batches:
            vectors = batch.column(3)
            dims = np.diff(vectors.offsets.to_numpy())
            values = vectors.values.to_numpy(zero_copy_only=False)
            at = vectors.offsets.to_numpy()
            ids = batch.column(1)
            columns = (batch.column(0).to_numpy(), ids.fill_null(0).to_numpy(), ids.is_valid().to_numpy(zero_copy_only=False),
                       batch.column(2).to_numpy())
            for dim in np.unique(dims):
                here = np.flatnonzero(dims == dim)
                x = values[at[here][:, None] + np.arange(dim)]
                held = waiting.setdefault(int(dim), [])
                held.append((*(c[here] for c in columns), x))
                most = max(256, block_bytes // (8 * max(int(dim), 1)))
                if sum(len(h[0]) for h in held) >= most:
                    whole = [np.concatenate(c) for c in zip(*held)]
                    for a in range(0, len(whole[0]) // most * most, most):
                        yield _block(int(dim), *(c[a : a + most] for c in whole))
                    waiting[int(dim)] = [tuple(c[len(whole[0]) // most * most :] for c in whole)]
        for dim, held in waiting.items():
            whole = [np.concatenate(c) for c in zip(*held)]
            if len(whole[0]):
                yield _block(dim, *whole)

    return rows.mapInArrow(pack, _BLOCK)


def _block(dim: int, row, ids, named, label, x) -> pa.RecordBatch:
    with np.errstate(over="ignore"):
        scaled = np.floor(256.0 * x.T)
    small = bool(np.abs(scaled).max(initial=0) < 1 << 15)
    value = np.ascontiguousarray(scaled.astype(np.int16) if small else x.T)
    parts = row.astype(np.int64), ids.astype(np.int64), named.astype(np.uint8), label.astype(np.int64)
    return pa.record_batch(
        [pa.array([dim], pa.int32()), *(pa.array([p.tobytes()], pa.binary()) for p in parts), pa.array([small]),
         pa.array([value.tobytes()], pa.binary())],
        ["dim", "row", "id", "named", "label", "small", "value"],
    )


def scaled(x: np.ndarray) -> np.ndarray:
    """floor(256 x) as doubles where these hold all products exactly, else as Python integers."""
    with np.errstate(over="ignore"):
        out = np.floor(256.0 * x)
    if np.abs(out).max(initial=0) < 1 << 20:
        return out
    exact = [int(v) * 256 if abs(v) >= _EXACT else int(np.floor(256.0 * v)) for v in x.ravel().tolist()]
    return np.array(exact, object).reshape(x.shape)


@dataclass
class Block:
    dim: int
    row: np.ndarray
    id: np.ndarray
    named: np.ndarray
    label: np.ndarray
    value: np.ndarray  # dimensions x rows: short integers, doubles or Python integers
    low: np.ndarray
    high: np.ndarray

    @classmethod
    def read(cls, batch: pa.RecordBatch) -> Iterator[Block]:
        for r in batch.to_pylist():
            row, ids, label = (np.frombuffer(r[k], np.int64) for k in ("row", "id", "label"))
            if r["small"]:
                value = np.frombuffer(r["value"], np.int16).reshape(r["dim"], len(row))
                ends = value.min(1).astype(float), value.max(1).astype(float)
            else:
                value = scaled(np.frombuffer(r["value"], np.float64).reshape(r["dim"], len(row)))
                ends = value.min(1), value.max(1)
            yield cls(r["dim"], row, ids, np.frombuffer(r["named"], np.uint8), label, value, *ends)


Keep = Callable[[np.ndarray, np.ndarray], np.ndarray]


def vertical_scan(block: Block, anchor: np.ndarray, candidates: np.ndarray, keep: Keep) -> tuple[np.ndarray, np.ndarray]:
    """(candidates, scores): those that ``keep`` (lower bounds, upper bounds) leaves, down to the exact scores."""
    low, high, value = block.low, block.high, block.value
    exact = anchor.dtype != object and low.dtype != object
    if exact and block.dim:
        largest = np.maximum(np.abs(low), np.abs(high)).max()
        exact = float(np.abs(anchor).max()) * float(largest) * block.dim < _EXACT
    if not exact:
        anchor, low, high = (np.array([int(v) for v in a], object) for a in (anchor, low, high))
    order = np.argsort(-np.abs(anchor), kind="stable")
    ends = np.stack([(anchor * low)[order], (anchor * high)[order]]) if block.dim else np.zeros((2, 0))
    left = [np.append(np.cumsum(f(ends, axis=0)[::-1])[::-1], 0) for f in (np.min, np.max)]  # still to come
    scores = np.zeros(len(candidates), anchor.dtype if not exact else float)
    at, step = 0, STEP
    while True:
        alive = keep(scores + left[0][at], scores + left[1][at])
        candidates, scores = candidates[alive], scores[alive]
        if at == block.dim or len(candidates) == 0:
            break
        dims = order[at : at + step]
        read = value[dims][:, candidates] if 2 * len(candidates) > value.shape[1] else value[np.ix_(dims, candidates)]
        scores = scores + (anchor[dims] @ (read if exact else read.astype(object)))
        at, step = at + len(dims), 2 * step
    if not exact:
        scores = np.clip(scores, _LEAST, _MOST)
    return candidates, scores.astype(np.int64) if len(scores) else np.zeros(0, np.int64)


class Best:
    """The first ``k`` rows seen so far: higher scores, then smaller ids, null ids last."""

    def __init__(self, k: int):
        self.k = k
        self.kept = (np.zeros(0, np.int64),) * 4  # score, unnamed, id, row

    @property
    def bar(self) -> float:
        """The score that a row must reach."""
        return float("-inf") if len(self.kept[0]) < self.k else int(self.kept[0][-1])

    def add(self, score: np.ndarray, block: Block, at: np.ndarray) -> None:
        new = score, 1 - block.named[at].astype(np.int64), block.id[at], block.row[at]
        both = [np.concatenate(c) for c in zip(self.kept, new)]
        first = np.lexsort((both[3], both[2], both[1], -both[0].astype(object) if both[0].min() == _LEAST else -both[0]))[: self.k]
        self.kept = tuple(c[first] for c in both)


def _kth(values: np.ndarray, k: int):
    return np.partition(values, len(values) - k)[len(values) - k]


def positives_scan(block: Block, anchor: dict, best: Best) -> None:
    def keep(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        bar = max(best.bar, _kth(low, best.k)) if len(low) >= best.k else best.bar
        return np.asarray(high >= bar, bool)

    same = np.flatnonzero((block.label == anchor["label"]) & (block.row != anchor["row"]))
    at, score = vertical_scan(block, anchor["value"], same, keep)
    if len(at):
        best.add(score, block, at)


def negatives_scan(block: Block, anchor: dict, windows: list[tuple[int, int]], lists: list[Best]) -> None:
    """``windows``: the least and largest score of each list."""

    def keep(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        alive = np.zeros(len(low), bool)
        for (least, most), best in zip(windows, lists):
            bar = max(least, best.bar)
            sure = low[np.asarray((low >= least) & (high <= most), bool)]
            if len(sure) >= best.k:
                bar = max(bar, _kth(sure, best.k))
            alive |= np.asarray((high >= bar) & (low <= most), bool)
        return alive

    other = np.flatnonzero(block.label != anchor["label"])
    at, score = vertical_scan(block, anchor["value"], other, keep)
    for (least, most), best in zip(windows, lists):
        inside = (score >= max(least, best.bar)) & (score <= most)
        if inside.any():
            best.add(score[inside], block, at[inside])


def window_of(positive: int) -> tuple[int, int]:
    """The scores s with LOW * positive <= 100 * s <= HIGH * positive."""
    return -(-LOW * positive // 100), HIGH * positive // 100


def _search(blocks: DataFrame, anchors: list[dict], lists: Callable[[dict], list[Best]], scan) -> DataFrame:
    """(anchor, slot, score, id, row): what each task keeps in the lists of each anchor."""
    sent = blocks.sparkSession.sparkContext.broadcast(anchors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = [(a, lists(a)) for a in sent.value]
        by_dim: dict[int, list] = {}
        for a, kept in asked:
            by_dim.setdefault(len(a["x"]), []).append((a | {"value": scaled(a["x"])}, kept))
        for batch in batches:
            for block in Block.read(batch):
                for anchor, kept in by_dim.get(block.dim, []):
                    scan(block, anchor, kept)
        for a in range(0, len(asked), 4096):
            found = [(anchor["row"], slot, *best.kept) for anchor, kept in asked[a : a + 4096] for slot, best in enumerate(kept)]
            sizes = [len(f[2]) for f in found]
            columns = [np.repeat([f[0] for f in found], sizes), np.repeat([f[1] for f in found], sizes).astype(np.int32),
                       *(np.concatenate([f[c] for f in found]) if found else [] for c in (2, 4, 5))]
            unnamed = np.concatenate([f[3] for f in found]) > 0
            arrays = [pa.array(c, pa.int32() if k == 1 else pa.int64(), mask=unnamed if k == 3 else None)
                      for k, c in enumerate(columns)]
            yield pa.record_batch(arrays, ["anchor", "slot", "score", "id", "row"])

    found = blocks.mapInArrow(run, _FOUND)
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    return found.withColumn("rank", F.row_number().over(order))


def _anchors(blocks: DataFrame, chosen: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """(row, id, label, x): the rows whose ids ``chosen`` marks, with their vectors as bytes of doubles."""

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                row, ids, label = (np.frombuffer(r[k], np.int64) for k in ("row", "id", "label"))
                at = np.flatnonzero(chosen(ids) & (np.frombuffer(r["named"], np.uint8) > 0))
                kind = np.int16 if r["small"] else np.float64
                x = np.frombuffer(r["value"], kind).reshape(r["dim"], len(row))[:, at].T
                x = x / 256.0 if r["small"] else x  # short integers came from these floors, and give them again
                yield pa.record_batch(
                    [pa.array(row[at]), pa.array(ids[at]), pa.array(label[at]), pa.array([v.tobytes() for v in x], pa.binary())],
                    ["row", "id", "label", "x"],
                )

    return blocks.mapInArrow(pick, "row long, id long, label long, x binary")


def hard_negatives(
    rows: DataFrame,
    id_col: str = "vec_id",
    label: Column | None = None,
    vector_col: str = "embedding",
    chosen: Callable[[np.ndarray], np.ndarray] = lambda ids: ids % 100 == 0,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    pass_bytes: int = PASS_BYTES,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the anchors whose ids ``chosen``
    marks. ``label`` is a column of ``rows``; only rows of different labels are negatives of each other."""
    spark = rows.sparkSession
    blocks = stored(blocks_of(taking_part(rows, id_col, F.col("label") if label is None else label, vector_col), block_bytes), "blocks")
    anchors = stored(_anchors(blocks, chosen), "anchors")
    size = anchors.agg(F.coalesce(F.sum(F.octet_length("x") + 64), F.lit(0))).first()[0]
    passes = max(1, -(-size // pass_bytes))
    parts = []
    for k in range(passes):
        mine = anchors.where(F.pmod(F.xxhash64("row"), F.lit(passes)) == k).orderBy("row").collect()
        asked = [{"row": r["row"], "label": r["label"], "x": np.frombuffer(r["x"], np.float64)} for r in mine]
        found = _search(blocks, asked, lambda a: [Best(positives)], lambda b, a, kept: positives_scan(b, a, kept[0]))
        near = stored(found.where(F.col("rank") <= positives), "positives")
        by_anchor: dict[int, list] = {}
        for r in near.orderBy("anchor", "rank").collect():
            by_anchor.setdefault(r["anchor"], []).append(r["score"])
        asked = [a | {"windows": [window_of(s) for s in by_anchor[a["row"]]]} for a in asked if a["row"] in by_anchor]
        found = _search(blocks, asked, lambda a: [Best(negatives) for _ in a["windows"]],
                        lambda b, a, kept: negatives_scan(b, a, a["windows"], kept))
        names = spark.createDataFrame([(r["row"], r["id"]) for r in mine], "anchor long, anchor_id long")
        near = near.select("anchor", (F.col("rank") - 1).alias("slot"), F.col("id").alias("positive_id"),
                           F.col("score").alias("positive_score"))
        out = found.where(F.col("rank") <= negatives).join(near, ["anchor", "slot"]).join(names, "anchor")
        out = out.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
                         F.col("score").alias("negative_score"))
        parts.append(stored(out, "negatives"))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionAll(part)
    return whole


def moved_label(id_col: str = "vec_id", label_col: str = "label") -> Column:
    """The label, one further (of ten) where the id is divisible by 7."""
    return F.when(F.col(id_col) % 7 == 0, (F.col(label_col) + 1) % 10).otherwise(F.col(label_col))
