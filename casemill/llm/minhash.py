"""Near-duplicate documents by DartMinHash (operator 1).

A document is a weighted set: its shingles of five words, each weighing as often as it occurs. Every element's
weight is a region cut into unit cells; hashes of a cell throw darts at it, each with a rank (a Poisson process, so
darts arrive in order of rank), a height within the cell and one of ``bands * rows`` coordinates. Darts above the
element's weight miss. The earliest dart of every coordinate makes the signature; two documents agree in a coordinate
with the probability of their weighted Jaccard similarity. Only darts of a rank that about fills all coordinates are
thrown, and twice as many for documents with a coordinate left empty, so the work per document is its length plus
``k log k``, not their product.

Candidates agree in all coordinates of a band. Exact copies (the same words in order) are one class from the start.
Then one pivot of every bucket is compared with all its members by the exact similarity of the shingles, which settles
a bucket of true copies with a comparison per member. What is left are buckets with members that are not all linked to
one pivot. They are cut into blocks of a bounded size, and every two blocks of a bucket meet in one task, which compares
what is not yet joined by a product of matrices and emits only links that join. So no pair of a bucket is skipped, and
none but links is emitted.

A text of fewer than five words, but not none, has one shingle. Texts without words are copies of each other if
equal; null texts are copies of nothing. Rows that repeat an id and its text share a class. An empty table gives an
empty result. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casemill.llm.common import by_bytes, stored
from casemill.llm.components import components
from casemill.llm.words import Words, mix, shingles, words

SHINGLE = 5
SIMILARITY = 0.8
BANDS = 20
ROWS = 6
BLOCK = 512  # members of a bucket that are compared with as many others in one task
_COLUMNS = 4096
PART = 1 << 20  # bytes of text hashed at a time; each takes about a hundred bytes of work space


def _salt(k: int) -> np.uint64:
    return mix(np.array([k], np.uint64))[0]


def _uniform(h: np.ndarray) -> np.ndarray:
    return ((h >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)


def weighted(sh: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, shingle, weight) of every element of the documents, ordered by document and then by shingle."""
    doc = np.repeat(np.arange(len(sh.counts)), sh.counts)
    order = np.lexsort((sh.hashes, doc))
    doc, h = doc[order], sh.hashes[order]
    new = np.ones(len(h), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])
    first = np.flatnonzero(new)
    return doc[first], h[first], np.diff(first, append=len(h)).astype(np.float64)


def signatures(doc: np.ndarray, element: np.ndarray, weight: np.ndarray, n_docs: int, k: int) -> np.ndarray:
    """DartMinHash signatures of ``n_docs`` weighted sets, one row of ``k`` 64-bit values each (0 for empty sets)."""
    cells = np.ceil(weight).astype(np.int64)
    at = np.repeat(np.arange(len(doc)), cells)
    number = np.arange(len(at)) - np.repeat(np.cumsum(cells) - cells, cells)
    with np.errstate(over="ignore"):
        cell = mix(element[at] ^ mix(number.astype(np.uint64)))
    total = np.bincount(doc, weight, n_docs)
    signature = np.zeros((n_docs, k), np.uint64)
    darts = np.full(n_docs, k * np.log(k) + 2 * k)
    todo = total > 0
    while todo.any():
        chosen = np.flatnonzero(todo[doc[at]])
        earliest = np.full(n_docs * k, np.inf)
        rank = np.zeros(len(chosen))
        turn, thrown = 0, []
        while len(chosen):
            with np.errstate(over="ignore"):
                h = mix(cell[chosen] ^ _salt(2 * turn))
                other = mix(cell[chosen] ^ _salt(2 * turn + 1))
            rank = rank - np.log(_uniform(h))
            d = doc[at[chosen]]
            alive = rank < darts[d] / total[d]
            chosen, rank, d, h, other = (x[alive] for x in (chosen, rank, d, h, other))
            hit = number[chosen] + _uniform(other) < weight[at[chosen]]
            place = d[hit] * k + (mix(other[hit]) % np.uint64(k)).astype(np.int64)
            np.minimum.at(earliest, place, rank[hit])
            thrown.append((place, rank[hit], mix(h[hit])))
            turn += 1
        for place, r, value in thrown:
            won = r == earliest[place]
            signature.reshape(-1)[place[won]] = value[won]
        empty = np.isinf(earliest.reshape(n_docs, k)).any(1)
        todo &= empty
        darts[todo] *= 2
    return signature


def _digests(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of the word sequence of each document with words."""
    place = np.arange(len(w.hashes)) - np.repeat(w.first[:-1], w.counts)
    some = np.flatnonzero(w.counts)
    out = []
    with np.errstate(over="ignore"):
        for k in (101, 202):
            sums = np.zeros(len(w.counts), np.uint64)
            if len(some):
                sums[some] = np.add.reduceat(mix(w.hashes + mix(place.astype(np.uint64) ^ _salt(k))), w.first[:-1][some])
            out.append(mix(sums ^ w.counts.astype(np.uint64)).view(np.int64))
    return out[0], out[1]


def _keys(text: pa.Array, w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Two hashes that name the exact class of each text, and which texts are null."""
    k1, k2 = _digests(w)
    null = text.is_null().to_numpy(zero_copy_only=False)
    for i in np.flatnonzero((w.counts == 0) & ~null):
        raw = hashlib.md5(text[int(i)].as_py().encode()).digest()
        k1[i], k2[i] = np.frombuffer(raw, np.int64)
    return k1, k2, null


def sketch(docs: DataFrame, id_col: str, shingle: int, bands: int, rows: int) -> DataFrame:
    """(id, t, k1, k2, n, bands) per document: a hash of its text, its exact class, how many shingles it has, its band
    hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "text", PART):
            w = words(batch.column(2))
            k1, k2, null = _keys(batch.column(2), w)
            sh = shingles(w, shingle)
            signature = signatures(*weighted(sh), len(batch), bands * rows).reshape(len(batch), bands, rows)
            band = np.zeros((len(batch), bands), np.uint64)
            with np.errstate(over="ignore"):
                for r in range(rows):
                    band = mix(band ^ signature[:, :, r] ^ _salt(r))
            counts = np.where(sh.counts > 0, bands, 0)
            lists = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)),
                pa.array(band[sh.counts > 0].reshape(-1).view(np.int64)),
            )
            yield pa.record_batch(
                [*batch.columns[:2], pa.array(k1, mask=null), pa.array(k2, mask=null), pa.array(sh.counts), lists],
                names=["id", "t", "k1", "k2", "n", "bands"],
            )

    return _source(docs, id_col).mapInArrow(run, "id long, t long, k1 long, k2 long, n long, bands array<long>")


def _source(docs: DataFrame, id_col: str) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("t"), text.alias("text"))


def elements(docs: DataFrame, shingle: int) -> DataFrame:
    """(class_no, elements) of ``docs`` (text, class_no, k1, k2) whose text has the class k1, k2.

    An element is a 32-bit fingerprint of a shingle and the number of its occurrence; sharing as many of them as
    weights in common, two arrays of n have a similarity that is wrong by less than n / 2**32.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "text", PART):
            w = words(batch.column(0))
            k1, k2, _ = _keys(batch.column(0), w)
            doc, h, weight = weighted(shingles(w, shingle))
            times = weight.astype(np.int64)
            turn = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            marks = (mix(np.repeat(h, times) ^ mix(turn.astype(np.uint64))) >> np.uint64(32)).astype(np.uint32)
            first = np.searchsorted(np.repeat(doc, times), np.arange(len(batch) + 1))
            lists = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(marks.view(np.int32)))
            right = (k1 == batch.column(2).to_numpy()) & (k2 == batch.column(3).to_numpy())
            out = pa.record_batch([batch.column(1), lists], names=["class_no", "elements"])
            yield out.filter(pa.array(right))

    return docs.select("text", "class_no", "k1", "k2").mapInArrow(run, "class_no long, elements array<int>")


def _similar(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose element sets have at least the similarity."""
    left = sets.select(F.col("class_no").alias("b"), F.col("elements").alias("eb"))
    right = sets.select(F.col("class_no").alias("a"), F.col("elements").alias("ea"))
    both = F.size(F.array_intersect("ea", "eb"))
    return (
        pairs.join(left, "b")
        .join(right, "a")
        .select("a", "b", both.alias("both"), (F.size("ea") + F.size("eb")).alias("sum"))
        .where(F.col("both") >= similarity * (F.col("sum") - F.col("both")) - 1e-9)
        .select("a", "b")
    )


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    similarity: float = SIMILARITY,
    shingle: int = SHINGLE,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """(id_col, class_id, class_size, kept) per document: the smallest id of the documents it is linked with, how many
    there are, and whether it is that document."""
    marks = stored(sketch(docs, id_col, shingle, bands, rows), "marks")
    classes = marks.where(F.col("k1").isNotNull()).groupBy("k1", "k2")
    classes = classes.agg(
        F.min(F.struct(F.col("id").isNull().alias("unnamed"), "id", "t")).alias("first"),
        F.count(F.lit(1)).alias("copies"), F.first("n").alias("n"), F.first("bands").alias("bands"),
    )
    classes = classes.select("k1", "k2", "first.id", "first.t", "copies", "n", "bands")
    classes = stored(classes.withColumn("class_no", F.monotonically_increasing_id()), "classes")
    labels = _labels(_source(docs, id_col), classes, similarity, shingle)
    named = classes.select("k1", "k2", "id", "copies", "class_no").join(labels, "class_no", "left")
    named = named.withColumn("component", F.coalesce("component", "class_no"))
    groups = named.groupBy("component").agg(F.min("id").alias("class_id"), F.sum("copies").alias("class_size"))
    named = named.select("k1", "k2", "component").join(groups, "component").drop("component")
    return (
        marks.select("id", "k1", "k2")
        .join(named, ["k1", "k2"], "left")
        .select(
            F.col("id").alias(id_col),
            F.coalesce("class_id", "id").alias("class_id"),
            F.coalesce("class_size", F.lit(1)).alias("class_size"),
            F.coalesce(F.col("class_id") == F.col("id"), F.lit(True)).alias("kept"),
        )
    )


def _labels(docs: DataFrame, classes: DataFrame, similarity: float, shingle: int) -> DataFrame:
    """(class_no, component) of the classes that are linked with another one."""
    banded = classes.select("class_no", "n", F.posexplode("bands").alias("band", "hash"))
    banded = banded.select(F.xxhash64("band", "hash").alias("bucket"), "class_no", "n")
    shared = banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("_c")).where("_c > 1").select("bucket")
    members = stored(banded.join(shared, "bucket"), "members")
    needed = members.select("class_no").distinct().join(classes.select("class_no", "id", "t", "k1", "k2"), "class_no")
    # The first document of each class; documents without an id are told apart by their texts.
    texts = docs.join(needed, docs["id"].eqNullSafe(needed["id"]) & (docs["t"] == needed["t"])).drop("id", "t")
    sets = stored(elements(texts, shingle).groupBy("class_no").agg(F.first("elements").alias("elements")), "elements")

    pivots = members.groupBy("bucket").agg(F.min("class_no").alias("a"), F.min_by("n", "class_no").alias("na"))
    pairs = members.join(pivots, "bucket").where("class_no != a").where(
        F.least("n", "na") >= similarity * F.greatest("n", "na") - 1e-9
    )
    links = stored(_similar(pairs.select("a", F.col("class_no").alias("b")).distinct(), sets, similarity), "similar")
    # Members that share a pivot are joined already; the pivots are done.
    joined = links.groupBy(F.col("b").alias("class_no")).agg(F.min("a").alias("component"))
    rest = members.select("bucket", "class_no").join(
        pivots.select("bucket", F.col("a").alias("class_no")), ["bucket", "class_no"], "left_anti"
    )
    rest = rest.join(joined, "class_no", "left").withColumn("component", F.coalesce("component", "class_no"))
    ends = rest.groupBy("bucket").agg(F.min("component").alias("_l"), F.max("component").alias("_h"))
    rest = stored(rest.join(ends.where("_l != _h").select("bucket"), "bucket"), "members")
    links = links.unionByName(stored(_in_blocks(rest, sets, similarity), "similar"))
    return components(links).withColumnRenamed("node", "class_no")


def _in_blocks(members: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Links (a, b) that join different components of a bucket's members (bucket, class_no, component)."""
    size = members.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    placed = members.join(size, "bucket").select(
        "bucket", "class_no", "component", F.pmod(F.xxhash64("class_no"), F.col("blocks")).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"),
    )
    placed = placed.select(
        "bucket", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "class_no",
        "component",
    ).join(sets, "class_no")

    def compare(group: pa.Table) -> pa.Table:
        group = group.sort_by("class_no").combine_chunks()
        name, component, block = (group.column(c).to_numpy() for c in ("class_no", "component", "block"))
        lists = group.column("elements").chunk(0)
        sizes = np.diff(lists.offsets.to_numpy()).astype(np.int64)
        own = np.repeat(np.arange(len(name)), sizes)
        _, element, times = np.unique(lists.flatten().to_numpy(), return_inverse=True, return_counts=True)
        column = np.cumsum(times > 1) - 1  # elements of one member alone have none
        own, element = own[times[element] > 1], column[element[times[element] > 1]]
        order = np.argsort(element, kind="stable")
        own, element = own[order], element[order]
        values, counts = np.unique(component, return_counts=True)
        few = np.flatnonzero(component != values[counts.argmax()])  # the others are in one component
        both = np.zeros((len(few), len(name)), np.float32)
        for start in range(0, int(column[-1]) + 1 if len(column) else 0, _COLUMNS):
            a, b = np.searchsorted(element, [start, start + _COLUMNS])
            part = np.zeros((len(name), _COLUMNS), np.float32)
            part[own[a:b], element[a:b] - start] = 1
            both += part[few] @ part.T
        both = both.astype(np.float64)
        alike = both >= similarity * (sizes[few][:, None] + sizes - both) - 1e-9
        alike &= component[few][:, None] != component
        if len(np.unique(block)) > 1 and group.column("i")[0] != group.column("j")[0]:
            alike &= block[few][:, None] != block
        parent = {int(c): int(c) for c in values}

        def top(c: int) -> int:
            while parent[c] != c:
                parent[c] = c = parent[parent[c]]
            return c

        links = []
        for x, y in zip(*np.nonzero(alike)):
            p, q = top(int(component[few[x]])), top(int(component[y]))
            if p != q:
                parent[p] = q
                links.append((int(name[few[x]]), int(name[y])))
        return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})

    return placed.groupBy("bucket", "i", "j").applyInArrow(compare, "a long, b long")
