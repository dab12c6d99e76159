"""Prefix trie of conversations as a burst trie (operator 12).

A conversation is a path of turns; a turn is known by the md5 of its role and text. Paths are cut into suffixes at every
``SEGMENT`` turns: a suffix lies in the container of its head, the node where it begins, which a hash of all turns before it
names. Equal suffixes of a container are one row with a count. A container that holds more than ``LIMIT`` suffixes bursts: its
head becomes a node and its suffixes move by their next turn into containers one turn deeper, round after round (at most
``SEGMENT`` rounds, usually as many as very common turns follow each other). Then every container fits a task; its suffixes are
sorted by their turns and one sweep with a stack of open nodes gives its nodes.

A node is owned by its smallest member, and a conversation owns the nodes of its path from some depth on. So a
node is named by its owner and depth, and both sums over a subtree become sums over the members of its top: leaves are
counted by the conversations that own one, and the tokens of all distinct nodes below are what members own, each from the
node where its ownership begins. A first sweep finds owners, a second one sums. No step gathers a
conversation, a node's members or a container that has not burst: positions come from row numbers over a range sort,
prefix hashes from a scan over segments, the ids that end at a node are hashed as a sorted stream of joined pieces.

Turns are ordered by turn (null first) and, where that ties, by their md5. Null roles and texts are empty. Rows without a
conversation belong to none and take no part. Repeated rows are turns of their own. A conversation may be left without turns;
it is a member of the root. An empty table gives an empty result, not even a root. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casemill.llm.common import numbered, stored

SEGMENT = 256  # turns of a suffix, at most
LIMIT = 256  # suffixes of a container, at least, before it bursts
HEADS = 250_000  # containers that burst in a round, at most: they are broadcast
FAMILY, SHARED = 20, 4
_ID = 16  # bytes of a turn's hash
_PIECE = 1 << 20  # characters of a piece of joined ids, about
EMPTY = hashlib.sha256(b"").hexdigest()
HEAD = ["seg", "depth", "c1", "c2"]
KEY = ["k1", "k2"]
NODE = (
    "conv long, depth long, parent long, n long, words long, prefix long, own_words long, sum_words long, sum_owned long, "
    "owned long, leaves long, ends long, children long, open boolean, border boolean"
)


def turns(rows: DataFrame, conv_col: str = "conv_id") -> tuple[DataFrame, int]:
    """(conv, id, words, number): the turns of all conversations, numbered in the order of conversations and turns."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    known = rows.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"),
        F.col("turn").cast("long").alias("turn"),
        F.unhex(F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))).alias("id"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).alias("words"),
    )
    table, n = numbered(stored(known, "turns"), [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("id")])
    return table.drop("turn"), n


def _each(lo: Column, hi: Column, columns: list[str], df: DataFrame, name: str) -> DataFrame:
    """``df`` with a row for every number from ``lo`` to ``hi``; long ranges are never one array."""
    wide = df.withColumns({"_lo": lo, "_hi": hi}).where("_lo <= _hi")
    wide = wide.withColumn("_big", F.explode(F.sequence(F.shiftright("_lo", 12), F.shiftright("_hi", 12))))
    first, last = F.greatest("_lo", F.shiftleft("_big", 12)), F.least("_hi", F.shiftleft("_big", 12) + 4095)
    return wide.withColumn(name, F.explode(F.sequence(first, last))).select(*columns, name)


def rebuilt(numbers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv, at, id, words), the turns of the rebuilt conversations with their places from 0, and (conv, length).

    A conversation begins with the first turns of the first of its family, as many as its id says, and goes on with its
    own turns after that many. Both are ranges of row numbers, joined to the rows in blocks of numbers.
    """
    convs = stored(numbers.groupBy("conv").agg(F.min("number").alias("first"), F.count(F.lit(1)).alias("n")), "convs")
    shared = F.crc32(F.col("conv").cast("string").cast("binary")) % SHARED
    facts = convs.withColumns({"h": shared, "base": F.col("conv") - F.col("conv") % FAMILY})
    bases = convs.select(F.col("conv").alias("base"), F.col("first").alias("base_first"), F.col("n").alias("base_n"))
    facts = facts.join(bases, "base", "left").withColumn("taken", F.least("h", F.coalesce("base_n", F.lit(0))))
    facts = stored(facts.select("conv", "first", "n", "h", "base_first", "taken"), "facts")
    own = facts.where("n > h").select("conv", (F.col("first") + F.col("h")).alias("lo"),
                                      (F.col("first") + F.col("n") - 1).alias("hi"), F.col("taken").alias("start"))
    before = facts.where("taken > 0").select("conv", F.col("base_first").alias("lo"),
                                             (F.col("base_first") + F.col("taken") - 1).alias("hi"), F.lit(0).alias("start"))
    ranges = own.unionByName(before)
    ranges = _each(F.shiftright("lo", 8), F.shiftright("hi", 8), ranges.columns, ranges, "block")
    rows = numbers.drop("conv").withColumn("block", F.shiftright("number", 8))
    rows = rows.join(ranges, "block").where("number between lo and hi")
    lengths = facts.select("conv", (F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length"))
    return rows.select("conv", (F.col("number") - F.col("lo") + F.col("start")).alias("at"), "id", "words"), lengths


def segments(rows: DataFrame, lengths: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """(conv, seg, ids, words, n, sum_words, x1, x2): suffixes of at most ``segment`` turns; a conversation that ends with a full
    one has an empty one after it, so that every member of a node is in the container of which it is the head."""
    place = F.col("at"), F.col("id")
    cut = rows.select("conv", F.expr(f"at div {segment}").alias("seg"), "at", "id", "words",
                      F.xxhash64(*place).alias("x1"), F.xxhash64(F.lit(1), *place).alias("x2"))
    full = cut.groupBy("conv", "seg").agg(
        F.array_sort(F.collect_list(F.struct("at", "id", "words"))).alias("t"),
        F.sum("words").alias("sum_words"), F.bit_xor("x1").alias("x1"), F.bit_xor("x2").alias("x2"),
    )
    full = full.select(
        "conv", "seg", F.unhex(F.array_join(F.transform("t", lambda t: F.hex(t["id"])), "")).alias("ids"),
        F.transform("t", lambda t: t["words"]).alias("words"), F.size("t").alias("n"), "sum_words", "x1", "x2",
    )
    empty = lengths.where(F.col("length") % segment == 0).select(
        "conv", F.expr(f"length div {segment}").alias("seg"), F.lit(b"").alias("ids"), F.array().cast("array<int>").alias("words"),
        F.lit(0).alias("n"), *(F.lit(0).cast("long").alias(c) for c in ("sum_words", "x1", "x2")),
    )
    return full.unionByName(empty)


def with_heads(segs: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """``segs`` with what lies before each (hash h1, h2 and words), and the conversation's words and length.

    Only conversations of several segments are scanned, in groups of 4,096 segments and then over groups.
    """
    narrow = segs.where((F.col("seg") > 0) | (F.col("n") == segment)).select(
        "conv", "seg", F.shiftright("seg", 12).alias("big"), "n", "sum_words", "x1", "x2"
    )

    def before(window, frame) -> dict[str, Column]:
        over = window.rowsBetween(*frame)
        zero = F.lit(0).cast("long")
        return {"b1": F.coalesce(F.bit_xor("x1").over(over), zero), "b2": F.coalesce(F.bit_xor("x2").over(over), zero),
                "bw": F.coalesce(F.sum("sum_words").over(over), zero)}

    earlier = (Window.unboundedPreceding, -1)
    inner = narrow.withColumns(before(Window.partitionBy("conv", "big").orderBy("seg"), earlier))
    bigs = narrow.groupBy("conv", "big").agg(F.bit_xor("x1").alias("x1"), F.bit_xor("x2").alias("x2"),
                                             F.sum("sum_words").alias("sum_words"), F.sum("n").alias("n"))
    whole = Window.partitionBy("conv")
    bigs = bigs.withColumns(
        {**{f"{k}_big": v for k, v in before(whole.orderBy("big"), earlier).items()},
         "total": F.sum("sum_words").over(whole), "length": F.sum("n").over(whole)}
    ).select("conv", "big", "b1_big", "b2_big", "bw_big", "total", "length")
    scanned = inner.join(bigs, ["conv", "big"]).select(
        "conv", "seg", F.col("b1").bitwiseXOR(F.col("b1_big")).alias("h1"), F.col("b2").bitwiseXOR(F.col("b2_big")).alias("h2"),
        (F.col("bw") + F.col("bw_big")).alias("hp"), "total", "length",
    )
    out = segs.join(scanned, ["conv", "seg"], "left")
    zero = F.lit(0).cast("long")
    return out.withColumns({
        "h1": F.coalesce("h1", zero), "h2": F.coalesce("h2", zero), "hp": F.coalesce("hp", zero),
        "total": F.coalesce("total", "sum_words"), "length": F.coalesce("length", F.col("n").cast("long")),
        "k1": F.xxhash64("seg", "h1", "h2", "x1", "x2", "n"), "k2": F.xxhash64(F.lit(1), "seg", "h1", "h2", "x1", "x2", "n"),
    }).withColumn(
        "last", (F.col("seg") * segment + F.col("n") == F.col("length")) & ((F.col("n") > 0) | (F.col("length") == 0))
    )


def burst(segs: DataFrame, segment: int, limit: int) -> tuple[DataFrame, DataFrame, DataFrame | None, DataFrame | None]:
    """(settled, absorbed, heads, children): suffixes in containers that hold at most ``limit``, suffixes that end at the head of a
    container that burst, the nodes such heads are, and how many containers came from each."""
    pending = segs.groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("n_convs"), F.min("conv").alias("owner"), F.min_by("total", "conv").alias("own_words"),
        F.sum("total").alias("sum_words"), F.min(F.when(F.col("last"), F.col("conv"))).alias("ends"),
        *(F.first(c).alias(c) for c in ("seg", "ids", "words", "n", "h1", "h2", "hp")),
    )
    pending = stored(pending.select(
        *KEY, "n_convs", "owner", "own_words", "sum_words", "ends", "seg", "ids", "words", "n",
        (F.col("seg") * segment).alias("depth"), F.col("h1").alias("c1"), F.col("h2").alias("c2"), F.col("hp").alias("prefix"),
        F.lit(0).alias("last_words"), F.lit(0).alias("off"), F.lit(None).cast("long").alias("above"),
        F.array().cast("array<struct<conv:long,depth:long>>").alias("over"),
    ), "suffixes")
    limit = max(limit, pending.count() // HEADS)
    settled, absorbed, heads, children = [], [], [], []
    for _ in range(segment + 1):
        at_end = F.col("off") == F.col("n")
        counts = pending.groupBy(*HEAD).agg(
            F.count(F.lit(1)).alias("suffixes"), F.min("owner").alias("conv"), F.min_by("own_words", "owner").alias("own_words"),
            F.sum("n_convs").alias("n"), F.sum("sum_words").alias("sum_words"), F.min(F.when(at_end, F.col("ends"))).alias("ends"),
            F.min("prefix").alias("prefix"), F.min("last_words").alias("words"), F.min("above").alias("parent"), F.min("off").alias("off"),
        )
        full = stored(counts.where(F.col("suffixes") > limit), "full")
        if full.isEmpty():
            settled.append(pending)
            break
        heads.append(full)
        marks = full.select(*HEAD, F.col("conv").alias("head_owner"), F.lit(True).alias("full"))
        marked = pending.join(F.broadcast(marks), HEAD, "left")
        settled.append(marked.where("full is null").select(*pending.columns))
        into = marked.where("full").withColumn("over", F.concat("over", F.array(F.struct(F.col("head_owner").alias("conv"), "depth"))))
        absorbed.append(into.where(at_end).select(*KEY, "over"))
        turn = F.substring(F.col("ids"), F.col("off") * _ID + 1, F.lit(_ID))
        moved = into.where(~at_end).withColumns({"id": turn, "next_words": F.element_at("words", F.col("off") + 1)})
        moved = moved.withColumns({
            "c1": F.col("c1").bitwiseXOR(F.xxhash64("depth", "id")), "c2": F.col("c2").bitwiseXOR(F.xxhash64(F.lit(1), "depth", "id")),
            "depth": F.col("depth") + 1, "off": F.col("off") + 1, "prefix": F.col("prefix") + F.col("next_words"),
            "last_words": F.col("next_words"), "above": F.col("head_owner"),
        })
        pending = stored(moved.select(*pending.columns), "pending")
        children.append(
            pending.select("above", *HEAD).distinct().groupBy(F.col("above").alias("conv"), (F.col("depth") - 1).alias("depth"))
            .agg(F.count(F.lit(1)).alias("children"))
        )
    union = lambda parts: reduce(DataFrame.unionAll, parts) if parts else None
    return union(settled), union(absorbed) if absorbed else None, union(heads), union(children)


class _Open:
    """A node whose subtree is being swept."""

    __slots__ = ("children", "depth", "done", "ends", "leaves", "n", "owned", "owner", "prefix", "sum_owned", "sum_words", "words")

    def __init__(self, depth: int, words: int, prefix: int):
        self.depth, self.words, self.prefix = depth, words, prefix
        self.n = self.sum_words = self.sum_owned = self.leaves = self.children = 0
        self.owner = self.ends = None  # owner: (conv, its words, what it owns)
        self.done = []

    def add(self, n: int, owner: tuple, sum_words: int, sum_owned: int, leaves: int) -> None:
        self.n += n
        self.sum_words += sum_words
        self.sum_owned += sum_owned
        self.leaves += leaves
        if self.owner is None or owner[0] < self.owner[0]:
            self.owner = owner

    def row(self, parent: int | None, last: int, border: bool = False) -> tuple:
        return (self.owner[0], self.depth, parent, self.n, self.words, self.prefix, self.owner[1], self.sum_words, self.sum_owned,
                self.owner[2], self.leaves, self.ends, self.children, self.depth == last, border)


def sweep(suffixes: DataFrame, segment: int) -> DataFrame:
    """Nodes of containers, each in one piece and sorted. A head that no container above has as a node gives a row with ``border``."""

    def close(stack: list[_Open], out: list, last: int) -> None:
        node = stack.pop()
        out.extend(child.row(node.owner[0], last) for child in node.done)
        node.done = []
        above = stack[-1]
        above.add(node.n, node.owner, node.sum_words, node.sum_owned, node.leaves)
        above.children += 1
        above.done.append(node)

    def finish(stack: list[_Open], out: list, head: tuple, last: int) -> None:
        while len(stack) > 1:
            close(stack, out, last)
        node = stack[0]
        out.extend(child.row(node.owner[0], last) for child in node.done)
        seg, off, above = head
        out.append(node.row(above, last, border=seg > 0 and off == 0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, stack, path, out, head, last = None, [], [], [], None, 0
        for batch in batches:
            for r in batch.to_pylist():
                key = r["seg"], r["depth"], r["c1"], r["c2"]
                if key != at:
                    if at is not None:
                        finish(stack, out, head, last)
                    at, path, head = key, [], (r["seg"], r["off"], r["above"])
                    last = (r["seg"] + 1) * segment
                    stack = [_Open(r["depth"], r["last_words"], r["prefix"])]
                ids, words = r["ids"], r["words"]
                new = [ids[k : k + _ID] for k in range(r["off"] * _ID, len(ids), _ID)]
                same = 0
                while same < len(path) and same < len(new) and path[same] == new[same]:
                    same += 1
                while len(stack) > same + 1:
                    close(stack, out, last)
                for k in range(same, len(new)):
                    w = words[r["off"] + k]
                    stack.append(_Open(stack[-1].depth + 1, w, stack[-1].prefix + w))
                stack[-1].add(r["n_convs"], (r["owner"], r["own_words"], r["owned"]), r["sum_words"], r["sum_owned"], r["leaves"])
                if r["ends"] is not None:
                    stack[-1].ends = r["ends"]  # equal suffixes are one row
                path = new
                if len(out) > 20_000:
                    yield _nodes(out)
                    out = []
        if at is not None:
            finish(stack, out, head, last)
        if out:
            yield _nodes(out)

    columns = [*HEAD, "ids", "words", "off", "n_convs", "owner", "own_words", "sum_words", "ends", "last_words", "prefix", "above",
               "sum_owned", "owned", "leaves"]
    dealt = suffixes.select(*columns).repartition(*HEAD).sortWithinPartitions(*HEAD, "ids")
    return dealt.mapInArrow(run, NODE)


def _nodes(rows: list[tuple]) -> pa.RecordBatch:
    names = [c.split()[0] for c in NODE.split(", ")]
    kinds = [pa.int64()] * 13 + [pa.bool_()] * 2
    return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def end_hashes(segs: DataFrame, segment: int) -> DataFrame:
    """(ends, sha): for the smallest of the conversations that end at a node, the hash of all their ids in order."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, first, texts, size = None, None, [], 0
        for batch in batches:
            out = []
            for e1, e2, length, conv in zip(*(c.to_pylist() for c in batch.columns)):
                if (e1, e2, length) != key or size > _PIECE:
                    if texts:
                        out.append((*key, first, ",".join(texts)))
                    key, first, texts, size = (e1, e2, length), conv, [], 0
                texts.append(str(conv))
                size += len(texts[-1]) + 1
            if out:
                yield pieces(out)
        if texts:
            yield pieces([(*key, first, ",".join(texts))])

    def pieces(rows: list[tuple]) -> pa.RecordBatch:
        return pa.record_batch([pa.array(c) for c in zip(*rows)], ["e1", "e2", "length", "first", "text"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, first, sha = None, None, None
        for batch in batches:
            out = []
            for e1, e2, length, conv, text in zip(*(c.to_pylist() for c in batch.columns)):
                if (e1, e2, length) != key:
                    if sha:
                        out.append((first, sha.hexdigest()))
                    key, first, sha = (e1, e2, length), conv, hashlib.sha256(text.encode())
                else:
                    sha.update(b"," + text.encode())
            if out:
                yield pa.record_batch([pa.array(c) for c in zip(*out)], ["ends", "sha"])
        if sha:
            yield pa.record_batch([pa.array([first]), pa.array([sha.hexdigest()])], ["ends", "sha"])

    ends = segs.where("last").select(F.col("h1").bitwiseXOR(F.col("x1")).alias("e1"), F.col("h2").bitwiseXOR(F.col("x2")).alias("e2"),
                                     "length", "conv")
    order = ["e1", "e2", "length", "conv"]
    joined = ends.repartitionByRange(*order).sortWithinPartitions(*order)
    joined = joined.mapInArrow(join, "e1 long, e2 long, length long, first long, text string")
    joined = joined.repartition("e1", "e2", "length").sortWithinPartitions("e1", "e2", "length", "first")
    return joined.mapInArrow(digest, "ends long, sha string")


def _as_nodes(heads: DataFrame) -> DataFrame:
    """Heads that burst, as nodes without sums."""
    zero = F.lit(0).cast("long")
    return heads.where((F.col("seg") == 0) | (F.col("off") > 0)).select(
        "conv", "depth", "parent", "n", F.col("words").cast("long").alias("words"), F.col("prefix").cast("long").alias("prefix"),
        "own_words", "sum_words", zero.alias("sum_owned"), zero.alias("owned"), zero.alias("leaves"), "ends", zero.alias("children"),
        F.lit(True).alias("open"), F.lit(False).alias("border"),
    )


def _counted(nodes: DataFrame, children: DataFrame | None) -> DataFrame:
    """Nodes with the number of their children, which for some are heads of other containers."""
    counts = nodes.where("border").select("conv", "depth", F.col("children").alias("more"))
    if children is not None:
        counts = counts.unionByName(children.withColumnRenamed("children", "more"))
    real = nodes.where("not border")
    opened = real.where("open").join(counts, ["conv", "depth"], "left")
    opened = opened.withColumn("children", F.col("children") + F.coalesce("more", F.lit(0)))
    return real.where("not open").unionByName(opened.select(*real.columns))


def prefix_trie(rows: DataFrame, conv_col: str = "conv_id", segment: int = SEGMENT, limit: int = LIMIT) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256): a row per node."""
    numbers, _ = turns(rows, conv_col)
    again, lengths = rebuilt(numbers)
    segs = stored(with_heads(stored(segments(again, lengths, segment), "segments"), segment), "headed")
    settled, absorbed, heads, children = burst(segs, segment, limit)
    zero = F.lit(0).cast("long")
    # The first sweep: who owns which nodes.
    first = sweep(settled.withColumns({"sum_owned": zero, "owned": zero, "leaves": zero}), segment)
    if heads is not None:
        first = first.unionByName(_as_nodes(heads))
    first = _counted(stored(first, "owners"), children)
    tops = first.where("parent is null or parent != conv").select(
        "conv", (F.col("own_words") - F.col("prefix") + F.col("words")).alias("owned"), zero.alias("leaf")
    )
    leaves = first.where("children = 0").select("conv", zero.alias("owned"), F.lit(1).cast("long").alias("leaf"))
    weights = tops.unionByName(leaves).groupBy("conv").agg(F.sum("owned").alias("owned"), F.sum("leaf").alias("leaf"))
    weights = stored(weights.join(lengths, "conv"), "weights")
    by_seg = _each(zero, F.expr(f"length div {segment}"), ["conv", "owned", "leaf"], weights, "seg")
    sums = segs.select("conv", "seg", *KEY).join(by_seg, ["conv", "seg"]).groupBy(*KEY).agg(
        F.sum("owned").alias("sum_owned"), F.min_by("owned", "conv").alias("owned"), F.sum("leaf").alias("leaves")
    )
    sums = stored(sums, "sums")
    # The second sweep: sums over the members of each node.
    weighed = settled.join(sums, KEY, "left").fillna(0, ["sum_owned", "owned", "leaves"])  # many members own no node
    nodes = sweep(weighed, segment)
    if heads is not None:
        below = settled.where(F.size("over") > 0).select(*KEY, "over").unionByName(absorbed)
        below = below.join(sums, KEY).select(F.explode("over").alias("o"), "sum_owned", "leaves")
        below = below.groupBy(F.col("o.conv").alias("conv"), F.col("o.depth").alias("depth")).agg(
            F.sum("sum_owned").alias("sum_owned"), F.sum("leaves").alias("leaves")
        )
        own = weights.select("conv", "owned")
        burst_nodes = _as_nodes(heads).drop("sum_owned", "leaves", "owned").join(below, ["conv", "depth"]).join(own, "conv")
        nodes = nodes.unionByName(burst_nodes)
    nodes = stored(_counted(stored(nodes, "nodes"), children), "counted")
    hashes = end_hashes(segs, segment)
    ended = nodes.where("ends is not null").join(hashes, "ends", "left")
    nodes = ended.unionByName(nodes.where("ends is null").withColumn("sha", F.lit(EMPTY)))
    above = F.col("prefix") - F.col("words")
    distinct = F.col("sum_owned") - F.col("owned") + F.col("own_words") - above
    return nodes.select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"),
        (F.col("sum_words") - F.col("n") * above - distinct).alias("saved_tokens"), F.col("sha").alias("ends_sha256"),
    )
