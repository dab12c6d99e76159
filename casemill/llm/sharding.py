"""Reproducible shuffle into shards (operator 11), in DataFrame functions only.

All rows get global numbers 0 to n-1 in the order of columns that the caller names. A Feistel network with keys from a
seed permutes the numbers of ``bits`` bits, the fewest that hold n, and cycle walking makes that a permutation of 0 to
n-1: a number that lands at n or above goes through the network again. The place p of a row in the shuffle gives shard
p mod shards and slot p div shards, so shards differ by at most one row, slots have no gaps, and ``place`` and
``number_at`` compute either from the other without a look at any table.

Numbering is a range sort of the rows as given (callers hand in narrow ones) and one count per partition; rows that are
equal in the order are spread over partitions by where they were read. They share a set of numbers, so the result is the
same at every layout and number of executors as long as rows that tie are equal, which a hash of the content
in the order ensures.

Null ids are ordered first, a null text is of no bytes; repeated rows have a slot each; an empty table gives an empty result.
Extra columns pass through ``shuffled``. Equal texts are no groups here: copies go where their row numbers send them.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casemill.llm.common import numbered, stored

SHARDS = 8
SEED = 20
ROUNDS = 8  # even, so that the halves end as wide as they began
_HALF = (1 << 31) - 1  # halves have at most 31 bits, and products of two such numbers fit a long
_WALK, _FAR = 64, 4096


def bits_of(n: int) -> int:
    return max(2, (n - 1).bit_length())


def round_keys(n: int, seed: int) -> list[tuple[int, int, int, int, int]]:
    """(xor, factor, xor, factor, mask) of each round; the mask is as wide as the half that the round changes."""
    bits = bits_of(n)
    if bits > 62:
        raise ValueError("at most 2^62 rows")
    widths = bits // 2, bits - bits // 2
    keys = []
    for k in range(ROUNDS):
        digest = hashlib.sha256(f"{seed}:{k}".encode()).digest()
        a, b, c, d = (int.from_bytes(digest[i : i + 4], "big") & _HALF for i in range(0, 16, 4))
        keys.append((a, b | 1 | 1 << 30, c, d | 1 | 1 << 30, (1 << widths[k % 2]) - 1))
    return keys


def _mixed(half: Column, key: Column) -> Column:
    """Middle bits of two products."""
    once = F.shiftright(half.bitwiseXOR(key["a"]) * key["b"], 20).bitwiseAND(F.lit(_HALF))
    return F.shiftright(once.bitwiseXOR(key["c"]) * key["d"], 20).bitwiseAND(key["mask"])


def _network(x: Column, n: int, seed: int, back: bool = False) -> Column:
    """The Feistel network on numbers of ``bits_of(n)`` bits, or its inverse."""
    keys = round_keys(n, seed)
    names = ("a", "b", "c", "d", "mask")
    rounds = F.array(*(
        F.struct(*(F.lit(v).cast("long").alias(name) for v, name in zip(key, names)))
        for key in (reversed(keys) if back else keys)
    ))
    low = bits_of(n) - bits_of(n) // 2
    halves = F.struct(
        F.shiftright(x, low).alias("l"), x.bitwiseAND(F.lit((1 << low) - 1).cast("long")).alias("r")
    )

    def forth(h: Column, key: Column) -> Column:
        return F.struct(h["r"].alias("l"), h["l"].bitwiseXOR(_mixed(h["r"], key)).alias("r"))

    def undo(h: Column, key: Column) -> Column:
        return F.struct(h["r"].bitwiseXOR(_mixed(h["l"], key)).alias("l"), h["l"].alias("r"))

    return F.reduce(rounds, halves, undo if back else forth, lambda h: F.shiftleft(h["l"], low).bitwiseOR(h["r"]))


def _walk(x: Column, n: int, seed: int, back: bool) -> Column:
    """Through the network until the number is below n. Less than half of all numbers are not, so a walk of more than 4,161
    steps has a chance below 2^-4000; it is an error, never a wrong place."""

    def steps(at: Column, most: int) -> Column:
        again = lambda p, _: F.when(p >= n, _network(p, n, seed, back)).otherwise(p)
        return F.reduce(F.sequence(F.lit(1), F.lit(most)), at, again)

    near = lambda p: F.when(p >= n, steps(p, _WALK)).otherwise(p)
    far = lambda p: F.when(p >= n, steps(p, _FAR)).otherwise(p)
    lost = lambda p: F.when(p >= n, F.raise_error(F.lit("a cycle walk did not end")).cast("long")).otherwise(p)
    out = F.array(_network(x.cast("long"), n, seed, back))
    for step in (near, far, lost):
        out = F.transform(out, step)
    return out[0]


def place(number: Column, n: int, shards: int = SHARDS, seed: int = SEED) -> Column:
    """struct<shard int, slot long> of a row number below ``n``."""
    at = F.transform(F.array(_walk(number, n, seed, False)), lambda p: F.struct(
        (p % shards).cast("int").alias("shard"), F.floor(p / F.lit(shards).cast("decimal(20,0)")).cast("long").alias("slot")
    ))
    return at[0]


def number_at(shard: Column, slot: Column, n: int, shards: int = SHARDS, seed: int = SEED) -> Column:
    """The row number that ``place`` sends to a slot of a shard."""
    return _walk(slot.cast("long") * shards + shard, n, seed, True)


def shuffled(rows: DataFrame, order: list[Column], shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """``rows`` with number, shard and slot. ``order`` should tell rows apart that are not equal."""
    table, n = numbered(rows, order)
    at = place(F.col("number"), max(n, 1), shards, seed)
    return table.withColumn("_at", at).withColumns({"shard": F.col("_at.shard"), "slot": F.col("_at.slot")}).drop("_at")


def shard_documents(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """(doc_id, size, text_crc32, number, shard, slot): where each document goes; texts stay where they are."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    facts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("text_hash"),
    )
    facts = stored(facts, "facts")
    order = [F.col("doc_id").asc_nulls_first(), F.col("size"), F.col("text_crc32"), F.col("text_hash")]
    return shuffled(facts, order, shards, seed).drop("text_hash")
