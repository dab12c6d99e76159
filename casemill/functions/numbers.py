"""Numbers that Spark deals to the same bucket."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The steps of ``hash()`` (32-bit Murmur3, seed 42, for a long its lower half first) that are taken back.
_SEED, _LONG = 42, 8
_FIRST, _SECOND, _FIVE, _ADDED = 0xCC9E2D51, 0x1B873593, 5, 0xE6546B64
_FINAL = (0x85EBCA6B, 0xC2B2AE35)
_MASK = 0xFFFFFFFF
Step = Callable[[Column], Column]


def _times(factor: int) -> Step:
    """The lower 32 bits of a product with a 32-bit number, without an overflow of longs."""
    high, low = factor >> 16, factor & 0xFFFF
    return lambda x: (x * F.lit(low) + (x * F.lit(high)).bitwiseAND(F.lit(0xFFFF)) * F.lit(1 << 16)).bitwiseAND(F.lit(_MASK))


def _over(factor: int) -> Step:
    return _times(pow(factor, -1, 1 << 32))


def _turned(bits: int) -> Step:
    return lambda x: F.shiftleft(x, bits).bitwiseOR(F.shiftright(x, 32 - bits)).bitwiseAND(F.lit(_MASK))


def _xor(other: Column) -> Step:
    return lambda x: x.bitwiseXOR(other)


def _unshifted(*bits: int) -> Step:
    def step(x: Column) -> Column:
        out = x
        for b in bits:
            out = out.bitwiseXOR(F.shiftright(x, b))
        return out

    return step


def _less_added(x: Column) -> Column:
    return (x + F.lit((1 << 32) - _ADDED)).bitwiseAND(F.lit(_MASK))


def with_hashed_number(df: DataFrame, name: str, upper: Column, wanted: Column) -> DataFrame:
    """``df`` with the long whose upper half is ``upper`` and whose ``hash()`` is ``wanted`` (numbers below 2^32 both).

    There is one for each pair, so numbers differ where the pairs do; they rise with ``upper`` below 2^31. Bucketed tables
    and ``repartition`` go by the hash, so rows that should lie together get the same one. A step uses the one before more than
    once, so each has a column of its own.
    """
    halves = {"_mixed": [_times(_FIRST), _turned(15), _times(_SECOND)]}
    halves[name] = [
        _unshifted(16), _over(_FINAL[1]), _unshifted(13, 26), _over(_FINAL[0]), _unshifted(16), _xor(F.lit(_LONG)),
        _less_added, _over(_FIVE), _turned(32 - 13), _xor(F.col("_mixed")),
        _less_added, _over(_FIVE), _turned(32 - 13), _xor(F.lit(_SEED)),
        _over(_SECOND), _turned(32 - 15), _over(_FIRST),
    ]
    df = df.withColumns({"_upper": upper.cast("long"), "_mixed": upper.cast("long"), name: wanted.cast("long")})
    for column, steps in halves.items():
        for step in steps:
            df = df.withColumn(column, step(F.col(column)))
    return df.withColumn(name, F.shiftleft("_upper", 32).bitwiseOR(F.col(name))).drop("_upper", "_mixed")
