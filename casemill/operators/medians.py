"""Exact medians of whole numbers, whatever the size of a group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from casemill.operators.joins import balanced_join
from casemill.session import cut_lineage

_SHIFTS = (40, 20, 0)


def exact_median(
    df: DataFrame, by: Sequence[str], value: str, out: str, single_pass: bool, written: bool = False
) -> DataFrame:
    """(by…, out): the median of a long column per group, as a double.

    ``single_pass`` uses the built-in percentile, which keeps a group's distinct values in one buffer; it is
    for inputs known to fit a task. Otherwise the two middle values are narrowed down in three rounds of
    counting by ever finer ranges of the value (2^40, 2^20, 1). Each round is a pre-aggregated count, so a
    group of any size reduces to at most 2^23 counters in the first round and 2^20 in the others. The rounds
    read the values from a written copy; ``written`` says that ``df`` already is one.
    """
    known = df.where(F.col(value).isNotNull())
    if single_pass:
        return known.groupBy(*by).agg(F.percentile(value, F.lit(0.5)).alias(out))
    groups = list(by) or ["_all"]
    group_columns = [F.col(c) for c in by] or [F.lit(0).alias("_all")]
    data = known.select(*group_columns, F.col(value).cast("long").alias("_v"))
    data = data if written else cut_lineage(data)
    picked = _middle_ranges(data, groups)
    for above, shift in zip(_SHIFTS, _SHIFTS[1:]):
        inside = balanced_join(
            data.withColumn("_up", F.shiftright("_v", above)),
            picked.withColumnRenamed("_b", "_up"),
            [(c, c) for c in [*groups, "_up"]],
            "inner",
        )
        side = [*groups, "_side", "_k"]
        counts = inside.groupBy(*side, F.shiftright("_v", shift).alias("_b")).agg(F.count(F.lit(1)).alias("_n"))
        picked = cut_lineage(_covering(counts, [*groups, "_side"], groups))
    result = picked.groupBy(*groups).agg(F.avg("_b").alias(out))
    return result if by else result.select(out)


def _middle_ranges(data: DataFrame, groups: list[str]) -> DataFrame:
    """Per group the coarse range that holds the lower (side 0) and the upper (side 1) middle value."""
    counts = data.groupBy(*groups, F.shiftright("_v", _SHIFTS[0]).alias("_b")).agg(F.count(F.lit(1)).alias("_n"))
    total = F.sum("_n").over(Window.partitionBy(*groups))
    sides = F.array(F.floor((F.col("_total") - 1) / 2), F.floor(F.col("_total") / 2))
    counts = counts.withColumn("_total", total).select("*", F.posexplode(sides).alias("_side", "_k"))
    return cut_lineage(_covering(counts, [*groups, "_side"], groups))


def _covering(counts: DataFrame, part: list[str], groups: list[str]) -> DataFrame:
    """The range whose running count covers rank ``_k``, and the rank that remains inside it."""
    running = Window.partitionBy(*part).orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
    end = F.col("_end")
    start = end - F.col("_n")
    hit = counts.withColumn("_end", F.sum("_n").over(running)).where((F.col("_k") >= start) & (F.col("_k") < end))
    return hit.select(*groups, "_side", (F.col("_k") - start).alias("_k"), "_b")
