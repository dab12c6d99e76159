"""Variants: the distinct activity sequences of the cases.

A case is never gathered into one row to be compared. Its sequence is identified by its length and two 64-bit
hashes that combine (position, activity) over all events, which any aggregation can do in parts. The
activities of a variant are read back from its first case.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from casemill.functions.columns import ACTIVITY, CASE, mining_order, usable, variant_label
from casemill.operators.joins import balanced_join, fits_broadcast
from casemill.operators.ordering import BROADCAST_KEYS, CaseLoad, measure_cases, sequence, split_hot
from casemill.session import cut_lineage, written

SIGNATURE = ("length", "h1", "h2")


def ranked_events(log: DataFrame, load: CaseLoad | None = None) -> DataFrame:
    """(case_id, _rank, activity), written: what signatures, counts and steps of variants are made of, ranked once."""
    return written(sequence(log, [], load).select(CASE, "_rank", ACTIVITY), "ranked")


def case_signatures(log: DataFrame, load: CaseLoad | None = None, ranked: DataFrame | None = None) -> DataFrame:
    """(case_id, length, h1, h2): equal signatures mean equal activity sequences. ``ranked``: see ``ranked_events``."""
    return _signatures(sequence(log, [], load) if ranked is None else ranked)


def _signatures(ranked: DataFrame) -> DataFrame:
    return ranked.groupBy(CASE).agg(
        F.count(F.lit(1)).alias("length"),
        F.bit_xor(F.xxhash64("_rank", ACTIVITY)).alias("h1"),
        F.bit_xor(F.xxhash64(ACTIVITY, "_rank", F.lit(1))).alias("h2"),
    )


def _variant_counts(signatures: DataFrame) -> DataFrame:
    return signatures.groupBy(*SIGNATURE).agg(F.count(F.lit(1)).alias("n"), F.min(CASE).alias("first_case"))


def variants(
    log: DataFrame, k: int | None = 10, load: CaseLoad | None = None, max_shown: int | None = None
) -> DataFrame:
    """(rank, variant, label, length, n, first_case): the k most frequent variants, or all of them.

    Ties go to the variant with the smaller first case. ``variant`` is an array of all its activities, which one row
    has to hold; a caller that does not want long ones gives ``max_shown``, above which it is null (the label stays),
    and reads them row by row with ``variant_steps``.
    """
    events = usable(log)
    load = load or measure_cases(events)
    counts = _variant_counts(case_signatures(log, load))
    order = [F.desc("n"), F.asc("first_case")]
    if k is not None:
        # One task ranks at most k rows here.
        counts = counts.orderBy(*order).limit(k).withColumn("rank", F.row_number().over(Window.orderBy(*order)))
    else:
        counts = counts.withColumn("rank", F.lit(None).cast("int"))
    shown = counts if max_shown is None else counts.where(F.col("length") <= max_shown)
    few = k is not None and k <= 1000
    at = mining_order(log)
    steps = _of_cases(events, shown, few).groupBy(CASE).agg(
        F.array_sort(F.collect_list(F.struct(*at, F.col(ACTIVITY).alias("_a")))).alias("_s")
    )
    shown = steps.select(F.col(CASE).alias("_c"), F.transform("_s", lambda s: s["_a"]).alias("variant"))
    out = counts.join(shown, F.col("first_case") == F.col("_c"), "left")
    label = variant_label("variant")
    if max_shown is not None:
        heads = _heads(sequence(log, [], load), counts.where(F.col("length") > max_shown), few)
        out = out.join(heads, F.col("first_case") == F.col("_hc"), "left")
        head = F.concat(F.array_join("_head", " -> "), F.when(F.col("length") > 3, F.lit("...")).otherwise(""))
        label = F.when(F.col("variant").isNotNull(), label).otherwise(head)
    return out.select("rank", "variant", label.alias("label"), "length", "n", "first_case")


def _of_cases(events: DataFrame, chosen: DataFrame, few: bool) -> DataFrame:
    cases = chosen.select(F.col("first_case").alias("_c"))
    return events.join(F.broadcast(cases) if few else cases, F.col(CASE) == F.col("_c"), "left_semi")


def _heads(ranked: DataFrame, chosen: DataFrame, few: bool) -> DataFrame:
    """The first three activities of the chosen variants' first cases."""
    first = _of_cases(ranked.where(F.col("_rank") <= 3), chosen, few)
    head = F.transform(F.array_sort(F.collect_list(F.struct("_rank", ACTIVITY))), lambda s: s[ACTIVITY])
    return first.groupBy(F.col(CASE).alias("_hc")).agg(head.alias("_head"))


def variant_steps(
    log: DataFrame, load: CaseLoad | None = None, signatures: DataFrame | None = None, ranked: DataFrame | None = None
) -> DataFrame:
    """(first_case, position, activity, length, n): all variants in long form, positions from 1.

    With the written result of ``case_signatures``, only the variants' first cases are ranked; with that of ``ranked_events``
    nothing is ranked again.
    """
    events = usable(log)
    load = load or measure_cases(events)
    if ranked is not None:
        counts = cut_lineage(_variant_counts(_signatures(ranked) if signatures is None else signatures))
        ranked = ranked.select(CASE, F.col("_rank").alias("position"), ACTIVITY)
        if fits_broadcast(counts.select("first_case")):
            counts = F.broadcast(counts)
    elif signatures is None:
        ranked = sequence(log, [], load).select(CASE, F.col("_rank").alias("position"), ACTIVITY)
        counts = _variant_counts(_signatures(ranked.withColumnRenamed("position", "_rank")))
    else:
        counts = cut_lineage(_variant_counts(signatures))
        first = _of_cases(events, counts, fits_broadcast(counts.select("first_case")))
        ranked = sequence(first, [], load).select(CASE, F.col("_rank").alias("position"), ACTIVITY)
    counts = counts.select("first_case", "length", "n")
    normal, hot = split_hot(ranked, load)
    out = normal.join(counts, F.col(CASE) == F.col("first_case"))
    if hot is not None:
        few = counts.join(load.hot.select(F.col("_hot").alias("first_case")), "first_case", "left_semi")
        few = F.broadcast(few) if load.hot_cases <= BROADCAST_KEYS else few
        out = out.unionByName(hot.join(few, F.col(CASE) == F.col("first_case")))
    return out.select("first_case", "position", ACTIVITY, "length", "n")


def case_variants(log: DataFrame, load: CaseLoad | None = None, signatures: DataFrame | None = None) -> DataFrame:
    """(case_id, first_case): which variant, named by its first case, every case follows.

    The table of variants is written down before it is joined, so that its size check costs no second pass.
    """
    signatures = case_signatures(log, load) if signatures is None else signatures
    counts = cut_lineage(_variant_counts(signatures).select(*SIGNATURE, "first_case"))
    return balanced_join(signatures, counts, [(s, s) for s in SIGNATURE], "inner").select(CASE, "first_case")
