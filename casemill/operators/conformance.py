"""Conformance to the frequent part of the directly-follows graph."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from casemill.functions.columns import ACTIVITY, CASE, share_pct, usable
from casemill.operators.dfg import dfg
from casemill.operators.joins import balanced_join
from casemill.operators.ordering import CaseLoad, measure_cases, sequence


def kept_edges(edges: DataFrame, noise: float = 0.2) -> DataFrame:
    """(src, tgt, freq) of the edges with at least ``noise`` times the strongest edge leaving the same source."""
    strongest = F.max("freq").over(Window.partitionBy("src"))
    return edges.withColumn("_m", strongest).where(F.col("freq") >= F.col("_m") * noise).drop("_m")


def _checked_pairs(log: DataFrame, noise: float, load: CaseLoad | None) -> DataFrame:
    """(case_id, src, tgt, n, kept): the pairs of every case; single events have one row with a null tgt."""
    load = load or measure_cases(usable(log))
    kept = kept_edges(dfg(log, load), noise).select("src", "tgt", F.lit(True).alias("_kept"))
    pairs = sequence(log, [ACTIVITY], load).select(
        CASE, F.col(ACTIVITY).alias("src"), F.col("_next_activity").alias("tgt")
    )
    if load.small_alphabet:
        joined = pairs.withColumn("n", F.lit(1)).join(F.broadcast(kept), ["src", "tgt"], "left")
    else:
        counted = pairs.groupBy(CASE, "src", "tgt").agg(F.count(F.lit(1)).alias("n"))
        joined = balanced_join(counted, kept, [("src", "src"), ("tgt", "tgt")])
    return joined.select(CASE, "src", "tgt", "n", F.col("_kept").isNotNull().alias("kept"))


def dfg_conformance(log: DataFrame, noise: float = 0.2, load: CaseLoad | None = None) -> DataFrame:
    """(case_id, pairs, deviating, fits): a case fits when all its pairs are kept edges."""
    pair = F.col("tgt").isNotNull()
    bad = F.coalesce(F.sum(F.when(pair & ~F.col("kept"), F.col("n"))), F.lit(0))
    return _checked_pairs(log, noise, load).groupBy(CASE).agg(
        F.coalesce(F.sum(F.when(pair, F.col("n"))), F.lit(0)).alias("pairs"),
        bad.alias("deviating"),
        (bad == 0).alias("fits"),
    )


def dfg_fitness(log: DataFrame, noise: float = 0.2, load: CaseLoad | None = None) -> DataFrame:
    """(cases, fitting, pct_fitting): one row."""
    cases = dfg_conformance(log, noise, load)
    fitting = F.count_if(F.col("fits"))
    return cases.agg(
        F.count(F.lit(1)).alias("cases"),
        fitting.alias("fitting"),
        share_pct(fitting, F.count(F.lit(1))).alias("pct_fitting"),
    )


def deviations(log: DataFrame, noise: float = 0.2, load: CaseLoad | None = None) -> DataFrame:
    """(case_id, src, tgt, n): pairs of a case that are not kept edges."""
    bad = _checked_pairs(log, noise, load).where(F.col("tgt").isNotNull() & ~F.col("kept"))
    return bad.groupBy(CASE, "src", "tgt").agg(F.sum("n").alias("n"))
