"""Directly-follows graph, its times and its drawing."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from casemill.functions.columns import ACTIVITY, CASE, TIMESTAMP, micros, mining_order, usable
from casemill.operators.joins import fits_broadcast
from casemill.operators.medians import exact_median
from casemill.operators.ordering import MAX_ACTIVITIES, CaseLoad, measure_cases, sequence
from casemill.session import cut_lineage


def dfg(log: DataFrame, load: CaseLoad | None = None) -> DataFrame:
    """(src, tgt, freq): how often tgt directly follows src within a case."""
    pairs = sequence(log, [ACTIVITY], load).where(F.col("_next_activity").isNotNull())
    return pairs.groupBy(F.col(ACTIVITY).alias("src"), F.col("_next_activity").alias("tgt")).agg(
        F.count(F.lit(1)).alias("freq")
    )


_SEQ, _NAMES = 10**10, 10**7  # of an order number: places for the source order, and for the number of an activity


def case_ends(log: DataFrame) -> DataFrame:
    """(case_id, start, end): the first and last activity of every case.

    Time, source order and the place of the activity in the alphabet make one decimal number per event, of which a hash
    aggregate keeps the least and the largest; the activities are read back from these. Where event ids order the
    events (logs without a source order), or the alphabet has more than 10^7 names, the columns themselves are compared.
    """
    events, order = usable(log), mining_order(log)
    names = events.select(ACTIVITY).distinct()
    by_number = "event_id" not in order and dict(log.dtypes).get("source_seq", "int") in ("int", "smallint", "tinyint")
    if by_number:  # one task numbers the distinct activities
        names = cut_lineage(names.withColumn("_no", F.row_number().over(Window.orderBy(ACTIVITY)) - 1))
        by_number = names.count() < _NAMES
    if not by_number:
        at = F.struct(*order)
        return events.groupBy(CASE).agg(F.min_by(ACTIVITY, at).alias("start"), F.max_by(ACTIVITY, at).alias("end"))
    small = fits_broadcast(names)
    wide = lambda c: c.cast("decimal(20,0)")
    seq = F.coalesce(F.col("source_seq").cast("long") + 2**31 + 1, F.lit(0)) if "source_seq" in order else F.lit(0)
    number = wide(micros(TIMESTAMP)) * F.lit(_SEQ * _NAMES).cast("decimal(18,0)") + wide(seq) * _NAMES + F.col("_no")
    numbered = events.join(F.broadcast(names) if small else names, ACTIVITY).select(CASE, number.cast("decimal(38,0)").alias("_at"))
    ends = numbered.groupBy(CASE).agg(F.min("_at").alias("_a"), F.max("_at").alias("_z"))
    for column, kind in (("_a", "start"), ("_z", "end")):
        named = names.select(F.col(ACTIVITY).alias(kind), F.col("_no").alias(f"{column}_no"))
        ends = ends.withColumn(f"{column}_no", F.pmod(F.col(column), F.lit(_NAMES)).cast("int"))
        ends = ends.join(F.broadcast(named) if small else named, f"{column}_no")
    return ends.select(CASE, "start", "end")


def start_end(log: DataFrame) -> DataFrame:
    """(activity, kind, n): first and last activities of the cases."""
    rows = F.array(
        F.struct(F.lit("start").alias("kind"), F.col("start").alias(ACTIVITY)),
        F.struct(F.lit("end").alias("kind"), F.col("end").alias(ACTIVITY)),
    )
    return case_ends(log).select(F.inline(rows)).groupBy(ACTIVITY, "kind").agg(F.count(F.lit(1)).alias("n"))


def activity_counts(log: DataFrame) -> DataFrame:
    """(activity, n) over the usable events."""
    return usable(log).groupBy(ACTIVITY).agg(F.count(F.lit(1)).alias("n"))


def alphabet(log: DataFrame, max_activities: int = MAX_ACTIVITIES) -> list[str]:
    """The activities in order, on the driver; raises when there are more than a caller can hold there."""
    rows = usable(log).select(ACTIVITY).distinct().limit(max_activities + 1).collect()
    if len(rows) > max_activities:
        raise ValueError(f"more than {max_activities} activities")
    return sorted(r[ACTIVITY] for r in rows)


def dfg_layers(log: DataFrame, load: CaseLoad | None = None, use_rank: bool = True) -> DataFrame:
    """(activity, layer): the median rank of an activity, rounded half to even.

    Without ``event_rank`` (object-centric events) or with ``use_rank=False`` the layer is the place in the
    alphabet, from 0.
    """
    events = usable(log)
    if use_rank and "event_rank" in log.columns:
        load = load or measure_cases(events)
        median = exact_median(events, [ACTIVITY], "event_rank", "_m", single_pass=load.small)
        return median.select(ACTIVITY, F.bround("_m").cast("long").alias("layer"))
    names = events.select(ACTIVITY).distinct()  # one task numbers the distinct activities
    return names.select(ACTIVITY, (F.row_number().over(Window.orderBy(ACTIVITY)) - 1).cast("long").alias("layer"))


def dfg_layout(log: DataFrame, load: CaseLoad | None = None, use_rank: bool = True) -> DataFrame:
    """(activity, layer, x, y): layers two apart, activities of a layer centred around 0."""
    layers = dfg_layers(log, load, use_rank)
    place = F.row_number().over(Window.partitionBy("layer").orderBy(ACTIVITY)) - 1
    size = F.count(F.lit(1)).over(Window.partitionBy("layer"))
    return layers.select(
        ACTIVITY,
        "layer",
        (F.col("layer") * 2).cast("double").alias("x"),
        ((place - (size - 1) / 2) * 1.5).alias("y"),
    )


def edge_weights(edges: DataFrame) -> DataFrame:
    """(src, tgt, freq, width, opacity) of a DFG, relative to its strongest edge."""
    share = F.col("freq") / edges.agg(F.max("freq").alias("m")).scalar()
    return edges.select(
        "src",
        "tgt",
        "freq",
        F.greatest(F.lit(0.5), share * 4).alias("width"),
        F.greatest(F.lit(0.2), share).alias("opacity"),
    )


def node_weights(nodes: DataFrame) -> DataFrame:
    """(activity, n, size) of activity counts, relative to the most frequent one."""
    share = F.col("n") / nodes.agg(F.max("n").alias("m")).scalar()
    return nodes.select(ACTIVITY, "n", F.greatest(F.lit(20.0), share * 60).alias("size"))


def dfg_weights(log: DataFrame, load: CaseLoad | None = None) -> DataFrame:
    """(kind, src, tgt, n, width, opacity, size): drawing weights of edges and nodes in one table."""
    edges = edge_weights(dfg(log, load))
    nodes = node_weights(activity_counts(log))
    return edges.select(
        F.lit("edge").alias("kind"), "src", "tgt", F.col("freq").alias("n"), "width", "opacity",
        F.lit(None).cast("double").alias("size"),
    ).unionByName(
        nodes.select(F.lit("node").alias("kind"), F.col(ACTIVITY).alias("src"), "n", "size"), allowMissingColumns=True
    )


def performance_dfg(log: DataFrame, load: CaseLoad | None = None, median: bool = True) -> DataFrame:
    """(src, tgt, n, mean_seconds, min_seconds, max_seconds, sum_seconds, median_seconds).

    Times are taken in microseconds. The median needs the full distribution of an edge; leave it out when
    only the mean is wanted.
    """
    events = usable(log)
    load = load or measure_cases(events)
    pairs = sequence(log, [ACTIVITY, TIMESTAMP], load).where(F.col("_next_activity").isNotNull())
    pairs = pairs.select(
        F.col(ACTIVITY).alias("src"),
        F.col("_next_activity").alias("tgt"),
        (micros(f"_next_{TIMESTAMP}") - micros(TIMESTAMP)).alias("_us"),
    )
    stats = [
        F.count(F.lit(1)).alias("n"),
        (F.avg("_us") / 1e6).alias("mean_seconds"),
        (F.min("_us") / 1e6).alias("min_seconds"),
        (F.max("_us") / 1e6).alias("max_seconds"),
        (F.sum(F.col("_us").cast("decimal(19, 0)")).cast("double") / 1e6).alias("sum_seconds"),  # beyond a long
    ]
    if not median:
        return pairs.groupBy("src", "tgt").agg(*stats)
    if load.small:
        middle = (F.percentile("_us", F.lit(0.5)) / 1e6).alias("median_seconds")
        return pairs.groupBy("src", "tgt").agg(*stats, middle)
    pairs = cut_lineage(pairs)
    middle = exact_median(pairs, ["src", "tgt"], "_us", "_m", single_pass=False, written=True)
    middle = middle.select("src", "tgt", (F.col("_m") / 1e6).alias("median_seconds"))
    return pairs.groupBy("src", "tgt").agg(*stats).join(middle, ["src", "tgt"])


def bottlenecks(log: DataFrame, k: int = 10, load: CaseLoad | None = None) -> DataFrame:
    """(label, src, tgt, n, mean_hours): the k edges with the longest mean time."""
    edges = performance_dfg(log, load, median=False)
    return (
        edges.orderBy(F.desc("mean_seconds"), "src", "tgt")
        .limit(k)
        .select(
            F.concat_ws(" -> ", "src", "tgt").alias("label"),
            "src",
            "tgt",
            "n",
            (F.col("mean_seconds") / 3600).alias("mean_hours"),
        )
    )
