"""What discovery tries where no cut divides a block, before it gives up with a flower.

Each way is a projection of the block's traces that leaves something to go on with: an activity that every trace has once,
or without which there is a cut, runs beside the rest; and traces that can be cut behind an end before a start, or
else before any start, are rounds of a loop. All open blocks of a level are asked at once: one aggregation counts what
traces have once, one gives for every activity the pairs that its runs stand between, from which the graph without
it follows from the block's graph, and the graphs are tried for cuts in parallel.
"""

from __future__ import annotations


import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casemill.functions import cuts as cuts_module
from casemill.functions import graphs as graphs_module
from casemill.functions.cuts import Graph, find_cut
from casemill.operators.ordering import CaseLoad, neighbours, running

for _module in (cuts_module, graphs_module):  # they travel with the tasks
    cloudpickle.register_pickle_by_value(_module)

TRACE = ["trace", "node", "seg"]


def once_per_trace(state: DataFrame, graphs: dict[int, Graph], nodes: list[int]) -> dict[int, str]:
    """For a block, the first activity by name that each of its traces has exactly once, where there is one."""
    steps = state.where(F.col("node").isin(nodes))
    single = steps.groupBy(*TRACE, "act").agg(F.count(F.lit(1)).alias("c"), F.max("n").alias("n")).where("c = 1")
    found: dict[int, str] = {}
    for r in single.groupBy("node", "act").agg(F.sum("n").alias("n")).collect():  # a row per activity
        g = graphs[r["node"]]
        if r["n"] == g.traces and len(g.activities) > 1:
            found[r["node"]] = min(r["act"], found.get(r["node"], r["act"]))
    return found


def beside_the_rest(
    state: DataFrame, graphs: dict[int, Graph], nodes: list[int], noise: float, load: CaseLoad
) -> dict[int, str]:
    """For a block, the activity without which the rest has a cut: first a cut of the whole graph, then of its frequent part,
    and by name."""
    steps = neighbours(state.where(F.col("node").isin(nodes)), TRACE, ["pos"], ["act"], load)
    runs = steps.where(~F.col("act").eqNullSafe(F.col("_prev_act"))).select(*state.columns)
    between = neighbours(runs, TRACE, ["pos"], ["act"], load)
    gaps = between.groupBy("node", "act", F.col("_prev_act").alias("a"), F.col("_next_act").alias("b")).agg(F.sum("n").alias("n"))
    sent = state.sparkSession.sparkContext.broadcast({k: graphs[k] for k in nodes})  # as large as the pairs of activities

    def try_without(group: pd.DataFrame) -> pd.DataFrame:
        node, act = int(group["node"].iloc[0]), group["act"].iloc[0]
        pairs = {(a if isinstance(a, str) else None, b if isinstance(b, str) else None): int(n)
                 for a, b, n in zip(group["a"], group["b"], group["n"])}
        cut = find_cut(sent.value[node].without(act, pairs), noise)
        return pd.DataFrame({"node": [node], "act": [act], "rank": [2 if cut is None else int(cut[2])]})

    tried = gaps.groupBy("node", "act").applyInPandas(try_without, "node int, act string, rank int")
    best = tried.where("rank < 2").groupBy("node").agg(F.min(F.struct("rank", "act")).alias("best"))
    return {r["node"]: r["best"]["act"] for r in best.collect()}


def rounds(g: Graph) -> tuple[frozenset, frozenset] | None:
    """(activities a round may end with, activities it may start with), where that cuts some trace in two: behind an end and
    before a start, else before any start."""
    starts, ends = frozenset(g.starts), frozenset(g.ends)
    if any(a in ends and b in starts for a, b in g.edges):
        return ends, starts
    if any(b in starts for _, b in g.edges):
        return frozenset(g.activities), starts
    return None


def cut_rounds(steps: DataFrame, load: CaseLoad) -> DataFrame:
    """``steps`` with flags ``ends`` and ``starts``: every round becomes a trace, named by its first position."""
    seen = neighbours(steps, TRACE, ["pos"], ["ends"], load)
    new = F.col("_prev_ends").isNull() | (F.col("_prev_ends") & F.col("starts"))
    seen = seen.select(*steps.columns, F.when(new, F.col("pos")).alias("_from"))
    return running(seen, TRACE, ["pos"], {"_run": F.col("_from")}, load, "max").withColumn("seg", F.col("_run"))
