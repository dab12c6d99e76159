"""Token-based replay of a log on a process model.

Only the variants are replayed, in Arrow batches. Replay and the exact test whether a trace is in the language are
machines whose state after a step depends on the state before and the activity alone. A long variant is cut into chunks,
and every chunk is a link from the state it begins with to the state it ends with. Links are made ahead from likely
states: the first one of the machine, then what the chunk before ended with. They are chained like functions; where the chain
of a variant meets a state no link begins with, links from that state are added, to all later chunks at once in the first
rounds, and along the chain for twice as many chunks as the round before. So rounds grow with the logarithm of the
chunks for any number of states, and a trace has the same result at any chunk length.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casemill.functions import net as net_module
from casemill.functions.columns import ACTIVITY, CASE, usable
from casemill.functions.net import Net, Replayer, net_of
from casemill.operators.joins import balanced_join
from casemill.operators.model import ProcessTree, discover_model
from casemill.operators.ordering import CaseLoad, measure_cases
from casemill.operators.variants import case_signatures, case_variants, ranked_events, variant_steps
from casemill.session import cut_lineage

# The replay code travels with the task, so workers need no copy of this package.
cloudpickle.register_pickle_by_value(net_module)

CHUNK = 10_000  # steps of a variant that one row may hold; an Arrow batch has up to 10,000 rows
FAN_IN = 256  # chunk results that are chained in one group
SPREADS = 6  # rounds in which a state the chain met is tried on all later chunks
AHEAD = 64  # chunks that are walked along the chain in the first round
COUNTS = ("produced", "consumed", "missing", "remaining")
_COUNTS_SCHEMA = ", ".join(f"{c} long" for c in COUNTS)
_LINK = ["first_case", "chunk", "start", "end", *COUNTS]


class _Tokens:
    """Replay as a machine: the state is a marking, a link carries what was counted."""

    def __init__(self, net: Net):
        self.player = Replayer(net)
        self.first = format(Replayer.START, "x")

    def run(self, state: str, names: list[str]) -> tuple[str, tuple]:
        marking, counts = self.player.run(int(state, 16), names)
        return format(marking, "x"), counts


class _Language:
    """Membership as a machine: the state is the set of markings a trace in the language can be in."""

    def __init__(self, net: Net):
        self.player = Replayer(net)
        self.first = self._text(self.player.first())

    @staticmethod
    def _text(markings: frozenset[int]) -> str:
        return ",".join(format(m, "x") for m in sorted(markings))

    def run(self, state: str, names: list[str]) -> tuple[str, tuple]:
        at = frozenset(int(m, 16) for m in state.split(",")) if state else frozenset()
        return self._text(self.player.follow(at, names)) if at else "", (0, 0, 0, 0)


def replay_variants(
    steps: DataFrame, model: ProcessTree, longest: int, chunk: int = CHUNK, ahead: int = AHEAD, fan_in: int = FAN_IN
) -> DataFrame:
    """(first_case, length, n, produced, consumed, missing, remaining) per variant.

    ``steps`` is the result of ``variant_steps``; ``longest`` is a bound of the longest variant. Below ``chunk`` everything
    is one lazy pass. Replay takes the shortest silent way, which may be the wrong one of several; a trace that it finds at
    fault but that is in the language has nothing missing or remaining, whatever its length.
    """
    net = net_of(model)
    labels = [*model.labels(), ""]  # an activity the model does not know has number -1 and finds the last entry
    names = steps.sparkSession.createDataFrame([(x, i) for i, x in enumerate(labels[:-1])], f"{ACTIVITY} string, code int")
    key_type = steps.schema["first_case"].dataType.simpleString()
    part = F.floor((F.col("position") - 1) / chunk).cast("long")
    coded = steps.join(F.broadcast(names), ACTIVITY, "left").withColumn("code", F.coalesce("code", F.lit(-1)))  # a row per label
    rows = coded.groupBy("first_case", "length", "n", part.alias("chunk")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("position", "code"))), lambda s: s["code"]).alias("acts")
    )
    short = rows.where(F.col("length") <= chunk).select("first_case", "length", "n", "acts")

    def whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        player = Replayer(net)
        for batch in batches:
            counts = [player.judge([labels[i] for i in acts]) for acts in batch["acts"]]
            out = batch[["first_case", "length", "n"]].copy()
            out[list(COUNTS)] = pd.DataFrame(counts, columns=list(COUNTS), index=batch.index)
            yield out

    done = short.mapInPandas(whole, f"first_case {key_type}, length long, n long, {_COUNTS_SCHEMA}")
    if longest <= chunk or not steps.where(F.col("length") > chunk).limit(1).collect():
        return done
    long = cut_lineage(rows.where(F.col("length") > chunk))
    return done.unionByName(_replay_long(long, net, labels, key_type, ahead, fan_in))


def _replay_long(long: DataFrame, net: Net, labels: list[str], key_type: str, ahead: int, fan_in: int) -> DataFrame:
    ended = _ends(long, _Tokens, net, labels, key_type, ahead, fan_in)

    def close(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        player = Replayer(net)
        for batch in batches:
            last = pd.DataFrame([player.finish(int(m, 16)) for m in batch["end"]], columns=list(COUNTS), index=batch.index)
            batch[list(COUNTS)] = batch[list(COUNTS)] + last
            yield batch.drop(columns="end")

    variants = long.select("first_case", "length", "n").distinct()
    counts = variants.join(ended, "first_case").select("first_case", "length", "n", "end", *COUNTS)
    counts = cut_lineage(counts.mapInPandas(close, f"first_case {key_type}, length long, n long, {_COUNTS_SCHEMA}"))
    faulty = counts.where((F.col("missing") > 0) | (F.col("remaining") > 0)).select("first_case")
    doubtful = cut_lineage(long.join(faulty, "first_case", "left_semi"))
    if doubtful.isEmpty():
        return counts
    sink = format(Replayer.SINK, "x")
    known = _ends(doubtful, _Language, net, labels, key_type, ahead, fan_in)
    allowed = known.where(F.array_contains(F.split("end", ","), sink)).select("first_case", F.lit(True).alias("allowed"))
    judged = counts.join(allowed, "first_case", "left")
    none = {c: F.when(F.col("allowed"), 0).otherwise(F.col(c)) for c in ("missing", "remaining")}
    return judged.withColumns(none).drop("allowed")


def _ends(long: DataFrame, machine: type, net: Net, labels: list[str], key_type: str, ahead: int, fan_in: int) -> DataFrame:
    """(first_case, end, counts): the last state of every variant of ``long`` (first_case, chunk, acts)."""
    schema = f"first_case {key_type}, chunk long, start string, end string, {_COUNTS_SCHEMA}"
    first = machine(net).first
    chunks = long.select("first_case", "chunk", "acts")

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Links from the given states."""
        at = machine(net)
        for batch in batches:
            rows = []
            for case, chunk, acts, start in zip(batch["first_case"], batch["chunk"], batch["acts"], batch["start"]):
                end, counts = at.run(start, [labels[i] for i in acts])
                rows.append((case, chunk, start, end, *counts))
            yield pd.DataFrame(rows, columns=_LINK)

    def along(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Links along the chain, from the given state of the first chunk of each variant; rows come in order."""
        at, case, state = machine(net), None, None
        for batch in batches:
            rows = []
            for r in batch.itertuples():
                if r.first_case != case:
                    case, state = r.first_case, r.start
                end, counts = at.run(state, [labels[i] for i in r.acts])
                rows.append((case, r.chunk, state, end, *counts))
                state = end
            yield pd.DataFrame(rows, columns=_LINK)

    links = cut_lineage(chunks.withColumn("start", F.lit(first)).mapInPandas(each, schema))
    guesses = links.select("first_case", (F.col("chunk") + 1).alias("chunk"), F.col("end").alias("start"))
    guesses = chunks.join(guesses.where(F.col("start") != first), ["first_case", "chunk"])
    links = cut_lineage(links.unionByName(guesses.select("first_case", "chunk", "acts", "start").mapInPandas(each, schema)))
    turn = 0
    while True:
        chained = cut_lineage(_chain(links, key_type, first, fan_in))
        met = chained.where("met is not null").select("first_case", F.col("met").alias("from"), F.col("end").alias("start"))
        if met.isEmpty():
            return chained.select("first_case", "end", *COUNTS)
        later = chunks.join(met, "first_case").where(F.col("chunk") >= F.col("from"))
        walked = later.where(F.col("chunk") < F.col("from") + ahead * 2**turn).select("first_case", "chunk", "acts", "start")
        walked = walked.repartition("first_case").sortWithinPartitions("first_case", "chunk").mapInPandas(along, schema)
        new = walked
        if turn < SPREADS:
            new = new.unionByName(later.select("first_case", "chunk", "acts", "start").mapInPandas(each, schema))
        new = new.join(links, ["first_case", "chunk", "start"], "left_anti").dropDuplicates(["first_case", "chunk", "start"])
        links = cut_lineage(links.unionByName(new))
        turn += 1


def _chain(links: DataFrame, key_type: str, first: str, fan_in: int = FAN_IN) -> DataFrame:
    """(first_case, end, met, counts) from the first state, chaining ``fan_in`` neighbouring chunks per round. Where the chain
    meets a state that no link of the next chunk begins with, ``met`` is that chunk and ``end`` the state."""
    schema = f"first_case {key_type}, chunk long, start string, end string, met long, {_COUNTS_SCHEMA}"

    def together(group: pd.DataFrame) -> pd.DataFrame:
        at, scale = {}, int(group["scale"].iloc[0])
        for chunk, part in group.groupby("chunk", sort=True):
            step = {r.start: (r.end, r.met, r.produced, r.consumed, r.missing, r.remaining) for r in part.itertuples()}
            if not at:
                at = step
                continue
            for s, (end, met, *counts) in at.items():
                if met >= 0:
                    continue
                if end in step:
                    then, met, *more = step[end]
                    at[s] = (then, met, *(x + y for x, y in zip(counts, more)))
                else:
                    at[s] = (end, chunk * scale, *counts)
        case, number = group["first_case"].iloc[0], group["chunk"].iloc[0] // fan_in
        return pd.DataFrame([(case, number, s, *v) for s, v in at.items()], columns=[*_LINK[:4], "met", *COUNTS])

    scale, most = 1, links.agg(F.max("chunk")).first()[0]
    runs = links.withColumn("met", F.lit(-1).cast("long"))
    while most > 0:
        groups = runs.withColumn("scale", F.lit(scale)).groupBy("first_case", F.floor(F.col("chunk") / fan_in))
        runs = groups.applyInPandas(together, schema)
        scale, most = scale * fan_in, most // fan_in
    runs = runs.where(F.col("start") == first)
    return runs.select("first_case", "end", F.when(F.col("met") >= 0, F.col("met")).alias("met"), *COUNTS)


def with_fitness(counts: DataFrame) -> DataFrame:
    """Add ``fitness`` = ½(1 - missing/consumed) + ½(1 - remaining/produced) and ``fits``."""
    lost = F.col("missing") / F.col("consumed") + F.col("remaining") / F.col("produced")
    return counts.withColumns(
        {"fitness": 1 - lost / 2, "fits": (F.col("missing") == 0) & (F.col("remaining") == 0)}
    )


def replay(
    log: DataFrame,
    model: ProcessTree,
    load: CaseLoad | None = None,
    steps: DataFrame | None = None,
    signatures: DataFrame | None = None,
) -> DataFrame:
    """(case_id, produced, consumed, missing, remaining, fitness, fits) for every case.

    ``steps`` and ``signatures`` are the written results of ``variant_steps`` and ``case_signatures`` where the caller
    already has them.
    """
    load = load or measure_cases(usable(log))
    if signatures is None:
        ranked = ranked_events(log, load)
        signatures = cut_lineage(case_signatures(log, load, ranked))
        steps = variant_steps(log, load, signatures, ranked) if steps is None else steps
    steps = variant_steps(log, load, signatures) if steps is None else steps
    results = cut_lineage(with_fitness(replay_variants(steps, model, load.events)).drop("length", "n"))
    joined = balanced_join(case_variants(log, load, signatures), results, [("first_case", "first_case")], "inner")
    return joined.select(CASE, *COUNTS, "fitness", "fits")


def fitness(
    log: DataFrame, model: ProcessTree | None = None, noise: float = 0.2, load: CaseLoad | None = None
) -> DataFrame:
    """(cases, average_trace_fitness, pct_fitting, status): averages are over cases.

    Without a model one is discovered first, from the same written table of variants that is replayed.
    Status is good above an average of 0.8.
    """
    load = load or measure_cases(usable(log))
    steps = variant_steps(log, load, ranked=ranked_events(log, load))
    if model is None:
        steps = cut_lineage(steps)
        model = discover_model(log, noise, load, steps=steps)
    per_variant = with_fitness(replay_variants(steps, model, load.events))
    cases = F.sum("n")
    average = F.sum(F.col("fitness") * F.col("n")) / cases
    fitting = F.coalesce(F.sum(F.when(F.col("fits"), F.col("n"))), F.lit(0)) * 100.0 / cases
    return per_variant.agg(
        F.coalesce(cases, F.lit(0)).alias("cases"),
        average.alias("average_trace_fitness"),
        F.coalesce(fitting, average * 100).alias("pct_fitting"),
        F.when(average > 0.8, "good").otherwise("warning").alias("status"),
    )
