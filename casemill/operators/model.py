"""Discovery of a block-structured process model.

The log is reduced to its variants in long form (one row per step, never one row per trace). Every level of
the recursion is one Spark aggregation over all open blocks that gives their directly-follows counts; the
driver looks for a cut in these alphabet-sized graphs, and Spark then assigns every step to its child block.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casemill.functions.columns import ACTIVITY, usable
from casemill.functions.cuts import Graph, find_cut
from casemill.operators.dfg import alphabet
from casemill.operators.fallthrough import TRACE, beside_the_rest, cut_rounds, once_per_trace, rounds
from casemill.operators.joins import balanced_join
from casemill.operators.ordering import CaseLoad, measure_cases, neighbours, running
from casemill.operators.variants import variant_steps
from casemill.session import cut_lineage

_START, _END = "\x02start", "\x03end"


@dataclass(frozen=True)
class ProcessTree:
    """A block: ``leaf``, ``silent``, ``sequence``, ``exclusive``, ``parallel`` or ``loop`` (body, redo)."""

    kind: str
    label: str | None = None
    children: tuple[ProcessTree, ...] = ()

    def __str__(self) -> str:
        if self.kind == "leaf":
            return f"'{self.label}'"
        if self.kind == "silent":
            return "tau"
        return f"{self.kind}({', '.join(map(str, self.children))})"

    def labels(self) -> list[str]:
        own = [self.label] if self.kind == "leaf" else []
        return own + [x for c in self.children for x in c.labels()]


SILENT = ProcessTree("silent")


def allowed_pairs(tree: ProcessTree) -> set[tuple[str, str]]:
    """The pairs of activities that directly follow each other in some trace of the model."""
    return _footprint(tree)[3]


def _footprint(tree: ProcessTree) -> tuple[bool, set, set, set]:
    """(can be empty, first activities, last activities, pairs)."""
    if tree.kind == "leaf":
        return False, {tree.label}, {tree.label}, set()
    if tree.kind == "silent":
        return True, set(), set(), set()
    parts = [_footprint(c) for c in tree.children]
    pairs = set().union(*[p[3] for p in parts])
    if tree.kind == "exclusive":
        return any(p[0] for p in parts), set().union(*[p[1] for p in parts]), set().union(*[p[2] for p in parts]), pairs
    if tree.kind == "parallel":
        labels = [c.labels() for c in tree.children]
        for i, mine in enumerate(labels):
            for theirs in labels[:i]:
                pairs |= {(a, b) for a in mine for b in theirs} | {(b, a) for a in mine for b in theirs}
        return all(p[0] for p in parts), set().union(*[p[1] for p in parts]), set().union(*[p[2] for p in parts]), pairs
    if tree.kind == "loop":
        (empty, first, last, _), redo = parts
        pairs |= {(a, b) for a in last for b in redo[1]} | {(a, b) for a in redo[2] for b in first}
        pairs |= {(a, b) for a in last for b in first} if redo[0] else set()
        pairs |= {(a, b) for a in redo[2] for b in redo[1]} if empty else set()
        return empty, first | (redo[1] if empty else set()), last | (redo[2] if empty else set()), pairs
    empty, first, last = True, set(), set()
    for e, f, end, _ in parts:  # sequence
        pairs |= {(a, b) for a in last for b in f}
        first |= f if empty else set()
        last = end | (last if e else set())
        empty = empty and e
    return empty, first, last, pairs


def leaf(label: str) -> ProcessTree:
    return ProcessTree("leaf", label)


def block(kind: str, children: Iterable[ProcessTree]) -> ProcessTree:
    """One block of the children; blocks of the same kind inside are taken apart (never used for loops)."""
    flat = [g for c in children for g in (c.children if c.kind == kind else (c,))]
    return flat[0] if len(flat) == 1 else ProcessTree(kind, None, tuple(flat))


@dataclass
class _Block:
    """An open block: where its traces come from, and what became of it."""

    traces: int | None  # how many traces reach the block, empty ones included; None: all are non-empty
    redo: tuple[int, ...] = ()  # for a loop body: blocks whose runs each call for one more body run
    optional: bool = False
    done: ProcessTree | None = None
    kind: str | None = None
    children: tuple[int, ...] = ()


def _graphs(state: DataFrame, load: CaseLoad) -> dict[int, Graph]:
    """Directly-follows counts of all open blocks; at most (alphabet + 1)² rows come to the driver."""
    steps = neighbours(state, TRACE, ["pos"], ["act"], load)
    into = F.struct(F.coalesce("_prev_act", F.lit(_START)).alias("a"), F.col("act").alias("b"))
    out = F.when(F.col("_next_act").isNull(), F.struct(F.col("act").alias("a"), F.lit(_END).alias("b")))
    pairs = steps.select("node", "n", F.explode(F.array(into, out)).alias("p")).where(F.col("p").isNotNull())
    graphs: dict[int, Graph] = {}
    for r in pairs.groupBy("node", "p.a", "p.b").agg(F.sum("n").alias("n")).collect():
        g = graphs.setdefault(r["node"], Graph())
        if r["a"] == _START:
            g.starts[r["b"]] = r["n"]
        elif r["b"] == _END:
            g.ends[r["a"]] = r["n"]
        else:
            g.edges[r["a"], r["b"]] = r["n"]
    return graphs


def discover_model(
    log: DataFrame,
    noise: float = 0.2,
    load: CaseLoad | None = None,
    max_activities: int | None = None,
    steps: DataFrame | None = None,
) -> ProcessTree:
    """A block-structured model of the log; behaviour rarer than ``noise`` does not stop a cut.

    Runs a few small Spark jobs per level of the model, at call time. A block without a cut is divided by a fall-through: an
    activity that every trace has once or without which there is a cut runs beside the rest, rounds that begin anew are a loop;
    only where none applies is it a flower. The counts of the pairs of activities that follow each other come to the driver;
    with ``max_activities`` a log of more activities raises instead, by exact count. ``steps`` is the result of
    ``variant_steps`` where the caller already has it.
    """
    events = usable(log)
    load = load or measure_cases(events)
    if max_activities is not None:
        alphabet(events, max_activities)
    steps = variant_steps(log, load) if steps is None else steps
    state = steps.select(
        F.lit(0).alias("node"),
        F.col("first_case").alias("trace"),
        F.lit(0).cast("long").alias("seg"),
        F.col("position").cast("long").alias("pos"),
        F.col(ACTIVITY).alias("act"),
        "n",
    )
    state = cut_lineage(state)
    blocks = {0: _Block(None)}
    open_blocks = [0]
    while open_blocks:
        graphs = _graphs(state, load)
        splits, stuck = [], []
        for b in open_blocks:
            decided = _decide(b, blocks, graphs, noise)
            splits += decided or []
            stuck += [b] if decided is None else []
        if stuck:
            splits += _fall_through(stuck, blocks, graphs, state, noise, load)
        open_blocks = [c for s in splits for c in s.children]
        if splits:
            state = cut_lineage(_split(state, splits, load))
    return _tree(0, blocks)


@dataclass
class _Split:
    node: int
    kind: str
    parts: list[frozenset]
    filtered: bool
    children: tuple[int, ...]
    ends: frozenset = frozenset()  # of the rounds of a block that is cut into rounds
    starts: frozenset = frozenset()


def _decide(b: int, blocks: dict[int, _Block], graphs: dict[int, Graph], noise: float) -> list[_Split] | None:
    """Close the block, or open its children; None where nothing cuts it."""
    block_, g = blocks[b], graphs.get(b, Graph())
    if not g.activities:
        block_.done = SILENT
        return []
    reached = block_.traces
    if reached is not None:
        reached += sum(graphs[r].traces for r in block_.redo if r in graphs)
        empty = reached - g.traces
        block_.optional = empty > 0 and empty >= noise * reached
    if len(g.activities) == 1:
        (only,) = g.activities
        once = g.occurrences(only) == g.traces
        block_.done = leaf(only) if once else ProcessTree("loop", None, (leaf(only), SILENT))
        return []
    cut = find_cut(g, noise)
    return None if cut is None else [_divide(b, blocks, g, *cut)]


def _divide(b: int, blocks: dict[int, _Block], g: Graph, kind: str, parts: list[frozenset], filtered: bool) -> _Split:
    first = max(blocks) + 1
    children = tuple(range(first, first + len(parts)))
    for i, c in enumerate(children):
        if kind in ("sequence", "parallel") or (kind == "loop" and i == 0):
            blocks[c] = _Block(g.traces, children[1:] if kind == "loop" else ())
        else:
            blocks[c] = _Block(None)
    blocks[b].kind, blocks[b].children = kind, children
    return _Split(b, kind, parts, filtered, children)


def _fall_through(
    stuck: list[int], blocks: dict[int, _Block], graphs: dict[int, Graph], state: DataFrame, noise: float, load: CaseLoad
) -> list[_Split]:
    """Divide the blocks that have no cut, or close them as flowers."""
    alone = once_per_trace(state, graphs, stuck)
    rest = [b for b in stuck if b not in alone]
    if rest:
        alone |= beside_the_rest(state, graphs, rest, noise, load)
    splits = []
    for b in stuck:
        g = graphs[b]
        if b in alone:
            others = frozenset(g.activities) - {alone[b]}
            splits.append(_divide(b, blocks, g, "parallel", [frozenset([alone[b]]), others], False))
        elif (borders := rounds(g)) is not None:
            split = _divide(b, blocks, g, "rounds", [frozenset(g.activities)], False)
            split.ends, split.starts = borders
            splits.append(split)
        else:
            flower = block("exclusive", [leaf(a) for a in g.activities])
            blocks[b].done = ProcessTree("loop", None, (SILENT, flower))
    return splits


def _tree(b: int, blocks: dict[int, _Block]) -> ProcessTree:
    me = blocks[b]
    if me.done is not None:
        tree = me.done
    elif me.kind == "loop":
        body, *redo = [_tree(c, blocks) for c in me.children]
        tree = ProcessTree("loop", None, (body, block("exclusive", redo)))
    elif me.kind == "rounds":
        (body,) = [_tree(c, blocks) for c in me.children]
        again = body.kind == "loop" and body.children[1] is SILENT
        tree = body if again else ProcessTree("loop", None, (body, SILENT))
    else:
        tree = block(me.kind, [_tree(c, blocks) for c in me.children])
    return ProcessTree("exclusive", None, (SILENT, tree)) if me.optional and tree is not SILENT else tree


def _split(state: DataFrame, splits: list[_Split], load: CaseLoad) -> DataFrame:
    """Give every step its child block; steps of closed blocks fall away."""
    rows = [
        (s.node, a, i, s.children[i], a in s.ends, a in s.starts)
        for s in splits for i, part in enumerate(s.parts) for a in sorted(part)
    ]
    # One row per activity and open block.
    where = state.sparkSession.createDataFrame(rows, "node int, act string, part int, child int, ends boolean, starts boolean")
    placed = state.join(F.broadcast(where), ["node", "act"])
    ways = {
        "map": [s.node for s in splits if s.kind == "parallel" or (s.kind not in ("loop", "rounds") and not s.filtered)],
        "exclusive": [s.node for s in splits if s.kind == "exclusive" and s.filtered],
        "sequence": [s.node for s in splits if s.kind == "sequence" and s.filtered],
        "loop": [s.node for s in splits if s.kind == "loop"],
        "rounds": [s.node for s in splits if s.kind == "rounds"],
    }
    out = None
    for way, nodes in ways.items():
        if not nodes:
            continue
        steps = placed.where(F.col("node").isin(nodes))
        if way == "exclusive":
            steps = _keep_main_part(steps)
        elif way == "sequence":
            steps = _keep_in_order(steps, max(len(s.parts) for s in splits if s.node in nodes), load)
        elif way == "loop":
            steps = _cut_runs(steps, load)
        elif way == "rounds":
            steps = cut_rounds(steps, load)
        steps = steps.select(F.col("child").alias("node"), "trace", "seg", "pos", "act", "n")
        out = steps if out is None else out.unionByName(steps)
    return out


def _keep_main_part(steps: DataFrame) -> DataFrame:
    """Of a trace that mixes alternatives, the one with most steps (the first one on a tie)."""
    counts = steps.groupBy(*TRACE, "part").agg(F.count(F.lit(1)).alias("c"))
    main = counts.groupBy(*TRACE).agg(F.max_by("part", F.struct("c", -F.col("part"))).alias("main"))
    return balanced_join(steps, main, [(c, c) for c in TRACE], "inner").where(F.col("part") == F.col("main"))


def _keep_in_order(steps: DataFrame, parts: int, load: CaseLoad) -> DataFrame:
    """Cut a trace between the ordered parts where the fewest steps are on the wrong side of each cut.

    Cut i goes after the position with the smallest running sum of +1 (part i or later) and -1 (earlier
    part); these positions grow with i. Steps outside the range of their part are dropped.
    """
    cuts = range(1, parts)
    signs = {f"s{i}": F.when(F.col("part") >= i, 1).otherwise(-1) for i in cuts}
    summed = running(steps, TRACE, ["pos"], signs, load)
    best = summed.groupBy(*TRACE).agg(*[F.min(F.struct(f"s{i}", "pos")).alias(f"m{i}") for i in cuts])
    after = [F.when(F.col(f"m{i}")[f"s{i}"] < 0, F.col(f"m{i}")["pos"]).otherwise(F.lit(0)) for i in cuts]
    bounds = best.select(*TRACE, F.array(F.lit(0).cast("long"), *after, F.lit(2**62)).alias("cut"))
    joined = balanced_join(steps, bounds, [(c, c) for c in TRACE], "inner")
    low, high = F.get("cut", F.col("part")), F.get("cut", F.col("part") + 1)
    return joined.where((F.col("pos") > low) & (F.col("pos") <= high))


def _cut_runs(steps: DataFrame, load: CaseLoad) -> DataFrame:
    """Every run of steps in the same loop part becomes a trace of that part, named by its first position."""
    seen = neighbours(steps, TRACE, ["pos"], ["part"], load)
    changed = F.when(~F.col("part").eqNullSafe(F.col("_prev_part")), F.col("pos"))
    seen = seen.select(*steps.columns, changed.alias("_from"))
    return running(seen, TRACE, ["pos"], {"_run": F.col("_from")}, load, "max").withColumn("seg", F.col("_run"))
