import random

import pytest
from pyspark.sql import functions as F

from casemill.functions.cuts import Graph, find_cut
from casemill.functions.net import Replayer, net_of
from casemill.operators.dfg import dfg_layers, dfg_layout, performance_dfg
from casemill.operators.model import SILENT, ProcessTree, allowed_pairs, block, discover_model, leaf
from casemill.operators.ordering import measure_cases
from casemill.operators.replay import fitness, replay, replay_variants, with_fitness
from casemill.operators.variants import variant_steps
from casemill.plans.report import report
from casemill.sources.config import EventLogConfig

from tests.fixtures import make_log, skewed_log


def tree(kind, *children):
    return ProcessTree(kind, None, tuple(leaf(c) if isinstance(c, str) else c for c in children))


EXAMPLE = tree("sequence", "a", tree("parallel", "b", tree("exclusive", "c", SILENT)), tree("loop", "d", "e"), "f")


def random_tree(rng, names, depth=3):
    if depth == 0 or rng.random() < 0.25 or len(names) == 1:
        return leaf(names.pop())
    kind = rng.choice(["sequence", "exclusive", "parallel", "loop"])
    children = []
    for _ in range(2):
        if not names:
            break
        children.append(random_tree(rng, names, depth - 1))
    if kind == "loop" and len(children) < 2:
        children.append(SILENT)
    if kind == "exclusive" and rng.random() < 0.4:
        children.append(SILENT)
    return ProcessTree(kind, None, tuple(children)) if len(children) > 1 else children[0]


def walk(t, rng):
    """A random trace of a tree."""
    if t.kind == "leaf":
        return [t.label]
    if t.kind == "silent":
        return []
    if t.kind == "sequence":
        return [x for c in t.children for x in walk(c, rng)]
    if t.kind == "exclusive":
        return walk(rng.choice(t.children), rng)
    if t.kind == "parallel":
        parts = [walk(c, rng) for c in t.children]
        out = []
        while any(parts):
            part = rng.choice([p for p in parts if p])
            out.append(part.pop(0))
        return out
    body, redo = t.children
    out = walk(body, rng)
    while rng.random() < 0.4:
        out += walk(redo, rng) + walk(body, rng)
    return out


def accepts(t, trace):
    """Slow membership test by splitting the trace in all ways."""
    trace = tuple(trace)
    if t.kind == "leaf":
        return trace == (t.label,)
    if t.kind == "silent":
        return not trace
    if t.kind == "exclusive":
        return any(accepts(c, trace) for c in t.children)
    if t.kind == "parallel":
        owner = [set(c.labels()) for c in t.children]
        known = set().union(*owner)
        return all(x in known for x in trace) and all(
            accepts(c, [x for x in trace if x in own]) for c, own in zip(t.children, owner)
        )
    if t.kind == "sequence":
        first, rest = t.children[0], t.children[1:]
        if not rest:
            return accepts(first, trace)
        tail = ProcessTree("sequence", None, rest)
        return any(accepts(first, trace[:i]) and accepts(tail, trace[i:]) for i in range(len(trace) + 1))
    body, redo = t.children
    if accepts(body, trace):
        return True
    for i in range(len(trace)):
        if accepts(body, trace[:i]):
            for j in range(i, len(trace) + 1):
                if j > 0 and accepts(redo, trace[i:j]) and (i, j) != (0, 0) and accepts(t, trace[j:]):
                    return True
    return False


def test_replay_agrees_with_the_language_of_the_tree():
    rng = random.Random(11)
    for _ in range(60):
        t = random_tree(rng, list("gfedcba"))
        player = Replayer(net_of(t))
        for _ in range(12):
            trace = walk(t, rng)[:9]
            if rng.random() < 0.6 and trace:
                i = rng.randrange(len(trace))
                trace = rng.choice([trace[:i] + trace[i + 1 :], trace + ["zz"], trace[::-1], trace[:i] + ["a"] + trace[i:]])
            marking, counts = player.run(Replayer.START, trace)
            p, c, m, r = (x + y for x, y in zip(counts, player.finish(marking)))
            assert (m == 0 and r == 0) == accepts(t, trace), (str(t), trace)
            assert p + m == c + r and p > 0 and c > 0


def test_traces_of_a_known_tree_fit(spark):
    rng = random.Random(2)
    traces = [walk(EXAMPLE, rng) for _ in range(60)]
    log = make_log(spark, traces)
    out = fitness(log, EXAMPLE).first()
    assert out["average_trace_fitness"] == 1.0 and out["pct_fitting"] == 100.0 and out["status"] == "good"
    worse = make_log(spark, [t + ["x"] for t in traces])
    assert fitness(worse, EXAMPLE).first()["average_trace_fitness"] < 1.0
    assert fitness(worse, EXAMPLE).first()["pct_fitting"] == 0.0


@pytest.mark.parametrize("seed", range(6))
def test_model_without_noise_fits_its_log(spark, seed):
    rng = random.Random(seed)
    t = random_tree(rng, list("hgfedcba"))
    traces = [w for w in (walk(t, rng) for _ in range(40)) if w] or [["a"]]
    log = make_log(spark, traces)
    model = discover_model(log, 0.0)
    assert set(model.labels()) == {x for w in traces for x in w}
    assert all(accepts(model, w) for w in traces if len(w) < 10), (str(t), str(model))
    assert fitness(log, model).first()["average_trace_fitness"] == 1.0


def test_random_logs_fit_without_noise(spark):
    rng = random.Random(8)
    log = make_log(spark, [[rng.choice("abcde") for _ in range(rng.randrange(1, 7))] for _ in range(40)])
    assert fitness(log, noise=0.0).first()["pct_fitting"] == 100.0


def test_noise_is_left_out_of_the_model(spark):
    log = make_log(spark, [list("abcd")] * 30 + [list("acbd")] * 30 + [list("dabc")] + [list("abdc")] * 2)
    assert str(discover_model(log, 0.2)) == "sequence('a', parallel('b', 'c'), 'd')"
    out = fitness(log, noise=0.2).first()
    assert 0.9 < out["average_trace_fitness"] < 1.0 and out["pct_fitting"] == pytest.approx(6000 / 63)
    loop = make_log(spark, [list("ab")] * 20 + [list("abcab")] * 10 + [list("cab")])
    assert str(discover_model(loop, 0.2)) == "loop(sequence('a', 'b'), 'c')"
    choice = make_log(spark, [list("ab")] * 20 + [list("cd")] * 20 + [list("ad")])
    assert str(discover_model(choice, 0.2)) == "exclusive(sequence('a', 'b'), sequence('c', 'd'))"


def test_flower_when_nothing_cuts():
    g = Graph({("a", "b"): 5, ("b", "a"): 5, ("a", "a"): 5, ("b", "c"): 5, ("c", "a"): 5, ("c", "b"): 5, ("a", "c"): 5}, {"a": 5}, {"b": 5})
    cut = find_cut(g, 0.0)
    assert cut is None or cut[0] in ("parallel", "loop")


def test_too_many_activities_raise(spark):
    log = make_log(spark, [[f"a{i}" for i in range(12)]])
    with pytest.raises(ValueError, match="more than 10"):
        discover_model(log, max_activities=10)


def test_hot_cases_give_the_same_model_and_replay(spark):
    log = skewed_log(spark, 600)
    hot = measure_cases(log, max_task_events=60)
    assert hot.hot is not None
    for noise in (0.0, 0.2):
        assert discover_model(log, noise) == discover_model(log, noise, hot)
    model = tree("loop", tree("exclusive", "a", tree("sequence", "b", "c")), tree("exclusive", SILENT, "d"))
    want = sorted(map(tuple, replay(log, model).collect()))
    assert sorted(map(tuple, replay(log, model, hot).collect())) == want
    steps = variant_steps(log).cache()
    whole = sorted(map(tuple, replay_variants(steps, model, 600).collect()))
    for chunk, ahead, fan_in in ((7, 64, 256), (20, 1, 3)):
        assert sorted(map(tuple, replay_variants(steps, model, 600, chunk, ahead, fan_in).collect())) == whole


def test_fitness_formula(spark):
    df = spark.createDataFrame([(4, 4, 1, 1), (3, 3, 0, 0)], "produced long, consumed long, missing long, remaining long")
    assert [(r["fitness"], r["fits"]) for r in with_fitness(df).collect()] == [(0.75, False), (1.0, True)]


def test_block_flattens():
    assert str(block("sequence", [leaf("a"), block("sequence", [leaf("b"), leaf("c")])])) == "sequence('a', 'b', 'c')"


def test_long_gaps_do_not_overflow(spark):
    """Forty gaps of 9,000 years are more microseconds than a long holds."""
    rows = [(f"c{i}", a, t) for i in range(40) for a, t in (("a", "0900-01-01"), ("b", "9900-01-01"))]
    log = spark.createDataFrame(rows, "case_id string, activity string, t string").select(
        "case_id", "activity", F.col("t").cast("timestamp_ntz").alias("event_timestamp")
    )
    edge = performance_dfg(log).first()
    assert edge["sum_seconds"] == pytest.approx(40 * edge["mean_seconds"]) and edge["sum_seconds"] * 1e6 > 2**63


def test_layout_and_report_of_many_activities(spark):
    names = [f"a{i:04}" for i in range(2_200)]
    log = make_log(spark, [names])
    assert dfg_layers(log, use_rank=False).where("activity = 'a2199'").first()["layer"] == 2_199
    assert dfg_layout(log, use_rank=False).count() == 2_200
    cfg = EventLogConfig("many", "many", ())
    listed = report(spark, cfg, log.withColumn("event_id", F.lit("x"))).where("item = 'activities'").first()["value"]
    assert listed == ", ".join(names)


def test_loop_with_silent_ways_fits(spark):
    """The shortest silent way is the wrong one here; the trace is in the language."""
    tree = ProcessTree("loop", None, (
        ProcessTree("parallel", None, (ProcessTree("loop", None, (leaf("A"), SILENT)), leaf("B"))), SILENT))
    log = make_log(spark, [list("ABAB"), list("AAB"), list("ABB"), list("BAXB")])
    assert sorted((r["case_id"], r["fits"]) for r in replay(log, tree).collect()) == [
        (c, f) for c, f in zip(sorted(r[0] for r in log.select("case_id").distinct().collect()), (True, True, False, False))
    ]


def drawn_tree(rng, labels, depth):
    if len(labels) == 1 or depth == 0:
        return block("sequence", [leaf(x) for x in labels]) if len(labels) > 1 else leaf(labels[0])
    kind = rng.choice(["sequence", "exclusive", "parallel", "loop", "optional"])
    if kind == "optional":
        return ProcessTree("exclusive", None, (SILENT, drawn_tree(rng, labels, depth - 1)))
    at = rng.randrange(1, len(labels))
    left, right = drawn_tree(rng, labels[:at], depth - 1), drawn_tree(rng, labels[at:], depth - 1)
    if kind == "loop" and rng.random() < 0.5:
        return ProcessTree("loop", None, (block("sequence", [left, right]), SILENT))
    return ProcessTree(kind, None, (left, right))


def test_random_traces_of_random_trees_fit():
    rng = random.Random(11)
    for _ in range(1_000):
        tree = drawn_tree(rng, list("ABCDEF")[: rng.randrange(2, 7)], 4)
        player = Replayer(net_of(tree))
        pairs = allowed_pairs(tree)
        for _ in range(10):
            trace = walk(tree, rng)
            assert player.judge(trace)[2:] == (0, 0), (str(tree), trace)
            assert set(zip(trace, trace[1:])) <= pairs
        assert any(player.judge([*trace, "Z"])[2:])


def long_logs(rng, tree, names):
    """Long traces in the language, and such with a step more, less or exchanged."""
    traces = []
    for _ in range(6):
        trace = []
        while len(trace) < 60:  # rounds of the loop
            trace = trace + walk(tree.children[0], rng)
        traces.append(trace)
        at = rng.randrange(len(trace))
        traces += [trace[:at] + trace[at + 1 :], trace[:at] + [rng.choice(names)] + trace[at:], trace[: len(trace) // 2]]
    return traces


@pytest.mark.parametrize("seed", range(2))
def test_chunks_judge_like_whole_traces(spark, seed):
    """Chunks of five steps, whatever silent ways there are: the same counts, and ``fits`` if and only if the model allows the trace."""
    rng = random.Random(seed)
    names = list("ABCDE")
    tree = ProcessTree("loop", None, (drawn_tree(rng, names, 4), SILENT))
    traces = long_logs(rng, tree, names)
    steps = variant_steps(make_log(spark, traces)).cache()
    longest = max(map(len, traces))
    whole = sorted(map(tuple, replay_variants(steps, tree, longest).collect()))
    assert sorted(map(tuple, replay_variants(steps, tree, longest, 5, ahead=1, fan_in=4).collect())) == whole
    player = Replayer(net_of(tree))
    assert {r[0] for r in whole if r[-2:] == (0, 0)} == {
        r["first_case"] for r in steps.groupBy("first_case").agg(
            F.sort_array(F.collect_list(F.struct("position", "activity"))).alias("t")).collect()
        if player.accepts([x["activity"] for x in r["t"]])
    }


def test_long_trace_with_more_states_than_chunks(spark):
    """Every border between chunks has a marking of its own, so nothing can be guessed."""
    names = [f"a{i}" for i in range(40)]
    tree = ProcessTree("parallel", None, tuple(leaf(x) for x in names))
    traces = [names, names[::-1], [*names, "a3"], names[:-1]]
    steps = variant_steps(make_log(spark, traces)).cache()
    whole = sorted(map(tuple, replay_variants(steps, tree, 41).collect()))
    assert [r[-2:] for r in whole].count((0, 0)) == 2
    assert sorted(map(tuple, replay_variants(steps, tree, 41, 2, ahead=1, fan_in=4).collect())) == whole


def graph_of(traces):
    g = Graph()
    for t in traces:
        if t:
            g.starts[t[0]] = g.starts.get(t[0], 0) + 1
            g.ends[t[-1]] = g.ends.get(t[-1], 0) + 1
        for pair in zip(t, t[1:]):
            g.edges[pair] = g.edges.get(pair, 0) + 1
    return g


def test_graph_without_an_activity_is_that_of_the_projected_traces():
    rng = random.Random(4)
    for _ in range(300):
        traces = [[rng.choice("abc") for _ in range(rng.randrange(1, 8))] for _ in range(6)]
        gaps = {}
        for t in traces:
            runs = [x for i, x in enumerate(t) if i == 0 or t[i - 1] != x]
            for i, x in enumerate(runs):
                if x == "a":
                    pair = (runs[i - 1] if i else None, runs[i + 1] if i + 1 < len(runs) else None)
                    gaps[pair] = gaps.get(pair, 0) + 1
        assert graph_of(traces).without("a", gaps) == graph_of([[x for x in t if x != "a"] for t in traces])


def is_flower(t):
    return t.kind == "loop" and t.children[0] is SILENT or any(map(is_flower, t.children))


@pytest.mark.parametrize("traces, want", [
    (["ab", "abab", "ababab"], "loop(sequence('a', 'b'), tau)"),  # rounds behind an end
    (["xab", "abxab", "ababx", "axb"], "parallel('x', loop(sequence('a', 'b'), tau))"),  # x once per trace
    # nothing is there once; without a, b and c run in order beside x
    (["xabc", "abbc", "acxc", "bcx", "abxbcc"],
     "parallel(exclusive(tau, 'a'), sequence(exclusive(tau, loop('b', tau)), loop('c', tau)), exclusive(tau, 'x'))"),
])
def test_fall_throughs(spark, traces, want):
    model = discover_model(make_log(spark, [list(t) for t in traces]), 0.0)
    assert str(model) == want


def test_logs_without_a_cut_get_no_flower(spark):
    """Logs of drawn trees whose first graph has no cut: the model has no flower and allows the log and its pairs."""
    rng = random.Random(21)
    tried = 0
    while tried < 4:
        tree = drawn_tree(rng, list("ABCDEF")[: rng.randrange(3, 7)], 4)
        traces = [w for w in (walk(tree, rng) for _ in range(30)) if w]
        if not traces or len({x for t in traces for x in t}) < 3 or find_cut(graph_of(traces), 0.0):
            continue
        tried += 1
        model = discover_model(make_log(spark, traces), 0.0)
        player = Replayer(net_of(model))
        assert not is_flower(model) and all(player.judge(t)[2:] == (0, 0) for t in traces), (str(tree), str(model))
        assert {p for t in traces for p in zip(t, t[1:])} <= allowed_pairs(model)


def test_cuts_of_thousands_of_activities():
    names = [f"a{i:05}" for i in range(4_000)]
    kind, parts, _ = find_cut(graph_of([names]), 0.2)
    assert kind == "sequence" and [min(p) for p in parts] == names
