import random
import statistics

import pytest
from pyspark.sql import functions as F

from casemill.operators import cases, dfg, variants
from casemill.operators.conformance import dfg_conformance
from casemill.operators.detectors import out_of_order
from casemill.operators.extract import cdc_events
from casemill.operators.joins import balanced_join, fits_broadcast, hot_keys
from casemill.operators.medians import exact_median
from casemill.operators.metrics import add_metrics, rework_flag
from casemill.operators.ordering import CaseLoad, _slices, dealt, measure_cases, neighbours, over_case, running

from tests.fixtures import day, make_log, skewed_log


def rows(df):
    return sorted(map(repr, (r.asDict() for r in df.collect())))


@pytest.fixture(scope="module")
def log(spark):
    return skewed_log(spark).cache()


@pytest.fixture(scope="module")
def hot(log):
    return measure_cases(log, max_task_events=100)


PLAIN = CaseLoad(900, activities=4)


def test_measure_finds_the_hot_case(log, hot):
    assert [r[0] for r in hot.hot.collect()] == ["hot"] and hot.events == 900 and not hot.small
    assert hot.hot_cases == 1 and hot.hot_events == log.where("case_id = 'hot'").count()
    assert measure_cases(log).hot is None
    assert measure_cases(log, at_most=10).events == 10


@pytest.mark.parametrize("key", [["case_id"], ["case_id", "activity"]])
def test_sliced_neighbours_equal_windows(log, hot, key):
    order = ["event_timestamp", "event_id"]
    a = neighbours(log, key, order, ["activity", "event_timestamp"], PLAIN)
    b = neighbours(log, key, order, ["activity", "event_timestamp"], hot).select(*a.columns)
    assert rows(a) == rows(b)


@pytest.mark.parametrize("kind", ["sum", "max"])
def test_sliced_running_equals_windows(log, hot, kind):
    value = F.when(F.col("activity") == "a", F.length("event_id") + F.col("event_id").substr(2, 9).cast("int") % 7)
    a, b = (
        running(log, ["case_id"], ["event_timestamp", "event_id"], {"v": value}, load, kind) for load in (PLAIN, hot)
    )
    assert rows(a) == rows(b.select(*a.columns))


def test_case_aggregates_equal(log, hot):
    values = {"n": F.count(F.lit(1)), "last": F.max("event_timestamp")}
    a, b = (over_case(log, values, load) for load in (PLAIN, hot))
    assert rows(a) == rows(b.select(*a.columns))


@pytest.mark.parametrize(
    "operator",
    [
        add_metrics,
        rework_flag,
        dfg.dfg,
        dfg.performance_dfg,
        dfg.bottlenecks,
        variants.variant_steps,
        variants.case_variants,
        variants.case_signatures,
        cases.kpis,
        cases.median_duration,
        dfg_conformance,
    ],
    ids=lambda f: f.__name__,
)
def test_operators_give_the_same_with_hot_cases(log, hot, operator):
    assert rows(operator(log, load=PLAIN)) == rows(operator(log, load=hot))


def test_other_operators_with_hot_cases(log, hot):
    ranked = add_metrics(log, load=PLAIN)
    assert rows(dfg.dfg_layers(ranked, PLAIN)) == rows(dfg.dfg_layers(ranked, hot))
    for mode in ("flag", "list", "filter"):
        a, b = (out_of_order(log, "b", "a", mode, load) for load in (PLAIN, hot))
        assert rows(a) == rows(b.select(*a.columns))
    a, b = (cdc_events(log, "case_id", "event_timestamp", "activity", tie=["event_id"], load=x) for x in (PLAIN, hot))
    assert rows(a) == rows(b)


def test_variant_of_a_hot_case_has_label_and_steps(log, hot):
    found = {r["first_case"]: r for r in variants.variants(log, None, hot).collect()}
    plain = {r["first_case"]: r for r in variants.variants(log, None, PLAIN).collect()}
    assert found.keys() == plain.keys()
    assert found["hot"]["variant"] == plain["hot"]["variant"] and found["hot"]["label"] == plain["hot"]["label"]
    short = {r["first_case"]: r for r in variants.variants(log, None, PLAIN, max_shown=2).collect()}
    for case, r in plain.items():
        assert short[case]["label"] == r["label"] and short[case]["length"] == r["length"]
        assert short[case]["variant"] == (r["variant"] if r["length"] <= 2 else None)
    assert all(found[c]["variant"] == plain[c]["variant"] for c in found if c != "hot")


def test_events_without_a_case_keep_null_metrics(spark):
    log = spark.createDataFrame(
        [("a", "x", day(0), "1"), (None, "x", day(0), "2"), (None, "y", day(1), "3")],
        "case_id string, activity string, event_timestamp timestamp_ntz, event_id string",
    )
    out = {r["event_id"]: r for r in add_metrics(log).collect()}
    assert out["1"]["event_rank"] == 1 and out["2"]["event_rank"] is None and out["3"]["case_event_count"] is None
    assert rework_flag(log).where("case_id IS NULL AND is_rework IS NOT NULL").count() == 0


def test_row_order_and_partitions_do_not_matter(spark):
    traces = [list("abcd"), list("acbd"), list("abd")]
    one = make_log(spark, traces, 5, 1)
    for partitions in (3, 7):
        other = one.repartition(partitions)
        for operator in (dfg.dfg, variants.variant_steps, add_metrics, dfg.start_end):
            assert rows(operator(one)) == rows(operator(other))
    freq = dfg.dfg(one).agg(F.sum("freq")).first()[0]
    assert freq == one.count() - one.select("case_id").distinct().count()
    assert variants.variants(one, None).agg(F.sum("n")).first()[0] == 15


@pytest.mark.parametrize("by", [[], ["g"]])
def test_exact_median_both_ways(spark, by):
    rng = random.Random(5)
    data = [(rng.choice("xyz"), rng.choice([5, 2**41 + rng.randrange(9), rng.randrange(2**50), None])) for _ in range(400)]
    data += [("x", 7)] * 301
    df = spark.createDataFrame(data, "g string, v long")
    want = {}
    for g in ("x", "y", "z") if by else (None,):
        values = [v for k, v in data if v is not None and g in (None, k)]
        want[g] = statistics.median(values)
    for single in (True, False):
        got = {r["g"] if by else None: r["m"] for r in exact_median(df, by, "v", "m", single).collect()}
        assert got == pytest.approx(want)


@pytest.mark.parametrize("how", ["left", "inner", "left_anti", "left_semi"])
@pytest.mark.parametrize("keys", [1, 2])
def test_salted_join_equals_plain_join(spark, how, keys):
    rng = random.Random(9)
    left = [(None if rng.random() < 0.2 else "k0" if rng.random() < 0.5 else f"k{rng.randrange(30)}", rng.randrange(2), i) for i in range(500)]
    left = spark.createDataFrame(left, "k string, j int, i int")
    right = spark.createDataFrame([(f"k{n}", m, n * 10 + m) for n in range(20) for m in (0, 1)][::1], "k string, j int, v int")
    right = right.where("j = 0") if keys == 1 else right
    names = ["k", "j"][:keys]
    small = balanced_join(left, right.select(*names, "v"), [(n, n) for n in names], how)
    salted = balanced_join(left, right.select(*names, "v"), [(n, n) for n in names], how, max_rows=1, max_task_rows=50)
    plain = left.join(right.select(*names, "v"), names, how).select(*small.columns)
    assert rows(small) == rows(plain) == rows(salted.select(*small.columns))
    assert all(r["_parts"] > 1 for r in hot_keys(left, names, 50).collect())
    assert hot_keys(left, names, 500) is None


def test_broadcast_check_counts_rows_and_bytes(spark):
    wide = spark.createDataFrame([("x" * 1000,)] * 50, "t string")
    assert fits_broadcast(wide) and not fits_broadcast(wide, max_rows=10) and not fits_broadcast(wide, max_bytes=1000)


def test_broadcast_check_counts_arrays_and_maps(spark):
    wide = spark.range(1000).select(F.array_repeat(F.col("id").cast("double") + 0.25, 100).alias("a"))
    assert fits_broadcast(wide) and not fits_broadcast(wide, max_bytes=200_000)
    maps = spark.range(1000).select(F.create_map(F.col("id"), F.array_repeat(F.lit("x"), 100)).alias("m"))
    assert not fits_broadcast(maps, max_bytes=100_000)


def test_equal_rows_of_a_hot_key_part(spark):
    left = spark.createDataFrame([(True, "k")] * 1000 + [(False, "k")], "f boolean, k string")
    right = spark.createDataFrame([(True, "k", 1), (False, "k", 2)], "f boolean, k string, v int")
    out = balanced_join(left, right, [("f", "f"), ("k", "k")], max_rows=1, max_task_rows=50)
    assert sorted((r["f"], r["v"]) for r in out.groupBy("f", "v").count().collect()) == [(False, 2), (True, 1)]
    assert out.count() == 1001
    assert [r["_parts"] for r in hot_keys(left, ["f", "k"], 50).collect()] == [20]


def test_columns_that_cannot_be_hashed(log, hot):
    """Hot cases are sliced also when the log has a map column."""
    mapped = log.withColumn("m", F.create_map(F.lit("a"), F.col("event_id")))
    order = ["event_timestamp", "event_id"]
    a = neighbours(mapped, ["case_id"], order, ["activity"], PLAIN)
    b = neighbours(mapped, ["case_id"], order, ["activity"], hot).select(*a.columns)
    assert rows(a) == rows(b)


def test_case_ends_by_number(spark):
    """The same ends as by comparing columns, ties and years before 1970 included, without a sort in the plan."""
    import datetime
    import random

    from casemill.operators.dfg import case_ends, start_end

    rng = random.Random(6)
    times = [datetime.datetime(1, 1, 2), datetime.datetime(1960, 5, 1, 1, 1, 1, 5), datetime.datetime(2024, 1, 1), datetime.datetime(9999, 12, 31)]
    rows = [(f"c{rng.randrange(40)}", rng.choice(["a", "b", "ab", "c"]), rng.choice(times), rng.choice([None, -5, 0, 3, 2**31 - 1])) for _ in range(400)]
    rows += [(None, "a", times[0], 0), ("c1", None, times[0], 0), ("c1", "z", None, 0)]
    log = spark.createDataFrame(rows, "case_id string, activity string, event_timestamp timestamp_ntz, source_seq int")
    first = lambda r: (r[2], r[3] is not None, r[3] or 0, r[1])
    cases = {}
    for r in rows:
        if None not in r[:3]:
            cases.setdefault(r[0], []).append(r)
    want = {c: (min(v, key=first)[1], max(v, key=first)[1]) for c, v in cases.items()}
    assert {r["case_id"]: (r["start"], r["end"]) for r in case_ends(log).collect()} == want
    plan = start_end(log)._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "HashAggregate" in plan


def test_slices_are_small_and_partitions_few(log, hot):
    """Slices of half of what a task may hold, in an order of their own, without a partition for each."""
    events = log.where("case_id = 'hot'")
    sliced, order = _slices(events, ["case_id"], ["event_timestamp", "event_id"], hot)
    sizes = [r["count"] for r in sliced.groupBy("_slice").count().collect()]
    assert sum(sizes) == hot.hot_events and max(sizes) <= hot.max_task_events // 2
    assert len(sizes) > sliced.rdd.getNumPartitions() == 2
    numbers = [r["_slice"] for r in sliced.orderBy("case_id", *order).collect()]
    assert numbers == sorted(numbers)


@pytest.mark.parametrize("null_keys", [False, True])
def test_neighbours_do_not_depend_on_tasks(log, monkeypatch, null_keys):
    key, order, carry = ["case_id"], ["event_timestamp", "event_id"], ["activity"]
    some = log.withColumn("case_id", F.when(F.col("event_id") > "e1", F.col("case_id"))) if null_keys else log
    known = lambda df: rows(df.where("case_id is not null"))
    a = known(neighbours(some, key, order, carry, PLAIN, null_keys))
    monkeypatch.setattr(dealt, "__defaults__", (20,))
    b = neighbours(some, key, order, carry, PLAIN, null_keys)
    assert b.rdd.getNumPartitions() == 45 and b.columns == [*some.columns, "_rank", "_size", "_prev_activity", "_next_activity"]
    assert known(b) == a and b.count() == some.count()
    assert str(b._jdf.queryExecution().executedPlan()).split("Initial Plan")[-1].count("Exchange hashpartitioning") == 1
