import datetime as dt

import pytest
from pyspark.sql import functions as F

from casemill.functions.columns import event_id, normalise_key, variant_label
from casemill.operators import enrich as en
from casemill.operators.classify import classify_tables
from casemill.operators.extract import (
    cdc_events,
    cdc_pair_events,
    extract_event,
    extract_source,
    history_events,
    mapping_stats,
    resolve_case,
    snapshot_stages,
    standardise_activities,
    union_events,
    unknown_stages,
)
from casemill.operators.metrics import add_metrics
from casemill.operators.ordering import dealt, measure_cases
from casemill.plans.build import build_event_log, propose_enrichments, propose_events
from casemill.plans.report import report
from casemill.sources.config import (
    EventLogConfig,
    EventSpec,
    SourceSpec,
    check_config,
    is_readable_name,
    load_config,
    parse_config,
)
from casemill.sources.tables import describe_columns, discover_logs, list_tables, load_log, normalise_log, save_log

from tests.fixtures import day, p2p

CONFIG = """
event_log:
  name: procure_to_pay
  output_table: mining.p2p
  sources:
    - table: purchase_orders
      case_id: po_id
      key: [po_id]
      events:
        - {activity: Create PO, timestamp: created_at, resource: buyer, cost: po_value, attributes: {source_system: source_system}}
        - {activity: Approve Purchase Order, timestamp: approved_at, condition: approved_at IS NOT NULL, resource: approver}
    - table: goods_receipts
      case_id: po_id
      key: [gr_id]
      events:
        - {activity: Post Goods Receipt, timestamp: posting_date, resource: receiver, attributes: {warehouse: warehouse}}
  standardization:
    activity_overrides: {Create PO: Create Purchase Order}
  enrichment:
    - {table: supplier_master, join_key: supplier_id, columns: [credit_risk_rating, country], prefix: supplier_}
"""


@pytest.fixture(scope="module")
def tables(spark):
    return p2p(spark)


@pytest.fixture(scope="module")
def cfg():
    return parse_config(CONFIG)


def test_build_from_config(spark, tables, cfg):
    log = build_event_log(spark, cfg, tables)
    po1 = log.where("case_id = 'PO-1'").orderBy("event_rank").collect()
    assert [r["activity"] for r in po1] == [
        "Create Purchase Order", "Approve Purchase Order", "Post Goods Receipt", "Post Goods Receipt",
    ]
    assert po1[0]["source_system"] == "SAP" and po1[1]["source_system"] == "purchase_orders"
    assert po1[0]["supplier_country"] == "DE" and po1[0]["cost"] == 100.0
    assert po1[2]["warehouse"] == "West" and po1[0]["warehouse"] is None
    assert po1[1]["time_since_prev_seconds"] == 86400 and po1[0]["case_event_count"] == 4
    assert log.count() == 5 + 3 + 4
    assert log.where("activity = 'Create PO'").count() == 0
    names = [f.name for f in log.schema.fields]
    assert names[:3] == ["case_id", "activity", "event_timestamp"] and len(set(names)) == len(names)


def test_config_build_equals_hand_build(spark, tables, cfg):
    orders, receipts = tables["purchase_orders"], tables["goods_receipts"]
    parts = [
        extract_event(orders, "po_id", EventSpec("Create Purchase Order", "created_at", seq=0), "purchase_orders", ["po_id"]),
        extract_event(orders, "po_id", EventSpec("Approve Purchase Order", "approved_at", seq=1), "purchase_orders", ["po_id"]),
        extract_event(receipts, "po_id", EventSpec("Post Goods Receipt", "posting_date", seq=2), "goods_receipts", ["gr_id"]),
    ]
    names = ["case_id", "activity", "event_timestamp", "event_id", "event_rank", "time_since_prev_seconds"]
    hand = add_metrics(union_events(parts)).select(*names)
    built = build_event_log(spark, cfg, tables).select(*names)
    assert hand.exceptAll(built).count() == 0 and built.exceptAll(hand).count() == 0


def test_rebuild_with_changes(spark, tables, cfg):
    assert build_event_log(spark, cfg.without_activity("Create PO"), tables).count() == 7
    by_supplier = build_event_log(spark, cfg.with_case_id({"purchase_orders": "supplier_id"}), tables)
    assert by_supplier.where("case_id = 'SUP-1'").count() == 4
    bare = build_event_log(spark, cfg.without_enrichment("supplier_master"), tables)
    assert "supplier_country" not in bare.columns


def test_proposals_and_report(spark, tables, cfg):
    events = {r["activity"]: r for r in propose_events(spark, cfg, tables, "2024-01-05").collect()}
    assert events["Approve Purchase Order"]["rows"] == 3 and events["Create PO"]["cases"] == 5
    assert events["Post Goods Receipt"]["rows_in_future"] == 3
    match = propose_enrichments(spark, cfg, tables).first()
    assert (match["rows"], match["matched"], match["pct"]) == (12, 5, 41.7)
    found = report(spark, cfg, build_event_log(spark, cfg, tables), classify_tables(tables)).collect()
    lines = {r["item"]: r["value"] for r in found}
    assert lines["events"] == "12" and lines["largest case"] == "4"
    assert lines["gate: null_timestamps"] == "passed" and "skipped: invoices" in lines
    assert lines["coverage: supplier_country"] == "41.7"


def test_config_rules(spark, tables, cfg, tmp_path):
    path = tmp_path / "log.yaml"
    path.write_text(CONFIG)
    assert load_config(str(path)) == cfg
    found = check_config(spark, cfg, tables)
    assert found.where("NOT passed").count() == 0
    assert {r["rule"] for r in found.collect()} == {1, 2, 3, 4, 5, 6}
    bad = parse_config(CONFIG.replace(", condition: approved_at IS NOT NULL", "").replace("case_id: po_id\n      key: [gr_id]", "case_id: nope"))
    failed = {(r["rule"], r["source"]) for r in check_config(spark, bad, tables).where("NOT passed").collect()}
    assert failed == {(1, "goods_receipts"), (3, "purchase_orders")}
    for missing in ("name: procure_to_pay", "output_table: mining.p2p"):
        with pytest.raises(ValueError, match="required"):
            parse_config(CONFIG.replace(missing, ""))
    assert is_readable_name("Create Purchase Order") and not is_readable_name("PO_CREATED")


def test_extraction_in_one_scan(spark, tables):
    source = SourceSpec(
        "invoices",
        "po_id",
        (EventSpec("Receive", "received_date", seq=0), EventSpec("Clear", "cleared_date", seq=1, cost="invoice_amount")),
        key=("invoice_id",),
    )
    both = extract_source(tables["invoices"], source)
    apart = union_events(
        [extract_source(tables["invoices"], SourceSpec("invoices", "po_id", (e,), key=("invoice_id",))) for e in source.events]
    )
    assert both.exceptAll(apart).count() == 0 and apart.exceptAll(both).count() == 0
    assert both.count() == 5
    plan = both.select("case_id", "activity")._jdf.queryExecution().toString()
    assert plan.count("ExistingRDD") <= 4 or "Union" not in plan
    keep = extract_source(tables["invoices"], source, keep_null_ts=True)
    assert keep.where("event_timestamp IS NULL").count() == 1
    stats = {r["activity"]: r for r in mapping_stats(tables["invoices"], source).collect()}
    assert stats["Clear"]["null_timestamps"] == 1


def test_text_and_date_times_and_zones(spark):
    df = spark.createDataFrame([(1, "2024-01-01 12:00:00", dt.date(2024, 1, 2)), (2, "bad", None)], "k int, t string, d date")
    log = extract_source(df, SourceSpec("s", "k", (EventSpec("T", "t", seq=0),), "America/New_York", ("k",)))
    assert [r["event_timestamp"] for r in log.collect()] == [dt.datetime(2024, 1, 1, 17)]
    log = extract_event(df, "k", EventSpec("D", "d"))
    assert [r["event_timestamp"] for r in log.collect()] == [dt.datetime(2024, 1, 2)]


def test_union_of_different_keys_becomes_text(spark):
    a = spark.createDataFrame([(1, "x")], "case_id long, activity string")
    b = spark.createDataFrame([("p", "y", 2.0)], "case_id string, activity string, cost double")
    out = union_events([a, b])
    assert sorted((r["case_id"], r["cost"]) for r in out.collect()) == [("1", None), ("p", 2.0)]


def test_snapshot_stages(spark):
    df = spark.createDataFrame(
        [
            ("a", day(0), day(3), "won"),
            ("b", day(0), None, "demo"),
            ("c", day(5), day(1), "won"),
            ("d", day(0), day(1), "lead"),
            ("e", day(0), day(1), "lost"),
        ],
        "k string, s timestamp_ntz, e timestamp_ntz, stage string",
    )
    stages = ["lead", "demo", "offer", "won"]
    out = snapshot_stages(df, "k", "s", "e", "stage", stages, as_of="2024-01-02 09:00:00").orderBy("case_id", "source_seq").collect()
    got = {}
    for r in out:
        got.setdefault(r["case_id"], []).append((r["activity"], r["event_timestamp"], r["is_approximate"], r["bad_interval"]))
    assert got["a"] == [(s, day(i), 0 < i < 3, False) for i, s in enumerate(stages)]
    assert got["b"] == [("lead", day(0), False, False), ("demo", day(1), False, False)]
    assert [x[1:] for x in got["c"]] == [(day(5), 0 < i < 3, True) for i in range(4)]
    assert got["d"] == [("lead", day(0), False, False)] and "e" not in got
    assert [tuple(r) for r in unknown_stages(df, "stage", stages).collect()] == [("lost", 1)]


def test_change_records(spark):
    rows = [("a", 1, "x"), ("a", 2, "x"), ("a", 3, None), ("a", 4, None), ("a", 5, "y"), ("b", 1, "x")]
    df = spark.createDataFrame([(k, day(n), v) for k, n, v in rows], "k string, t timestamp_ntz, v string")
    out = cdc_events(df, "k", "t", "v").orderBy("case_id", "event_timestamp").collect()
    assert [(r["case_id"], r["activity"], r["event_timestamp"]) for r in out] == [
        ("a", "x", day(1)), ("a", None, day(3)), ("a", "y", day(5)), ("b", "x", day(1)),
    ]
    assert cdc_events(df, "k", "t", "v", keep=["y"]).count() == 1
    pairs = spark.createDataFrame([("a", day(1), None, "x"), ("a", day(2), "x", "x"), ("a", day(3), "x", None)], "k string, t timestamp_ntz, o string, n string")
    assert cdc_pair_events(pairs, "k", "t", "o", "n").count() == 2


def test_history_and_overrides(spark):
    df = spark.createDataFrame([("a", "01", day(1)), ("a", "02", day(2))], "k string, code string, t timestamp_ntz")
    log = history_events(df, "k", "code", "t", {"01": "Open"})
    assert [r["activity"] for r in log.orderBy("event_timestamp").collect()] == ["Open", "02"]
    assert standardise_activities(log, {}) is log


def test_case_through_a_link(spark, tables):
    requisitions = extract_event(tables["purchase_requisitions"], "pr_id", EventSpec("Create PR", "created_at"))
    events = requisitions.withColumnRenamed("case_id", "pr_id")
    inner = resolve_case(events, tables["purchase_orders"], "pr_id", "po_id")
    assert sorted(r["case_id"] for r in inner.collect()) == ["PO-1", "PO-2", "PO-3", "PO-5"]
    left = resolve_case(events, tables["purchase_orders"], "pr_id", "po_id", "left")
    assert left.where("case_id IS NULL").count() == 1


def test_enrichment_guards(spark, tables):
    orders, suppliers = tables["purchase_orders"], tables["supplier_master"]
    with pytest.raises(ValueError, match="prefix"):
        en.enrich(orders.withColumn("country", F.lit("x")), suppliers, "supplier_id", ["country"])
    twice = suppliers.unionByName(suppliers)
    with pytest.raises(ValueError, match="unique"):
        en.enrich(orders, twice, "supplier_id", ["country"])
    for out in (en.enrich(orders, suppliers, "supplier_id", ["country"]), en.enrich(orders, twice, "supplier_id", ["country"], on_dup="first")):
        assert out.count() == 5 and out.where("country IS NOT NULL").count() == 3
    norm = en.enrich(orders, suppliers, "supplier_id", ["country"], normalise=True)
    assert norm.where("country IS NOT NULL").count() == 4
    reasons = {r["reason"]: r["rows"] for r in en.coverage_reasons(orders, suppliers, "supplier_id").collect()}
    assert reasons == {"matched": 3, "null key": 1, "matches after normalising": 1}
    rate = en.match_rate(orders, suppliers, "supplier_id").first()
    assert (rate["rows"], rate["matched"], rate["keys"], rate["matched_keys"]) == (5, 3, 3, 2)
    assert en.coverage(orders.limit(0), ["buyer"]).first()["pct"] is None


def test_enrichment_through_a_bridge(spark, tables):
    receipts = tables["goods_receipts"]
    out = en.enrich_via(receipts, tables["purchase_orders"], tables["contracts"], "po_id", "contract_id", ["contract_type"], "contract_")
    assert {r["gr_id"]: r["contract_contract_type"] for r in out.collect()} == {
        "GR-1": "frame", "GR-1-DUP": "frame", "GR-2": "frame", "GR-3": "spot",
    }
    many = tables["purchase_orders"].where("pr_id IS NOT NULL")
    with pytest.raises(ValueError, match="several"):
        en.enrich_via(tables["purchase_requisitions"], many.withColumn("contract_id", F.col("po_id")), tables["contracts"], "pr_id", "contract_id", ["contract_type"])


def test_case_constant(spark):
    log = spark.createDataFrame([("a", "x", 1), ("a", "x", 2), ("b", "y", 1), ("b", None, 1)], "case_id string, p string, q int")
    assert [tuple(r) for r in en.check_case_constant(log, ["p", "q"]).collect()] == [("q", "a", 2)]


def test_scalar_helpers(spark):
    df = spark.createDataFrame([(" ab ", None, ["x", "y", "z", "w"]), ("AB", 1, ["x"])], "k string, n int, v array<string>")
    got = df.select(normalise_key("k").alias("k"), event_id(F.lit("t"), F.col("n")).alias("i"), variant_label("v").alias("v")).collect()
    assert [tuple(r) for r in got] == [("AB", "t|~", "x -> y -> z..."), ("AB", "t|1", "x")]


def test_tables_in_the_catalog(spark, tables, cfg):
    spark.sql("CREATE SCHEMA IF NOT EXISTS casemill_test")
    log = build_event_log(spark, cfg, tables)
    save_log(log, "casemill_test.p2p")
    save_log(log.drop("cost"), "casemill_test.p2p")  # replaces the schema too
    save_log(tables["contracts"], "casemill_test.contracts")
    try:
        assert [r["table_name"] for r in list_tables(spark, "casemill_test").collect()] == ["contracts", "p2p"]
        assert [tuple(r) for r in discover_logs(spark, "casemill_test").collect()] == [("p2p", "traditional")]
        back = load_log(spark, "casemill_test.p2p")
        assert back.count() == 12 and "cost" not in back.columns and dict(back.dtypes)["event_rank"] == "double"
        assert describe_columns(back).first()["column"] == "case_id"
    finally:
        spark.sql("DROP SCHEMA casemill_test CASCADE")


def test_normalise_keeps_all_rows(spark):
    raw = spark.createDataFrame([("b", "2024-01-02", "5.5"), ("a", "oops", "x")], "case_id string, event_timestamp string, cost string")
    out = normalise_log(raw, sort=True).collect()
    assert [(r["case_id"], r["event_timestamp"], r["cost"]) for r in out] == [
        ("a", None, None), ("b", dt.datetime(2024, 1, 2), 5.5),
    ]


def test_case_key_must_group_or_link(spark):
    """Rule 1: a key that names every row once and occurs nowhere else makes no cases."""
    alone = spark.createDataFrame([(i, f"2024-01-0{i}") for i in range(1, 5)], "id long, at string")
    other = spark.createDataFrame([(9, "2024-01-01")], "id long, at string")
    one, two = (SourceSpec(t, "id", (EventSpec("Step " + t.upper(), "at"),)) for t in "ab")

    def passed(sources, **tables):
        found = check_config(spark, EventLogConfig("x", "x", sources), tables).where("rule = 1").collect()
        return {r["source"]: r["passed"] for r in found}

    assert passed((one,), a=alone) == {"a": False}
    assert passed((one,), a=alone.union(alone)) == {"a": True}
    assert passed((one, two), a=alone, b=other) == {"a": False, "b": False}
    assert passed((one, two), a=alone, b=alone) == {"a": True, "b": True}


def test_rows_without_a_key(spark):
    """Ids from all columns, maps too; equal rows have ids of their own, the same ones in every layout."""
    df = spark.createDataFrame([(1, {"a": 1}), (1, {"a": 1}), (1, {"a": 2})], "id long, m map<string,int>")
    df = df.withColumn("at", F.lit("2024-01-01"))
    ids = [r["event_id"] for r in extract_event(df, "id", EventSpec("Go", "at"), "t", []).collect()]
    assert len(set(ids)) == 3 == len(ids)
    many = df.crossJoin(spark.range(40).select(F.lit(1).alias("x"))).unionAll(df.where("m['a'] = 2").withColumn("x", F.lit(2)))
    layouts = [many.repartition(n) for n in (1, 7)]
    first, second = ([r["event_id"] for r in extract_event(d, "id", EventSpec("Go", "at"), "t", []).collect()] for d in layouts)
    assert len(set(first)) == 121 == len(first) and sorted(first) == sorted(second)


def test_broken_config_and_gates_stop_the_build(spark, tables, cfg):
    from casemill.operators.quality import GateFailure
    from casemill.plans.run import ConfigFailure, build_and_save, complete_log

    bad = EventLogConfig("x", "x", (SourceSpec("purchase_orders", "nothing", (EventSpec("Go", "created_at"),)),))
    with pytest.raises(ConfigFailure, match="rule 1"):
        build_and_save(spark, bad, tables)
    with pytest.raises(GateFailure):
        complete_log(spark, spark.createDataFrame([("c", "a", "2024-01-01")], "case_id string, activity string, event_timestamp string"))


def test_script_builds_the_same_log(spark):
    """Text and texts with quotes, time zones, text timestamps, conditions, sources without a key, two enrichments."""
    from casemill.plans.build import build_event_log
    from casemill.plans.script import build_script
    from casemill.sources.config import EnrichmentSpec

    a = spark.createDataFrame([(1, "2024-01-01 10:00:00", "x", 5), (1, "2024-01-01 10:00:00", "x", 5), (2, "bad", "y", None), (None, "2024-01-02", "it's", 7)],
                              "id int, at string, who string, amount int")
    b = spark.createDataFrame([("1", day(3), 10, "x"), ("2", day(1), 11, "z"), ("3", None, 12, "x")], "case string, day timestamp_ntz, k int, who string")
    ref = spark.createDataFrame([("x", 1.5, 7), ("y", None, 8), (None, 9.0, 9)], "who string, rate double, nr int")
    more = spark.createDataFrame([(7, "seven")], "nr int, name string")
    t = {"a": a, "dbb": b, "ref": ref, "more": more}
    cfg = EventLogConfig("l", "out.l", (
        SourceSpec("a", "id", (EventSpec("Go 'n", "at", resource="who", cost="amount", attributes={"who": "who"}),
                               EventSpec("Big", "at", condition="amount > 5", attributes={"who": "upper(who)"}))),
        SourceSpec("dbb", "`case`", (EventSpec("Late", "day", cost="k * 2"),), "America/New_York", ("k",)),
    ), {"Late": "Over"}, (EnrichmentSpec("ref", "who", ("rate", "nr"), prefix="r_"), EnrichmentSpec("more", "r_nr", ("name",), "nr")))
    want = build_event_log(spark, cfg, t)
    text = build_script(spark, cfg, t, rates=True)
    for name, df in t.items():
        df.createOrReplaceTempView(name)
    got = spark.sql(text)
    assert got.dtypes == want.dtypes
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and want.count() == 6
    assert "of 6 events match ref" in text and build_script(spark, cfg, t, create=True).startswith("CREATE OR REPLACE TABLE `out`.`l` AS")
    for name in t:
        spark.catalog.dropTempView(name)


def test_hot_keys_of_a_build_are_measured_once(spark, monkeypatch):
    """Three enrichments that are not broadcast: no join reads the events to find its hot keys, and the log is the same."""
    from casemill.operators import joins
    from casemill.operators.ordering import dealt, measure_cases
    from casemill.plans.build import build_event_log, raw_events
    from casemill.sources.config import EnrichmentSpec

    rows = [(i, "hot" if i % 3 else f"k{i}", i % 5, None if i % 2 else i, day(1)) for i in range(600)]
    src = spark.createDataFrame(rows, "id int, who string, nr int, other int, at timestamp_ntz")
    refs = {
        "w": spark.createDataFrame([("hot", 1), ("k0", 2)], "who string, w int"), "n": spark.createDataFrame([(k, k * k) for k in range(4)], "nr int, n int"),
        "o": spark.createDataFrame([(k, -k) for k in range(0, 600, 3)], "other int, o int"),
    }
    t = {"src": src, **refs}
    cfg = EventLogConfig("l", "l", (SourceSpec("src", "id", (EventSpec("Go", "at"),), key=("id",)),), {}, (
        EnrichmentSpec("w", "who", ("w",)), EnrichmentSpec("n", "nr", ("n",)), EnrichmentSpec("o", "other", ("o",))))
    want = sorted(map(str, build_event_log(spark, cfg, t).collect()))
    load = measure_cases(raw_events(spark, cfg, t), max_task_events=100)
    found = joins.measure_hot_keys(src, ["who", "nr", "other", "id"], 600, 100)
    assert {c: sorted((r[0], r[1]) for r in f.collect()) if f is not None else None for c, f in found.items()} == {
        "who": [("hot", 4)], "nr": [(k, 2) for k in range(5)], "other": [(None, 3)], "id": None,
    }
    monkeypatch.setattr(joins, "fits_broadcast", lambda *_: False)
    monkeypatch.setattr(joins, "hot_keys", lambda *_: pytest.fail("the events are read once more"))
    assert sorted(map(str, build_event_log(spark, cfg, t, load).collect())) == want
    assert joins.measure_hot_keys(src, ["who"], 600, 600) == {"who": None}


def test_case_constant_deals_a_large_log(spark, monkeypatch):
    """The same cases whether rows are dealt to more tasks, cases are hot, or neither; joins have as many tasks as rows need."""
    monkeypatch.setattr(en, "measure_cases", lambda df: measure_cases(df, max_task_events=20))
    rows = [(i % 40 if i % 3 else 7, "x" if i % 40 < 20 else str(i), None if i % 2 else 1) for i in range(900)] + [(None, "y", 2)]
    log = spark.createDataFrame(rows, "case_id long, a string, b int")
    want = {}
    for case, a, b in rows:
        for name, value in (("a", a), ("b", b)):
            if case is not None and value is not None:
                want.setdefault((name, case), set()).add(value)
    got = en.check_case_constant(log, ["a", "b"]).collect()
    assert {(r["column"], r["case_id"]): r["values"] for r in got} == {k: len(v) for k, v in want.items() if len(v) > 1}
    assert len(got) == len({(r["column"], r["case_id"]) for r in got})
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert dealt(log, ["case_id"], 10 * parts, 10) is log
    assert dealt(log, ["case_id"], 10 * parts + 1, 10).rdd.getNumPartitions() == parts + 1
