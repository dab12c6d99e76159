import pytest
from pyspark.sql import functions as F

from casemill.operators import detectors as dt
from casemill.operators import quality as qa
from casemill.operators.classify import classify_tables
from casemill.operators.extract import extract_event, union_events
from casemill.operators.profile import column_roles, key_relationships, match_templates, pii_scan, profile_table
from casemill.sources.config import EventSpec

from tests.fixtures import day, make_log, p2p


@pytest.fixture(scope="module")
def tables(spark):
    return p2p(spark)


@pytest.fixture(scope="module")
def p2p_log(tables):
    def take(table, case, activity, ts, key):
        return extract_event(tables[table], case, EventSpec(activity, ts), table, [key])

    requisitions = take("purchase_requisitions", "pr_id", "Create PR", "created_at", "pr_id").withColumnRenamed("case_id", "pr_id")
    links = tables["purchase_orders"].select("pr_id", F.col("po_id").alias("case_id")).dropna()
    return union_events(
        [
            requisitions.join(links, "pr_id").drop("pr_id"),
            take("purchase_orders", "po_id", "Create PO", "created_at", "po_id"),
            take("purchase_orders", "po_id", "Approve PO", "approved_at", "po_id"),
            take("purchase_orders", "po_id", "Amend PO", "modified_at", "po_id"),
            take("goods_receipts", "po_id", "Goods Receipt", "posting_date", "gr_id"),
            take("invoices", "po_id", "Invoice", "received_date", "invoice_id"),
            take("payments", "po_id", "Payment", "payment_date", "payment_id"),
        ]
    )


def keys(df, name):
    return sorted(r[name] for r in df.collect())


def test_noise_in_tables(tables):
    t = tables
    copy = dt.duplicate_records(t["goods_receipts"], "gr_id").collect()
    assert [(r["gr_id"], r["copies"]) for r in copy] == [("GR-1", 2)]
    assert keys(dt.status_conflicts(t["purchase_orders"], "status", "approved", "approved_at"), "po_id") == ["PO-3"]
    assert keys(dt.orphans(t["invoices"], t["purchase_orders"], "po_id"), "invoice_id") == ["INV-2"]
    missing = {r["column"]: r["missing"] for r in dt.missing_keys(t["purchase_orders"], ["supplier_id", "pr_id", "po_id"]).collect()}
    assert missing == {"supplier_id": 1, "pr_id": 1, "po_id": 0}
    assert keys(dt.rows_missing_keys(t["purchase_orders"], ["supplier_id", "pr_id"]), "po_id") == ["PO-3", "PO-4"]
    typed = t["purchase_orders"].unionByName(t["purchase_orders"].where("po_id = 'PO-5'"))
    assert [(r["normalised"], r["spellings"], r["rows"]) for r in dt.key_variants(typed, "supplier_id").collect()] == [("SUP-2", 2, 3)]
    early = dt.early_children(t["payments"], t["invoices"], "invoice_id", "payment_date", "cleared_date")
    assert keys(early, "payment_id") == ["PAY-2"]


def test_noise_in_the_log(p2p_log):
    late = dt.out_of_order(p2p_log, "Approve PO", "Goods Receipt", "list")
    assert keys(late, "case_id") == ["PO-2"]
    assert dt.out_of_order(p2p_log, "Approve PO", "Goods Receipt", "filter").count() == p2p_log.count() - 1
    assert keys(dt.first_before(p2p_log, "Invoice", "Goods Receipt"), "case_id") == ["PO-4"]
    assert keys(dt.all_before(p2p_log, "Invoice", "Goods Receipt"), "case_id") == ["PO-4"]
    assert "PO-4" in keys(dt.missing_start(p2p_log, ["Create PR"]), "case_id")
    assert "PO-1" not in keys(dt.missing_start(p2p_log, ["Create PR"]), "case_id")
    assert keys(dt.rework_cases(p2p_log), "case_id") == ["PO-1"]
    assert keys(dt.activity_after(p2p_log, "Amend PO", "Approve PO"), "case_id") == ["PO-1"]
    assert [r["dupes"] for r in qa.duplicate_events(p2p_log).collect()] == [2]


def test_gates(spark):
    log = make_log(spark, [list("abc"), list("ab")])
    assert qa.require_gates(log) is log
    broken = log.withColumn("event_timestamp", F.when(F.col("activity") != "a", F.col("event_timestamp")))
    with pytest.raises(qa.GateFailure, match="null_timestamps = 2.0"):
        qa.require_gates(broken)
    single = log.where("activity = 'a'")
    failed = {r["gate"] for r in qa.quality_gates(single).where("NOT passed").collect()}
    assert failed == {"distinct_activities", "events_per_case"}
    empty = {r["gate"]: r["passed"] for r in qa.quality_gates(log.limit(0)).collect()}
    assert not empty["events"] and not empty["events_per_case"]


def test_compare_counts_copies(spark):
    a = make_log(spark, [list("ab")])
    b = a.unionByName(a.where("activity = 'a'"))
    got = {r["build"]: r["rows_not_in_other"] for r in qa.compare_logs(a, b).collect()}
    assert got == {"a": 0, "b": 1}


def test_trace_of_a_case(spark):
    log = make_log(spark, [list("abc"), list("ab")])
    assert [r["activity"] for r in qa.case_trace(log).collect()] == list("abc")
    assert [r["activity"] for r in qa.case_trace(log, "c00001").collect()] == list("ab")


def test_example_tables_get_their_class(spark, tables):
    got = {r["table"]: r["class"] for r in classify_tables(tables).collect()}
    sources = ("purchase_requisitions", "purchase_orders", "goods_receipts", "invoices", "payments")
    assert {t: got[t] for t in sources} == dict.fromkeys(sources, "event source")
    references = ("supplier_master", "contracts", "cost_centers")
    assert {t: got[t] for t in references} == dict.fromkeys(references, "reference")


def test_sensor_data_is_no_process(spark):
    sensor = spark.createDataFrame([(day(i), 20.5 + i) for i in range(9)], "ts timestamp_ntz, temperature double")
    many = spark.range(500).select(F.expr("timestamp_ntz'2024-01-01'").alias("ts"), (F.col("id") * 1.5).alias("t"))
    got = {r["table"]: (r["class"], r["reason"]) for r in classify_tables({"sensor": many, "small": sensor}).collect()}
    assert got["sensor"] == ("not process data", "times but no case key")


def test_profile_exact_and_sketched(spark, tables):
    exact = {r["column"]: r for r in profile_table(tables["purchase_orders"], exact=True).collect()}
    quick = {r["column"]: r for r in profile_table(tables["purchase_orders"]).collect()}
    assert exact["buyer"]["samples"] == ["buyer1", "buyer2"] and quick["buyer"]["samples"] == ["buyer1", "buyer2"]
    for c in exact:
        assert exact[c]["distinct"] == quick[c]["distinct"] and exact[c]["nulls"] == quick[c]["nulls"]
    assert exact["modified_at"]["nulls"] == 4 and exact["po_value"]["max"] == "100.0"


def test_roles_and_keys(spark, tables):
    roles = {r["column"]: r["role"] for r in column_roles(tables["purchase_orders"], exact=True).collect()}
    assert roles["po_id"] == "key" and roles["created_at"] == "timestamp" and roles["buyer"] == "resource"
    assert roles["po_value"] == "amount" and roles["status"] == "status" and roles["source_system"] == "system"
    found = {(r["l_table"], r["l_col"], r["r_table"]): (r["containment"], r["cardinality"]) for r in key_relationships(tables).collect()}
    assert found["purchase_orders", "pr_id", "purchase_requisitions"] == (1.0, "N:1")
    assert found["purchase_orders", "po_id", "goods_receipts"] == (0.6, "1:N")
    assert found["invoices", "invoice_id", "payments"][1] == "1:1"


def test_pii(spark):
    df = spark.createDataFrame([("mail me: a.b@c.org",), ("call 212-555-0100",), ("plain",), (None,)], "t string")
    hits = {r["kind"]: (r["rows"], r["hits"]) for r in pii_scan(df).collect()}
    assert hits["email"] == (3, 1) and hits["phone"] == (3, 1) and hits["ip"] == (3, 0)


def test_pii_numbers_must_pass_their_checks(spark):
    """Digit runs of the right shape that fail a check digit or a range do not count."""
    good = ["card 4111 1111 1111 1111.", "4000-0000-0000-0002 and 1234 5678 9012 3456", "ip 10.0.0.255", "ssn 123-45-6789",
            "GB82 WEST 1234 5698 7654 32", "to DE89370400440532013000 now"]
    bad = ["4111 1111 1111 1112", "256.1.1.1", "000-45-6789", "666-45-6789, 912-11-1111, 123-00-1111, 123-45-0000", "DE89370400440532013001",
           "AB12 CDEF GHIJ KL"]
    df = spark.createDataFrame([(t,) for t in [*good, *bad, None]], "t string")
    hits = lambda **k: {r["kind"]: r["hits"] for r in pii_scan(df, **k).collect()}
    assert {k: hits()[k] for k in ("card", "ip", "ssn", "iban")} == {"card": 2, "ip": 1, "ssn": 1, "iban": 2}
    assert {k: hits(checked=False)[k] for k in ("card", "ip", "ssn", "iban")} == {"card": 3, "ip": 2, "ssn": 3, "iban": 4}


def test_templates(p2p_log):
    got = {r["template"]: r["hits"] for r in match_templates(p2p_log).collect()}
    assert got["procure_to_pay"] == max(got.values()) and got["procure_to_pay"] >= 4


def test_keys_out_of_their_normal_form(spark):
    typed = spark.createDataFrame([("ACME ",), ("ACME ",), ("beta",), ("GAMMA",), ("delta",), (None,)], "k string")
    found = {r["normalised"]: (r["spellings"], r["rows"]) for r in dt.key_variants(typed, "k").collect()}
    assert found == {"ACME": (1, 2)}
    listed = spark.createDataFrame([("BETA",), ("GAMMA",)], "name string")
    found = {r["normalised"]: r["rows"] for r in dt.key_variants(typed, "k", listed, "name").collect()}
    assert found == {"ACME": 2, "BETA": 1}


def test_duplicates_are_told_by_their_rows(spark):
    from casemill.operators.classify import classify_tables, content_overlap

    rows = [(i, f"n{i}", float(i % 7)) for i in range(9_000)]
    schema = "item_id long, name string, price double"
    one = spark.createDataFrame(rows, schema)
    copy = spark.createDataFrame(rows[::-1], schema).select("price", "item_id", "name").repartition(5)
    part = spark.createDataFrame(rows[:7_000] + [(i, "new", 0.0) for i in range(2_000)], schema)
    other = spark.createDataFrame([(i, f"m{i}", 0.5) for i in range(9_000)], schema)
    assert content_overlap(one, copy, 9_000) == 1.0 and content_overlap(one, other, 9_000) == 0.0
    assert 0.7 < content_overlap(one, part, 9_000, 4_000) < 0.85
    twice = one.unionAll(one)
    assert 0.4 < content_overlap(twice, one, 18_000) < 0.6 and content_overlap(one.limit(0), one.limit(0), 0) == 1.0
    classes = {r["table"]: r["class"] for r in classify_tables({"a": one, "b": copy, "c": other, "cleaned_c": one}).collect()}
    assert classes["b"] == "duplicate" and classes["cleaned_c"] == "duplicate" and classes["c"] != "duplicate"
    old = {r["table"]: r["class"] for r in classify_tables({"a": one, "c": other}, same_rows=0).collect()}
    assert old["c"] == "duplicate"
