"""Small hand-made logs and procure-to-pay tables."""

import datetime as dt
import random

P2P_SCHEMAS = {
    "purchase_requisitions": "pr_id string, created_at timestamp, approved_at timestamp, requestor string, approver string, "
    "department string, cost_center string, category string, total_value double, source_system string, status string",
    "purchase_orders": "po_id string, pr_id string, supplier_id string, contract_id string, created_at timestamp, "
    "approved_at timestamp, buyer string, approver string, po_value double, source_system string, status string, "
    "modified_at timestamp",
    "goods_receipts": "gr_id string, po_id string, posting_date timestamp, receiver string, warehouse string, "
    "quantity_received double",
    "invoices": "invoice_id string, po_id string, supplier_id string, received_date timestamp, cleared_date timestamp, "
    "invoice_amount double, three_way_match string",
    "payments": "payment_id string, invoice_id string, po_id string, supplier_id string, payment_date timestamp, "
    "payment_amount double, payment_method string, processed_by string",
    "supplier_master": "supplier_id string, supplier_name string, credit_risk_rating string, avg_delivery_lead_days double, "
    "open_quality_incidents long, on_time_delivery_rate double, country string",
    "contracts": "contract_id string, contract_type string, amendment_count long, payment_terms_days long, "
    "max_value_usd double",
    "cost_centers": "cost_center string, department string, business_unit string, region string",
}


def day(n, hour=9):
    return dt.datetime(2024, 1, 1, hour) + dt.timedelta(days=n)


def p2p(spark):
    """The eight example tables: four requisitions, five orders, and one row set per kind of noise."""
    rows = {
        "purchase_requisitions": [
            (f"PR-{i}", day(i), None if i == 4 else day(i + 1), f"user{i}", "boss", "IT" if i % 2 else "HR",
             f"CC-{i % 2}", "goods", 100.0 * i, "SAP", "pending" if i == 4 else "approved")
            for i in range(1, 5)
        ],
        "purchase_orders": [
            ("PO-1", "PR-1", "SUP-1", "CON-1", day(3), day(4), "buyer1", "boss", 100.0, "SAP", "approved", day(6)),
            ("PO-2", "PR-1", "sup-2 ", "CON-1", day(3), day(4), "buyer1", "boss", 50.0, "SAP", "approved", None),
            ("PO-3", "PR-2", None, "CON-2", day(4), None, "buyer2", "boss", 70.0, "Ariba", "approved", None),
            ("PO-4", None, "SUP-1", "CON-2", day(5), day(6), "buyer2", "boss", 80.0, "SAP", "approved", None),
            ("PO-5", "PR-3", "SUP-2", None, day(5), None, "buyer1", "boss", 90.0, "SAP", "pending", None),
        ],
        "goods_receipts": [
            ("GR-1", "PO-1", day(10), "rec", "West", 5.0),
            ("GR-1-DUP", "PO-1", day(10), "rec", "West", 5.0),
            ("GR-2", "PO-2", day(2), "rec", "East", 3.0),
            ("GR-3", "PO-4", day(12), "rec", "East", 4.0),
        ],
        "invoices": [
            ("INV-1", "PO-1", "SUP-1", day(11), day(15), 100.0, "ok"),
            ("INV-2", "PO-GHOST-1", "SUP-2", day(11), None, 40.0, "fail"),
            ("INV-3", "PO-4", "SUP-1", day(8), day(16), 80.0, "ok"),
        ],
        "payments": [
            ("PAY-1", "INV-1", "PO-1", "SUP-1", day(20), 100.0, "wire", "clerk"),
            ("PAY-2", "INV-3", "PO-4", "SUP-1", day(14), 80.0, "wire", "clerk"),
        ],
        "supplier_master": [
            ("SUP-1", "Acme", "low", 5.0, 0, 0.95, "DE"),
            ("SUP-2", "Bolt", "high", 9.0, 2, 0.7, "FR"),
        ],
        "contracts": [("CON-1", "frame", 1, 30, 1000.0), ("CON-2", "spot", 0, 10, 500.0)],
        "cost_centers": [("CC-0", "HR", "Corp", "EU"), ("CC-1", "IT", "Corp", "EU")],
    }
    return {t: spark.createDataFrame(rows[t], schema) for t, schema in P2P_SCHEMAS.items()}


LOG_SCHEMA = "case_id string, activity string, event_timestamp timestamp_ntz, event_id string"


def make_log(spark, traces, repeat=1, partitions=None):
    """A log of the given activity lists, one hour between events, with ``repeat`` cases per list."""
    rows = []
    for i, trace in enumerate(traces * repeat):
        rows += [(f"c{i:05d}", a, day(i % 300) + dt.timedelta(hours=j), f"{i}|{j}") for j, a in enumerate(trace)]
    random.Random(1).shuffle(rows)
    log = spark.createDataFrame(rows, LOG_SCHEMA)
    return log.repartition(partitions) if partitions else log


def skewed_log(spark, events=900, seed=3):
    """One case holds a third of all events; many events share their time."""
    rng = random.Random(seed)
    rows = []
    for i in range(events):
        case = "hot" if i % 3 == 0 else f"c{rng.randrange(events // 12):03d}"
        rows.append((case, rng.choice("abcd"), day(rng.randrange(events // 4)), f"e{i:05d}"))
    return spark.createDataFrame(rows, LOG_SCHEMA)
