"""Logs made from the driver tables, and the same logs in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casemill.operators.extract import history_events
from casemill.operators.ocel import Ocel, build_ocel
from casemill.operators.ordering import CaseLoad, measure_cases
from casemill.plans.build import build_event_log, log_load, raw_events
from casemill.sources.config import EventLogConfig, EventSpec, SourceSpec

NAMES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)

LINE_KEY = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
ORDERS = SourceSpec(
    "orders", "o_orderkey", (EventSpec("Create Order", "o_orderdate", cost="o_totalprice"),), key=("o_orderkey",)
)
LINES = SourceSpec(
    "lineitem",
    "l_orderkey",
    (
        EventSpec("Ship Item", "l_shipdate", resource="l_suppkey", cost="l_extendedprice"),
        EventSpec(
            "Return Item", "l_shipdate", condition="l_returnflag = 'R'", resource="l_suppkey", cost="l_extendedprice"
        ),
    ),
    key=LINE_KEY,
)
O2C = EventLogConfig("order_to_cash", "o2c_event_log", (ORDERS, LINES))


def tables(spark: SparkSession, sf: str, *names: str) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{sf}/{n}.parquet") for n in names or NAMES}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def o2c(spark: SparkSession, sf: str, cfg: EventLogConfig = O2C) -> tuple[DataFrame, CaseLoad]:
    """The order-to-cash log with its metrics, and its load."""
    t = tables(spark, sf, "orders", "lineitem")
    load = log_load(spark, cfg, t)
    return build_event_log(spark, cfg, t, load), load


def o2c_events(spark: SparkSession, sf: str) -> tuple[DataFrame, CaseLoad]:
    """The same events before metrics."""
    t = tables(spark, sf, "orders", "lineitem")
    return raw_events(spark, O2C, t), log_load(spark, O2C, t)


def clicks(spark: SparkSession, sf: str) -> tuple[DataFrame, CaseLoad]:
    """The events table as a log that already exists: one case per user."""
    events = table(spark, sf, "events")
    log = history_events(events, "user_id", "event_type", "ts", keep=["event_id", "value"])
    return log, measure_cases(log, at_most=events.count())


def clicks_by_day(spark: SparkSession, sf: str) -> tuple[DataFrame, CaseLoad]:
    """One case per user and day."""
    events = table(spark, sf, "events")
    log = history_events(
        events, "concat_ws('-', user_id, date_format(ts, 'yyyyMMdd'))", "event_type", "ts", keep=["event_id"]
    )
    return log, measure_cases(log, at_most=events.count())


OBJECTS = {"Order": "order_id", "Customer": "customer_id", "Part": "part_id", "Supplier": "supplier_id"}


def object_events(spark: SparkSession, sf: str) -> DataFrame:
    """O2C events with one id column per object type; ids carry the type so that they differ across types."""
    order = SourceSpec(
        "orders",
        "o_orderkey",
        (
            EventSpec(
                "Create Order",
                "o_orderdate",
                cost="o_totalprice",
                attributes={"order_id": "concat('o', o_orderkey)", "customer_id": "concat('c', o_custkey)"},
            ),
        ),
        key=("o_orderkey",),
    )
    ids = {
        "order_id": "concat('o', l_orderkey)",
        "part_id": "concat('p', l_partkey)",
        "supplier_id": "concat('s', l_suppkey)",
    }
    lines = SourceSpec(
        "lineitem",
        "l_orderkey",
        tuple(EventSpec(e.activity, e.timestamp, e.condition, e.resource, e.cost, ids) for e in LINES.events),
        key=LINE_KEY,
    )
    cfg = EventLogConfig("o2c_objects", "o2c", (order, lines))
    return raw_events(spark, cfg, tables(spark, sf, "orders", "lineitem"))


def ocel(spark: SparkSession, sf: str) -> Ocel:
    return build_ocel(object_events(spark, sf), OBJECTS)


def snapshot(spark: SparkSession, sf: str) -> DataFrame:
    """One row per order with its status and, where it has lines, the time of its last shipment."""
    last = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.max("l_shipdate").alias("last_ship"))
    orders = table(spark, sf, "orders")
    return orders.join(last, orders["o_orderkey"] == last["l_orderkey"], "left").drop("l_orderkey")


# The same logs in SQL, as common table expressions.
RAW_SQL = """raw AS (
  SELECT o_orderkey AS case_id, 'Create Order' AS activity, o_orderdate AS event_timestamp,
         CAST(NULL AS VARCHAR) AS resource, 'orders' AS source_system, o_totalprice AS cost, 0 AS source_seq,
         'orders|0|' || o_orderkey AS event_id
  FROM orders
  UNION ALL
  SELECT l_orderkey, 'Ship Item', l_shipdate, CAST(l_suppkey AS VARCHAR), 'lineitem', l_extendedprice, 1,
         'lineitem|1|' || l_orderkey || '|' || l_linenumber || '|' || l_partkey || '|' || l_suppkey
  FROM lineitem
  UNION ALL
  SELECT l_orderkey, 'Return Item', l_shipdate, CAST(l_suppkey AS VARCHAR), 'lineitem', l_extendedprice, 2,
         'lineitem|2|' || l_orderkey || '|' || l_linenumber || '|' || l_partkey || '|' || l_suppkey
  FROM lineitem WHERE l_returnflag = 'R'
)"""
LOG_SQL = (
    RAW_SQL
    + """, log AS (
  SELECT *, CAST(row_number() OVER w AS INTEGER) AS event_rank,
         date_diff('second', lag(event_timestamp) OVER w, event_timestamp) AS time_since_prev_seconds,
         count(*) OVER (PARTITION BY case_id) AS case_event_count
  FROM raw WINDOW w AS (PARTITION BY case_id ORDER BY event_timestamp, source_seq, event_id)
)"""
)
PAIRS_SQL = (
    RAW_SQL
    + """, pairs AS (
  SELECT case_id, activity AS src, lead(activity) OVER w AS tgt,
         event_timestamp AS ts, lead(event_timestamp) OVER w AS next_ts
  FROM raw WINDOW w AS (PARTITION BY case_id ORDER BY event_timestamp, source_seq, event_id)
)"""
)
CLICKS_SQL = "clicks AS (SELECT user_id AS case_id, event_type AS activity, ts AS event_timestamp, event_id, value FROM events)"
DAYS_SQL = """days AS (
  SELECT user_id || '-' || strftime(ts, '%Y%m%d') AS case_id, event_type AS activity, ts AS event_timestamp, event_id
  FROM events
)"""
SNAPSHOT_SQL = """snap AS (
  SELECT o.*, m.last_ship FROM orders o
  LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS last_ship FROM lineitem GROUP BY 1) m ON m.l_orderkey = o.o_orderkey
)"""
OCEL_SQL = (
    RAW_SQL
    + """, e2o AS (
  SELECT 'orders|0|' || o_orderkey AS event_id, 'o' || o_orderkey AS object_id, 'Order' AS object_type FROM orders
  UNION ALL SELECT 'orders|0|' || o_orderkey, 'c' || o_custkey, 'Customer' FROM orders
  UNION ALL SELECT event_id, 'o' || split_part(event_id, '|', 3), 'Order' FROM raw WHERE source_seq > 0
  UNION ALL SELECT event_id, 'p' || split_part(event_id, '|', 5), 'Part' FROM raw WHERE source_seq > 0
  UNION ALL SELECT event_id, 's' || split_part(event_id, '|', 6), 'Supplier' FROM raw WHERE source_seq > 0
)"""
)
