"""Checks of extraction, enrichment and computed columns."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from casemill.functions.columns import normalise_key
from casemill.operators import enrich as en
from casemill.operators.extract import (
    cdc_events,
    cdc_pair_events,
    extract_event,
    extract_source,
    history_events,
    mapping_stats,
    resolve_case,
    snapshot_events,
    snapshot_stages,
    standardise_activities,
    union_events,
)
from casemill.operators.metrics import add_metrics, rework_flag
from casemill.operators.ordering import sequence
from casemill.plans.build import build_event_log, propose_enrichments, propose_events
from casemill.plans.report import report
from casemill.plans.script import build_script
from casemill.sources.config import EnrichmentSpec, EventSpec, SourceSpec

from checks.logs import (
    CLICKS_SQL,
    LINE_KEY,
    LINES,
    LOG_SQL,
    O2C,
    ORDERS,
    RAW_SQL,
    SNAPSHOT_SQL,
    clicks,
    o2c,
    o2c_events,
    snapshot,
    table,
    tables,
)
from checks.registry import check

EVENT = ["case_id", "activity", "event_timestamp", "resource", "source_system", "cost", "source_seq", "event_id"]
METRICS = ["event_rank", "time_since_prev_seconds", "case_event_count"]
_EVENT_SQL = "case_id, activity, event_timestamp, resource, source_system, cost, source_seq, event_id"


@check("c01_extract_event", f"WITH {RAW_SQL} SELECT {_EVENT_SQL} FROM raw WHERE source_seq = 0")
def one_event(spark, sf):
    event = ORDERS.events[0]
    return extract_event(table(spark, sf, "orders"), "o_orderkey", event, "orders", ["o_orderkey"]).select(*EVENT)


@check("c02_condition", f"WITH {RAW_SQL} SELECT {_EVENT_SQL} FROM raw WHERE source_seq = 2")
def condition(spark, sf):
    event = replace(LINES.events[1], seq=2)
    return extract_event(table(spark, sf, "lineitem"), "l_orderkey", event, "lineitem", LINE_KEY).select(*EVENT)


@check(
    "c03_null_timestamp_guard",
    f"""WITH {SNAPSHOT_SQL} SELECT o_orderkey AS case_id, 'Complete Shipment' AS activity, last_ship AS event_timestamp
FROM snap WHERE last_ship IS NOT NULL""",
)
def null_guard(spark, sf):
    event = EventSpec("Complete Shipment", "last_ship")
    return extract_event(snapshot(spark, sf), "o_orderkey", event).select("case_id", "activity", "event_timestamp")


@check(
    "c04_attributes",
    """SELECT l_orderkey AS case_id, 'Ship Item' AS activity, l_linestatus AS status,
  CASE WHEN l_discount > 0.05 THEN 1 ELSE 0 END AS discounted, 'warehouse' AS department, 'erp' AS source_system
FROM lineitem""",
)
def attributes(spark, sf):
    event = EventSpec(
        "Ship Item",
        "l_shipdate",
        attributes={
            "status": "l_linestatus",
            "discounted": "CASE WHEN l_discount > 0.05 THEN 1 ELSE 0 END",
            "department": "'warehouse'",
            "source_system": "'erp'",
        },
    )
    log = extract_event(table(spark, sf, "lineitem"), "l_orderkey", event, "lineitem", LINE_KEY)
    return log.select("case_id", "activity", "status", "discounted", "department", "source_system")


@check(
    "c05_time_zone",
    "SELECT user_id AS case_id, event_type AS activity, ts - INTERVAL 330 MINUTE AS event_timestamp FROM events",
)
def time_zone(spark, sf):
    source = SourceSpec(
        "events", "user_id", (EventSpec("Click", "ts", attributes={"kind": "event_type"}),), "+05:30", ("event_id",)
    )
    log = extract_source(table(spark, sf, "events"), source)
    return log.select("case_id", F.col("kind").alias("activity"), "event_timestamp")


_RENAMED = {"signup": "Sign Up", "purchase": "Buy"}


@check(
    "c06_standardise_activities",
    """SELECT user_id AS case_id, event_id, ts AS event_timestamp,
  CASE event_type WHEN 'signup' THEN 'Sign Up' WHEN 'purchase' THEN 'Buy' ELSE event_type END AS activity
FROM events""",
)
def standardise(spark, sf):
    log, _ = clicks(spark, sf)
    return standardise_activities(log, _RENAMED).select("case_id", "event_id", "event_timestamp", "activity")


@check("c07_union_events", f"WITH {RAW_SQL} SELECT {_EVENT_SQL} FROM raw")
def united(spark, sf):
    orders, lines = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    parts = [extract_event(orders, "o_orderkey", ORDERS.events[0], "orders", ["o_orderkey"])]
    parts += [
        extract_event(lines, "l_orderkey", replace(e, seq=i + 1), "lineitem", LINE_KEY)
        for i, e in enumerate(LINES.events)
    ]
    return union_events(parts).select(*EVENT)


@check("c08_single_scan", f"WITH {RAW_SQL} SELECT {_EVENT_SQL} FROM raw WHERE source_seq > 0")
def single_scan(spark, sf):
    events = tuple(replace(e, seq=i + 1) for i, e in enumerate(LINES.events))
    return extract_source(table(spark, sf, "lineitem"), replace(LINES, events=events)).select(*EVENT)


@check(
    "c09_snapshot_events",
    f"""WITH {SNAPSHOT_SQL} SELECT o_orderkey AS case_id, 'Order' AS activity, o_orderdate AS event_timestamp, 0 AS source_seq FROM snap
UNION ALL SELECT o_orderkey, 'Complete', last_ship, 1 FROM snap WHERE last_ship IS NOT NULL""",
)
def from_snapshot(spark, sf):
    log = snapshot_events(snapshot(spark, sf), "o_orderkey", {"Order": "o_orderdate", "Complete": "last_ship"})
    return log.select("case_id", "activity", "event_timestamp", "source_seq")


@check(
    "c10_snapshot_stages",
    f"""WITH {SNAPSHOT_SQL}, s AS (
  SELECT o_orderkey, epoch_us(o_orderdate) AS a, epoch_us(coalesce(last_ship, TIMESTAMP '2005-01-01')) AS z,
         list_position(['O', 'P', 'F'], o_orderstatus) - 1 AS k FROM snap
), e AS (SELECT *, unnest(range(0, k + 1)) AS i FROM s WHERE k >= 0)
SELECT o_orderkey AS case_id, ['O', 'P', 'F'][i + 1] AS activity,
  make_timestamp(CAST(a + CASE WHEN k = 0 THEN 0 ELSE ((greatest(z, a) - a) * i) // k END AS BIGINT)) AS event_timestamp,
  CAST(i AS INTEGER) AS source_seq, i > 0 AND i < k AS is_approximate, z < a AS bad_interval
FROM e""",
)
def stages(spark, sf):
    return snapshot_stages(
        snapshot(spark, sf), "o_orderkey", "o_orderdate", "last_ship", "o_orderstatus", ["O", "P", "F"], "2005-01-01"
    )


@check(
    "c11_cdc_events",
    """WITH c AS (SELECT user_id AS case_id, event_type AS activity, ts AS event_timestamp, event_id,
  lag(event_type) OVER w AS previous, row_number() OVER w AS rn FROM events
  WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT case_id, activity, event_timestamp, previous, event_id FROM c WHERE rn = 1 OR activity IS DISTINCT FROM previous""",
)
def changes(spark, sf):
    events = table(spark, sf, "events")
    _, load = clicks(spark, sf)
    return cdc_events(events, "user_id", "ts", "event_type", tie=["event_id"], load=load)


@check(
    "c11_cdc_pair_events",
    """SELECT l_orderkey AS case_id, l_returnflag AS activity, l_shipdate AS event_timestamp, l_linestatus AS previous
FROM lineitem WHERE l_linestatus IS DISTINCT FROM l_returnflag AND l_returnflag IN ('A', 'R')""",
)
def change_pairs(spark, sf):
    lines = table(spark, sf, "lineitem")
    return cdc_pair_events(lines, "l_orderkey", "l_shipdate", "l_linestatus", "l_returnflag", ["A", "R"])


@check(
    "c12_history_events",
    """SELECT conv_id AS case_id, CASE role WHEN 'user' THEN 'Ask' WHEN 'assistant' THEN 'Answer' ELSE role END AS activity,
  TIMESTAMP '2020-01-01' + turn * INTERVAL 1 MINUTE AS event_timestamp FROM conversations""",
)
def history(spark, sf):
    talk = table(spark, sf, "conversations")
    ts = "timestamp_ntz'2020-01-01' + make_dt_interval(0, 0, CAST(turn AS INT))"
    return history_events(talk, "conv_id", "role", ts, {"user": "Ask", "assistant": "Answer"})


@check(
    "c13_mapping_stats",
    f"""WITH {RAW_SQL} SELECT source_system AS source, source_seq, activity, count(*) AS "rows",
  count(*) - count(case_id) AS null_case_ids, count(*) - count(event_timestamp) AS null_timestamps,
  min(event_timestamp) AS first_timestamp, max(event_timestamp) AS last_timestamp, count(DISTINCT case_id) AS cases,
  count(*) FILTER (event_timestamp > TIMESTAMP '2001-06-01') AS rows_in_future
FROM raw WHERE source_seq > 0 GROUP BY 1, 2, 3""",
)
def tested_mapping(spark, sf):
    events = tuple(replace(e, seq=i + 1) for i, e in enumerate(LINES.events))
    return mapping_stats(table(spark, sf, "lineitem"), replace(LINES, events=events), as_of="2001-06-01")


@check(
    "c14_propose_events",
    f"""WITH {RAW_SQL} SELECT source_system AS source, activity,
  CASE WHEN source_seq = 0 THEN 'o_orderkey' ELSE 'l_orderkey' END AS case_id,
  CASE WHEN source_seq = 0 THEN 'o_orderdate' ELSE 'l_shipdate' END AS "timestamp",
  CASE WHEN source_seq = 2 THEN 'l_returnflag = ''R''' ELSE '' END AS "condition",
  count(*) AS "rows", count(*) - count(case_id) AS null_case_ids, count(*) - count(event_timestamp) AS null_timestamps,
  count(DISTINCT raw.case_id) AS cases, count(*) FILTER (event_timestamp > TIMESTAMP '2001-06-01') AS rows_in_future
FROM raw GROUP BY source_system, source_seq, activity""",
)
def proposed_events(spark, sf):
    return propose_events(spark, O2C, tables(spark, sf, "orders", "lineitem"), as_of="2001-06-01")


_ENRICHED = replace(
    O2C,
    enrichment=(
        EnrichmentSpec("supplier", "l_suppkey", ("s_nationkey",), "s_suppkey", "supplier_"),
        EnrichmentSpec("nation", "supplier_s_nationkey", ("n_name", "n_regionkey"), "n_nationkey", "supplier_"),
    ),
)
_ENRICHED_SQL = """enriched AS (
  SELECT log.*, CAST(log.resource AS BIGINT) AS l_suppkey, s.s_nationkey AS supplier_s_nationkey,
         n.n_name AS supplier_n_name, n.n_regionkey AS supplier_n_regionkey
  FROM log LEFT JOIN supplier s ON s.s_suppkey = CAST(log.resource AS BIGINT) LEFT JOIN nation n ON n.n_nationkey = s.s_nationkey
)"""


@check(
    "c14_propose_enrichments",
    f"""WITH {LOG_SQL}, {_ENRICHED_SQL}
SELECT 'supplier' AS "table", 'l_suppkey' AS join_key, count(*) AS "rows", count(supplier_s_nationkey) AS matched,
  round(count(supplier_s_nationkey) * 100.0 / count(*), 1) AS pct, 'supplier_s_nationkey' AS columns FROM enriched
UNION ALL SELECT 'nation', 'supplier_s_nationkey', count(*), count(supplier_n_name),
  round(count(supplier_n_name) * 100.0 / count(*), 1), 'supplier_n_name, supplier_n_regionkey' FROM enriched""",
)
def proposed_enrichments(spark, sf):
    return propose_enrichments(spark, _ENRICHED, tables(spark, sf, "orders", "lineitem", "supplier", "nation"))


@check(
    "c15_resolve_case",
    """WITH first AS (SELECT l_partkey, min(l_shipdate) AS event_timestamp FROM lineitem GROUP BY 1)
SELECT DISTINCT l.l_orderkey AS case_id, 'First Shipment' AS activity, f.event_timestamp, l.l_partkey
FROM first f JOIN lineitem l USING (l_partkey)""",
)
def resolved(spark, sf):
    lines = table(spark, sf, "lineitem")
    first = lines.groupBy("l_partkey").agg(F.min("l_shipdate").alias("event_timestamp"))
    events = first.withColumn("activity", F.lit("First Shipment"))
    log = resolve_case(events, lines, "l_partkey", "l_orderkey")
    return log.select("case_id", "activity", "event_timestamp", "l_partkey")


@check(
    "c16_other_case_key",
    f"""WITH {RAW_SQL}, other AS (
  SELECT CASE WHEN source_seq = 0 THEN o_custkey ELSE CAST(raw.resource AS BIGINT) END AS case_id, activity, event_timestamp,
         source_seq, event_id
  FROM raw LEFT JOIN orders ON source_seq = 0 AND o_orderkey = raw.case_id WHERE activity <> 'Return Item')
SELECT case_id, activity, event_id, CAST(row_number() OVER (
  PARTITION BY case_id ORDER BY event_timestamp, source_seq, event_id) AS INTEGER) AS event_rank FROM other""",
)
def other_case(spark, sf):
    cfg = O2C.with_case_id({"orders": "o_custkey", "lineitem": "l_suppkey"}).without_activity("Return Item")
    log, _ = o2c(spark, sf, cfg)
    return log.select("case_id", "activity", "event_id", "event_rank")


@check(
    "c17_build_event_log",
    f"""WITH {LOG_SQL}, {_ENRICHED_SQL} SELECT {_EVENT_SQL}, event_rank, time_since_prev_seconds, case_event_count,
  supplier_s_nationkey, supplier_n_name, supplier_n_regionkey FROM enriched""",
)
def built(spark, sf):
    t = tables(spark, sf, "orders", "lineitem", "supplier", "nation")
    log = build_event_log(spark, _ENRICHED, t)
    return log.select(*EVENT, *METRICS, "supplier_s_nationkey", "supplier_n_name", "supplier_n_regionkey")


@check(
    "c17_build_script",
    f"""WITH {LOG_SQL}, {_ENRICHED_SQL} SELECT {_EVENT_SQL}, event_rank, time_since_prev_seconds, case_event_count,
  supplier_s_nationkey, supplier_n_name, supplier_n_regionkey FROM enriched""",
)
def scripted(spark, sf):
    """The same log from the SQL text of the build, run on views of the tables."""
    t = tables(spark, sf, "orders", "lineitem", "supplier", "nation")
    text = build_script(spark, _ENRICHED, t)
    for name, df in t.items():
        df.createOrReplaceTempView(name)
    log = spark.sql(text)
    for name in t:
        spark.catalog.dropTempView(name)
    return log.select(*EVENT, *METRICS, "supplier_s_nationkey", "supplier_n_name", "supplier_n_regionkey")


@check(
    "f19_match_rates",
    f"""WITH {RAW_SQL}, known AS (SELECT CAST(s_suppkey AS VARCHAR) AS k, s_nationkey FROM supplier WHERE s_suppkey % 3 > 0),
rows AS (SELECT resource, k, s_nationkey, n_nationkey FROM raw LEFT JOIN known ON k = resource LEFT JOIN nation ON n_nationkey = s_nationkey),
rates AS (SELECT 'supplier' AS t, count(*) AS n, count(k) AS m, count(DISTINCT resource) AS keys, count(DISTINCT k) AS matched_keys FROM rows
  UNION ALL SELECT 'nation', count(*), count(n_nationkey), count(DISTINCT s_nationkey), count(DISTINCT n_nationkey) FROM rows)
SELECT 'match rate: ' || t AS item, m || ' of ' || n || ' events (' || round(m * 100.0 / n, 1) || ' %), ' || matched_keys || ' of ' || keys
  || ' keys' AS value FROM rates""",
)
def reported_rates(spark, sf):
    """The lines of the report, with a third of the suppliers missing."""
    t = tables(spark, sf, "orders", "lineitem", "supplier", "nation")
    t["supplier"] = t["supplier"].where("s_suppkey % 3 > 0")
    out = report(spark, _ENRICHED, build_event_log(spark, _ENRICHED, t), tables=t)
    return out.where("item like 'match rate%'").select("item", "value")


@check(
    "d01_enrich",
    f"""WITH {LOG_SQL} SELECT event_id, o_custkey, o_orderpriority FROM log LEFT JOIN orders ON o_orderkey = case_id
  AND o_orderstatus <> 'F'""",
)
def enriched(spark, sf):
    log, _ = o2c(spark, sf)
    ref = table(spark, sf, "orders").where("o_orderstatus <> 'F'")
    out = en.enrich(log, ref, {"case_id": "o_orderkey"}, ["o_custkey", "o_orderpriority"])
    return out.select("event_id", "o_custkey", "o_orderpriority")


_SOME = "s_nationkey < 20"


@check(
    "d02_match_rate",
    f"""SELECT count(*) AS "rows", count(s_suppkey) AS matched, round(count(s_suppkey) * 100.0 / count(*), 1) AS pct,
  count(DISTINCT l_suppkey) AS keys, count(DISTINCT s_suppkey) AS matched_keys
FROM lineitem LEFT JOIN supplier ON s_suppkey = l_suppkey AND {_SOME}""",
)
def matched(spark, sf):
    return en.match_rate(
        table(spark, sf, "lineitem"), table(spark, sf, "supplier").where(_SOME), {"l_suppkey": "s_suppkey"}
    )


@check(
    "d04_prefix",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, s_name AS supplier_s_name, s_acctbal AS supplier_s_acctbal "
    "FROM lineitem LEFT JOIN supplier ON s_suppkey = l_suppkey",
)
def prefixed(spark, sf):
    lines = table(spark, sf, "lineitem").select(*LINE_KEY)
    return en.enrich(lines, table(spark, sf, "supplier"), {"l_suppkey": "s_suppkey"}, ["s_name", "s_acctbal"], "supplier_")


@check(
    "d05_enrich_via",
    f"""WITH {LOG_SQL} SELECT event_id, c_mktsegment AS customer_c_mktsegment, c_nationkey AS customer_c_nationkey
FROM log LEFT JOIN orders ON o_orderkey = case_id LEFT JOIN customer ON c_custkey = o_custkey""",
)
def bridged(spark, sf):
    log, _ = o2c(spark, sf)
    out = en.enrich_via(
        log,
        table(spark, sf, "orders"),
        table(spark, sf, "customer"),
        {"case_id": "o_orderkey"},
        {"o_custkey": "c_custkey"},
        ["c_mktsegment", "c_nationkey"],
        "customer_",
    )
    return out.select("event_id", "customer_c_mktsegment", "customer_c_nationkey")


def _misspelled(spark, sf):
    """Lines with the name of their supplier, of which one in ten is written differently."""
    typo = F.when(F.col("s_suppkey") % 10 == 0, F.concat(F.lower("s_name"), F.lit(" "))).otherwise(F.col("s_name"))
    names = table(spark, sf, "supplier").select("s_suppkey", typo.alias("supplier_name"))
    return en.enrich(
        table(spark, sf, "lineitem").select(*LINE_KEY), names, {"l_suppkey": "s_suppkey"}, ["supplier_name"]
    )


_TYPO_SQL = """typo AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CASE WHEN s_suppkey % 10 = 0 THEN lower(s_name) || ' ' ELSE s_name END AS supplier_name
  FROM lineitem LEFT JOIN supplier ON s_suppkey = l_suppkey)"""


@check(
    "d06_normalise_key",
    f"WITH {_TYPO_SQL} SELECT t.*, s.s_acctbal FROM typo t LEFT JOIN supplier s ON upper(trim(s.s_name)) = upper(trim(t.supplier_name))",
)
def normalised(spark, sf):
    return en.enrich(
        _misspelled(spark, sf), table(spark, sf, "supplier"), {"supplier_name": "s_name"}, ["s_acctbal"], normalise=True
    )


@check(
    "d07_coverage",
    f"""SELECT 's_name' AS "column", count(*) AS total_rows, count(s_name) AS enriched, round(count(s_name) * 100.0 / count(*), 1) AS pct
FROM lineitem LEFT JOIN supplier ON s_suppkey = l_suppkey AND {_SOME}""",
)
def covered(spark, sf):
    ref = table(spark, sf, "supplier").where(_SOME)
    return en.coverage(en.enrich(table(spark, sf, "lineitem"), ref, {"l_suppkey": "s_suppkey"}, ["s_name"]), ["s_name"])


@check(
    "d08_coverage_reasons",
    f"""WITH {_TYPO_SQL}, t AS (SELECT CASE WHEN l_linenumber = 7 THEN NULL ELSE supplier_name END AS k FROM typo),
r AS (SELECT s_name FROM supplier WHERE {_SOME})
SELECT CASE WHEN k IS NULL THEN 'null key' WHEN k IN (SELECT s_name FROM r) THEN 'matched'
  WHEN upper(trim(k)) IN (SELECT upper(trim(s_name)) FROM r) THEN 'matches after normalising'
  ELSE 'not in reference' END AS reason, count(*) AS "rows"
FROM t GROUP BY 1""",
)
def reasons(spark, sf):
    lines = _misspelled(spark, sf).withColumn("supplier_name", F.when(F.col("l_linenumber") != 7, F.col("supplier_name")))
    return en.coverage_reasons(lines, table(spark, sf, "supplier").where(_SOME), {"supplier_name": "s_name"})


@check("d09_check_ref_key", 'SELECT o_custkey, count(*) AS "rows" FROM orders GROUP BY 1 HAVING count(*) > 1')
def repeated_keys(spark, sf):
    return en.check_ref_key(table(spark, sf, "orders"), "o_custkey")


@check(
    "d09_enrich_first",
    """SELECT c_custkey, c_name, o_orderdate, o_orderkey FROM customer LEFT JOIN (
  SELECT o_custkey, o_orderdate, o_orderkey FROM orders
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1) o ON o_custkey = c_custkey""",
)
def first_only(spark, sf):
    customers = table(spark, sf, "customer").select("c_custkey", "c_name")
    orders = table(spark, sf, "orders")
    return en.enrich(customers, orders, {"c_custkey": "o_custkey"}, ["o_orderdate", "o_orderkey"], on_dup="first")


@check(
    "d10_case_constant",
    """SELECT 'l_partkey' AS "column", l_orderkey AS case_id, count(DISTINCT l_partkey) AS "values" FROM lineitem GROUP BY 2
HAVING count(DISTINCT l_partkey) > 1
UNION ALL SELECT 'o_custkey', l_orderkey, count(DISTINCT o_custkey) FROM lineitem JOIN orders ON o_orderkey = l_orderkey
GROUP BY 2 HAVING count(DISTINCT o_custkey) > 1""",
)
def constant(spark, sf):
    lines = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("case_id"), "l_partkey")
    log = en.enrich(lines, table(spark, sf, "orders"), {"case_id": "o_orderkey"}, ["o_custkey"])
    return en.check_case_constant(log, ["o_custkey", "l_partkey"])


@check("e01_metrics", f"WITH {LOG_SQL} SELECT event_id, event_rank, time_since_prev_seconds, case_event_count FROM log")
def metrics(spark, sf):
    events, load = o2c_events(spark, sf)
    return add_metrics(events, load=load).select("event_id", *METRICS)


@check(
    "e04_only_missing",
    f"""WITH {CLICKS_SQL} SELECT event_id, -1 AS event_rank,
  date_diff('second', lag(event_timestamp) OVER w, event_timestamp) AS time_since_prev_seconds,
  count(*) OVER (PARTITION BY case_id) AS case_event_count
FROM clicks WINDOW w AS (PARTITION BY case_id ORDER BY event_timestamp, event_id)""",
)
def only_missing(spark, sf):
    log, load = clicks(spark, sf)
    known = log.withColumn("event_rank", F.lit(-1))
    return add_metrics(known, only_missing=True, load=load).select("event_id", *METRICS)


@check(
    "e05_rework_flag",
    f"""WITH {RAW_SQL} SELECT event_id, CASE WHEN row_number() OVER (PARTITION BY case_id, activity
  ORDER BY event_timestamp, source_seq, event_id) > 1 THEN 1 ELSE 0 END AS is_rework FROM raw""",
)
def rework(spark, sf):
    events, load = o2c_events(spark, sf)
    return rework_flag(events, load).select("event_id", "is_rework")


@check(
    "e06_neighbours",
    f"""WITH {CLICKS_SQL} SELECT event_id, lag(activity) OVER w AS previous, lead(activity) OVER w AS next
FROM clicks WINDOW w AS (PARTITION BY case_id ORDER BY event_timestamp, event_id)""",
)
def neighbouring(spark, sf):
    log, load = clicks(spark, sf)
    seen = sequence(log, ["activity"], load)
    return seen.select("event_id", F.col("_prev_activity").alias("previous"), F.col("_next_activity").alias("next"))
