"""Checks of gates, validation queries and noise detectors."""

from __future__ import annotations

from pyspark.sql import functions as F

from casemill.operators import detectors as dt
from casemill.operators import quality as qa
from casemill.operators.cases import largest_cases
from casemill.operators.classify import classify_tables
from casemill.operators.enrich import enrich
from casemill.plans.report import report
from casemill.plans.run import build_and_save, complete_log
from casemill.session import cut_lineage
from casemill.sources.config import EnrichmentSpec

from checks.logs import LOG_SQL, O2C, RAW_SQL, SNAPSHOT_SQL, clicks, o2c, o2c_events, snapshot, table, tables
from checks.registry import check
from checks.sources import scratch_schema


@check(
    "f01_quality_gates",
    f"""WITH {RAW_SQL}, s AS (SELECT count(*) AS n, count(*) - count(case_id) AS nc, count(*) - count(event_timestamp) AS nt,
  count(*) - count(activity) AS na, count(DISTINCT activity) AS a, count(case_id) / count(DISTINCT case_id) AS m FROM raw)
SELECT 'events' AS gate, CAST(n AS DOUBLE) AS value, n > 0 AS passed, false AS advisory FROM s
UNION ALL SELECT 'null_case_ids', nc, nc = 0, false FROM s UNION ALL SELECT 'null_timestamps', nt, nt = 0, false FROM s
UNION ALL SELECT 'distinct_activities', a, a >= 2, false FROM s
UNION ALL SELECT 'events_per_case', round(m, 6), m > 1, false FROM s
UNION ALL SELECT 'null_activities', na, na = 0, true FROM s""",
)
def gates(spark, sf):
    return qa.quality_gates(o2c(spark, sf)[0]).withColumn("value", F.round("value", 6))


@check(
    "f02_basic_stats",
    f"WITH {RAW_SQL} SELECT count(*) AS events, count(DISTINCT case_id) AS cases, count(DISTINCT activity) AS activities FROM raw",
)
def stats(spark, sf):
    return qa.basic_stats(o2c(spark, sf)[0])


@check("f03_activity_distribution", f"WITH {RAW_SQL} SELECT activity, count(*) AS cnt FROM raw GROUP BY 1")
def distribution(spark, sf):
    return qa.activity_distribution(o2c(spark, sf)[0])


@check(
    "f04_null_check",
    f"""WITH {RAW_SQL} SELECT count(*) FILTER (case_id IS NULL) AS null_case_ids,
  count(*) FILTER (activity IS NULL) AS null_activities, count(*) FILTER (event_timestamp IS NULL) AS null_timestamps FROM raw""",
)
def nulls(spark, sf):
    return qa.null_check(o2c(spark, sf)[0])


@check(
    "f05_case_trace",
    f"WITH {RAW_SQL} SELECT case_id, activity, event_timestamp, resource FROM raw WHERE case_id = (SELECT min(case_id) FROM raw)",
)
def trace(spark, sf):
    return qa.case_trace(o2c(spark, sf)[0])


@check(
    "f07_duplicate_events",
    f"WITH {RAW_SQL} SELECT case_id, activity, event_timestamp, count(*) AS dupes FROM raw GROUP BY 1, 2, 3 HAVING count(*) > 1",
)
def duplicates(spark, sf):
    return qa.duplicate_events(o2c(spark, sf)[0])


_COPIED_SQL = """copied AS (SELECT * FROM lineitem UNION ALL
  SELECT * REPLACE (l_linenumber + 100 AS l_linenumber) FROM lineitem WHERE l_orderkey % 33 = 0)"""


@check(
    "f08_duplicate_records",
    f"""WITH {_COPIED_SQL} SELECT min(l_linenumber) AS l_linenumber, l_orderkey, l_partkey, l_suppkey, l_quantity, l_extendedprice,
  l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate, count(*) AS copies
FROM copied GROUP BY ALL HAVING count(*) > 1""",
)
def copies(spark, sf):
    lines = table(spark, sf, "lineitem")
    again = lines.where("l_orderkey % 33 = 0").withColumn("l_linenumber", F.col("l_linenumber") + 100)
    return dt.duplicate_records(lines.unionByName(again), "l_linenumber")


@check(
    "f09_orphans",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F')""",
)
def orphaned(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return dt.orphans(lines, table(spark, sf, "orders").where("o_orderstatus <> 'F'"), "l_orderkey", "o_orderkey")


@check(
    "f10_status_conflicts",
    f"WITH {SNAPSHOT_SQL} SELECT o_orderkey, o_orderstatus, o_orderdate FROM snap WHERE o_orderstatus = 'F' AND last_ship IS NULL",
)
def conflicts(spark, sf):
    found = dt.status_conflicts(snapshot(spark, sf), "o_orderstatus", "F", "last_ship")
    return found.select("o_orderkey", "o_orderstatus", "o_orderdate")


def _partly_matched(spark, sf):
    ref = table(spark, sf, "supplier").where("s_nationkey < 20").withColumn("supplier_key", F.col("s_suppkey"))
    lines = table(spark, sf, "lineitem")
    return enrich(lines, ref, {"l_suppkey": "s_suppkey"}, ["supplier_key", "s_name"])


@check(
    "f11_missing_keys",
    """SELECT 'supplier_key' AS "column", count(*) AS "rows", count(*) - count(s_suppkey) AS missing
FROM lineitem LEFT JOIN supplier ON s_suppkey = l_suppkey AND s_nationkey < 20
UNION ALL SELECT 'l_orderkey', count(*), count(*) - count(l_orderkey) FROM lineitem""",
)
def missing(spark, sf):
    return dt.missing_keys(_partly_matched(spark, sf), ["supplier_key", "l_orderkey"])


@check(
    "f11_rows_missing_keys",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
LEFT JOIN supplier ON s_suppkey = l_suppkey AND s_nationkey < 20 WHERE s_suppkey IS NULL""",
)
def rows_missing(spark, sf):
    found = dt.rows_missing_keys(_partly_matched(spark, sf), ["supplier_key"])
    return found.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@check(
    "f12_key_variants",
    """WITH t AS (SELECT CASE WHEN s_suppkey % 10 = 0 AND l_linenumber < 4 THEN lower(s_name) || ' ' ELSE s_name END AS k
  FROM lineitem JOIN supplier ON s_suppkey = l_suppkey)
SELECT upper(trim(k)) AS normalised, count(DISTINCT k) AS spellings, count(*) AS "rows" FROM t GROUP BY 1
HAVING count(DISTINCT k) > 1 OR bool_or(k <> trim(k))""",
)
def spellings(spark, sf):
    lines = enrich(table(spark, sf, "lineitem"), table(spark, sf, "supplier"), {"l_suppkey": "s_suppkey"}, ["s_name"])
    odd = (F.col("l_suppkey") % 10 == 0) & (F.col("l_linenumber") < 4)
    typed = F.when(odd, F.concat(F.lower("s_name"), F.lit(" "))).otherwise(F.col("s_name"))
    return dt.key_variants(lines.withColumn("k", typed), "k")


_EARLY_SQL = f"""{RAW_SQL}, early AS (SELECT *, coalesce(activity = 'Ship Item' AND event_timestamp <
  min(event_timestamp) FILTER (activity = 'Create Order') OVER (PARTITION BY case_id), false) AS out_of_order FROM raw)"""


@check("f13_out_of_order", f"WITH {_EARLY_SQL} SELECT event_id, out_of_order FROM early")
def flagged(spark, sf):
    events, load = o2c_events(spark, sf)
    return dt.out_of_order(events, "Create Order", "Ship Item", load=load).select("event_id", "out_of_order")


@check("f13_out_of_order_list", f"WITH {_EARLY_SQL} SELECT event_id, case_id, event_timestamp FROM early WHERE out_of_order")
def listed(spark, sf):
    events, load = o2c_events(spark, sf)
    found = dt.out_of_order(events, "Create Order", "Ship Item", "list", load)
    return found.select("event_id", "case_id", "event_timestamp")


@check(
    "f14_first_before",
    f"""WITH {RAW_SQL} SELECT case_id, min(event_timestamp) FILTER (activity = 'Return Item') AS first_a,
  min(event_timestamp) FILTER (activity = 'Create Order') AS first_b FROM raw GROUP BY 1 HAVING first_a < first_b""",
)
def wrong_first(spark, sf):
    return dt.first_before(o2c(spark, sf)[0], "Return Item", "Create Order")


@check(
    "f14_all_before",
    f"""WITH {RAW_SQL} SELECT case_id, max(event_timestamp) FILTER (activity = 'Ship Item') AS last_a,
  min(event_timestamp) FILTER (activity = 'Create Order') AS first_b FROM raw GROUP BY 1 HAVING last_a < first_b""",
)
def all_early(spark, sf):
    return dt.all_before(o2c(spark, sf)[0], "Ship Item", "Create Order")


@check(
    "f15_early_children",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, o_orderdate AS parent_time
FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_shipdate < o_orderdate""",
)
def early(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    return dt.early_children(lines, table(spark, sf, "orders"), "l_orderkey", "l_shipdate", "o_orderdate", "o_orderkey")


@check(
    "f16_missing_start",
    f"""WITH {RAW_SQL} SELECT case_id, activity AS first_activity FROM raw
QUALIFY row_number() OVER (PARTITION BY case_id ORDER BY event_timestamp, source_seq, event_id) = 1 AND activity <> 'Create Order'""",
)
def unplanned(spark, sf):
    return dt.missing_start(o2c(spark, sf)[0], ["Create Order"])


@check(
    "f17_rework_cases",
    f"""WITH {RAW_SQL} SELECT case_id, CAST(sum(n - 1) AS BIGINT) AS rework_events, count(*) AS repeated_activities
FROM (SELECT case_id, activity, count(*) AS n FROM raw GROUP BY 1, 2 HAVING count(*) > 1) GROUP BY 1""",
)
def reworked(spark, sf):
    return dt.rework_cases(o2c(spark, sf)[0])


@check(
    "f17_activity_after",
    f"""WITH {RAW_SQL}, a AS (SELECT case_id, min(event_timestamp) AS approved FROM raw WHERE activity = 'Create Order' GROUP BY 1)
SELECT raw.case_id, approved, count(*) AS events_after FROM raw JOIN a USING (case_id)
WHERE activity = 'Return Item' AND event_timestamp > approved GROUP BY 1, 2""",
)
def after_approval(spark, sf):
    return dt.activity_after(o2c(spark, sf)[0], "Return Item", "Create Order")


_REPORT_SQL = f"""WITH {RAW_SQL} SELECT 2 AS position, 'events' AS item, CAST(count(*) AS VARCHAR) AS value FROM raw
UNION ALL SELECT 3, 'cases', CAST(count(DISTINCT case_id) AS VARCHAR) FROM raw
UNION ALL SELECT 4, 'largest case', CAST(max(n) AS VARCHAR) FROM (SELECT count(*) AS n FROM raw GROUP BY case_id)
UNION ALL SELECT 5, 'activities', string_agg(DISTINCT activity, ', ' ORDER BY activity) FROM raw
UNION ALL SELECT * FROM (VALUES (0, 'process', 'order_to_cash'), (1, 'output', 'o2c_event_log'),
  (6, 'columns: mandatory', 'case_id, activity, event_timestamp'),
  (7, 'columns: activity level', 'resource, department, source_system, cost'),
  (8, 'columns: computed', 'event_rank, time_since_prev_seconds, case_event_count'), (9, 'columns: case level', ''),
  (11, 'gate: distinct_activities', 'passed'), (11, 'gate: events', 'passed'), (11, 'gate: events_per_case', 'passed'),
  (11, 'gate: null_activities', 'passed'), (11, 'gate: null_case_ids', 'passed'), (11, 'gate: null_timestamps', 'passed'),
  (12, 'tables used', 'orders, lineitem'),
  (13, 'skipped: documents', 'not process data: no time column and no link to an event source')) v"""


@check("f19_report", _REPORT_SQL)
def summary(spark, sf):
    classes = classify_tables(tables(spark, sf, "orders", "lineitem", "documents"))
    return report(spark, O2C, o2c(spark, sf)[0], classes)


@check("p01_build_and_save", _REPORT_SQL)
def built(spark, sf):
    """From source tables to the report on the saved log."""
    sources = tables(spark, sf, "orders", "lineitem")
    classes = classify_tables(tables(spark, sf, "orders", "lineitem", "documents"))
    with scratch_schema(spark) as schema:
        return cut_lineage(build_and_save(spark, O2C, sources, f"{schema}.o2c_event_log", classes=classes))


@check(
    "p02_complete_log",
    """SELECT user_id AS case_id, event_type AS activity, ts AS event_timestamp, event_id, c_mktsegment AS segment_c_mktsegment,
  CAST(row_number() OVER w AS INTEGER) AS event_rank, date_diff('second', lag(ts) OVER w, ts) AS time_since_prev_seconds,
  CAST(7 AS BIGINT) AS case_event_count
FROM events LEFT JOIN customer ON c_custkey = user_id WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""",
)
def completed(spark, sf):
    """A log that already exists, with one of its metrics (which is left as it is)."""
    log = clicks(spark, sf)[0].withColumn("case_event_count", F.lit(7).cast("long"))
    log = log.withColumn("event_timestamp", F.col("event_timestamp").cast("string"))
    spec = EnrichmentSpec("customer", "case_id", ("c_mktsegment",), "c_custkey", "segment_")
    with scratch_schema(spark) as schema:
        out = complete_log(spark, log, [spec], tables(spark, sf, "customer"), table=f"{schema}.clicks")
        out = out.withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp_ntz"))
        return cut_lineage(out.drop("value"))


@check(
    "f20_compare_logs",
    f"""WITH {RAW_SQL} SELECT 'full' AS build, count(*) AS events, count(DISTINCT case_id) AS cases,
  count(DISTINCT activity) AS activities, count(*) FILTER (activity = 'Return Item') AS rows_not_in_other FROM raw
UNION ALL SELECT 'without returns', count(*), count(DISTINCT case_id), count(DISTINCT activity), 0
FROM raw WHERE activity <> 'Return Item'""",
)
def compared(spark, sf):
    full, _ = o2c(spark, sf)
    less, _ = o2c(spark, sf, O2C.without_activity("Return Item"))
    return qa.compare_logs(full, less, ("full", "without returns"))


@check(
    "f21_largest_cases",
    f"WITH {LOG_SQL} SELECT case_id, count(*) AS events FROM log GROUP BY 1 ORDER BY events DESC, case_id LIMIT 5",
)
def largest(spark, sf):
    return largest_cases(o2c(spark, sf)[0])
