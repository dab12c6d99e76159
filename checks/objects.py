"""Checks of object-centric logs."""

from __future__ import annotations

from pyspark.sql import functions as F

from casemill.operators import ocel as oc
from casemill.operators.dfg import dfg, dfg_layers
from casemill.operators.extract import extract_event
from casemill.session import written
from casemill.sources.config import EventSpec

from checks.logs import OBJECTS, OCEL_SQL, RAW_SQL, object_events, ocel, table
from checks.registry import check
from checks.sources import scratch_schema


@check(
    "g01_ocel_candidate",
    f"""WITH {RAW_SQL}, per AS (SELECT CASE WHEN source_seq = 0 THEN 2 ELSE 3 END AS n FROM raw)
SELECT 4 AS object_columns, count(*) AS events, count(*) FILTER (n > 1) AS multi_object_events,
  round(count(*) FILTER (n > 1) * 100.0 / count(*), 1) AS pct, true AS offer FROM per""",
)
def candidate(spark, sf):
    return oc.ocel_candidate(object_events(spark, sf), OBJECTS)


@check(
    "g02_ocel_events",
    f"WITH {RAW_SQL} SELECT event_id, activity, event_timestamp, resource, cost, source_system AS source_table FROM raw",
)
def events(spark, sf):
    return ocel(spark, sf).events


@check("g03_event_ids", f"WITH {RAW_SQL} SELECT count(*) AS events, count(DISTINCT event_id) AS ids FROM raw")
def event_ids(spark, sf):
    return ocel(spark, sf).events.agg(F.count(F.lit(1)).alias("events"), F.count_distinct(F.col("event_id")).alias("ids"))


@check(
    "g03_ids_of_equal_rows",
    """SELECT l_orderkey AS case_id, count(*) AS events, count(*) AS ids, count(*) - count(DISTINCT l_shipdate) AS repeats
FROM lineitem GROUP BY 1""",
)
def ids_of_equal_rows(spark, sf):
    """Orders and dates of the lines without their keys: many rows are equal, their events are not."""
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_shipdate")
    log = extract_event(rows, "l_orderkey", EventSpec("Ship Item", "l_shipdate"), "lineitem")
    return log.groupBy("case_id").agg(
        F.count(F.lit(1)).alias("events"), F.count_distinct(F.col("event_id")).alias("ids"),
        F.count_if(F.col("event_id").rlike(r"\|#[0-9]+$")).alias("repeats"),
    )


@check("g04_ocel_objects", f"WITH {OCEL_SQL} SELECT DISTINCT object_id, object_type FROM e2o")
def objects(spark, sf):
    return ocel(spark, sf).objects


@check(
    "g04_ocel_objects_with_masters",
    f"""WITH {OCEL_SQL} SELECT object_id, object_type FROM e2o UNION SELECT 'p' || p_partkey, 'Part' FROM part
UNION SELECT 'c' || c_custkey, 'Customer' FROM customer""",
)
def with_masters(spark, sf):
    parts = table(spark, sf, "part").select(F.concat(F.lit("p"), "p_partkey").alias("id"))
    customers = table(spark, sf, "customer").select(F.concat(F.lit("c"), "c_custkey").alias("id"))
    masters = {"Part": (parts, "id"), "Customer": (customers, "id")}
    return oc.build_ocel(object_events(spark, sf), OBJECTS, masters).objects


@check("g05_ocel_links", f"WITH {OCEL_SQL} SELECT event_id, object_id, object_type FROM e2o")
def links(spark, sf):
    return ocel(spark, sf).e2o


@check(
    "g06_ocel_checks",
    f"""WITH {OCEL_SQL}, obj AS (SELECT DISTINCT object_id, object_type FROM e2o),
broken AS (SELECT * FROM e2o WHERE object_type <> 'Customer'),
kept AS (SELECT * FROM raw WHERE activity <> 'Return Item')
SELECT "check", violations, violations = 0 AS passed FROM (
  SELECT 'duplicate event ids' AS "check", (SELECT count(*) FROM (SELECT 1 FROM kept GROUP BY event_id HAVING count(*) > 1)) AS violations
  UNION ALL SELECT 'links without event', (SELECT count(*) FROM e2o WHERE event_id NOT IN (SELECT event_id FROM kept))
  UNION ALL SELECT 'links without object', (SELECT count(*) FROM e2o WHERE object_type = 'Customer')
  UNION ALL SELECT 'events without link', (SELECT count(*) FROM kept WHERE event_id NOT IN (SELECT event_id FROM e2o))
  UNION ALL SELECT 'ids with several types', (SELECT count(*) FROM (
    SELECT 1 FROM broken GROUP BY object_id HAVING count(DISTINCT object_type) > 1)))""",
)
def checks(spark, sf):
    full = ocel(spark, sf)
    events = full.events.where("activity <> 'Return Item'")
    return oc.ocel_checks(oc.Ocel(events, full.objects.where("object_type <> 'Customer'"), full.e2o))


@check("g07_object_types", f"WITH {OCEL_SQL} SELECT object_type, count(*) AS cnt FROM e2o GROUP BY 1")
def types(spark, sf):
    return oc.object_types(ocel(spark, sf))


# Every line has one supplier and one part, so the links of these types are read off the lines.
_FLAT_SQL = """flat AS MATERIALIZED (
  SELECT 'lineitem|1|' || k AS event_id, 'Ship Item' AS activity, l_shipdate AS event_timestamp, CAST(l_suppkey AS VARCHAR) AS resource,
    l_extendedprice AS cost, 'lineitem' AS source_table, 's' || l_suppkey AS case_id, 'p' || l_partkey AS part
  FROM (SELECT *, concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS k FROM lineitem)
  UNION ALL
  SELECT 'lineitem|2|' || concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey), 'Return Item', l_shipdate,
    CAST(l_suppkey AS VARCHAR), l_extendedprice, 'lineitem', 's' || l_suppkey, 'p' || l_partkey
  FROM lineitem WHERE l_returnflag = 'R')"""
# Lines that agree in their key share an event id, and a join by the id pairs each of them with the links of all.
_JOINED_SQL = f"""{_FLAT_SQL}, joined AS (SELECT event_id, activity, event_timestamp, resource, cost, source_table, case_id
  FROM (SELECT *, unnest(range(copies)) FROM (SELECT *, count(*) OVER (PARTITION BY event_id) AS copies FROM flat)))"""


@check("g08_flatten", f"WITH {_JOINED_SQL} SELECT * FROM joined")
def flattened(spark, sf):
    return oc.flatten(ocel(spark, sf), "Supplier")


@check(
    "g08_flatten_buckets",
    f"WITH {_FLAT_SQL} SELECT event_id, activity, event_timestamp, resource, cost, source_table, case_id FROM flat",
)
def flattened_in_buckets(spark, sf):
    """The same from tables that are saved in buckets."""
    log = oc.build_ocel(oc.with_event_numbers(object_events(spark, sf)), OBJECTS)
    with scratch_schema(spark) as schema:
        oc.save_ocel(log, f"{schema}.o2c", buckets=8)
        flat = oc.flatten(oc.load_ocel(spark, f"{schema}.o2c_ocel_events"), "Supplier")
        return written(flat, "flat", **oc.COMPACT)


@check(
    "g08_flatten_dfg",
    f"""WITH {_JOINED_SQL}, p AS (SELECT activity AS src,
  lead(activity) OVER (PARTITION BY case_id ORDER BY event_timestamp, event_id) AS tgt FROM joined)
SELECT src, tgt, count(*) AS freq FROM p WHERE tgt IS NOT NULL GROUP BY 1, 2""",
)
def flattened_dfg(spark, sf):
    log = ocel(spark, sf)
    return dfg(oc.flatten(log, "Supplier"), oc.perspective_load(log, "Supplier"))


@check(
    "g09_default_perspective",
    f"""WITH {OCEL_SQL}, best AS (SELECT object_type FROM e2o GROUP BY 1 ORDER BY count(*) DESC, object_type LIMIT 1)
SELECT object_id AS case_id, count(*) AS events FROM raw JOIN e2o USING (event_id) JOIN best USING (object_type) GROUP BY 1""",
)
def default(spark, sf):
    return oc.flatten(ocel(spark, sf)).groupBy("case_id").agg(F.count(F.lit(1)).alias("events"))


@check(
    "g10_object_counts",
    f"WITH {OCEL_SQL} SELECT object_type, count(DISTINCT object_id) AS cnt FROM e2o GROUP BY 1",
)
def counts(spark, sf):
    return oc.object_counts(ocel(spark, sf))


@check(
    "g11_links_per_event",
    f"WITH {OCEL_SQL} SELECT links, count(*) AS events FROM (SELECT event_id, count(*) AS links FROM e2o GROUP BY 1) GROUP BY 1",
)
def per_event(spark, sf):
    return oc.links_per_event(ocel(spark, sf))


@check("g12_total_links", f"WITH {OCEL_SQL} SELECT count(*) AS cnt FROM e2o")
def total(spark, sf):
    return oc.total_links(ocel(spark, sf))


@check(
    "g13_object_trace",
    f"""WITH {_FLAT_SQL} SELECT event_id, activity, event_timestamp, resource, cost, source_table FROM flat WHERE part = 'p7'""",
)
def trace(spark, sf):
    return oc.object_trace(ocel(spark, sf), "Part", "p7")


@check(
    "h04_layers_without_rank",
    f"WITH {RAW_SQL} SELECT activity, row_number() OVER (ORDER BY activity) - 1 AS layer FROM (SELECT DISTINCT activity FROM raw)",
)
def layers(spark, sf):
    return dfg_layers(oc.flatten(ocel(spark, sf), "Order"))
