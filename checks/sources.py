"""Checks of sources, profiling and classification."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import functions as F

from casemill.operators.classify import classify_tables
from casemill.operators.ocel import load_ocel, object_types, save_ocel
from casemill.operators.profile import (
    column_roles,
    key_relationships,
    match_templates,
    pii_scan,
    profile_table,
    value_distribution,
)
from casemill.session import cut_lineage, shared_folder
from casemill.sources.config import check_config, parse_config
from casemill.sources.tables import describe_columns, discover_logs, list_tables, load_log, normalise_log, save_log

from checks.logs import LOG_SQL, OCEL_SQL, o2c, ocel, table, tables
from checks.registry import check


@contextmanager
def scratch_schema(spark):
    """A schema whose tables lie in the shared folder, dropped with them when it has been read."""
    name = "casemill_" + uuid.uuid4().hex[:8]
    spark.sql(f"CREATE SCHEMA {name} LOCATION '{shared_folder(spark)}/{name}'")
    try:
        yield name
    finally:
        spark.sql(f"DROP SCHEMA {name} CASCADE")


@check("a01_list_tables", "SELECT * FROM (VALUES ('nation'), ('o2c')) t(table_name)")
def listed(spark, sf):
    with scratch_schema(spark) as schema:
        save_log(o2c(spark, sf)[0], f"{schema}.o2c")
        save_log(table(spark, sf, "nation"), f"{schema}.nation")
        return list_tables(spark, schema)


@check(
    "a03_describe_columns",
    """SELECT CAST(row_number() OVER () - 1 AS INTEGER) AS position, column_name AS "column",
  CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double'
    WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' END AS type
FROM (DESCRIBE SELECT * FROM lineitem)""",
)
def described(spark, sf):
    return describe_columns(table(spark, sf, "lineitem"))


@check("a02_discover_logs", "SELECT * FROM (VALUES ('o2c', 'traditional'), ('o2c_ocel_events', 'ocel')) t(table_name, kind)")
def discover(spark, sf):
    log, _ = o2c(spark, sf)
    with scratch_schema(spark) as schema:
        save_log(log, f"{schema}.o2c")
        save_ocel(ocel(spark, sf), f"{schema}.o2c")
        save_log(table(spark, sf, "nation"), f"{schema}.nation")
        return discover_logs(spark, schema)


@check(
    "a05_normalise_log",
    """SELECT user_id AS case_id, event_type AS activity,
       try_cast(CASE WHEN value > 90 THEN 'at ' || ts ELSE CAST(ts AS VARCHAR) END AS TIMESTAMP) AS event_timestamp,
       CASE WHEN event_type = 'error' THEN NULL ELSE round(value, 2) END AS cost
FROM events""",
)
def normalise(spark, sf):
    events = table(spark, sf, "events")
    foreign = events.select(
        F.col("user_id").alias("case_id"),
        F.col("event_type").alias("activity"),
        F.when(F.col("value") > 90, F.concat(F.lit("at "), F.col("ts").cast("string")))
        .otherwise(F.col("ts").cast("string"))
        .alias("event_timestamp"),
        F.when(F.col("event_type") == "error", "n/a").otherwise(F.round("value", 2).cast("string")).alias("cost"),
    )
    return normalise_log(foreign).withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp_ntz"))


@check(
    "a07_save_and_load_log",
    f"WITH {LOG_SQL} SELECT case_id, activity, event_timestamp, CAST(event_rank AS DOUBLE) AS event_rank, event_id FROM log",
)
def save_and_load(spark, sf):
    with scratch_schema(spark) as schema:
        save_log(o2c(spark, sf)[0], f"{schema}.o2c")
        log = load_log(spark, f"{schema}.o2c")
        return cut_lineage(log.select("case_id", "activity", "event_timestamp", "event_rank", "event_id"))


_YAML = """
event_log:
  name: order_to_cash
  output_table: mining.o2c
  sources:
    - table: orders
      case_id: o_orderkey
      key: [o_orderkey]
      events:
        - {activity: Create Order, timestamp: o_orderdate, cost: o_totalprice}
    - table: lineitem
      case_id: l_orderkey
      key: [l_orderkey, l_linenumber, l_partkey, l_suppkey]
      events:
        - {activity: SHIP_ITEM, timestamp: l_shipdate, resource: l_suppkey}
        - {activity: Return Item, timestamp: l_shipped, condition: l_returnflag = 'R'}
  enrichment:
    - {table: customer, join_key: o_custkey, ref_key: c_custkey, columns: [c_mktsegment]}
    - {table: nation, join_key: c_nationkey, ref_key: n_nationkey, columns: [n_name]}
"""


@check(
    "a10_check_config",
    """WITH n AS (SELECT count(*) FILTER (o_orderdate IS NULL) AS o FROM orders),
     l AS (SELECT count(*) FILTER (l_shipdate IS NULL) AS s FROM lineitem)
SELECT CAST(rule AS INTEGER) AS rule, source, passed, count(*) AS findings FROM (
  SELECT 1 AS rule, 'orders' AS source, true AS passed UNION ALL SELECT 1, 'lineitem', true
  UNION ALL SELECT 2, 'orders', true UNION ALL SELECT 2, 'lineitem', true UNION ALL SELECT 2, 'lineitem', false
  UNION ALL SELECT 3, 'orders', o = 0 FROM n UNION ALL SELECT 3, 'lineitem', s = 0 FROM l
  UNION ALL SELECT 4, 'orders', true UNION ALL SELECT 4, 'lineitem', false UNION ALL SELECT 4, 'lineitem', true
  UNION ALL SELECT 5, 'customer', true UNION ALL SELECT 5, 'nation', false
  UNION ALL SELECT 6, 'customer', true UNION ALL SELECT 6, 'nation', true
) GROUP BY ALL""",
)
def config_rules(spark, sf):
    found = check_config(spark, parse_config(_YAML), tables(spark, sf))
    return found.groupBy("rule", "source", "passed").agg(F.count(F.lit(1)).alias("findings"))


def _profile_sql(name: str, columns: dict[str, str]) -> str:
    parts = []
    for c, kind in columns.items():
        parts.append(
            f"""SELECT '{c}' AS "column", '{kind}' AS type, count(*) AS "rows", count(*) - count({c}) AS nulls,
  count(DISTINCT {c}) AS "distinct", CAST(min({c}) AS VARCHAR) AS "min", CAST(max({c}) AS VARCHAR) AS "max",
  (SELECT string_agg(v, ',' ORDER BY n DESC, v) FROM (
     SELECT CAST({c} AS VARCHAR) AS v, count(*) AS n FROM {name} WHERE {c} IS NOT NULL GROUP BY 1
     ORDER BY n DESC, v LIMIT 5)) AS samples FROM {name}"""
        )
    return " UNION ALL ".join(parts)


@check(
    "b01_profile_table",
    _profile_sql(
        "orders",
        {
            "o_orderkey": "bigint",
            "o_custkey": "bigint",
            "o_orderstatus": "string",
            "o_totalprice": "double",
            "o_orderdate": "timestamp_ntz",
            "o_orderpriority": "string",
        },
    ),
)
def profile(spark, sf):
    return profile_table(table(spark, sf, "orders"), exact=True).withColumn("samples", F.array_join("samples", ","))


@check(
    "b02_value_distribution",
    "SELECT l_partkey AS value, count(*) AS cnt FROM lineitem GROUP BY 1 ORDER BY cnt DESC, value LIMIT 20",
)
def distribution(spark, sf):
    return value_distribution(table(spark, sf, "lineitem"), "l_partkey")


_CLASSES = """SELECT * FROM (VALUES
  ('region', 'reference', false), ('nation', 'reference', false), ('customer', 'reference', false),
  ('supplier', 'reference', false), ('part', 'reference', false), ('orders', 'event source', true),
  ('lineitem', 'event source', false), ('events', 'existing event log', false),
  ('documents', 'not process data', false), ('embeddings', 'not process data', false),
  ('pages', 'not process data', false), ('benchmark', 'not process data', false),
  ('labels', 'not process data', false), ('conversations', 'not process data', false),
  ('raw_orders', 'duplicate', false), ('orders_by_status', 'aggregate', false), ('status_changes', 'cdc', false)
) t("table", class, snapshot)"""


@check("b03_classify_tables", _CLASSES)
def classes(spark, sf):
    t = tables(spark, sf)
    t["raw_orders"] = t["orders"]
    t["orders_by_status"] = t["orders"].groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("orders"))
    t["status_changes"] = t["lineitem"].select(
        "l_orderkey",
        F.col("l_linestatus").alias("old_status"),
        F.col("l_returnflag").alias("new_status"),
        F.col("l_shipdate").alias("changed_at"),
    )
    t["events"] = t["events"].withColumnsRenamed(
        {"user_id": "case_id", "event_type": "activity", "ts": "event_timestamp"}
    )
    return classify_tables(t).select("table", "class", "snapshot")


@check(
    "b11_column_roles",
    """SELECT 'o_orderkey' AS "column", 'key' AS role, round(count(DISTINCT o_orderkey) / count(*), 2) AS score FROM orders
UNION ALL SELECT 'o_custkey', 'key', round(count(DISTINCT o_custkey) / count(*), 2) FROM orders
UNION ALL SELECT * FROM (VALUES ('o_orderstatus', 'status', 1.0), ('o_totalprice', 'amount', 1.0),
  ('o_orderdate', 'timestamp', 1.0), ('o_orderpriority', 'document', 1.0)) v""",
)
def roles(spark, sf):
    return column_roles(table(spark, sf, "orders"), exact=True)


_KEYS = [
    ("orders", "o_orderkey", "lineitem", "l_orderkey"),
    ("orders", "o_custkey", "customer", "c_custkey"),
    ("lineitem", "l_partkey", "part", "p_partkey"),
    ("lineitem", "l_suppkey", "supplier", "s_suppkey"),
    ("customer", "c_nationkey", "nation", "n_nationkey"),
    ("supplier", "s_nationkey", "nation", "n_nationkey"),
    ("customer", "c_nationkey", "supplier", "s_nationkey"),
    ("nation", "n_regionkey", "region", "r_regionkey"),
]


def _key_sql(lt: str, lc: str, rt: str, rc: str) -> str:
    return f"""SELECT '{lt}' AS l_table, '{lc}' AS l_col, '{rt}' AS r_table, '{rc}' AS r_col,
  round(count(r.n) / count(*), 4) AS containment,
  CASE WHEN max(l.n) = 1 AND coalesce(max(r.n), 0) <= 1 THEN '1:1' WHEN max(l.n) = 1 THEN '1:N'
       WHEN coalesce(max(r.n), 0) <= 1 THEN 'N:1' ELSE 'N:M' END AS cardinality
FROM (SELECT {lc} AS k, count(*) AS n FROM {lt} WHERE {lc} IS NOT NULL GROUP BY 1) l
LEFT JOIN (SELECT {rc} AS k, count(*) AS n FROM {rt} WHERE {rc} IS NOT NULL GROUP BY 1) r USING (k)"""


@check(
    "b12_key_relationships",
    " UNION ALL ".join(_key_sql(*k) + " UNION ALL " + _key_sql(*k[2:], *k[:2]) for k in _KEYS),
)
def keys(spark, sf):
    return key_relationships(
        tables(spark, sf, "orders", "lineitem", "customer", "supplier", "part", "nation", "region")
    )


_PII_SQL = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"),
    ("phone", r"(\+[0-9]{1,3}[ .-]?)?\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}"),
    ("ssn", r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b"),
    ("card", r"\b[0-9]{4}[ -][0-9]{4}[ -][0-9]{4}[ -][0-9]{4}\b"),
    ("iban", r"\b[A-Z]{2}[0-9]{2}( ?[A-Z0-9]{4}){2,7}( ?[A-Z0-9]{1,3})?\b"),
    ("ip", r"\b[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\b"),
)
_DIGIT_SQL = "CAST(substr(regexp_replace(m, '[^0-9]', '', 'g'), 16 - i, 1) AS INTEGER)"
_CODES_SQL = """list_transform(string_split(substr(replace(m, ' ', ''), 5) || substr(m, 1, 4), ''),
    lambda c: CASE WHEN ascii(c) < 58 THEN ascii(c) - 48 ELSE ascii(c) - 55 END)"""
_VALID_SQL = {  # the rules of the numbers: check digit, area and group, 97-check, parts of an address
    "card": f"""list_sum(list_transform(range(16), lambda i: CASE WHEN i % 2 = 0 THEN {_DIGIT_SQL}
    WHEN {_DIGIT_SQL} > 4 THEN 2 * {_DIGIT_SQL} - 9 ELSE 2 * {_DIGIT_SQL} END)) % 10 = 0""",
    "ssn": "m[1:3] NOT IN ('000', '666') AND m[1] <> '9' AND m[5:6] <> '00' AND m[8:11] <> '0000'",
    "iban": f"""len(replace(m, ' ', '')) >= 15 AND list_reduce(list_prepend(0, {_CODES_SQL}),
    lambda a, b: (a * CASE WHEN b < 10 THEN 10 ELSE 100 END + b) % 97) = 1""",
    "ip": "list_max(list_transform(string_split(m, '.'), lambda p: CAST(p AS INTEGER))) <= 255",
}


def _pii_sql(column: str, kind: str, pattern: str) -> str:
    if kind not in _VALID_SQL:
        return f"regexp_matches({column}, '{pattern}')"
    return f"len(list_filter(regexp_extract_all({column}, '{pattern}'), lambda m: {_VALID_SQL[kind]})) > 0"


@check(
    "b13_pii_scan",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", '{kind}' AS kind, count({c}) AS "rows",
  count(*) FILTER ({_pii_sql(c, kind, pattern)}) AS hits,
  round(count(*) FILTER ({_pii_sql(c, kind, pattern)}) / count({c}), 4) AS rate FROM documents"""
        for c in ("text", "lang", "source")
        for kind, pattern in _PII_SQL
    ),
)
def pii(spark, sf):
    return pii_scan(table(spark, sf, "documents"))


@check(
    "b14_match_templates",
    f"""WITH {LOG_SQL}, seen AS (SELECT DISTINCT activity FROM log),
hits AS (SELECT count(*) FILTER (activity = 'Create Order') AS created, count(*) FILTER (activity = 'Ship Item') AS ship FROM seen)
SELECT template, CAST(steps AS INTEGER) AS steps, hits, round(hits / steps, 4) AS coverage FROM (
  SELECT 'procure_to_pay' AS template, 8 AS steps, 0 AS hits FROM hits
  UNION ALL SELECT 'order_to_cash', 7, created + ship FROM hits
  UNION ALL SELECT 'incident_management', 5, created FROM hits
  UNION ALL SELECT 'sales_pipeline', 8, 0 FROM hits
  UNION ALL SELECT 'patient_journey', 6, 0 FROM hits)""",
)
def templates(spark, sf):
    return match_templates(o2c(spark, sf)[0])


@check(
    "g14_load_ocel",
    f"WITH {OCEL_SQL} SELECT object_type, count(*) AS cnt FROM e2o GROUP BY 1",
)
def sibling_load(spark, sf):
    with scratch_schema(spark) as schema:
        save_ocel(ocel(spark, sf), f"{schema}.o2c")
        return cut_lineage(object_types(load_ocel(spark, f"{schema}.o2c_ocel_events")))
