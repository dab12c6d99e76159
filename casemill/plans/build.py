"""Build a log from its configuration, and propose one before building."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casemill.functions.columns import METRICS
from casemill.operators.enrich import enrich, match_rate
from casemill.operators.extract import extract_source, mapping_stats, standardise_activities, union_events
from casemill.operators.joins import MEASURE, measure_hot_keys
from casemill.operators.metrics import add_metrics
from casemill.operators.ordering import MAX_TASK_EVENTS, CaseLoad, measure_cases
from casemill.sources.config import EventLogConfig, SourceSpec, number_events, table_of

Tables = Mapping[str, DataFrame] | None


def event_bound(spark: SparkSession, cfg: EventLogConfig, tables: Tables = None) -> int:
    """An upper bound of the number of events, from the row counts of the source tables."""
    return sum(table_of(spark, tables, s.table).count() * len(s.events) for s in cfg.sources)


def log_load(spark: SparkSession, cfg: EventLogConfig, tables: Tables = None) -> CaseLoad:
    """How the events of a configured log spread over its cases."""
    names = {cfg.activity_overrides.get(e.activity, e.activity) for s in cfg.sources for e in s.events}
    bound = event_bound(spark, cfg, tables)
    if bound <= MAX_TASK_EVENTS:
        return CaseLoad(bound, activities=len(names))
    return measure_cases(raw_events(spark, cfg, tables), activities=len(names))


def sources_with_keys(spark: SparkSession, cfg: EventLogConfig, tables: Tables) -> list[SourceSpec]:
    """Sources that also bring along the keys which enrichments need and the log does not have."""
    sources = []
    for source in number_events(cfg).sources:
        df = table_of(spark, tables, source.table)
        mapped = {a for e in source.events for a in e.attributes} | {"resource", "cost", "department", "case_id"}
        extra = [
            e.join_key
            for e in cfg.enrichment
            if e.join_key in df.columns and e.join_key not in mapped and e.join_key not in source.carry
        ]
        sources.append(replace(source, carry=tuple(dict.fromkeys([*source.carry, *extra]))))
    return sources


def raw_events(spark: SparkSession, cfg: EventLogConfig, tables: Tables = None) -> DataFrame:
    """All events of all sources, with canonical activity names, before enrichment and metrics."""
    sources = sources_with_keys(spark, cfg, tables)
    events = union_events([extract_source(table_of(spark, tables, s.table), s) for s in sources])
    return standardise_activities(events, cfg.activity_overrides)


def build_event_log(
    spark: SparkSession, cfg: EventLogConfig, tables: Tables = None, load: CaseLoad | None = None
) -> DataFrame:
    """Extract, unite, enrich and add metrics; ``tables`` replaces catalog tables by name.

    Where the log is larger than what a task may hold, the hot keys of all enrichments are found in one scan of the events;
    only keys that an enrichment brings along are measured later.
    """
    events = raw_events(spark, cfg, tables)
    load = load or log_load(spark, cfg, tables)
    keys = [e.join_key for e in cfg.enrichment if e.join_key in events.columns]
    hot = measure_hot_keys(events, keys, load.events, load.max_task_events)
    for e in cfg.enrichment:
        ref = table_of(spark, tables, e.table)
        known = hot.get(e.join_key, None if load.small else MEASURE)
        events = enrich(events, ref, {e.join_key: e.ref_key or e.join_key}, e.columns, e.prefix, hot=known)
    log = add_metrics(events, load=load)
    first = [c for c in log.columns if c not in METRICS and c not in ("source_seq", "event_id")]
    return log.select(*first, *METRICS, "source_seq", "event_id")


def propose_events(
    spark: SparkSession, cfg: EventLogConfig, tables: Tables = None, as_of: str | None = None
) -> DataFrame:
    """The mapping as a table, with the tested numbers: what a person confirms before the build."""
    parts = []
    for source in number_events(cfg).sources:
        stats = mapping_stats(table_of(spark, tables, source.table), source, as_of)
        texts = [
            F.struct(
                F.lit(e.seq).alias("_seq"),
                F.lit(source.case_id).alias("case_id"),
                F.lit(e.timestamp).alias("timestamp"),
                F.lit(e.condition or "").alias("condition"),
            )
            for e in source.events
        ]
        at = F.element_at(F.filter(F.array(*texts), lambda t: t["_seq"] == F.col("source_seq")), 1)
        shown = ["source", "activity", "_t.case_id", "_t.timestamp", "_t.condition"]
        numbers = ["rows", "null_case_ids", "null_timestamps", "cases", "rows_in_future"]
        parts.append(stats.withColumn("_t", at).select(*shown, *numbers))
    return reduce(DataFrame.unionByName, parts)


def propose_enrichments(spark: SparkSession, cfg: EventLogConfig, tables: Tables = None) -> DataFrame:
    """(table, join_key, rows, matched, pct, columns) for every enrichment of the configuration."""
    events = raw_events(spark, cfg, tables)
    parts = []
    for e in cfg.enrichment:
        rate = match_rate(events, table_of(spark, tables, e.table), {e.join_key: e.ref_key or e.join_key})
        parts.append(
            rate.select(
                F.lit(e.table).alias("table"),
                F.lit(e.join_key).alias("join_key"),
                "rows",
                "matched",
                "pct",
                F.lit(", ".join(e.prefix + c for c in e.columns)).alias("columns"),
            )
        )
        if e is not cfg.enrichment[-1]:  # a later key may come from an earlier enrichment
            ref = table_of(spark, tables, e.table)
            events = enrich(events, ref, {e.join_key: e.ref_key or e.join_key}, e.columns, e.prefix)
    return reduce(DataFrame.unionByName, parts)
