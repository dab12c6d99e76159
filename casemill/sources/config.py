"""Event-log configuration: what to read, which events to take, what to add."""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass, field, replace

import yaml
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casemill.functions.columns import MANDATORY, METRICS, column


@dataclass(frozen=True)
class EventSpec:
    """One event type of a source; names are columns or SQL expressions over the source."""

    activity: str
    timestamp: str
    condition: str | None = None
    resource: str | None = None
    cost: str | None = None
    attributes: Mapping[str, str] = field(default_factory=dict)
    drop_null_ts: bool = True
    seq: int | None = None


@dataclass(frozen=True)
class SourceSpec:
    """One source table; ``key`` names the columns that identify a row (all columns when empty)."""

    table: str
    case_id: str
    events: tuple[EventSpec, ...]
    timezone: str = "UTC"
    key: tuple[str, ...] = ()
    carry: tuple[str, ...] = ()


@dataclass(frozen=True)
class EnrichmentSpec:
    """Columns to add from a reference table; ``ref_key`` is its key where the name differs."""

    table: str
    join_key: str
    columns: tuple[str, ...]
    ref_key: str | None = None
    prefix: str = ""


@dataclass(frozen=True)
class EventLogConfig:
    name: str
    output_table: str
    sources: tuple[SourceSpec, ...]
    activity_overrides: Mapping[str, str] = field(default_factory=dict)
    enrichment: tuple[EnrichmentSpec, ...] = ()

    def with_case_id(self, case_ids: Mapping[str, str]) -> EventLogConfig:
        """The same mapping with another case key per source table."""
        return replace(
            self, sources=tuple(replace(s, case_id=case_ids.get(s.table, s.case_id)) for s in self.sources)
        )

    def without_activity(self, activity: str) -> EventLogConfig:
        """The same mapping without one activity; source order numbers stay as they were."""
        numbered = number_events(self)
        kept = [replace(s, events=tuple(e for e in s.events if e.activity != activity)) for s in numbered.sources]
        return replace(numbered, sources=tuple(s for s in kept if s.events))

    def without_enrichment(self, table: str) -> EventLogConfig:
        """The same mapping without the columns of one reference table."""
        return replace(self, enrichment=tuple(e for e in self.enrichment if e.table != table))


def number_events(cfg: EventLogConfig) -> EventLogConfig:
    """Give every event its place in the configuration, which orders events of equal time."""
    at, sources = 0, []
    for source in cfg.sources:
        events = []
        for event in source.events:
            events.append(event if event.seq is not None else replace(event, seq=at))
            at += 1
        sources.append(replace(source, events=tuple(events)))
    return replace(cfg, sources=tuple(sources))


def parse_config(text: str) -> EventLogConfig:
    """Read the YAML form; a missing required entry raises with its name."""
    root = _need(yaml.safe_load(text) or {}, "event_log", "config")
    sources = tuple(
        SourceSpec(
            table=_need(s, "table", "source"),
            case_id=_need(s, "case_id", "source"),
            timezone=s.get("timezone", "UTC"),
            key=tuple(s.get("key", ())),
            events=tuple(
                EventSpec(
                    activity=_need(e, "activity", "event"),
                    timestamp=_need(e, "timestamp", "event"),
                    condition=e.get("condition"),
                    resource=e.get("resource"),
                    cost=e.get("cost"),
                    attributes=dict(e.get("attributes", {})),
                )
                for e in _need(s, "events", "source")
            ),
        )
        for s in _need(root, "sources", "event_log")
    )
    return EventLogConfig(
        name=_need(root, "name", "event_log"),
        output_table=_need(root, "output_table", "event_log"),
        sources=sources,
        activity_overrides=dict((root.get("standardization") or {}).get("activity_overrides") or {}),
        enrichment=tuple(
            EnrichmentSpec(
                table=_need(e, "table", "enrichment"),
                join_key=_need(e, "join_key", "enrichment"),
                columns=tuple(_need(e, "columns", "enrichment")),
                ref_key=e.get("ref_key"),
                prefix=e.get("prefix", ""),
            )
            for e in root.get("enrichment") or ()
        ),
    )


def load_config(path: str) -> EventLogConfig:
    """Read a YAML configuration file."""
    with open(path, encoding="utf-8") as handle:
        return parse_config(handle.read())


def _need(entry: Mapping, name: str, where: str):
    if entry.get(name) in (None, "", []):
        raise ValueError(f"{where}: '{name}' is required")
    return entry[name]


def table_of(spark: SparkSession, tables: Mapping[str, DataFrame] | None, name: str) -> DataFrame:
    """A table by name from the given frames, or from the catalog."""
    return tables[name] if tables is not None and name in tables else spark.table(name)


def check_config(
    spark: SparkSession, cfg: EventLogConfig, tables: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    """(rule, source, passed, detail): the six configuration rules against the real tables.

    1 the case key exists and groups rows or occurs in several sources; 2 activity and timestamp are given and
    readable; 3 a nullable timestamp has a condition that excludes the nulls; 4 activity names read like text;
    5 an enrichment key can reach the log and exists in the reference; 6 enrichment columns are new.
    """
    rows: list[tuple[int, str, bool, str]] = []
    sources = [(s, table_of(spark, tables, s.table)) for s in cfg.sources]
    for source, df in sources:
        try:
            column_type = df.select(column(df, source.case_id)).schema[0].dataType.simpleString()
            others = [(s, d) for s, d in sources if s is not source]
            useful = _groups_rows(df, source) or any(_share_a_case(df, source, d, s) for s, d in others)
            rows.append((1, source.table, useful, f"{source.case_id}: {column_type}"))
        except Exception as error:  # an unreadable expression is the finding itself
            rows.append((1, source.table, False, str(error).splitlines()[0]))
            continue
        readable = []
        for event in source.events:
            try:
                kind = df.select(column(df, event.timestamp)).schema[0].dataType.typeName()
                good = kind in ("timestamp", "timestamp_ntz", "date", "string")
                rows.append((2, source.table, good, f"{event.activity}: {event.timestamp} is {kind}"))
                readable += [event] if good else []
            except Exception as error:
                rows.append((2, source.table, False, str(error).splitlines()[0]))
        counts = [
            F.count_if(
                column(df, e.timestamp).isNull() & (F.expr(e.condition) if e.condition else F.lit(True))
            ).alias(f"n{i}")
            for i, e in enumerate(readable)
        ]
        if counts:
            nulls = df.agg(*counts).first()
            for i, event in enumerate(readable):
                rows.append((3, source.table, nulls[i] == 0, f"{event.activity}: {nulls[i]} null timestamps"))
        for event in source.events:
            name = cfg.activity_overrides.get(event.activity, event.activity)
            rows.append((4, source.table, is_readable_name(name), name))
    reachable = {c for s, df in sources for c in df.columns} | {c for c in log_columns(cfg)}
    taken = set(log_columns(cfg))
    for enrichment in cfg.enrichment:
        ref = table_of(spark, tables, enrichment.table)
        missing = [enrichment.join_key] if enrichment.join_key not in reachable else []
        wanted = (enrichment.ref_key or enrichment.join_key, *enrichment.columns)
        missing += [c for c in wanted if c not in ref.columns]
        rows.append((5, enrichment.table, not missing, f"missing: {', '.join(missing)}" if missing else enrichment.join_key))
        names = [enrichment.prefix + c for c in enrichment.columns]
        clash = [c for c in names if c in taken]
        rows.append((6, enrichment.table, not clash, f"already there: {', '.join(clash)}" if clash else ", ".join(names)))
        taken |= set(names)
        reachable |= set(names)
    return spark.createDataFrame(rows, "rule int, source string, passed boolean, detail string")


def _groups_rows(df: DataFrame, source: SourceSpec) -> bool:
    """Can a case have several events of this source?"""
    if len(source.events) > 1:
        return True
    keys = df.select(column(df, source.case_id).alias("_k")).where(F.col("_k").isNotNull())
    return not keys.groupBy("_k").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1).isEmpty()


def _share_a_case(df: DataFrame, source: SourceSpec, other: DataFrame, spec: SourceSpec) -> bool:
    """Does a case of one source occur in the other?"""
    try:
        theirs = other.select(column(other, spec.case_id).cast("string").alias("_k"))
    except AnalysisException:  # rule 1 of the other source says so
        return False
    mine = df.select(column(df, source.case_id).cast("string").alias("_k"))
    return not mine.join(theirs, "_k", "left_semi").isEmpty()


def is_readable_name(name: str) -> bool:
    """Is this activity name for people ("Create Purchase Order"), not a code ("PO_CREATED")?"""
    return bool(re.search(r"[A-Za-z]", name)) and "_" not in name and not re.fullmatch(r"[A-Z0-9.\-]{2,}", name)


def log_columns(cfg: EventLogConfig) -> list[str]:
    """Columns of the log before enrichment."""
    attributes = [a for s in cfg.sources for e in s.events for a in e.attributes]
    carried = [c for s in cfg.sources for c in s.carry]
    base = [*MANDATORY, "resource", "department", "source_system", "cost", "source_seq", "event_id", *METRICS]
    return list(dict.fromkeys([*base, *attributes, *carried]))
