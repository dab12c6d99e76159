"""The build of a log as SQL text, to be read, changed and run by hand."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from casemill.functions.columns import ACTIVITY, CASE, METRICS, TIMESTAMP, type_of
from casemill.plans.build import Tables, propose_enrichments, raw_events, sources_with_keys
from casemill.sources.config import EventLogConfig, EventSpec, SourceSpec, table_of


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _name(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def _table(name: str) -> str:
    return ".".join(_name(part) for part in name.split("."))


def _value(df: DataFrame, text: str) -> str:
    """A column by name, or else the expression."""
    return _name(text) if text in df.columns else f"({text})"


def _moment(df: DataFrame, event: EventSpec, timezone: str) -> str:
    value, kind = _value(df, event.timestamp), type_of(df, event.timestamp)
    if kind == "string":
        value = f"try_to_timestamp({value})"
    elif kind == "date":
        value = f"CAST({value} AS TIMESTAMP_NTZ)"
    if timezone.upper() in ("UTC", "ETC/UTC", "Z"):
        return value
    into = kind if kind.startswith("timestamp") else "timestamp"
    return f"CAST(to_utc_timestamp(CAST({value} AS TIMESTAMP), {_text(timezone)}) AS {into})"


def _rows(df: DataFrame, source: SourceSpec) -> tuple[str, list[str]]:
    """(what the events are selected from, the parts that name a row): rows without a key are named by their hashes, and equal
    ones numbered."""
    if source.key:
        return _table(source.table), [_value(df, k) for k in source.key]
    fields = [f"CAST({_name(f.name)} AS STRING)" if "map" in f.dataType.simpleString() else _name(f.name) for f in df.schema.fields]
    one, two = f"xxhash64({', '.join(fields)})", f"xxhash64(1, {', '.join(fields)})"
    numbered = f"row_number() OVER (PARTITION BY {one}, {two} ORDER BY {one}) - 1"
    rows = f"(SELECT *, {one} AS _h1, {two} AS _h2, {numbered} AS _copy FROM {_table(source.table)})"
    return rows, ["_h1", "_h2"]


def _extraction(df: DataFrame, source: SourceSpec, event: EventSpec, activity: str, kinds: dict[str, str]) -> str:
    """One SELECT of the events of one kind; columns that the source does not have are null."""
    rows, key = _rows(df, source)
    named = [_text(source.table), str(event.seq or 0), *key]
    parts = [f"coalesce(CAST({p} AS STRING), '~')" for p in named]
    if not source.key:
        parts.append("CASE WHEN _copy > 0 THEN concat('#', _copy) END")
    values = {
        CASE: _value(df, source.case_id),
        ACTIVITY: _text(activity),
        TIMESTAMP: _moment(df, event, source.timezone),
        "source_system": _text(source.table),
        "source_seq": str(event.seq or 0),
        "event_id": f"concat_ws('|', {', '.join(parts)})",
        **{c: _name(c) for c in source.carry},
        **{n: _value(df, t) for n, t in event.attributes.items()},
    }
    for column, text in (("resource", event.resource), ("cost", event.cost)):
        if text:
            values[column] = _value(df, text)
    columns = ",\n    ".join(f"CAST({values.get(c, 'NULL')} AS {kind}) AS {_name(c)}" for c, kind in kinds.items())
    keep = [f"({event.condition})"] if event.condition else []
    keep += [f"{values[TIMESTAMP]} IS NOT NULL"] if event.drop_null_ts else []
    where = f"\n  WHERE {' AND '.join(keep)}" if keep else ""
    return f"  SELECT\n    {columns}\n  FROM {rows}{where}"


def build_script(
    spark: SparkSession, cfg: EventLogConfig, tables: Tables = None, create: bool = False, rates: bool = False
) -> str:
    """One SQL statement that gives the log of ``build_event_log``: the extractions united, every enrichment joined, the metrics
    by windows. ``create`` puts CREATE OR REPLACE TABLE before it; ``rates`` measures how well each enrichment matches and says
    so in comments. Only schemas are read otherwise."""
    raw = raw_events(spark, cfg, tables)
    kinds = dict(raw.dtypes)
    selects = [
        _extraction(table_of(spark, tables, s.table), s, e, cfg.activity_overrides.get(e.activity, e.activity), kinds)
        for s in sources_with_keys(spark, cfg, tables)
        for e in s.events
    ]
    united = "\n  UNION ALL\n".join(selects)
    steps, at = [f"events AS (\n{united}\n)"], "events"
    matched = [r.asDict() for r in propose_enrichments(spark, cfg, tables).collect()] if rates and cfg.enrichment else []
    columns = list(kinds)
    for i, e in enumerate(cfg.enrichment):
        key = _name(e.ref_key or e.join_key)
        taken = ", ".join(f"{_name(c)} AS {_name(e.prefix + c)}" for c in e.columns)
        note = f"-- {matched[i]['matched']} of {matched[i]['rows']} events match {e.table} ({matched[i]['pct']} %)\n" if matched else ""
        columns += [e.prefix + c for c in e.columns]
        steps.append(
            f"{note}enriched_{i + 1} AS (\n  SELECT {', '.join(map(_name, columns))}\n  FROM {at}\n"
            f"  LEFT JOIN (SELECT {key} AS _key, {taken} FROM {_table(e.table)} WHERE {key} IS NOT NULL) AS ref\n"
            f"  ON {at}.{_name(e.join_key)} = ref._key\n)"
        )
        at = f"enriched_{i + 1}"
    seconds = f"unix_timestamp(CAST({TIMESTAMP} AS TIMESTAMP))"
    before = f"unix_timestamp(CAST(lag({TIMESTAMP}) OVER in_order AS TIMESTAMP))"
    known = f"CASE WHEN {CASE} IS NOT NULL THEN "
    metrics = (f"CAST({known}row_number() OVER in_order END AS INT)", f"{known}{seconds} - {before} END", f"{known}count(*) OVER whole END")
    shown = [_name(c) for c in columns if c not in ("source_seq", "event_id")]
    shown += [f"{m} AS {name}" for m, name in zip(metrics, METRICS)] + ["source_seq", "event_id"]
    case = f"PARTITION BY {CASE}, CASE WHEN {CASE} IS NULL THEN xxhash64({TIMESTAMP}, source_seq, event_id) END"
    head = f"CREATE OR REPLACE TABLE {_table(cfg.output_table)} AS\n" if create else ""
    return (
        head + "WITH " + ",\n".join(steps) + "\nSELECT\n  " + ",\n  ".join(shown) + f"\nFROM {at}\n"
        f"WINDOW in_order AS ({case} ORDER BY {TIMESTAMP}, source_seq, event_id),\n  whole AS ({case})"
    )
