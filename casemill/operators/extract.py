"""From source tables to events."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casemill.functions.columns import ACTIVITY, CASE, TIMESTAMP, as_timestamp, column, event_id, micros, type_of
from casemill.operators.joins import balanced_join, fits_broadcast
from casemill.operators.ordering import CaseLoad, measure_cases, neighbours
from casemill.session import cut_lineage
from casemill.sources.config import EventSpec, SourceSpec


def _moment(df: DataFrame, event: EventSpec, timezone: str) -> Column:
    """The event's time in UTC, of the type it has in the source."""
    ts = as_timestamp(df, event.timestamp)
    if timezone.upper() in ("UTC", "ETC/UTC", "Z"):
        return ts
    kind = type_of(df, event.timestamp)
    return F.to_utc_timestamp(ts.cast("timestamp"), timezone).cast(kind if kind.startswith("timestamp") else "timestamp")


def _pick(values: Sequence[Column], texts: Sequence[str]) -> Column:
    """The value of event number ``_i``; one plain expression where all events share it."""
    if len(set(texts)) == 1:
        return values[0]
    choice = F.when(F.col("_i") == 0, values[0])
    for i, value in enumerate(values[1:], start=1):
        choice = choice.when(F.col("_i") == i, value)
    return choice


def _event_fields(df: DataFrame, source: SourceSpec, attributes: Sequence[str]) -> dict[str, Column]:
    events = source.events

    def mapped(texts: Sequence[str | None], kind: str, default: Column | None = None) -> Column:
        missing = F.lit(None) if default is None else default
        values = [(column(df, t) if t else missing).cast(kind) for t in texts]
        return _pick(values, [t or "" for t in texts])

    fields = {
        ACTIVITY: _pick([F.lit(e.activity) for e in events], [e.activity for e in events]),
        TIMESTAMP: _pick([_moment(df, e, source.timezone) for e in events], [e.timestamp for e in events]),
        "resource": mapped([e.resource for e in events], "string"),
        "department": mapped([e.attributes.get("department") for e in events], "string"),
        "source_system": mapped([e.attributes.get("source_system") for e in events], "string", F.lit(source.table)),
        "cost": mapped([e.cost for e in events], "double"),
        "source_seq": _pick([F.lit(e.seq or 0) for e in events], [str(e.seq or 0) for e in events]),
    }
    for name in attributes:
        if name not in fields:
            fields[name] = mapped([e.attributes.get(name) for e in events], _attribute_type(df, source, name))
    return fields


def _attribute_type(df: DataFrame, source: SourceSpec, name: str) -> str:
    """The type an attribute has in the events that map it (text where they differ)."""
    kinds = {
        type_of(df, e.attributes[name])
        for e in source.events
        if name in e.attributes
    }
    return kinds.pop() if len(kinds) == 1 else "string"


def _row_id(df: DataFrame, source: SourceSpec) -> list[Column]:
    """What names a row: its key, or else 128 bits of hashes of all its columns (rows that are equal share them, see
    ``_with_copies``)."""
    if source.key:
        return [column(df, k) for k in source.key]
    fields = [(f"`{f.name}`", "map" in f.dataType.simpleString()) for f in df.schema.fields]
    values = [F.col(name).cast("string") if is_map else F.col(name) for name, is_map in fields]
    return [F.xxhash64(*values), F.xxhash64(F.lit(1), *values)]


def _with_copies(df: DataFrame, ids: list[Column]) -> DataFrame:
    """``df`` with ``_copy``, the number of a row among the rows that are equal to it, from 0.

    Hashes that occur more than once are counted at call time; without any, nothing else is done. Rows that have one are
    numbered within the partition they are read in, and partitions are told where to begin by their counts, so equal rows
    are never gathered. They are interchangeable: whichever gets a number, the rows with their numbers are the same.
    """
    names = ["_h1", "_h2"]
    hashed = df.withColumns(dict(zip(names, ids)))
    repeated = hashed.groupBy(*names).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(*names)
    repeated = cut_lineage(repeated)
    if repeated.isEmpty():
        return df.withColumn("_copy", F.lit(0).cast("long"))
    if fits_broadcast(repeated):
        repeated = F.broadcast(repeated)
    placed = hashed.withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id()})
    copies = cut_lineage(placed.join(repeated, names, "left_semi"))
    earlier = Window.partitionBy(*names).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = copies.groupBy(*names, "_part").agg(F.count(F.lit(1)).alias("_n"))
    counts = counts.select(*names, "_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    here = F.row_number().over(Window.partitionBy(*names, "_part").orderBy("_at")) - 1
    copies = copies.withColumn("_here", here).join(counts, [*names, "_part"])
    copies = copies.withColumn("_copy", F.col("_here") + F.col("_before"))
    single = hashed.join(repeated, names, "left_anti").withColumn("_copy", F.lit(0).cast("long"))
    return single.unionByName(copies.select(*single.columns)).drop(*names)


def extract_source(df: DataFrame, source: SourceSpec, keep_null_ts: bool = False) -> DataFrame:
    """All events of a source in one scan: each row is repeated for the events it stands for.

    Only the event numbers are exploded and the event columns are chosen by number, so a query that needs
    few of them reads few source columns. Conditions and the null-timestamp guard are applied per event.
    ``keep_null_ts`` leaves rows without a time in place, which is what the mapping test counts. A source without a key is
    searched for equal rows at call time, whose events get ids of their own.
    """
    row_id = _row_id(df, source)
    if not source.key and not keep_null_ts:
        df = _with_copies(df, row_id)
        row_id = [*row_id, F.when(F.col("_copy") > 0, F.concat(F.lit("#"), F.col("_copy")))]
    attributes = list(dict.fromkeys(a for e in source.events for a in e.attributes))
    wanted = []
    for event in source.events:
        holds = F.expr(event.condition) if event.condition else F.lit(True)
        if event.drop_null_ts and not keep_null_ts:
            holds = holds & as_timestamp(df, event.timestamp).isNotNull()
        wanted.append(holds)
    if len(wanted) == 1:
        rows = df.where(wanted[0])
    else:
        numbers = F.array(*[F.when(holds, F.lit(i)) for i, holds in enumerate(wanted)])
        rows = df.withColumn("_i", F.explode(numbers)).where(F.col("_i").isNotNull())
    fields = _event_fields(df, source, attributes)
    named = [F.coalesce(p.cast("string"), F.lit("~")) for p in row_id[: len(source.key) or 2]]
    row_key = F.concat_ws("|", *named, *row_id[len(named) :])  # only copies have a number after the hashes
    return rows.select(
        column(df, source.case_id).alias(CASE),
        *[value.alias(name) for name, value in fields.items()],
        event_id(F.lit(source.table), fields["source_seq"], row_key).alias("event_id"),
        *[F.col(f"`{c}`") for c in source.carry],
    )


def extract_event(df: DataFrame, case_id: str, event: EventSpec, table: str = "source", key: Sequence[str] = ()) -> DataFrame:
    """One event type of one table."""
    return extract_source(df, SourceSpec(table, case_id, (event,), key=tuple(key)))


def union_events(parts: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by column name; columns a part lacks are null, keys of different types become text."""
    kinds: dict[str, set[str]] = {}
    for part in parts:
        for name, kind in part.dtypes:
            kinds.setdefault(name, set()).add(kind)
    mixed = {n for n, k in kinds.items() if len(k) > 1 and "string" in k or (n == CASE and len(k) > 1)}
    aligned = [
        p.withColumns({n: F.col(f"`{n}`").cast("string") for n in p.columns if n in mixed}) if mixed else p
        for p in parts
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), aligned)


def standardise_activities(log: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Raw activity names to canonical ones; names without a mapping stay."""
    if not mapping:
        return log
    table = F.create_map(*[F.lit(v) for pair in mapping.items() for v in pair])
    return log.withColumn(ACTIVITY, F.coalesce(table[F.col(ACTIVITY)], F.col(ACTIVITY)))


def snapshot_events(df: DataFrame, key: str, activities: Mapping[str, str], table: str = "snapshot") -> DataFrame:
    """One event per filled timestamp column of a one-row-per-entity table."""
    events = tuple(EventSpec(activity, ts, seq=i) for i, (activity, ts) in enumerate(activities.items()))
    return extract_source(df, SourceSpec(table, key, events, key=(key,)))


def snapshot_stages(
    df: DataFrame, key: str, start: str, end: str, stage: str, stages: Sequence[str], as_of: str | None = None
) -> DataFrame:
    """Stage events of a snapshot, spaced evenly between start and end (an approximation, marked as such).

    A row at stage k emits stages 0..k. Open rows end at ``as_of``. An end before the start is moved to the
    start and flagged. Rows with an unknown stage or without a start emit nothing (see ``unknown_stages``).
    """
    begin = as_timestamp(df, start)
    finish = as_timestamp(df, end)
    if as_of is not None:
        finish = F.coalesce(finish, F.lit(as_of).cast(df.select(finish.alias("v")).schema["v"].dataType))
    reached = F.array_position(F.array(*[F.lit(s) for s in stages]), column(df, stage).cast("string"))
    rows = (
        df.select(
            column(df, key).alias(CASE),
            micros(begin).alias("_a"),
            micros(finish).alias("_z"),
            (reached - 1).alias("_k"),
            begin.alias("_begin"),
        )
        .where((F.col("_k") >= 0) & F.col("_a").isNotNull())
        .withColumn("bad_interval", F.coalesce(F.col("_z") < F.col("_a"), F.lit(False)))
        .withColumn("_z", F.greatest("_a", F.coalesce("_z", "_a")))
    )
    names = F.slice(F.array(*[F.lit(s) for s in stages]), F.lit(1), (F.col("_k") + 1).cast("int"))
    rows = rows.select("*", F.posexplode(names).alias("source_seq", ACTIVITY))
    step = F.when(F.col("_k") == 0, F.lit(0)).otherwise(
        F.expr("(_z - _a) * source_seq div greatest(_k, 1)")
    )
    kind = df.select(begin.alias("v")).schema["v"].dataType.simpleString()
    return rows.select(
        CASE,
        ACTIVITY,
        F.timestamp_micros(F.col("_a") + step).cast(kind).alias(TIMESTAMP),
        "source_seq",
        ((F.col("source_seq") > 0) & (F.col("source_seq") < F.col("_k"))).alias("is_approximate"),
        "bad_interval",
    )


def unknown_stages(df: DataFrame, stage: str, stages: Sequence[str]) -> DataFrame:
    """(stage, rows): current stages that are not in the list."""
    value = column(df, stage).cast("string")
    return (
        df.where(value.isNull() | ~value.isin(list(stages)))
        .groupBy(value.alias("stage"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def cdc_events(
    df: DataFrame,
    key: str,
    ts: str,
    value: str,
    keep: Sequence[str] | None = None,
    tie: Sequence[str] = (),
    load: CaseLoad | None = None,
) -> DataFrame:
    """Change records to events: a row whose value differs from the key's previous one (the first one counts)."""
    rows = df.select(
        column(df, key).alias(CASE),
        column(df, value).cast("string").alias(ACTIVITY),
        as_timestamp(df, ts).alias(TIMESTAMP),
        *[F.col(f"`{c}`") for c in tie],
    ).where(F.col(CASE).isNotNull() & F.col(TIMESTAMP).isNotNull())
    order = [TIMESTAMP, *(tie or [ACTIVITY])]
    load = load or measure_cases(rows)
    seen = neighbours(rows, [CASE], order, [ACTIVITY], load)
    first = F.col("_rank") == 1
    events = seen.where(first | ~F.col(ACTIVITY).eqNullSafe(F.col("_prev_activity")))
    if keep is not None:
        events = events.where(F.col(ACTIVITY).isin(list(keep)))
    return events.select(CASE, ACTIVITY, TIMESTAMP, F.col("_prev_activity").alias("previous"), *tie)


def cdc_pair_events(df: DataFrame, key: str, ts: str, old: str, new: str, keep: Sequence[str] | None = None) -> DataFrame:
    """Change records that carry old and new value: rows where they differ, nulls compared as values."""
    before, after = column(df, old).cast("string"), column(df, new).cast("string")
    events = df.where(~before.eqNullSafe(after))
    if keep is not None:
        events = events.where(after.isin(list(keep)))
    return events.select(
        column(df, key).alias(CASE), after.alias(ACTIVITY), as_timestamp(df, ts).alias(TIMESTAMP), before.alias("previous")
    )


def history_events(
    df: DataFrame, case_id: str, activity: str, ts: str, codes: Mapping[str, str] | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """A table that already has one row per event; ``codes`` turns status codes into names."""
    events = df.select(
        column(df, case_id).alias(CASE),
        column(df, activity).cast("string").alias(ACTIVITY),
        as_timestamp(df, ts).alias(TIMESTAMP),
        *[F.col(f"`{c}`") for c in keep],
    )
    return standardise_activities(events, codes or {})


def mapping_stats(df: DataFrame, source: SourceSpec, as_of: str | None = None) -> DataFrame:
    """Test a mapping: per activity the rows, gaps, time range, cases and rows later than ``as_of`` (default now)."""
    rows = extract_source(df, source, keep_null_ts=True)
    now = F.lit(as_of).cast("timestamp") if as_of else F.current_timestamp()
    return rows.groupBy(F.lit(source.table).alias("source"), "source_seq", ACTIVITY).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col(CASE).isNull()).alias("null_case_ids"),
        F.count_if(F.col(TIMESTAMP).isNull()).alias("null_timestamps"),
        F.min(TIMESTAMP).alias("first_timestamp"),
        F.max(TIMESTAMP).alias("last_timestamp"),
        F.count_distinct(F.col(CASE)).alias("cases"),
        F.count_if(F.col(TIMESTAMP).cast("timestamp") > now).alias("rows_in_future"),
    )


def resolve_case(events: DataFrame, link: DataFrame, on: str, case_id: str, how: str = "inner") -> DataFrame:
    """Give events of another document the case key of a link table.

    An event appears once per linked case. ``how="left"`` keeps events without a link, with a null case.
    """
    pairs = link.where(F.col(f"`{on}`").isNotNull() & F.col(f"`{case_id}`").isNotNull())
    pairs = pairs.select(F.col(f"`{on}`").alias("_link"), F.col(f"`{case_id}`").alias("_case")).distinct()
    joined = balanced_join(events.drop(CASE) if on != CASE else events, pairs, [(on, "_link")], how)
    return joined.withColumn(CASE, F.col("_case")).drop("_case")
