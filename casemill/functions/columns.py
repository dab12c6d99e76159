"""Column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CASE, ACTIVITY, TIMESTAMP = "case_id", "activity", "event_timestamp"
MANDATORY = (CASE, ACTIVITY, TIMESTAMP)
METRICS = ("event_rank", "time_since_prev_seconds", "case_event_count")


def column(df: DataFrame, text: str) -> Column:
    """A column by name, or else a SQL expression over the columns."""
    return F.col(f"`{text}`") if text in df.columns else F.expr(text)


def type_of(df: DataFrame, text: str) -> str:
    """The type of a column or expression; a plain column needs no analysis of a new plan."""
    if text in df.columns:
        return df.schema[text].dataType.simpleString()
    return df.select(F.expr(text).alias("v")).schema["v"].dataType.simpleString()


def order_columns(df: DataFrame) -> list[str]:
    """The order of events within a case: time, then source order, then event id (activity where no id exists)."""
    tail = [c for c in ("source_seq", "event_id") if c in df.columns]
    if "event_id" not in tail:
        tail.append(ACTIVITY)
    return [TIMESTAMP, *tail]


def mining_order(log: DataFrame) -> list[str]:
    """An order that gives the same activity sequences as ``order_columns`` without sorting event ids.

    ``source_seq`` numbers the event definitions, so events equal in time and number have the same activity
    and may change places.
    """
    return [TIMESTAMP, "source_seq", ACTIVITY] if "source_seq" in log.columns else order_columns(log)


def usable(log: DataFrame) -> DataFrame:
    """Events the mining operators can place: case, activity and time are all known."""
    return log.where(F.col(CASE).isNotNull() & F.col(ACTIVITY).isNotNull() & F.col(TIMESTAMP).isNotNull())


def micros(ts: Column | str) -> Column:
    """Microseconds since 1970 (the session runs in UTC)."""
    return F.unix_micros((F.col(ts) if isinstance(ts, str) else ts).cast("timestamp"))


def whole_seconds(ts: Column | str) -> Column:
    """Whole Unix seconds, rounded down."""
    return F.unix_timestamp((F.col(ts) if isinstance(ts, str) else ts).cast("timestamp"))


def as_timestamp(df: DataFrame, text: str) -> Column:
    """A timestamp from a timestamp, date or text column; unreadable text becomes null."""
    value = column(df, text)
    kind = type_of(df, text)
    if kind == "string":
        return F.try_to_timestamp(value)
    if kind == "date":
        return value.cast("timestamp_ntz")
    return value


def normalise_key(key: Column | str) -> Column:
    """Key text without case and outer blanks, so that typing variants meet."""
    return F.upper(F.trim((F.col(key) if isinstance(key, str) else key).cast("string")))


def event_id(*parts: Column) -> Column:
    """Parts joined by a bar; a null part stays visible so that ids keep their arity."""
    return F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("~")) for p in parts])


def variant_label(variant: Column | str, shown: int = 3) -> Column:
    """The first activities of a variant, with dots when there are more."""
    v = F.col(variant) if isinstance(variant, str) else variant
    return F.concat(F.array_join(F.slice(v, 1, shown), " -> "), F.when(F.size(v) > shown, "...").otherwise(""))


def share_pct(part: Column, whole: Column) -> Column:
    """Percentage with one decimal; null for an empty whole."""
    return F.round(F.when(whole > 0, part * 100.0 / whole), 1)
