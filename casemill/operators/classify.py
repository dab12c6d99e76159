"""Which tables hold events, which describe them, and which to leave out."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casemill.functions.patterns import (
    ACTIVITY_NAMES,
    CASE_NAMES,
    ID_PATTERN,
    OLD_NEW_PATTERNS,
    STATUS_PATTERN,
    TABLE_PREFIXES,
    TIMESTAMP_NAMES,
    bare_name,
)

_TIMES = ("timestamp", "timestamp_ntz", "date")
SAMPLE_HASHES = 2_000  # row hashes of a table that are compared with another, about
_KEY_TYPES = ("bigint", "int", "smallint", "string")

LOG, SOURCE, REFERENCE = "existing event log", "event source", "reference"
AGGREGATE, DUPLICATE, CDC, OTHER = "aggregate", "duplicate", "cdc", "not process data"


@dataclass
class _Facts:
    """What the rules look at; sizes are those of the schema, never of the data."""

    df: DataFrame
    rows: int
    types: dict[str, str]
    distinct: dict[str, int]
    tested: dict[str, bool] = field(default_factory=dict)

    @property
    def times(self) -> list[str]:
        return [c for c, k in self.types.items() if k in _TIMES]

    @property
    def ids(self) -> list[str]:
        return [c for c in self.distinct if re.search(ID_PATTERN, bare_name(c))]

    def share(self, column: str) -> float:
        return min(1.0, self.distinct[column] / self.rows) if self.rows else 0.0

    def unique(self, column: str) -> bool:
        """Does the column identify rows? The sketch only decides whether the exact test is worth a job."""
        if column not in self.tested:
            self.tested[column] = self.share(column) > 0.8 and not (
                self.df.groupBy(F.col(f"`{column}`").alias("_k"))
                .agg(F.count(F.lit(1)).alias("_n"))
                .where((F.col("_n") > 1) | F.col("_k").isNull())
                .limit(1)
                .collect()
            )
        return self.tested[column]

    def named(self, names: tuple[str, ...], kinds: tuple[str, ...] | None = None) -> str | None:
        found = [c for c in self.types if c.lower() in names and (kinds is None or self.types[c] in kinds)]
        return min(found, key=lambda c: names.index(c.lower())) if found else None


def _all_facts(tables: Mapping[str, DataFrame]) -> dict[str, _Facts]:
    """Row counts and approximate distinct counts of the columns that may be keys; other columns are not read.

    All tables are counted in one job, one row per table.
    """
    shared = _shared_texts(tables)
    keys, parts = {}, []
    for t, df in tables.items():
        keys[t] = [
            c
            for c, k in df.dtypes
            if k in _KEY_TYPES
            and (re.search(ID_PATTERN, bare_name(c)) or c.lower() in CASE_NAMES or bare_name(c) in shared)
        ]
        counts = [F.approx_count_distinct(F.col(f"`{c}`")) for c in keys[t]]
        distinct = F.array(*counts) if counts else F.array().cast("array<bigint>")
        parts.append(df.agg(F.count(F.lit(1)).alias("rows"), distinct.alias("distinct")).withColumn("table", F.lit(t)))
    found = {r["table"]: r for r in reduce(DataFrame.unionByName, parts).collect()}
    return {
        t: _Facts(df, found[t]["rows"], dict(df.dtypes), dict(zip(keys[t], found[t]["distinct"])))
        for t, df in tables.items()
    }


def _shared_texts(tables: Mapping[str, DataFrame]) -> set[str]:
    """Names of text columns of tables without times that also occur in a table with times."""
    timed = {t for t, df in tables.items() if any(k in _TIMES for _, k in df.dtypes)}
    in_events = {bare_name(c) for t in timed for c, k in tables[t].dtypes if k == "string"}
    elsewhere = {bare_name(c) for t, df in tables.items() if t not in timed for c, k in df.dtypes if k == "string"}
    return in_events & elsewhere


def classify_tables(
    tables: Mapping[str, DataFrame], id_share: float = 0.9, max_agg_rows: int = 100, duplicate_tolerance: float = 0.05,
    same_rows: float = 0.5,
) -> DataFrame:
    """(table, class, snapshot, case_col, activity_col, ts_col, reason): one row per table.

    Rules are tried in a fixed order: existing log, duplicate, change records, event source, reference
    (repeated until nothing changes), aggregate; what remains is not process data. Data is only read for
    counts; the rules run over column names and numbers. Tables of the same columns and about the same size are duplicates
    where their names differ by a prefix only, or where ``same_rows`` of their rows are equal (0: not looked at), which a
    sample of row hashes tells.
    """
    facts = _all_facts(tables)
    found: dict[str, tuple] = {}
    for t, f in facts.items():
        case, activity, ts = f.named(CASE_NAMES), f.named(ACTIVITY_NAMES, ("string",)), f.named(TIMESTAMP_NAMES, _TIMES)
        if case and activity and ts and case in f.distinct and not f.unique(case):
            found[t] = (LOG, False, case, activity, ts, "case, activity and time columns, several rows per case")
    for t, f in facts.items():
        original = _original_of(t, facts, found, duplicate_tolerance, same_rows)
        if t not in found and original:
            found[t] = (DUPLICATE, False, None, None, None, f"same columns and size as {original}")
    for t, f in facts.items():
        pair = _old_new(f)
        repeated = [c for c in f.ids if f.share(c) < id_share]
        if t not in found and pair and f.times and repeated:
            reason = f"old and new values in {pair[0]} and {pair[1]}, several rows per {repeated[0]}"
            found[t] = (CDC, False, repeated[0], pair[1], f.times[0], reason)
    _event_sources(facts, found, id_share)
    _references(facts, found)
    for t, f in facts.items():
        if t in found:
            continue
        if not f.ids and f.rows <= max_agg_rows:
            found[t] = (AGGREGATE, False, None, None, None, f"{f.rows} rows of dimensions without an id")
        elif f.times:
            found[t] = (OTHER, False, None, None, f.times[0], "times but no case key")
        else:
            found[t] = (OTHER, False, None, None, None, "no time column and no link to an event source")
    spark = next(iter(tables.values())).sparkSession
    schema = "table string, class string, snapshot boolean, case_col string, activity_col string, ts_col string, reason string"
    return spark.createDataFrame([(t, *found[t]) for t in tables], schema)


def _row_hashes(df: DataFrame, rows: int, size: int) -> Counter:
    """How often each row hash of a share of all hashes occurs, about ``size`` of them; the share is a power of two, so samples of
    tables of about the same size overlap as the tables do, whatever the order of their rows."""
    values = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\0")) for c in sorted(df.columns)]
    bits = max(0, (rows // size).bit_length() - 1)
    hashed = df.select(F.xxhash64(*values).alias("h")).where(F.shiftrightunsigned("h", 64 - bits) == 0 if bits else F.lit(True))
    return Counter({r["h"]: r["n"] for r in hashed.groupBy("h").agg(F.count(F.lit(1)).alias("n")).collect()})


def content_overlap(a: DataFrame, b: DataFrame, rows: int, size: int = SAMPLE_HASHES) -> float:
    """The share of rows that two tables of the same columns have in common as multisets, from a sample of about ``size`` of
    ``rows`` row hashes of each: one scan of either table, in any order and layout. Two empty tables are equal."""
    left, right = _row_hashes(a, rows, size), _row_hashes(b, rows, size)
    whole = max(sum(left.values()), sum(right.values()))
    return sum((left & right).values()) / whole if whole else 1.0


def _original_of(
    table: str, facts: Mapping[str, _Facts], found: Mapping[str, tuple], tolerance: float, same_rows: float
) -> str | None:
    """The table this one repeats: a prefixed name repeats an unprefixed one, else the later name the earlier."""

    def rank(name: str) -> tuple:
        return (name.startswith(TABLE_PREFIXES), name)

    def bare(name: str) -> str:
        return next((name.removeprefix(p) for p in TABLE_PREFIXES if name.startswith(p)), name)

    mine = facts[table]
    for other, theirs in facts.items():
        same = other != table and set(mine.types) == set(theirs.types)
        close = abs(mine.rows - theirs.rows) <= tolerance * max(mine.rows, theirs.rows)
        if same and close and rank(other) < rank(table) and table not in found:
            named = bare(table) == bare(other)
            if named or not same_rows or content_overlap(mine.df, theirs.df, max(mine.rows, theirs.rows)) >= same_rows:
                return other
    return None


def _old_new(f: _Facts) -> tuple[str, str] | None:
    for old, new in OLD_NEW_PATTERNS:
        olds = [c for c in f.types if re.search(old, c.lower())]
        news = [c for c in f.types if re.search(new, c.lower())]
        for o in olds:
            for n in news:
                if re.sub(old, "", o.lower()) == re.sub(new, "", n.lower()):
                    return o, n
    return None


def _event_sources(facts: Mapping[str, _Facts], found: dict[str, tuple], id_share: float) -> None:
    def status(f: _Facts) -> str | None:
        return next((c for c in f.types if re.search(STATUS_PATTERN, bare_name(c)) and f.types[c] == "string"), None)

    for t, f in facts.items():
        strong = [c for c in f.ids if f.share(c) >= id_share]
        if t not in found and f.times and strong:
            stage = status(f)
            snapshot = stage is not None and f.unique(strong[0])
            reason = f"{strong[0]} identifies rows, {len(f.times)} time columns"
            found[t] = (SOURCE, snapshot, strong[0], stage if snapshot else None, f.times[0], reason)
    changed = True
    while changed:
        changed = False
        shared = {bare_name(c): t for t, v in found.items() if v[0] == SOURCE for c in facts[t].ids}
        for t, f in facts.items():
            link = next((c for c in f.ids if bare_name(c) in shared), None)
            if t not in found and f.times and link:
                reason = f"{link} is shared with {shared[bare_name(link)]}, {len(f.times)} time columns"
                found[t] = (SOURCE, False, link, None, f.times[0], reason)
                changed = True


def _references(facts: Mapping[str, _Facts], found: dict[str, tuple]) -> None:
    changed = True
    while changed:
        changed = False
        linked = {bare_name(c): t for t, v in found.items() if v[0] in (SOURCE, LOG, REFERENCE, CDC) for c in facts[t].types}
        for t, f in facts.items():
            if t in found or f.times:
                continue
            texts = [c for c, k in f.types.items() if k == "string"]
            named = [c for c in f.distinct if c in f.ids or len(texts) > 1]  # other keys need a description
            key = next((c for c in named if bare_name(c) in linked and f.unique(c)), None)
            if key:
                found[t] = (REFERENCE, False, key, None, None, f"unique {key} is used by {linked[bare_name(key)]}")
                changed = True
