"""Event order within a case, also for cases too large for one task.

Most cases are short and one window per case is the right plan. A case that holds a large part of the log
would put all of it into one task, so such *hot* cases take another way: their events are range-partitioned
by the full order, each slice is ranked on its own, and a table with one row per slice carries rank offsets
and neighbours across the slice borders. Both ways give the same rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casemill.functions.columns import ACTIVITY, CASE, mining_order, usable
from casemill.session import cut_lineage

MAX_TASK_EVENTS = 5_000_000  # events of one case that a single task may hold
MAX_ACTIVITIES = 1000  # up to here, a table of activity pairs is small enough to broadcast
MIN_PARTITION_EVENTS = 200_000  # events of hot cases that are worth a partition of their own
TASK_ROWS = 1_000_000  # rows that a task of a shuffle should sort or hold
BROADCAST_KEYS = 500_000  # up to so many hot cases, their names are broadcast


@dataclass(frozen=True)
class CaseLoad:
    """How the events spread over the cases."""

    events: int
    hot: DataFrame | None = None  # the cases with more events than one task should hold, one written row each
    max_task_events: int = MAX_TASK_EVENTS
    activities: int | None = None  # an upper bound or a close estimate, where known
    hot_cases: int = 0
    hot_events: int = 0

    @property
    def small(self) -> bool:
        """Is the whole log no larger than what one task may hold?"""
        return self.events <= self.max_task_events

    @property
    def small_alphabet(self) -> bool:
        """Are the activity pairs known to be a small table?"""
        return self.activities is not None and self.activities <= MAX_ACTIVITIES


def measure_cases(
    df: DataFrame,
    key: str = CASE,
    at_most: int | None = None,
    max_task_events: int = MAX_TASK_EVENTS,
    activities: int | None = None,
) -> CaseLoad:
    """Count the log and, only when it exceeds one task, find its hot cases.

    ``at_most`` and ``activities`` are upper bounds the caller already knows (for example from file footers
    and the configuration). The names of the hot cases are written as a table and stay there.
    """
    if at_most is not None and at_most <= max_task_events:
        return CaseLoad(at_most, None, max_task_events, activities)
    counted = activities is None and ACTIVITY in df.columns
    names = F.approx_count_distinct(ACTIVITY) if counted else F.lit(None)
    total, estimate = df.agg(F.count(F.lit(1)), names).first()
    activities = activities if estimate is None else estimate
    load = CaseLoad(total, None, max_task_events, activities)
    if load.small:
        return load
    per_case = df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_hot")).agg(F.count(F.lit(1)).alias("_n"))
    hot = cut_lineage(per_case.where(F.col("_n") > max_task_events))
    many, events = hot.agg(F.count(F.lit(1)), F.coalesce(F.sum("_n"), F.lit(0))).first()
    return replace(load, hot=hot.select("_hot"), hot_cases=many, hot_events=events) if many else load


def split_hot(df: DataFrame, load: CaseLoad, key: str = CASE) -> tuple[DataFrame, DataFrame | None]:
    """(events of ordinary cases, events of hot cases or None)."""
    if load.hot is None:
        return df, None
    names = F.broadcast(load.hot) if load.hot_cases <= BROADCAST_KEYS else load.hot
    same = F.col(key) == F.col("_hot")
    return df.join(names, same, "left_anti"), df.join(names, same, "left_semi")


def dealt(df: DataFrame, keys: Sequence[str], rows: int, task_rows: int = TASK_ROWS) -> DataFrame:
    """``df`` partitioned by ``keys`` into as many parts as keep ``rows`` at ``task_rows`` a task; as it is, where the session's
    number of shuffle partitions is enough for that."""
    parts = -(-rows // task_rows)
    few = parts <= int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df if few else df.repartition(parts, *[F.col(f"`{k}`") for k in keys])


def neighbours(
    df: DataFrame,
    key: Sequence[str],
    order: Sequence[str],
    carry: Sequence[str],
    load: CaseLoad,
    null_keys: bool = False,
) -> DataFrame:
    """Add ``_rank``, ``_size`` and, per carried column c, ``_prev_c`` and ``_next_c``.

    Columns that a caller does not use are pruned from the window by the optimizer. With ``null_keys``, rows
    without a key are spread by their content instead of meeting in one task; callers blank their values. The number of
    tasks grows with the events.
    """
    normal, hot = split_hot(df, load, key[0])
    spread = {"_spread": F.when(F.col(key[0]).isNull(), F.xxhash64(*order))} if null_keys else {}
    parts = [*key, *spread]
    normal = dealt(normal.withColumns(spread) if spread else normal, parts, load.events)
    w = Window.partitionBy(*parts).orderBy(*order)
    out = normal.withColumns(
        {
            "_rank": F.row_number().over(w).cast("long"),
            "_size": F.count(F.lit(1)).over(Window.partitionBy(*parts)),
            **{f"_prev_{c}": F.lag(c).over(w) for c in carry},
            **{f"_next_{c}": F.lead(c).over(w) for c in carry},
        }
    ).drop(*spread)
    return out if hot is None else out.unionByName(_sliced_neighbours(hot, key, order, carry, load))


def _hashable(df: DataFrame) -> list[str]:
    """The columns that can be hashed: all but maps and what holds maps."""
    return [f"`{f.name}`" for f in df.schema.fields if "map" not in f.dataType.simpleString()]


def _slices(hot: DataFrame, key: Sequence[str], order: Sequence[str], load: CaseLoad) -> tuple[DataFrame, list[str]]:
    """Events of hot cases in slices of their full order, and that order.

    The order is cut into partitions, and these into slices of half of what a task may hold, by the places of the
    events. So partitions, whose results all go to the driver, are few however small the slices are. The slice
    numbers are written down before they are used, so that a lost executor cannot change them.
    """
    count = max(2, 2 * -(-load.hot_events // max(load.max_task_events, MIN_PARTITION_EVENTS)))
    full_order = [*order, "_tie"]
    events = hot.withColumn("_tie", F.xxhash64(*_hashable(hot))).repartitionByRange(count, *key, *full_order)
    at = F.monotonically_increasing_id()  # the partition above 33 bits for the place in it
    events = events.sortWithinPartitions(*key, *full_order).withColumn("_at", at)
    here = F.col("_at").bitwiseAND((1 << 33) - 1)
    slice_no = F.col("_at") - here + F.floor(here / max(1, load.max_task_events // 2))
    return cut_lineage(events.withColumn("_slice", slice_no).drop("_at")), full_order


def _with_slice_table(events: DataFrame, table: DataFrame, key: Sequence[str], load: CaseLoad) -> DataFrame:
    # One row per slice and key: at most the slices plus the hot keys. With a compound key their number can
    # follow the data, so only the plain case key is broadcast, and only while there are few.
    few = len(key) == 1 and 3 * load.hot_events // load.max_task_events + load.hot_cases <= BROADCAST_KEYS
    return events.join(F.broadcast(table) if few else table, [*key, "_slice"])


def _sliced_neighbours(
    hot: DataFrame, key: Sequence[str], order: Sequence[str], carry: Sequence[str], load: CaseLoad
) -> DataFrame:
    events, full_order = _slices(hot, key, order, load)
    at = F.struct(*full_order)
    carried = F.struct(*carry) if carry else F.lit(0)
    ends = events.groupBy(*key, "_slice").agg(
        F.count(F.lit(1)).alias("_n"), F.min_by(carried, at).alias("_first"), F.max_by(carried, at).alias("_last")
    )
    across = Window.partitionBy(*key).orderBy("_slice")
    ends = ends.select(
        *key,
        "_slice",
        F.coalesce(F.sum("_n").over(across.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
        F.sum("_n").over(Window.partitionBy(*key)).alias("_size"),
        F.lag("_last").over(across).alias("_left"),
        F.lead("_first").over(across).alias("_right"),
    )
    w = Window.partitionBy(*key, "_slice").orderBy(*full_order)
    inner = events.withColumns(
        {
            "_here": F.row_number().over(w),
            "_last_here": F.lead(F.lit(1)).over(w).isNull(),
            **{f"_prev_{c}": F.lag(c).over(w) for c in carry},
            **{f"_next_{c}": F.lead(c).over(w) for c in carry},
        }
    )
    first, last = F.col("_here") == 1, F.col("_last_here")
    return _with_slice_table(inner, ends, key, load).select(
        *hot.columns,
        (F.col("_here") + F.col("_before")).alias("_rank"),
        "_size",
        *[F.when(first, F.col("_left")[c]).otherwise(F.col(f"_prev_{c}")).alias(f"_prev_{c}") for c in carry],
        *[F.when(last, F.col("_right")[c]).otherwise(F.col(f"_next_{c}")).alias(f"_next_{c}") for c in carry],
    )


def running(
    df: DataFrame,
    key: Sequence[str],
    order: Sequence[str],
    values: Mapping[str, Column],
    load: CaseLoad,
    kind: str = "sum",
) -> DataFrame:
    """Add running sums (or maxima) up to and including each event; hot cases go slice by slice."""
    fold = {"sum": F.sum, "max": F.max}[kind]
    join = {"sum": lambda a, b: F.coalesce(a + b, a, b), "max": F.greatest}[kind]
    normal, hot = split_hot(df, load, key[0])
    w = Window.partitionBy(*key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = normal.withColumns({name: fold(value).over(w) for name, value in values.items()})
    if hot is None:
        return out
    events, full_order = _slices(hot, key, order, load)
    earlier = Window.partitionBy(*key).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    totals = events.groupBy(*key, "_slice").agg(*[fold(v).alias(f"_t_{n}") for n, v in values.items()])
    totals = totals.select(*key, "_slice", *[fold(f"_t_{n}").over(earlier).alias(f"_b_{n}") for n in values])
    here = Window.partitionBy(*key, "_slice").orderBy(*full_order).rowsBetween(Window.unboundedPreceding, 0)
    inner = events.withColumns({n: fold(v).over(here) for n, v in values.items()})
    joined = _with_slice_table(inner, totals, key, load)
    return out.unionByName(joined.select(*hot.columns, *[join(F.col(f"_b_{n}"), F.col(n)).alias(n) for n in values]))


def sequence(log: DataFrame, carry: Sequence[str] = ("activity",), load: CaseLoad | None = None) -> DataFrame:
    """The usable events of a log with rank and neighbours in their case."""
    events = usable(log)
    return neighbours(events, [CASE], mining_order(log), carry, load or measure_cases(events))


def over_case(df: DataFrame, values: Mapping[str, Column], load: CaseLoad, key: str = CASE) -> DataFrame:
    """Add per-case aggregates to every event.

    Ordinary cases use a window, in which rows without a case are spread by their content. Hot cases are
    aggregated with map-side partials and come back as a table of one row each.
    """
    normal, hot = split_hot(df, load, key)
    w = Window.partitionBy(key, F.when(F.col(key).isNull(), F.xxhash64(*_hashable(df))))
    out = normal.withColumns({name: agg.over(w) for name, agg in values.items()})
    if hot is None:
        return out
    totals = hot.groupBy(key).agg(*[agg.alias(name) for name, agg in values.items()])
    return out.unionByName(hot.join(F.broadcast(totals) if load.hot_cases <= BROADCAST_KEYS else totals, key))


def all_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)
