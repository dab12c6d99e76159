"""Detectors for the usual noise in source tables and logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casemill.functions.columns import ACTIVITY, CASE, TIMESTAMP, column, normalise_key, usable
from casemill.operators.dfg import case_ends
from casemill.operators.joins import balanced_join
from casemill.operators.ordering import CaseLoad, measure_cases, over_case


def duplicate_records(df: DataFrame, key: str) -> DataFrame:
    """(key of the kept row, every other column, copies): rows equal in all but their key."""
    rest = [c for c in df.columns if c != key]
    groups = df.groupBy(*[F.col(f"`{c}`") for c in rest]).agg(
        F.min(f"`{key}`").alias(key), F.count(F.lit(1)).alias("copies")
    )
    return groups.where(F.col("copies") > 1).select(key, *rest, "copies")


def orphans(child: DataFrame, parent: DataFrame, on: str, parent_key: str | None = None) -> DataFrame:
    """Child rows whose key has no parent; a null key is a missing link, not an orphan."""
    keys = parent.select(F.col(f"`{parent_key or on}`").alias("_p")).dropna().distinct()
    return balanced_join(child.where(F.col(f"`{on}`").isNotNull()), keys, [(on, "_p")], "left_anti")


def status_conflicts(df: DataFrame, status: str, value: str, ts: str) -> DataFrame:
    """Rows whose status says a step is done although its timestamp is missing."""
    return df.where((column(df, status) == value) & column(df, ts).isNull())


def missing_keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, rows, missing) for key columns."""
    counts = df.agg(
        F.count(F.lit(1)).alias("rows"), *[F.count(F.col(f"`{c}`")).alias(f"_c{i}") for i, c in enumerate(columns)]
    )
    cells = [
        F.struct(F.lit(c).alias("column"), (F.col("rows") - F.col(f"_c{i}")).alias("missing"))
        for i, c in enumerate(columns)
    ]
    return counts.select("rows", F.inline(F.array(*cells))).select("column", "rows", "missing")


def rows_missing_keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The rows that lack one of the keys."""
    return df.where(F.greatest(*[F.col(f"`{c}`").isNull().cast("int") for c in [*columns, columns[0]]]) == 1)


def key_variants(df: DataFrame, key: str, reference: DataFrame | None = None, ref_key: str | None = None) -> DataFrame:
    """(normalised, spellings, rows): keys written in several ways, or with outer blanks.

    With a ``reference``, also keys that it has only in another spelling.
    """
    spelled = df.where(F.col(f"`{key}`").isNotNull()).groupBy(F.col(f"`{key}`").cast("string").alias("_raw"))
    spelled = spelled.agg(F.count(F.lit(1)).alias("_n")).withColumn("_odd", F.col("_raw") != F.trim("_raw"))
    spelled = spelled.withColumn("_norm", normalise_key("_raw"))
    if reference is not None:
        listed = reference.select(F.col(f"`{ref_key or key}`").cast("string").alias("_listed")).dropna().distinct()
        norms = listed.select(normalise_key("_listed").alias("_known")).distinct()
        spelled = balanced_join(spelled, listed.withColumn("_same", F.lit(True)), [("_raw", "_listed")])
        spelled = balanced_join(spelled, norms.withColumn("_there", F.lit(True)), [("_norm", "_known")])
        spelled = spelled.withColumn("_odd", F.col("_odd") | (F.col("_there").isNotNull() & F.col("_same").isNull()))
    grouped = spelled.groupBy(F.col("_norm").alias("normalised")).agg(
        F.count(F.lit(1)).alias("spellings"), F.sum("_n").alias("rows"), F.bool_or("_odd").alias("_odd")
    )
    return grouped.where((F.col("spellings") > 1) | F.col("_odd")).drop("_odd")


def out_of_order(
    log: DataFrame, before: str, after: str, mode: str = "flag", load: CaseLoad | None = None
) -> DataFrame:
    """Events of activity ``after`` stamped earlier than the first ``before`` of their case.

    ``mode="flag"`` adds ``out_of_order`` to every event, ``"list"`` gives the affected events and
    ``"filter"`` the log without them.
    """
    first = F.min(F.when(F.col(ACTIVITY) == before, F.col(TIMESTAMP)))
    known = over_case(log, {"_first": first}, load or measure_cases(log)) if mode == "flag" else None
    early = F.coalesce((F.col(ACTIVITY) == after) & (F.col(TIMESTAMP) < F.col("_first")), F.lit(False))
    if known is not None:
        return known.withColumn("out_of_order", early & F.col(CASE).isNotNull()).drop("_first")
    if mode == "filter":
        known = over_case(log, {"_first": first}, load or measure_cases(log))
        return known.where(~(early & F.col(CASE).isNotNull())).drop("_first")
    relevant = usable(log).where(F.col(ACTIVITY).isin(before, after))
    known = over_case(relevant, {"_first": first}, load or measure_cases(relevant))
    return known.where(early).drop("_first")


def first_before(log: DataFrame, a: str, b: str) -> DataFrame:
    """(case_id, first_a, first_b): cases in which the first ``a`` happens before the first ``b``."""
    firsts = usable(log).groupBy(CASE).agg(
        F.min(F.when(F.col(ACTIVITY) == a, F.col(TIMESTAMP))).alias("first_a"),
        F.min(F.when(F.col(ACTIVITY) == b, F.col(TIMESTAMP))).alias("first_b"),
    )
    return firsts.where(F.col("first_a") < F.col("first_b"))


def all_before(log: DataFrame, a: str, b: str) -> DataFrame:
    """(case_id, last_a, first_b): cases in which every ``a`` happens before the first ``b``."""
    ends = usable(log).groupBy(CASE).agg(
        F.max(F.when(F.col(ACTIVITY) == a, F.col(TIMESTAMP))).alias("last_a"),
        F.min(F.when(F.col(ACTIVITY) == b, F.col(TIMESTAMP))).alias("first_b"),
    )
    return ends.where(F.col("last_a") < F.col("first_b"))


def early_children(
    child: DataFrame, parent: DataFrame, on: str, child_ts: str, parent_ts: str, parent_key: str | None = None
) -> DataFrame:
    """Child rows stamped before their parent, with the parent's time."""
    times = parent.select(F.col(f"`{parent_key or on}`").alias("_p"), F.col(f"`{parent_ts}`").alias("parent_time"))
    joined = balanced_join(child.where(F.col(f"`{on}`").isNotNull()), times.dropna(), [(on, "_p")], "inner")
    return joined.where(F.col(f"`{child_ts}`") < F.col("parent_time"))


def missing_start(log: DataFrame, allowed: Sequence[str]) -> DataFrame:
    """(case_id, first_activity): cases that begin with an activity outside the allowed set."""
    firsts = case_ends(log).select(CASE, F.col("start").alias("first_activity"))
    return firsts.where(~F.col("first_activity").isin(list(allowed)))


def rework_cases(log: DataFrame, activities: Sequence[str] | None = None) -> DataFrame:
    """(case_id, rework_events, repeated_activities): cases in which an activity happens again."""
    events = log.where(F.col(CASE).isNotNull() & F.col(ACTIVITY).isNotNull())
    if activities is not None:
        events = events.where(F.col(ACTIVITY).isin(list(activities)))
    counts = events.groupBy(CASE, ACTIVITY).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
    return counts.groupBy(CASE).agg(
        F.sum(F.col("_n") - 1).alias("rework_events"), F.count(F.lit(1)).alias("repeated_activities")
    )


def activity_after(log: DataFrame, activity: str, approval: str) -> DataFrame:
    """(case_id, approved, events_after): cases in which ``activity`` happens after the first ``approval``."""
    events = usable(log).where(F.col(ACTIVITY).isin(activity, approval))
    approved = events.where(F.col(ACTIVITY) == approval).groupBy(CASE).agg(F.min(TIMESTAMP).alias("approved"))
    late = balanced_join(events.where(F.col(ACTIVITY) == activity), approved, [(CASE, CASE)], "inner")
    late = late.where(F.col(TIMESTAMP) > F.col("approved"))
    return late.groupBy(CASE, "approved").agg(F.count(F.lit(1)).alias("events_after"))
