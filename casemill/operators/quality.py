"""Gates and validation queries for a built log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casemill.functions.columns import ACTIVITY, CASE, MANDATORY, TIMESTAMP, order_columns


class GateFailure(ValueError):
    """A built log does not pass its gates."""


def quality_gates(log: DataFrame) -> DataFrame:
    """(gate, value, passed, advisory): the five gates and, as advice, null activities."""
    per_case = log.groupBy(CASE).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col(TIMESTAMP).isNull()).alias("null_ts"),
        F.count_if(F.col(ACTIVITY).isNull()).alias("null_act"),
    )
    names = log.agg(F.count_distinct(F.col(ACTIVITY)).alias("n")).scalar()
    total = F.coalesce(F.sum("n"), F.lit(0))
    known = F.sum(F.when(F.col(CASE).isNotNull(), F.col("n")))
    totals = per_case.agg(
        total.alias("events"),
        F.coalesce(F.sum(F.when(F.col(CASE).isNull(), F.col("n"))), F.lit(0)).alias("null_cases"),
        F.coalesce(F.sum("null_ts"), F.lit(0)).alias("null_ts"),
        F.coalesce(F.sum("null_act"), F.lit(0)).alias("null_act"),
        (known / F.count(F.col(CASE))).alias("mean"),
    ).withColumn("activities", names)

    def gate(name: str, value: str, passed, advisory: bool = False):
        return F.struct(
            F.lit(name).alias("gate"),
            F.col(value).cast("double").alias("value"),
            F.coalesce(passed, F.lit(False)).alias("passed"),
            F.lit(advisory).alias("advisory"),
        )

    gates = F.array(
        gate("events", "events", F.col("events") > 0),
        gate("null_case_ids", "null_cases", F.col("null_cases") == 0),
        gate("null_timestamps", "null_ts", F.col("null_ts") == 0),
        gate("distinct_activities", "activities", F.col("activities") >= 2),
        gate("events_per_case", "mean", F.col("mean") > 1),
        gate("null_activities", "null_act", F.col("null_act") == 0, advisory=True),
    )
    return totals.select(F.inline(gates))


def require_gates(log: DataFrame) -> DataFrame:
    """The log itself when all gates pass; otherwise raises with the failed gates."""
    failed = quality_gates(log).where(~F.col("passed") & ~F.col("advisory")).collect()
    if failed:
        raise GateFailure(", ".join(f"{r['gate']} = {r['value']}" for r in failed))
    return log


def basic_stats(log: DataFrame) -> DataFrame:
    """(events, cases, activities)."""
    return log.agg(
        F.count(F.lit(1)).alias("events"),
        F.count_distinct(F.col(CASE)).alias("cases"),
        F.count_distinct(F.col(ACTIVITY)).alias("activities"),
    )


def activity_distribution(log: DataFrame) -> DataFrame:
    """(activity, cnt), most frequent first."""
    return log.groupBy(ACTIVITY).agg(F.count(F.lit(1)).alias("cnt")).orderBy(F.desc("cnt"), ACTIVITY)


def null_check(log: DataFrame) -> DataFrame:
    """(null_case_ids, null_activities, null_timestamps)."""
    return log.agg(
        F.count_if(F.col(CASE).isNull()).alias("null_case_ids"),
        F.count_if(F.col(ACTIVITY).isNull()).alias("null_activities"),
        F.count_if(F.col(TIMESTAMP).isNull()).alias("null_timestamps"),
    )


def case_trace(log: DataFrame, case_id=None) -> DataFrame:
    """The events of one case in order; without a case, those of the smallest case id."""
    wanted = log.agg(F.min(CASE)).scalar() if case_id is None else F.lit(case_id)
    shown = [c for c in (*MANDATORY, "resource") if c in log.columns]
    return log.where(F.col(CASE) == wanted).orderBy(*order_columns(log)).select(*shown)


def duplicate_events(log: DataFrame) -> DataFrame:
    """(case_id, activity, event_timestamp, dupes): events recorded more than once."""
    return log.groupBy(*MANDATORY).agg(F.count(F.lit(1)).alias("dupes")).where(F.col("dupes") > 1)


def compare_logs(a: DataFrame, b: DataFrame, names: Sequence[str] = ("a", "b"), columns: Sequence[str] = MANDATORY) -> DataFrame:
    """(build, events, cases, activities, rows_not_in_other): two builds side by side.

    Rows are compared with their multiplicity: counts per distinct row are set against each other, so copies
    meet as one counted row in the shuffle.
    """
    left = a.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n")).withColumn("_m", F.lit(0))
    right = b.groupBy(*columns).agg(F.count(F.lit(1)).alias("_m")).withColumn("_n", F.lit(0))
    both = left.unionByName(right).groupBy(*columns).agg(F.sum("_n").alias("_n"), F.sum("_m").alias("_m"))

    def side(own: str, other: str, name: str) -> DataFrame:
        mine = both.where(F.col(own) > 0)
        return mine.agg(
            F.coalesce(F.sum(own), F.lit(0)).alias("events"),
            F.count_distinct(F.col(CASE)).alias("cases"),
            F.count_distinct(F.col(ACTIVITY)).alias("activities"),
            F.coalesce(F.sum(F.greatest(F.col(own) - F.col(other), F.lit(0))), F.lit(0)).alias("rows_not_in_other"),
        ).select(F.lit(name).alias("build"), "*")

    return side("_n", "_m", names[0]).unionByName(side("_m", "_n", names[1]))
