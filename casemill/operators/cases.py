"""Case-level numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casemill.functions.columns import ACTIVITY, CASE, TIMESTAMP, micros, usable
from casemill.operators.medians import exact_median
from casemill.operators.ordering import CaseLoad, measure_cases

DAY = 86400


def _spans(log: DataFrame) -> DataFrame:
    return (
        usable(log)
        .groupBy(CASE)
        .agg(F.count(F.lit(1)).alias("events"), F.min(TIMESTAMP).alias("first"), F.max(TIMESTAMP).alias("last"))
        .withColumn("_us", micros("last") - micros("first"))
    )


def case_durations(log: DataFrame) -> DataFrame:
    """(case_id, events, first, last, duration_seconds, duration_days)."""
    seconds = F.col("_us") / 1e6
    return _spans(log).select(
        CASE, "events", "first", "last", seconds.alias("duration_seconds"), (seconds / DAY).alias("duration_days")
    )


def median_duration(log: DataFrame, exact: bool = True, load: CaseLoad | None = None) -> DataFrame:
    """(median_seconds, median_days) over all cases; null for an empty log."""
    spans = _spans(log)
    if exact:
        load = load or measure_cases(usable(log))
        middle = exact_median(spans, [], "_us", "_m", single_pass=load.small)
    else:
        middle = spans.agg(F.approx_percentile("_us", 0.5, 10_000).alias("_m"))
    return middle.select((F.col("_m") / 1e6).alias("median_seconds"), (F.col("_m") / 1e6 / DAY).alias("median_days"))


def kpis(log: DataFrame, load: CaseLoad | None = None) -> DataFrame:
    """(cases, events, activities, median_duration_days): one row; the median of an empty log is 0."""
    events = usable(log)
    load = load or measure_cases(events)
    spans = _spans(log)
    names = events.agg(F.count_distinct(F.col(ACTIVITY)).alias("n")).scalar()
    if load.small:
        middle = F.percentile("_us", F.lit(0.5)) / 1e6 / DAY
        totals = spans.agg(F.count(F.lit(1)).alias("cases"), F.sum("events").alias("events"), middle.alias("_m"))
        return totals.select(
            "cases",
            F.coalesce("events", F.lit(0)).alias("events"),
            names.alias("activities"),
            F.coalesce("_m", F.lit(0.0)).alias("median_duration_days"),
        )
    totals = spans.agg(F.count(F.lit(1)).alias("cases"), F.sum("events").alias("events"))
    middle = median_duration(log, load=load).select("median_days").scalar()
    return totals.select("cases", "events", names.alias("activities"), middle.alias("median_duration_days"))


def duration_histogram(log: DataFrame, bins: int = 40) -> DataFrame:
    """(bin, lo, hi, n): case durations in days over equal-width bins; empty bins are left out.

    Equal durations everywhere make one bin.
    """
    days = _spans(log).select((F.col("_us") / 1e6 / DAY).alias("d"))
    low = days.agg(F.min("d")).scalar()
    high = days.agg(F.max("d")).scalar()
    width = F.col("w")
    placed = days.select("d", low.alias("low"), ((high - low) / bins).alias("w")).select(
        "low",
        "w",
        F.when(width == 0, 0)
        .otherwise(F.least(F.floor((F.col("d") - F.col("low")) / F.when(width != 0, width)), F.lit(bins - 1)))
        .cast("int")
        .alias("bin"),
    )
    return placed.groupBy("bin", "low", "w").agg(F.count(F.lit(1)).alias("n")).select(
        "bin",
        (F.col("low") + F.col("bin") * width).alias("lo"),
        (F.col("low") + (F.col("bin") + 1) * width).alias("hi"),
        "n",
    )


def largest_cases(log: DataFrame, k: int = 5) -> DataFrame:
    """(case_id, events): the k cases with the most events."""
    counts = log.where(F.col(CASE).isNotNull()).groupBy(CASE).agg(F.count(F.lit(1)).alias("events"))
    return counts.orderBy(F.desc("events"), CASE).limit(k)
