"""Computed event columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casemill.functions.columns import ACTIVITY, CASE, METRICS, TIMESTAMP, order_columns, whole_seconds
from casemill.operators.ordering import CaseLoad, measure_cases, neighbours


def add_metrics(log: DataFrame, only_missing: bool = False, load: CaseLoad | None = None) -> DataFrame:
    """Add rank, whole seconds since the previous event and the size of the case.

    Events without a case keep null metrics. ``only_missing`` leaves metrics alone that the log already has.
    """
    wanted = [m for m in METRICS if not (only_missing and m in log.columns)]
    if not wanted:
        return log
    base = log.drop(*wanted)
    load = load or measure_cases(base)
    ranked = neighbours(base, [CASE], order_columns(log), [TIMESTAMP], load, null_keys=True)
    known = F.col(CASE).isNotNull()
    values = {
        "event_rank": F.when(known, F.col("_rank")).cast("int"),
        "time_since_prev_seconds": F.when(known, whole_seconds(TIMESTAMP) - whole_seconds(f"_prev_{TIMESTAMP}")),
        "case_event_count": F.when(known, F.col("_size")),
    }
    return ranked.select(*base.columns, *[values[m].alias(m) for m in wanted])


def rework_flag(log: DataFrame, load: CaseLoad | None = None) -> DataFrame:
    """Add ``is_rework``: 1 when the activity already happened in the case."""
    load = load or measure_cases(log)
    ranked = neighbours(log, [CASE, ACTIVITY], order_columns(log), [], load, null_keys=True)
    known = F.col(CASE).isNotNull() & F.col(ACTIVITY).isNotNull()
    return ranked.select(*log.columns, F.when(known, (F.col("_rank") > 1).cast("int")).alias("is_rework"))
