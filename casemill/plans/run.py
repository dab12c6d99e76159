"""The two ways to a saved log: from source tables, and from a log that is already there."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from casemill.operators.enrich import enrich
from casemill.operators.metrics import add_metrics
from casemill.operators.ordering import CaseLoad
from casemill.operators.quality import require_gates
from casemill.plans.build import build_event_log, log_load
from casemill.plans.report import report
from casemill.session import cut_lineage
from casemill.sources.config import EnrichmentSpec, EventLogConfig, check_config, table_of
from casemill.sources.tables import normalise_log, save_log


class ConfigFailure(ValueError):
    """A configuration breaks one of its rules."""


def build_and_save(
    spark: SparkSession,
    cfg: EventLogConfig,
    tables: Mapping[str, DataFrame] | None = None,
    table: str | None = None,
    path: str | None = None,
    classes: DataFrame | None = None,
) -> DataFrame:
    """Check the rules, build, check the gates, save, and report on the saved log; runs at call time.

    The log is written once before the gates read it, and saved from there, so nothing is built twice. ``table``
    replaces the configured output table.
    """
    broken = check_config(spark, cfg, tables).where("not passed").collect()
    if broken:
        raise ConfigFailure("; ".join(f"rule {r['rule']}, {r['source']}: {r['detail']}" for r in broken))
    log = cut_lineage(build_event_log(spark, cfg, tables, log_load(spark, cfg, tables)))
    name = table or cfg.output_table
    save_log(require_gates(log), name, path)
    return report(spark, cfg, spark.table(name), classes, tables)


def complete_log(
    spark: SparkSession,
    log: DataFrame,
    enrichment: Sequence[EnrichmentSpec] = (),
    tables: Mapping[str, DataFrame] | None = None,
    load: CaseLoad | None = None,
    table: str | None = None,
    path: str | None = None,
) -> DataFrame:
    """A log that already exists, normalised, checked, enriched and with the metrics it lacks; saved if ``table`` is given.

    Metrics that the log has are left as they are. The gates run at call time.
    """
    out = require_gates(normalise_log(log))
    for e in enrichment:
        out = enrich(out, table_of(spark, tables, e.table), {e.join_key: e.ref_key or e.join_key}, e.columns, e.prefix)
    out = add_metrics(out, only_missing=True, load=load)
    if table is None:
        return out
    save_log(out, table, path)
    return spark.table(table)
