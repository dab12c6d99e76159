"""The summary of a build."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casemill.functions.columns import ACTIVITY, CASE, MANDATORY, METRICS
from casemill.operators.enrich import coverage, match_rates
from casemill.operators.quality import quality_gates
from casemill.plans.build import Tables
from casemill.session import cut_lineage
from casemill.sources.config import EventLogConfig, table_of


def report(
    spark: SparkSession, cfg: EventLogConfig, log: DataFrame, classes: DataFrame | None = None, tables: Tables = None
) -> DataFrame:
    """(position, item, value): process, output, counts, columns, coverage, match rates, gates and the tables used or left out.

    All activities are listed by name. The log is read four times: for its counts per case and activity, which are
    written at call time, for the gates, for the coverage, and for the match rates of all enrichments whose keys it has
    and whose tables are there (``tables`` replaces catalog tables by name).
    """
    counts = cut_lineage(log.groupBy(CASE, ACTIVITY).agg(F.count(F.lit(1)).alias("n")))
    per_case = counts.groupBy(CASE).agg(F.sum("n").alias("n"))
    names = counts.select(ACTIVITY).where(F.col(ACTIVITY).isNotNull()).distinct()
    listed = F.array_join(F.array_sort(F.collect_list(ACTIVITY)), ", ")
    enriched = [e.prefix + c for e in cfg.enrichment for c in e.columns]
    extra = [c for c in log.columns if c not in (*MANDATORY, *METRICS, *enriched, "source_seq", "event_id")]
    used = [s.table for s in cfg.sources] + [e.table for e in cfg.enrichment]

    def one(position: int, item: str, value: Column, df: DataFrame) -> DataFrame:
        return df.agg(value.cast("string").alias("value")).select(
            F.lit(position).alias("position"), F.lit(item).alias("item"), "value"
        )

    fixed = spark.createDataFrame(
        [
            (0, "process", cfg.name),
            (1, "output", cfg.output_table),
            (6, "columns: mandatory", ", ".join(MANDATORY)),
            (7, "columns: activity level", ", ".join(extra)),
            (8, "columns: computed", ", ".join(c for c in METRICS if c in log.columns)),
            (9, "columns: case level", ", ".join(enriched)),
            (12, "tables used", ", ".join(used)),
        ],
        "position int, item string, value string",
    )
    parts = [
        fixed,
        one(2, "events", F.coalesce(F.sum("n"), F.lit(0)), per_case),
        one(3, "cases", F.count(CASE), per_case),
        one(4, "largest case", F.coalesce(F.max("n"), F.lit(0)), per_case.where(F.col(CASE).isNotNull())),
        one(5, "activities", listed, names),
        quality_gates(log).select(
            F.lit(11).alias("position"),
            F.concat(F.lit("gate: "), "gate").alias("item"),
            F.when(F.col("passed"), "passed").otherwise(F.concat(F.lit("failed: "), F.col("value").cast("string"))).alias("value"),
        ),
    ]
    if enriched:
        rates = coverage(log, enriched)
        parts.append(
            rates.select(F.lit(10).alias("position"), F.concat(F.lit("coverage: "), "column").alias("item"), F.col("pct").cast("string").alias("value"))
        )
    there = lambda name: name in (tables or {}) or spark.catalog.tableExists(name)
    joined = [e for e in cfg.enrichment if e.join_key in log.columns and there(e.table)]
    if joined:
        refs = [(e.table, table_of(spark, tables, e.table), {e.join_key: e.ref_key or e.join_key}) for e in joined]
        text = F.format_string(
            "%d of %d events (%s %%), %d of %d keys", "matched", "rows", F.coalesce(F.col("pct").cast("string"), F.lit("-")),
            "matched_keys", "keys",
        )
        found = match_rates(log, refs)
        parts.append(found.select(F.lit(10).alias("position"), F.concat(F.lit("match rate: "), "table").alias("item"), text.alias("value")))
    if classes is not None:
        skipped = classes.where(~F.col("table").isin(used))
        parts.append(
            skipped.select(
                F.lit(13).alias("position"),
                F.concat(F.lit("skipped: "), "table").alias("item"),
                F.concat_ws(": ", "class", "reason").alias("value"),
            )
        )
    return reduce(DataFrame.unionByName, parts).orderBy("position", "item")
