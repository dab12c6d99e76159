"""Log tables in the catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casemill.functions.columns import CASE, MANDATORY, TIMESTAMP, as_timestamp

_NUMERIC = ("cost", "time_since_prev_seconds", "event_rank")


def list_tables(spark: SparkSession, schema: str) -> DataFrame:
    """(table_name) of a schema, by name."""
    names = sorted(t.name for t in spark.catalog.listTables(schema) if not t.isTemporary)
    return spark.createDataFrame([(n,) for n in names], "table_name string")


def describe_columns(df: DataFrame) -> DataFrame:
    """(position, column, type) of a table."""
    rows = [(i, name, kind) for i, (name, kind) in enumerate(df.dtypes)]
    return df.sparkSession.createDataFrame(rows, "position int, column string, type string")


def discover_logs(spark: SparkSession, schema: str) -> DataFrame:
    """(table_name, kind) of the logs in a schema: ``ocel`` event tables and ``traditional`` logs by columns."""
    rows = []
    for table in sorted(spark.catalog.listTables(schema), key=lambda t: t.name):
        if table.isTemporary or "ocel_e2o" in table.name or "ocel_objects" in table.name:
            continue
        if "ocel_events" in table.name:
            rows.append((table.name, "ocel"))
        elif set(MANDATORY) <= set(spark.table(f"{schema}.{table.name}").columns):
            rows.append((table.name, "traditional"))
    return spark.createDataFrame(rows, "table_name string, kind string")


def normalise_log(log: DataFrame, sort: bool = False) -> DataFrame:
    """Read timestamps and numbers of a foreign log; unreadable ones become null and no row is dropped.

    ``sort`` orders by case and time, which only a display needs.
    """
    fixes = {c: F.expr(f"try_cast(`{c}` AS DOUBLE)") for c in _NUMERIC if c in log.columns}
    if TIMESTAMP in log.columns:
        fixes[TIMESTAMP] = as_timestamp(log, TIMESTAMP)
    out = log.withColumns(fixes) if fixes else log
    keys = [c for c in (CASE, TIMESTAMP) if c in out.columns]
    return out.orderBy(*keys) if sort and keys else out


def load_log(spark: SparkSession, table: str) -> DataFrame:
    """A log table, normalised."""
    return normalise_log(spark.table(table))


def ensure_schema(spark: SparkSession, schema: str) -> None:
    """Create the schema if it is missing."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{schema}`")


def save_log(df: DataFrame, table: str, path: str | None = None, partition_by: tuple[str, ...] = ()) -> None:
    """Create or replace a log table, schema included."""
    writer = df.write.mode("overwrite").format("parquet")
    writer = writer.partitionBy(*partition_by) if partition_by else writer
    (writer.option("path", path) if path else writer).saveAsTable(table)
