"""Equi joins that stay balanced when one key holds a large part of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casemill.operators.ordering import MAX_TASK_EVENTS, all_of, dealt
from casemill.session import cut_lineage

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Count rows and bytes of a side before it is sent to every executor: one aggregation, nothing is shuffled.

    Arrays, maps and structs count as many bytes as their text has.
    """
    rows, size = _rows_and_bytes(df)
    return rows <= max_rows and size <= max_bytes


def _rows_and_bytes(df: DataFrame) -> tuple[int, int]:
    width = F.lit(0)
    for field in df.schema.fields:
        kind, value = field.dataType.typeName(), F.col(f"`{field.name}`")
        if kind in ("array", "map", "struct", "variant"):
            value = value.cast("string")
        wide = kind in ("string", "binary", "array", "map", "struct", "variant")
        width = width + (F.coalesce(F.octet_length(value), F.lit(0)) if wide else F.lit(8))
    return tuple(df.agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first())


def hot_keys(df: DataFrame, keys: Sequence[str], max_task_rows: int = MAX_TASK_EVENTS) -> DataFrame | None:
    """(_h0, _h1, ..., _parts): keys (nulls included) with more rows than one task should hold, and into how many
    parts they should go, as a written table; None if there are none. ``df`` is read once."""
    counts = df.groupBy(*[F.col(f"`{k}`").alias(f"_h{i}") for i, k in enumerate(keys)]).agg(F.count(F.lit(1)).alias("_n"))
    hot = counts.where(F.col("_n") > max_task_rows)
    hot = cut_lineage(hot.withColumn("_parts", F.ceil(F.col("_n") / max_task_rows).cast("int")).drop("_n"))
    return None if hot.isEmpty() else hot


MEASURE = "measure"


def measure_hot_keys(
    df: DataFrame, columns: Sequence[str], rows: int, max_task_rows: int = MAX_TASK_EVENTS
) -> dict[str, DataFrame | None]:
    """Per column what ``hot_keys`` gives for it, from one scan for all of them and none where ``rows``, a bound of the rows of
    ``df``, fit a task.

    Sketches of the most frequent values are kept in map-side partials, with so many counters that they are wrong by a small part
    of ``max_task_rows``; a key that is held for hot by mistake is merely spread. A rather frequent key counts as hot from
    three quarters of the bound on, as estimates can be too low.
    """
    columns = list(dict.fromkeys(columns))
    if rows <= max_task_rows or not columns:
        return dict.fromkeys(columns)
    full = -(-rows // max_task_rows)  # so many keys can be hot at most
    top, counters = min(100_000, 2 * full + 8), min(1_000_000, 64 * full + 1_000)
    sketches = df.select(*[F.expr(f"approx_top_k(`{c}`, {min(top, counters)}, {counters})").alias(f"_s{i}") for i, c in enumerate(columns)])
    found = {}
    for i, (c, top_values) in enumerate(zip(columns, sketches.first())):
        kind = df.schema[c].dataType.simpleString()
        hot = [(v["item"], -(-v["count"] // max_task_rows)) for v in top_values or () if 4 * v["count"] > 3 * max_task_rows]
        found[c] = df.sparkSession.createDataFrame(hot, f"_h0 {kind}, _parts int") if hot else None
    return found


def balanced_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[tuple[str, str]],
    how: str = "left",
    max_rows: int = BROADCAST_ROWS,
    max_task_rows: int = MAX_TASK_EVENTS,
    hot: DataFrame | None | str = MEASURE,
) -> DataFrame:
    """Join ``left`` and ``right`` on equal keys; the right key columns are dropped.

    Runs a job at call time to measure the sides; ``hot`` is what ``measure_hot_keys`` found for the left key, where a caller
    has measured it. A right side of checked size is broadcast. Otherwise the join
    shuffles, and left rows of hot keys are spread over several partitions, with the right rows of those keys repeated
    for each. Where a hot row goes is drawn once and written down, so equal rows part and a lost executor changes nothing.
    The number of partitions grows with the rows (those of the left side are counted where its hot keys are).
    """
    renamed = right.select(
        *[F.col(f"`{r}`").alias(f"_k{i}") for i, (_, r) in enumerate(on)],
        *[F.col(f"`{c}`") for c in right.columns if c not in {r for _, r in on}],
    )
    match = [F.col(f"`{l}`") == F.col(f"_k{i}") for i, (l, _) in enumerate(on)]
    drop = [f"_k{i}" for i in range(len(on))]
    rows, size = _rows_and_bytes(renamed)
    if rows <= max_rows and size <= BROADCAST_BYTES:
        return left.join(F.broadcast(renamed), all_of(match), how).drop(*drop)
    if isinstance(hot, str):
        hot = hot_keys(left, [l for l, _ in on], max_task_rows)
        rows += left.count()

    def shuffled(left: DataFrame) -> DataFrame:
        mine, theirs = dealt(left, [l for l, _ in on], rows), dealt(renamed, drop, rows)
        return mine.join(theirs, all_of(match), how).drop(*drop)

    if hot is None:
        return shuffled(left)
    names = F.broadcast(hot) if hot.count() <= BROADCAST_ROWS else hot
    is_hot = all_of([F.col(f"`{l}`").eqNullSafe(F.col(f"_h{i}")) for i, (l, _) in enumerate(on)])
    cold = shuffled(left.join(names, is_hot, "left_anti"))
    own = [f"_h{i}" for i in range(len(on))]
    spread = left.join(names, is_hot).withColumn("_salt", F.floor(F.rand() * F.col("_parts")).cast("int"))
    spread = cut_lineage(spread.drop(*own, "_parts"))
    theirs = all_of([F.col(f"_k{i}").eqNullSafe(F.col(f"_h{i}")) for i in range(len(on))])
    repeated = renamed.join(names, theirs).withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
    joined = spread.join(repeated.drop(*own, "_parts"), all_of([*match, F.col("_salt") == F.col("_part")]), how)
    return cold.unionByName(joined.drop(*drop, "_salt", "_part"))
