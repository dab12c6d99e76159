"""Object-centric logs: events, objects and the links between them."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casemill.functions.columns import ACTIVITY, CASE, TIMESTAMP, share_pct
from casemill.functions.numbers import with_hashed_number
from casemill.operators.ordering import MAX_TASK_EVENTS, CaseLoad, measure_cases
from casemill.session import written

EVENT_NO = "event_no"
BUCKET_LINKS = 2_000_000  # links that a bucket should have at most
RUN_EVENTS = 100_000  # events in a row that go to the same bucket, at most
MIN_RUNS = 64  # into so many runs at least, as far as there are events
FEW_FILES, FILE_ROWS = 256, 50_000  # up to so many files, or with so many rows each, buckets are written from where rows lie
FEW_TYPES = 32  # up to so many object types, links are written in one pass for each
COMPACT = {"compression": "zstd"}  # tables of long ids are half as large as by default
EVENT_COLUMNS = ("event_id", ACTIVITY, TIMESTAMP, "resource", "cost", "source_table")


@dataclass(frozen=True)
class Ocel:
    events: DataFrame
    objects: DataFrame
    e2o: DataFrame


def ocel_candidate(events: DataFrame, objects: Mapping[str, str]) -> DataFrame:
    """(object_columns, events, multi_object_events, pct, offer): is an object-centric log worth offering?"""
    used = [F.count(F.col(f"`{c}`")).alias(f"_u{i}") for i, c in enumerate(objects.values())]
    links = sum((F.col(f"`{c}`").isNotNull().cast("int") for c in objects.values()), F.lit(0))
    totals = events.agg(F.count(F.lit(1)).alias("events"), F.count_if(links > 1).alias("multi_object_events"), *used)
    filled = sum(((F.col(f"_u{i}") > 0).cast("int") for i in range(len(objects))), F.lit(0))
    return totals.select(
        filled.alias("object_columns"),
        "events",
        "multi_object_events",
        share_pct(F.col("multi_object_events"), F.col("events")).alias("pct"),
        ((filled >= 2) & (F.col("multi_object_events") > 0)).alias("offer"),
    )


def _links(objects: Mapping[str, str]) -> Column:
    """One struct (object_id, object_type) per object column; ids of all types become text."""
    return F.array(
        *[
            F.struct(F.col(f"`{c}`").cast("string").alias("object_id"), F.lit(kind).alias("object_type"))
            for kind, c in objects.items()
        ]
    )


def with_event_numbers(events: DataFrame) -> DataFrame:
    """``events`` with a number of their own, written. Tables built from them are joined by it instead of by long text ids, and
    can be saved in buckets.

    The upper half of a number is the place of the event among all of them, the lower half makes it hash to the number of its run
    of events. So the events of a run share a bucket whatever the number of buckets, runs are dealt to the buckets in turn, and
    what is written together needs no shuffle to get there. Files end where runs do.
    """
    task_bits = 33  # below the task in a number that Spark gives
    at = F.monotonically_increasing_id()
    events = written(events.withColumn(EVENT_NO, at), "numbered-events", maxRecordsPerFile=str(RUN_EVENTS), **COMPACT)
    task, at = F.shiftright(EVENT_NO, task_bits), F.col(EVENT_NO).bitwiseAND(F.lit((1 << task_bits) - 1))
    counts = events.groupBy(task.alias("task")).agg(F.count(F.lit(1)).alias("n")).orderBy("task").collect()  # a row per task
    run = max(1, min(RUN_EVENTS, sum(r["n"] for r in counts) // MIN_RUNS))
    begins, place, run_no = [], 0, 0
    for r in counts:
        begins.append((r["task"], place, run_no))
        place, run_no = place + r["n"], run_no - (-r["n"] // run)
    begins = F.broadcast(events.sparkSession.createDataFrame(begins, "_task long, _begin long, _first_run long"))
    placed = events.join(begins, task == F.col("_task")).withColumn("_at", at)
    upper = (F.col("_begin") + F.col("_at")).bitwiseAND(F.lit(0xFFFFFFFF))
    wanted = (F.col("_first_run") + F.expr(f"_at div {run}")).bitwiseAND(F.lit(0x7FFFFFFF))
    return with_hashed_number(placed, EVENT_NO, upper, wanted).drop("_task", "_begin", "_first_run", "_at")


def build_ocel(
    events: DataFrame,
    objects: Mapping[str, str],
    masters: Mapping[str, tuple[DataFrame, str]] | None = None,
    distinct: bool = False,
) -> Ocel:
    """The three tables from a log with one column per object type.

    ``masters`` adds objects of master tables, given as type → (table, key), also those without events. Links
    of an event are made by exploding an array in one scan; ``distinct`` removes repeated links. Event numbers, where the
    events have them, go into the events and the links.
    """
    number = [EVENT_NO] if EVENT_NO in events.columns else []
    source = "source_table" if "source_table" in events.columns else "source_system"
    shaped = events.withColumnRenamed(source, "source_table") if source in events.columns else events
    missing = [c for c in EVENT_COLUMNS if c not in shaped.columns]
    shaped = shaped.withColumns({c: F.lit(None).cast("string") for c in missing}) if missing else shaped
    e2o = events.select("event_id", *number, F.inline(_links(objects))).where(F.col("object_id").isNotNull())
    objs = e2o.select("object_id", "object_type").distinct()
    if masters:
        for kind, (table, key) in masters.items():
            ids = table.select(F.col(f"`{key}`").cast("string").alias("object_id"), F.lit(kind).alias("object_type"))
            objs = objs.unionByName(ids.where(F.col("object_id").isNotNull()))
        objs = objs.distinct()
    return Ocel(shaped.select(*EVENT_COLUMNS, *number), objs, e2o.distinct() if distinct else e2o)


def ocel_checks(ocel: Ocel) -> DataFrame:
    """(check, violations, passed): unique events and objects, links without event or object, events without
    link, ids with several types.

    Tables are not joined: rows and links of an id are counted side by side, one pre-aggregated shuffle for
    events and one for objects.
    """

    def side_by_side(rows: DataFrame, keys: list[str]) -> DataFrame:
        mine = rows.select(*keys, F.lit(1).alias("_rows"), F.lit(0).alias("_links"))
        links = ocel.e2o.select(*keys, F.lit(0).alias("_rows"), F.lit(1).alias("_links"))
        return mine.unionByName(links).groupBy(*keys).agg(F.sum("_rows").alias("_rows"), F.sum("_links").alias("_links"))

    def total(column: Column) -> Column:
        return F.coalesce(F.sum(column), F.lit(0)).cast("long")

    def listed(counts: DataFrame, names: Mapping[str, str]) -> DataFrame:
        cells = [F.struct(F.lit(text).alias("check"), F.col(c).alias("violations")) for c, text in names.items()]
        return counts.select(F.inline(F.array(*cells)))

    events = side_by_side(ocel.events, ["event_id"]).agg(
        F.count_if(F.col("_rows") > 1).alias("twice"),
        total(F.when(F.col("_rows") == 0, F.col("_links"))).alias("no_event"),
        total(F.when(F.col("_links") == 0, F.col("_rows"))).alias("no_link"),
    )
    per_id = side_by_side(ocel.objects, ["object_id", "object_type"]).groupBy("object_id").agg(
        F.count_if(F.col("_rows") > 0).alias("_types"), F.sum(F.when(F.col("_rows") == 0, F.col("_links"))).alias("_lost")
    )
    objects = per_id.agg(total(F.col("_lost")).alias("no_object"), F.count_if(F.col("_types") > 1).alias("types"))
    event_names = {"twice": "duplicate event ids", "no_event": "links without event", "no_link": "events without link"}
    object_names = {"no_object": "links without object", "types": "ids with several types"}
    out = listed(events, event_names).unionByName(listed(objects, object_names))
    return out.withColumn("passed", F.col("violations") == 0)


def object_types(ocel: Ocel) -> DataFrame:
    """(object_type, cnt): links per type, most linked first."""
    return ocel.e2o.groupBy("object_type").agg(F.count(F.lit(1)).alias("cnt")).orderBy(F.desc("cnt"), "object_type")


def default_perspective(ocel: Ocel) -> DataFrame:
    """(object_type): the most linked type."""
    return object_types(ocel).limit(1).select("object_type")


def _event_key(ocel: Ocel) -> str:
    """What links and events are joined by: the event number where both have it."""
    return EVENT_NO if EVENT_NO in ocel.events.columns and EVENT_NO in ocel.e2o.columns else "event_id"


def flatten(ocel: Ocel, object_type: str | None = None) -> DataFrame:
    """A traditional log seen from one object type, whose ids become the case; default: the most linked type.

    An event linked to n objects of the type appears n times, so its id is only unique within a case. Tables that were
    saved in buckets are joined where they lie.
    """
    kind = F.lit(object_type) if object_type is not None else default_perspective(ocel).scalar()
    key = _event_key(ocel)
    cases = ocel.e2o.where(F.col("object_type") == kind).select(key, F.col("object_id").alias(CASE))
    return ocel.events.join(cases, key).select(*[c for c in ocel.events.columns if c != EVENT_NO], CASE)


def perspective_load(ocel: Ocel, object_type: str | None = None) -> CaseLoad:
    """How the events of a perspective spread over its cases; needs the links only, not the join."""
    kind = F.lit(object_type) if object_type is not None else default_perspective(ocel).scalar()
    links = ocel.e2o.where(F.col("object_type") == kind).select(F.col("object_id").alias(CASE))
    return measure_cases(links)


def object_counts(ocel: Ocel) -> DataFrame:
    """(object_type, cnt): objects per type, most first."""
    counts = ocel.objects.groupBy("object_type").agg(F.count(F.lit(1)).alias("cnt"))
    return counts.orderBy(F.desc("cnt"), "object_type")


def links_per_event(ocel: Ocel) -> DataFrame:
    """(links, events): how many events have how many links."""
    per_event = ocel.e2o.groupBy("event_id").agg(F.count(F.lit(1)).alias("links"))
    return per_event.groupBy("links").agg(F.count(F.lit(1)).alias("events")).orderBy("links")


def total_links(ocel: Ocel) -> DataFrame:
    """(cnt): number of links."""
    return ocel.e2o.agg(F.count(F.lit(1)).alias("cnt"))


def object_trace(ocel: Ocel, object_type: str, object_id: str) -> DataFrame:
    """The events of one object in order."""
    mine = ocel.e2o.where((F.col("object_type") == object_type) & (F.col("object_id") == object_id))
    key = _event_key(ocel)
    return ocel.events.join(mine.select(key), key, "left_semi").drop(EVENT_NO).orderBy(TIMESTAMP, "event_id")


EVENTS_SUFFIX, OBJECTS_SUFFIX, LINKS_SUFFIX = "_ocel_events", "_ocel_objects", "_ocel_e2o"


def sibling_tables(events_table: str) -> tuple[str, str]:
    """(objects table, link table) that belong to an events table; only the table part is looked at."""
    schema, _, name = events_table.rpartition(".")
    if not name.endswith(EVENTS_SUFFIX):
        raise ValueError(f"{events_table} does not end in {EVENTS_SUFFIX}")
    base = (schema + "." if schema else "") + name.removesuffix(EVENTS_SUFFIX)
    return base + OBJECTS_SUFFIX, base + LINKS_SUFFIX


def load_ocel(spark: SparkSession, events_table: str) -> Ocel:
    """The three tables of an object-centric log by the name of its events table; a missing one raises."""
    objects, links = sibling_tables(events_table)
    missing = [t for t in (events_table, objects, links) if not spark.catalog.tableExists(t)]
    if missing:
        raise ValueError(f"missing tables: {', '.join(missing)}")
    e2o = spark.table(links)
    first = [c for c in ("event_id", "object_id", "object_type") if c in e2o.columns]
    return Ocel(spark.table(events_table), spark.table(objects), e2o.select(*first, *[c for c in e2o.columns if c not in first]))


def save_ocel(ocel: Ocel, base: str, buckets: int | None = None) -> None:
    """Write the three tables under ``base`` plus their suffixes, links in a folder per object type.

    With ``buckets``, events and links are dealt to so many buckets by the event number (see ``with_event_numbers``), so that no
    later flattening shuffles them; to more where these would have more than BUCKET_LINKS links, so that a bucket is sorted and
    joined in memory. Rows whose numbers put them into few files as they lie are written from there, by tasks of at most
    MAX_TASK_EVENTS rows, others are shuffled into a file for each bucket. An event has at most as many links as there are object columns, so buckets are about even. The links
    of each type are written on their own, as writing several folders from a task sorts all its links (unless shuffled).
    """
    if buckets is not None and _event_key(ocel) != EVENT_NO:
        raise ValueError("buckets need event numbers")

    kinds = ocel.e2o.groupBy("object_type").agg(F.count(F.lit(1)).alias("n")).limit(FEW_TYPES + 1).collect()
    few = len(kinds) <= FEW_TYPES
    if buckets is not None:
        links = sum(kind["n"] for kind in kinds) if few else ocel.e2o.count()
        buckets = max(buckets, -(-links // BUCKET_LINKS))

    def must_shuffle(df: DataFrame, passes: int = 1) -> bool:
        """Would the rows as they lie go into many small files, or a task sort too many of them in one of the passes?"""
        if buckets is None:
            return False
        bucket = F.pmod(F.hash(EVENT_NO), F.lit(buckets))
        files = df.groupBy(F.spark_partition_id().alias("task"), bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
        tasks = files.groupBy("task").agg(F.count(F.lit(1)).alias("files"), F.sum("n").alias("n"))
        many, rows, most = tasks.agg(*[F.coalesce(c, F.lit(0)) for c in (F.sum("files"), F.sum("n"), F.max("n"))]).first()
        return many > max(FEW_FILES, rows // FILE_ROWS) or most > passes * MAX_TASK_EVENTS

    def writer(df: DataFrame, shuffle: bool, mode: str = "overwrite"):
        dealt = df.repartition(buckets, EVENT_NO) if shuffle else df
        out = dealt.write.mode(mode).format("parquet").options(**COMPACT)
        return out if buckets is None else out.bucketBy(buckets, EVENT_NO).sortBy(EVENT_NO)

    writer(ocel.events, must_shuffle(ocel.events)).saveAsTable(base + EVENTS_SUFFIX)
    ocel.objects.write.mode("overwrite").format("parquet").options(**COMPACT).saveAsTable(base + OBJECTS_SUFFIX)
    shuffle = must_shuffle(ocel.e2o, len(kinds) if few else 1)
    if shuffle or not kinds or not few:
        writer(ocel.e2o, shuffle).partitionBy("object_type").saveAsTable(base + LINKS_SUFFIX)
        return
    for i, kind in enumerate(kinds):
        kind = F.lit(kind["object_type"]).cast("string")
        links = ocel.e2o.where(F.col("object_type").eqNullSafe(kind)).withColumn("object_type", kind)
        writer(links, False, "append" if i else "overwrite").partitionBy("object_type").saveAsTable(base + LINKS_SUFFIX)
