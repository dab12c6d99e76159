import pytest
from pyspark.sql import functions as F

from casemill.functions.numbers import with_hashed_number
from casemill.operators import ocel as oc
from checks.sources import scratch_schema

from tests.fixtures import day

OBJECTS = {"Order": "o", "Part": "p"}


@pytest.fixture(scope="module")
def events(spark):
    rows = [
        ("e1", "a", day(1), "o1", None), ("e2", "b", day(2), "o1", "p1"), ("e3", "b", day(3), "o2", "p1"),
        ("e4", "c", day(4), None, "p2"), ("e5", "c", day(5), "o2", "p2"),
    ]
    return spark.createDataFrame(rows, "event_id string, activity string, event_timestamp timestamp_ntz, o string, p string")


@pytest.fixture(scope="module")
def log(events):
    return oc.build_ocel(events, OBJECTS)


def test_tables(events, log):
    assert log.events.columns == list(oc.EVENT_COLUMNS)
    assert log.e2o.count() == 8 and log.objects.count() == 4
    assert oc.ocel_checks(log).where("NOT passed").count() == 0
    assert [tuple(r) for r in oc.object_types(log).collect()] == [("Order", 4), ("Part", 4)]
    assert oc.default_perspective(log).first()[0] == "Order"
    assert [tuple(r) for r in oc.links_per_event(log).collect()] == [(1, 2), (2, 3)]
    assert oc.total_links(log).first()["cnt"] == 8


def test_flatten_has_one_row_per_link(log):
    for kind, n in (("Order", 4), ("Part", 4), (None, 4)):
        assert oc.flatten(log, kind).count() == n
    assert [r["event_id"] for r in oc.object_trace(log, "Part", "p1").collect()] == ["e2", "e3"]


def test_repeated_links_and_masters(spark, events):
    twice = {"Order": "o", "Buyer": "o"}
    assert oc.build_ocel(events, twice).e2o.count() == 8
    again = events.unionByName(events.where("event_id = 'e1'"))
    assert oc.build_ocel(again, OBJECTS).e2o.count() == 9
    assert oc.build_ocel(again, OBJECTS, distinct=True).e2o.count() == 8
    parts = spark.createDataFrame([("p1",), ("p9",)], "id string")
    assert oc.build_ocel(events, OBJECTS, {"Part": (parts, "id")}).objects.count() == 5


def test_checks_find_every_violation(spark, log):
    events = log.events.where("event_id <> 'e1'").unionByName(log.events.where("event_id = 'e2'"))
    events = events.unionByName(log.events.where("event_id = 'e1'").withColumn("event_id", F.lit("e9")))
    objects = log.objects.where("object_id <> 'p2'").unionByName(spark.createDataFrame([("o1", "Part")], log.objects.schema))
    got = {r["check"]: r["violations"] for r in oc.ocel_checks(oc.Ocel(events, objects, log.e2o)).collect()}
    assert got == {
        "duplicate event ids": 1, "links without event": 1, "links without object": 2, "events without link": 1,
        "ids with several types": 1,
    }


def test_offer_only_with_several_objects(events):
    assert oc.ocel_candidate(events, OBJECTS).first()["offer"]
    assert not oc.ocel_candidate(events, {"Order": "o"}).first()["offer"]
    assert not oc.ocel_candidate(events.withColumn("p", F.lit(None).cast("string")), OBJECTS).first()["offer"]


def test_sibling_names(spark):
    assert oc.sibling_tables("a_ocel_events_db.x_ocel_events") == ("a_ocel_events_db.x_ocel_objects", "a_ocel_events_db.x_ocel_e2o")
    with pytest.raises(ValueError, match="does not end"):
        oc.sibling_tables("db.x")
    with pytest.raises(ValueError, match="missing tables"):
        oc.load_ocel(spark, "nope_ocel_events")


def test_buckets_are_joined_where_they_lie(spark, events):
    with pytest.raises(ValueError, match="event numbers"):
        oc.save_ocel(oc.build_ocel(events, OBJECTS), "nowhere.x", buckets=4)
    plain = oc.build_ocel(events, OBJECTS)
    with scratch_schema(spark) as schema:
        oc.save_ocel(oc.build_ocel(oc.with_event_numbers(events), OBJECTS), f"{schema}.x", buckets=4)
        saved = oc.load_ocel(spark, f"{schema}.x_ocel_events")
        rows = lambda df: sorted(map(str, df.select(*sorted(df.columns)).collect()))
        before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            for kind in OBJECTS:
                flat = oc.flatten(saved, kind)
                assert "Exchange" not in flat._jdf.queryExecution().executedPlan().toString()
                assert rows(flat) == rows(oc.flatten(plain, kind))
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        assert rows(oc.object_trace(saved, "Part", "p1")) == rows(oc.object_trace(plain, "Part", "p1"))
        assert {r["violations"] for r in oc.ocel_checks(saved).collect()} == {r["violations"] for r in oc.ocel_checks(plain).collect()}


def test_saved_links_are_those_given(spark, events, monkeypatch):
    """Links written type by type or in one pass, null types included, and none at all; buckets grow with the links."""
    log = oc.build_ocel(oc.with_event_numbers(events), OBJECTS)
    odd = log.e2o.limit(2).withColumn("object_type", F.lit(None).cast("string"))
    every = log.e2o.unionByName(odd)
    listed = lambda df: sorted(map(repr, df.select("event_id", "object_id", "object_type").collect()))
    for few in (oc.FEW_TYPES, 1):
        monkeypatch.setattr(oc, "FEW_TYPES", few)
        for links in (every, every.limit(0), log.e2o.where("object_type = 'Order'")):
            with scratch_schema(spark) as schema:
                oc.save_ocel(oc.Ocel(log.events, log.objects, links), f"{schema}.x")
                assert listed(oc.load_ocel(spark, f"{schema}.x_ocel_events").e2o) == listed(links)
    monkeypatch.setattr(oc, "BUCKET_LINKS", 2)
    with scratch_schema(spark) as schema:
        oc.save_ocel(log, f"{schema}.x", buckets=2)
        detail = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {schema}.x_ocel_e2o").collect()}
        assert int(detail["Num Buckets"]) == max(2, -(-log.e2o.count() // 2)) > 2
        assert listed(oc.load_ocel(spark, f"{schema}.x_ocel_events").e2o) == listed(log.e2o)


def test_numbers_of_a_wanted_hash(spark):
    """Whatever the halves are, the number hashes as asked, no number comes twice, and numbers rise with the upper half."""
    edges = [0, 1, 41, 2**16, 2**31 - 1]
    rows = [(u, w) for u in [*edges, *range(7, 60_000, 601), 2**31, 2**32 - 1] for w in [*edges, 486, 1_234_567]]
    got = with_hashed_number(spark.createDataFrame(rows, "u long, w long"), "n", F.col("u"), F.col("w"))
    assert got.columns == ["u", "w", "n"] and got.where(F.hash("n") != F.col("w")).isEmpty()
    found = [tuple(r) for r in got.where(f"u < {2**31}").collect()]
    assert len({n for _, _, n in found}) == len(found) and all(n >> 32 == u for u, _, n in found)
    assert got.select("n").distinct().count() == len(rows)


def test_runs_of_events_share_a_bucket_and_are_saved_without_a_shuffle(spark, events, monkeypatch):
    many = spark.range(0, 9_000, 1, 5).select(
        F.concat(F.lit("e"), "id").alias("event_id"), F.lit("a").alias("activity"), F.lit(day(1)).alias("event_timestamp"),
        F.concat(F.lit("o"), F.col("id") % 700).alias("o"), F.when(F.col("id") % 3 > 0, F.concat(F.lit("p"), "id")).alias("p"),
    )
    monkeypatch.setattr(oc, "RUN_EVENTS", 100)
    numbered = oc.with_event_numbers(many)
    assert numbered.columns == [*many.columns, oc.EVENT_NO] and sorted(numbered.drop(oc.EVENT_NO).collect()) == sorted(many.collect())
    assert numbered.select(oc.EVENT_NO).distinct().count() == 9_000
    runs = [r["count"] for r in numbered.groupBy(F.hash(oc.EVENT_NO)).count().collect()]
    assert len(runs) == 90 and set(runs) == {100}
    per_bucket = [r["count"] for r in numbered.groupBy(F.pmod(F.hash(oc.EVENT_NO), F.lit(7))).count().collect()]
    assert len(per_bucket) == 7 and max(per_bucket) - min(per_bucket) <= 100
    assert oc.with_event_numbers(many.limit(0)).count() == 0

    log = oc.build_ocel(numbered, OBJECTS)
    scattered = {"events": log.events, "e2o": log.e2o}
    for name, df in scattered.items():
        scattered[name] = df.withColumn(oc.EVENT_NO, F.xxhash64(oc.EVENT_NO))
    frame, calls = type(log.events), []
    plain = frame.repartition
    monkeypatch.setattr(frame, "repartition", lambda self, *a: calls.append(a) or plain(self, *a))
    rows = lambda df: sorted(map(repr, df.select("event_id", "case_id").collect()))
    odd = oc.Ocel(scattered["events"], log.objects, scattered["e2o"])
    for ocel, few, most, shuffles in ((log, oc.FEW_FILES, 9_000, 0), (odd, 1, 9_000, 2), (log, oc.FEW_FILES, 100, 4)):
        monkeypatch.setattr(oc, "FEW_FILES", few)
        monkeypatch.setattr(oc, "MAX_TASK_EVENTS", most)
        with scratch_schema(spark) as schema:
            oc.save_ocel(ocel, f"{schema}.x", buckets=7)
            assert len(calls) == shuffles
            saved = oc.load_ocel(spark, f"{schema}.x_ocel_events")
            for table in (saved.events, saved.objects, saved.e2o):
                assert all(f.endswith(".zstd.parquet") for f in table.inputFiles())
            for kind in OBJECTS:
                assert rows(oc.flatten(saved, kind)) == rows(oc.flatten(oc.build_ocel(many, OBJECTS), kind))
