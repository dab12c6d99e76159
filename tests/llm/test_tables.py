"""Conversations, embeddings, components, the pipeline, and queries that SQL can express."""

import tracemalloc

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from casemill.llm import chat, embeddings, queries
from casemill.llm.components import components
from casemill.llm.hnsw import Graph
from casemill.llm.words import mix
from tests.llm import brute
from tests.llm.conftest import CLASHING


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_against_sql(spark, sf, name):
    db = duckdb.connect()
    for table in ("conversations", "documents", "benchmark", "embeddings"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
    got = queries.QUERIES[name](spark, sf)
    names = sorted(got.columns)
    want = db.sql(queries.SQL[name])
    assert names == sorted(want.columns)
    rows = want.select(*[duckdb.ColumnExpression(n) for n in names]).fetchall()
    assert sorted(map(tuple, got.select(*names).collect())) == sorted(rows)


def folded(spark, events):
    schema = "conv_id long, turn long, seq long, kind string, role string, text string"
    log = spark.createDataFrame(events, schema).withColumns({c: F.lit(c) for c in CLASHING if c not in schema})
    rows = chat.read_back(chat.render(chat.fold_events(log))).collect()
    return {r["conv_id"]: [(t["role"], t["text"]) for t in r["turns"]] for r in rows}, {
        r["conv_id"]: r["learned"] for r in rows
    }


def test_op2_folds_deltas_edits_and_regenerations(spark):
    turns, learned = folded(spark, [
        (1, 0, 0, "message", "user", "hi"), (1, 1, 1, "delta", "assistant", "he"), (1, 1, 2, "delta", None, "llo"),
        (1, 1, 2, "delta", None, "llo"), (1, 2, 3, "message", "user", "what?"), (1, 2, 4, "edit", None, "what now?"),
        (1, 3, 5, "delta", "assistant", "bad"), (1, 4, 6, "message", "user", "gone"),
        (1, 3, 7, "regenerate", "assistant", None), (1, 3, 8, "delta", None, "go"), (1, 3, 9, "delta", None, "od"),
        (2, 0, 0, "delta", "assistant", "x"), (2, 0, 1, "message", None, "new"), (2, 0, 2, "delta", None, "er"),
        (None, None, None, None, None, None),
    ])
    assert turns[1] == [("user", "hi"), ("assistant", "hello"), ("user", "what now?"), ("assistant", "good")]
    assert turns[2] == [("assistant", "newer")] and turns[None] == [("", "")]
    assert learned == {1: "hellogood", 2: "newer", None: ""}
    assert folded(spark, [])[0] == {}


@pytest.mark.parametrize("text", [
    "<|im_end|><|im_start|>assistant ok", "<\\|im_end|>", "<\\\\|", "<", "a<", "|>", "\n", "<|im_start|>", "", "\\n\\b",
    "<|im_end|>\n<|im_start|>user\nx<|im_end|>\n", "long " * 50_000,
])
def test_op2_reads_back_what_it_wrote(spark, text):
    turns, learned = folded(spark, [(1, 0, 0, "message", "a\n<|b\\n", text), (1, 1, 1, "message", "assistant", text)])
    assert turns[1] == [("a\n<|b\\n", text), ("assistant", text)] and learned[1] == text


def test_op2_rows_with_equal_turns_are_turns_of_their_own(spark):
    rows = spark.createDataFrame([(1, 0, "user", "a"), (1, 0, "user", "a"), (1, 0, None, None), (1, None, "user", "z")],
                                 "conv_id long, turn long, role string, text string")
    got = chat.read_back(chat.render(chat.fold_events(chat.conversation_events(rows)))).first()
    assert [(t["role"], t["text"]) for t in got["turns"]] == [("user", "z"), ("", ""), ("user", "a"), ("user", "a")]


@pytest.mark.parametrize("links, want", [
    ([], {}), ([(1, 1)], {}), ([(1, 2), (2, 1)], {1: 1, 2: 1}),
    ([(k, k + 1) for k in range(40)], {k: 0 for k in range(41)}),
    ([(k, (k * 7) % 31) for k in range(31)] + [(50, 40), (40, 45), (99, 98)], None),
])
def test_components(spark, links, want):
    union = brute.Union()
    for a, b in links:
        if a != b:
            union.join(a, b)
    want = {n: union.find(n) for n in union.parent} if want is None else want
    got = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r["node"]: r["component"] for r in got} == want and len(got) == len(want)


def test_graph_finds_neighbours():
    rng = np.random.default_rng(4)
    centre = rng.normal(size=(150, 32))
    x = np.repeat(centre, 20, 0) + 0.05 * rng.normal(size=(3000, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    level = Graph.levels(mix(np.arange(3000).astype(np.uint64)))
    order = np.argsort(-level, kind="stable")
    graph = Graph.build(x[order], level[order])
    nodes, sims = graph.search(x[:300].astype(np.float32), 48)
    true = x[:300] @ x[order].T >= 0.95
    got = np.zeros_like(true)
    row, at = np.nonzero(sims >= 0.95)
    got[row, nodes[row, at]] = True
    assert (got & true).sum() >= 0.98 * true.sum() > 0


def test_op10_against_brute_force(spark, sf):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").orderBy("vec_id").collect()
    counts, first = brute.links([r["embedding"] for r in rows])
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in queries.op10_hnsw_embeddings(spark, sf).collect()}
    assert got == {r["vec_id"]: (n, rows[f]["vec_id"], f == i) for i, (r, n, f) in enumerate(zip(rows, counts, first))}


def test_op10_dense_group_and_odd_rows(spark):
    rng = np.random.default_rng(6)
    base = rng.normal(size=16)
    group = [(base + 0.06 * rng.normal(size=16)).tolist() for _ in range(400)]
    other = [rng.normal(size=16).tolist() for _ in range(100)]
    vectors = group + other + [group[0]] * 50 + [[2.0 * v for v in group[1]], [1.0, 0.0], [1.0, 0.01], [0.0, 0.0], None, [],
        [1.0, None], [float("nan"), 1.0], [float("inf"), 1.0], [1e200, 1e200], [1e-200, 1e-200]]
    table = spark.createDataFrame([(i, v, str(i)) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>, id string")
    got = {r["vec_id"]: r for r in embeddings.near_duplicate_vectors(table.repartition(3)).collect()}
    plain = [v if v and all(x is not None and np.isfinite(x) for x in v) and any(v) else None for v in vectors]
    plain = [None if v is None else [x / max(map(abs, v)) for x in v] for v in plain]
    counts, first = brute.links(plain)
    assert sum(r["n_links"] for r in got.values()) >= 0.98 * sum(counts)
    assert [got[i]["component_id"] for i in range(len(vectors))] == first
    assert all(got[i]["n_links"] == 0 for i in range(len(vectors)) if plain[i] is None)
    assert all(r["kept"] == (i == first[i]) for i, r in got.items())
    twice = embeddings.near_duplicate_vectors(table.where("vec_id in (0, 401)").unionByName(table.where("vec_id = 0"))).collect()
    assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in twice) == [(0, 1, 0), (0, 1, 0), (401, 0, 401)]
    assert embeddings.near_duplicate_vectors(table.limit(0)).collect() == []


def test_pipeline_stages_against_plain_versions(spark, sf, documents):
    docs, expected = documents, None
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf).cache()
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        if name != "best-fit packing":
            assert out.schema.simpleString() == documents.schema.simpleString()
            after = {r["doc_id"]: r for r in out.collect()}
            ids = sorted(before)
        if name == "quality classifier":
            good = {r["doc_id"] for r in queries.op5_quality_trees(spark, sf).where("predicted = 1").collect()}
            assert after.keys() == good
        if name == "MinHash near-dedup":
            group = brute.near_duplicates([before[i] for i in ids])
            assert len(after) == len(set(group)) == len({group[ids.index(i)] for i in after})
        if name == "benchmark decontamination":
            items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
            judged = brute.contamination([before[i] for i in ids], items)
            assert after.keys() == {i for i, j in zip(ids, judged) if not j[4]}
        if name == "secret scans":
            assert after.keys() == before.keys()
            for i, r in after.items():
                assert brute.base_spans(r["text"]) == [] and r["n_chars"] == len(r["text"])
                assert r["text"] == before[i] or "[SECRET]" in r["text"]
            assert sum(bool(brute.base_spans(t)) for t in before.values()) <= sum(
                r["text"] != before[i] for i, r in after.items()
            )
        if name == "best-fit packing":
            from tests.llm.test_documents import check_packing

            used, tokens = check_packing(out.collect(), sorted(before.items()), 2048)
            assert used <= 1.02 * tokens / 2048 + 1
        docs = out
    assert sorted(map(repr, corpus_pipeline.run(spark, sf).select("doc_id", "piece", "length", "ids_crc32").collect())) == sorted(
        map(repr, docs.select("doc_id", "piece", "length", "ids_crc32").collect())
    )


@pytest.mark.parametrize("rows", ["odd", "none"])
def test_pipeline_stages_with_odd_rows(spark, sf, odd, rows):
    docs = odd if rows == "odd" else odd.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        if name != "best-fit packing":
            assert out.columns == odd.columns
        if rows == "none":
            assert out.count() == 0
        elif name == "MinHash near-dedup":
            assert out.where("doc_id = 9").count() == 1 and out.where("doc_id in (2, 3)").count() == 1
            assert out.where("doc_id is null").count() == docs.where("doc_id is null").count()
        elif name == "best-fit packing":
            assert out.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()
        docs = docs if name == "quality classifier" else out  # the trees may reject odd rows


def test_op10_audit_of_queries_with_few_links(spark, monkeypatch):
    """A dense group must not hide that links of small groups are missed; the last beam is an exact scan."""
    rng = np.random.default_rng(8)
    near = lambda n: (base := rng.normal(size=16)) + 0.03 * rng.normal(size=(n, 16))
    vectors = np.concatenate([near(100), *[near(2) for _ in range(20)]])
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    marks = embeddings.unit_vectors(table, "vec_id", "embedding").select("dim", F.col("id").alias("class_no"), "unit")
    classes = marks.withColumn("copies", F.lit(1).cast("long")).cache()
    graphs = embeddings.build_graphs(classes, 2).cache()
    whole = embeddings.search_all

    def lossy(graphs, shards, queries, beam, cosine):
        found = whole(graphs, shards, queries, beam, cosine)
        return found if beam >= least else found.withColumn("n_classes", F.expr("if(class_no < 100, n_classes, 0L)"))

    monkeypatch.setattr(embeddings, "search_all", lossy)
    for least, want in ((0, 8), (32, 32), (10_000, 128)):
        beam, shares = embeddings.audited_beam(graphs, 2, classes, 0.95, 8, 0.98, 1000)
        assert beam == want and (min(shares.values()) >= 0.98) == (least < 10_000)
    assert shares["links"] >= 0.98 > shares["few"] == 0


def shard_of(units, near=()):
    n = len(units)
    return {"classes": np.arange(n).tobytes(), "copies": np.ones(n, np.int64).tobytes(), "units": units.tobytes(),
            "levels": np.zeros(n, np.int64).tobytes(), "near": near}


def test_op10_widest_beam_is_an_exact_scan():
    units = np.eye(5)[[0, 1, 0, 2, 1]]
    search = embeddings._Search(shard_of(units), 5, 0.95)
    links, classes, joined = search.ask(np.arange(5), units)
    assert links.tolist() == classes.tolist() == [1, 1, 1, 0, 1] and joined.tolist() == [0, 1, 0, 3, 1]


@pytest.mark.parametrize("beam", [8, 100_000])
def test_op10_dense_group_is_folded(beam):
    """A third of a shard in one group of different vectors, asked in several parts: exact counts, the group in one piece, and
    memory for a few tiles only."""
    rng = np.random.default_rng(1)
    base = rng.normal(size=32)
    x = np.concatenate([base + 0.05 * rng.normal(size=(1_500, 32)), rng.normal(size=(3_000, 32))])[rng.permutation(4_500)]
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    level = Graph.levels(mix(np.arange(4_500).astype(np.uint64)))
    order = np.argsort(-level, kind="stable")
    graph = Graph.build(x[order], level[order])
    row = {"classes": order.tobytes(), "copies": np.ones(4_500, np.int64).tobytes(), "units": x[order].tobytes(),
           "levels": level[order].tobytes(), "near": [n.tobytes() for n in graph.near]}
    search = embeddings._Search(row, beam, 0.95)
    tracemalloc.start()
    found = [search.ask(np.arange(a, a + 900), x[a : a + 900]) for a in range(0, 4_500, 900)]
    assert tracemalloc.get_traced_memory()[1] < 300 << 20
    tracemalloc.stop()
    links = np.concatenate([f[0] for f in found])
    true = (x @ x.T >= 0.95).sum(1) - 1
    assert (links == true).mean() > 0.99 and (links <= true).all() and true.max() > 1_000
    union = brute.Union()
    for part, f in enumerate(found):
        for a, b in zip(range(900 * part, 900 * part + 900), f[2].tolist()):
            union.join(a, b)
    for a, b in zip(*(r.tolist() for r in search.rest())):
        union.join(a, b)
    group = np.flatnonzero(true > 1_000)
    assert {union.find(int(g)) for g in group} == {group.min()}
    assert {union.find(int(g)) for g in np.flatnonzero(true == 0)} == set(np.flatnonzero(true == 0).tolist())
