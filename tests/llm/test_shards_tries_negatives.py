"""Shards, prefix tries and hard negatives against plain versions, and their odd rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from casemill.llm import negatives, sharding
from casemill.llm.trie import prefix_trie
from tests.llm.conftest import CLASHING

TURNS = "conv_id long, turn long, role string, text string"


# --- shards


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 1_000, 4_097])
def test_places_are_a_permutation_and_go_back(spark, n):
    at = spark.range(n).select("id", sharding.place(F.col("id"), n, 3, 5).alias("p"))
    rows = at.select("id", "p.*", sharding.number_at(F.col("p.shard"), F.col("p.slot"), n, 3, 5).alias("back")).collect()
    assert all(r["back"] == r["id"] for r in rows)
    assert sorted(r["slot"] * 3 + r["shard"] for r in rows) == list(range(n))


def network(x, n, seed):
    """The permutation in plain Python."""
    bits = max(2, (n - 1).bit_length())
    low = bits - bits // 2
    while True:
        l, r = x >> low, x & ((1 << low) - 1)
        for a, b, c, d, mask in sharding.round_keys(n, seed):
            once = (((r ^ a) * b) >> 20) & ((1 << 31) - 1)
            l, r = r, l ^ ((((once ^ c) * d) >> 20) & mask)
        x = l << low | r
        if x < n:
            return x


def test_places_of_large_numbers_match_plain_arithmetic(spark):
    for n in (10**11, (1 << 62) - 5, 1 << 40):
        some = [0, 1, n // 3, n - 1]
        rows = spark.createDataFrame([(x,) for x in some], "x long").select(sharding.place(F.col("x"), n).alias("p")).collect()
        assert [(r["p"]["slot"], r["p"]["shard"]) for r in rows] == [divmod(network(x, n, sharding.SEED), 8) for x in some]


def test_shuffle_mixes_neighbours_and_depends_on_the_seed():
    n = 10_000
    places = np.array([network(x, n, 1) for x in range(n)])
    assert abs(np.corrcoef(np.arange(n), places)[0, 1]) < 0.05
    assert abs(np.corrcoef(places[:-1], places[1:])[0, 1]) < 0.05
    assert np.mean(places == [network(x, n, 2) for x in range(n)]) < 0.01


def test_shards_of_odd_rows_at_any_layout(spark, odd):
    def result(docs):
        rows = sharding.shard_documents(docs).collect()
        assert sorted(r["slot"] * 8 + r["shard"] for r in rows) == list(range(len(rows)))
        return Counter((r["doc_id"], r["size"], r["text_crc32"], r["shard"], r["slot"]) for r in rows)

    many = odd.unionAll(odd.where("doc_id = 9").crossJoin(spark.range(50)).drop("id").select(*odd.columns[:5], F.lit("x").alias("id"),
                                                                                         *odd.columns[6:]))
    once = result(many.repartition(1))
    assert once == result(many.repartition(7, "text"))
    texts = {r["doc_id"]: r["text"] or "" for r in odd.select("doc_id", "text").collect()}
    for doc_id, size, crc, _, _ in once:
        if doc_id is not None:
            data = texts[doc_id].encode()
            assert (size, crc) == (len(data) + 1, zlib.crc32(data))
    assert result(odd.limit(0)) == Counter()
    assert sharding.shard_documents(odd).count() == odd.count()


def test_shuffled_passes_columns_through(spark, odd):
    out = sharding.shuffled(odd, [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")], 5, 3)
    assert out.columns == [*odd.columns, "number", "shard", "slot"] and out.count() == odd.count()
    sizes = Counter(r["shard"] for r in out.collect())
    assert max(sizes.values()) - min(sizes.values()) <= 1


# --- tries


def plain_trie(rows):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            key = hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()
            convs[conv].append((turn is not None, turn or 0, key, role, text))
    own = {c: [e[3:] for e in sorted(v)] for c, v in convs.items()}
    paths, members = {}, defaultdict(list)
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        paths[c] = tuple(own.get(c - int(math.fmod(c, 20)), [])[:h] + own[c][h:])
        for d in range(len(paths[c]) + 1):
            members[paths[c][:d]].append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += children[p] == 0
            saved[p[:d]] += (len(m) - 1) * words
    out = []
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if paths[c] == p)
        above = min(members[p[:-1]]) if p else None
        sha = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(m), len(p), above, len(m), children[p], leaves[p], saved[p], sha))
    return Counter(out)


def trie(spark, rows, **options):
    log = spark.createDataFrame(rows, TURNS).withColumns({c: F.lit(c) for c in CLASHING}).repartition(3)
    return Counter(map(tuple, prefix_trie(log, **options).collect()))


def random_log(seed, convs, texts, longest):
    rng = random.Random(seed)
    rows = [(None, 1, "user", "nobody's")]
    for c in range(-5, convs):
        for t in range(rng.randint(1, longest)):
            turn = rng.choice([t, t, None]) if rng.random() < 0.05 else t
            role = rng.choice(["user", "assistant", None]) if rng.random() < 0.1 else "user"
            rows.append((c, turn, role, " ".join(rng.choice(texts) for _ in range(rng.randint(0, 2)))))
    return rows


@pytest.mark.parametrize("seed, convs, texts, longest, segment, limit", [
    (1, 60, "a", 9, 3, 2), (2, 80, "ab", 12, 4, 3), (3, 80, "ab", 12, 64, 1), (4, 150, "ab", 6, 2, 5), (5, 1, "a", 5, 2, 1),
])
def test_trie_against_plain(spark, seed, convs, texts, longest, segment, limit):
    rows = random_log(seed, convs, texts, longest)
    assert trie(spark, rows, segment=segment, limit=limit) == plain_trie(rows)


def test_trie_of_copies_long_and_odd_conversations(spark):
    rows = [(c, t, "user", f"same {t}") for c in range(100, 160) for t in range(7)]  # copies, but for what families put before
    rows += [(7, t, "user", "x " * (t % 3)) for t in range(700)] + [(8, t, "user", "x " * (t % 3)) for t in range(650)]
    rows += [(200, 0, "u", "a\x0bb c d"), (200, 0, "u", "a\x0bb c d"), (201, None, None, None), (202, 1, "a", ""), (202, 1, "", "a")]
    rows += [(300, 0, "user", "long " * 40_000), (321, 0, "user", "long " * 40_000)]
    assert trie(spark, rows, limit=16) == plain_trie(rows)
    assert trie(spark, []) == Counter()
    assert trie(spark, [(None, 0, "user", "x")]) == Counter()


def test_trie_of_a_comb(spark):
    """Every depth loses one conversation, so containers burst as often as turns are shared."""
    rows = [(20 * c, t, "user", "on" if t < c else f"off {c}") for c in range(1, 24) for t in range(c + 1)]
    assert trie(spark, rows, segment=8, limit=2) == plain_trie(rows)


# --- hard negatives


def plain_negatives(rows, chosen=lambda i: i % 100 == 0, positives=5, negatives=10):
    taking = []
    for vec_id, label, x in rows:
        if label is not None and x is not None and all(v is not None and math.isfinite(v) for v in x):
            label = (label + 1) % 10 if vec_id is not None and vec_id % 7 == 0 else label
            taking.append((vec_id, label, [int(v) * 256 if abs(v) >= 1 << 53 else math.floor(256 * v) for v in x]))
    order = lambda e: (-e[0], e[1] is None, e[1] or 0)
    out = Counter()
    for a, (anchor, label, x) in enumerate(taking):
        if anchor is None or not chosen(anchor):
            continue
        scored = [(sum(p * q for p, q in zip(x, y)), i, other == label) for b, (i, other, y) in enumerate(taking) if b != a and len(y) == len(x)]
        for score, positive, _ in sorted((s for s in scored if s[2]), key=order)[:positives]:
            fit = [s for s in scored if not s[2] and 30 * score <= 100 * s[0] <= 90 * score]
            for rank, (s, i, _) in enumerate(sorted(fit, key=order)[:negatives], 1):
                out[anchor, positive, rank, i, score, s] += 1
    return out


def mined(spark, rows, **options):
    table = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").withColumns({c: F.lit(c) for c in CLASHING})
    return Counter(map(tuple, negatives.hard_negatives(table.repartition(3), label=negatives.moved_label(), **options).collect()))


@pytest.mark.parametrize("dims, spread, options", [
    (1, 1.0, {}), (12, 0.3, {"block_bytes": 1}), (40, 1.0, {"pass_bytes": 900}), (40, 0.05, {"block_bytes": 1, "pass_bytes": 2_000}),
    (9, 0.0, {}),
])
def test_negatives_against_plain(spark, dims, spread, options):
    rng = np.random.default_rng(dims)
    base = rng.normal(size=dims)
    rows = [(int(i), int(i) % 3, (rng.uniform(0.2, 1) * (base + spread * rng.normal(size=dims))).tolist())
            for i in rng.permutation(900)]
    want = plain_negatives(rows)
    assert mined(spark, rows, **options) == want and sum(want.values()) > 0


def test_negatives_odd_rows(spark):
    rng = np.random.default_rng(1)
    rows = [(i, i % 2, rng.normal(size=4).tolist()) for i in range(60)]
    rows += [(100, 1, [1.0, 2.0, 3.0, 4.0])] * 2 + [(None, 0, [1.0, 1.0, 1.0, 1.0]), (None, 1, [1.0, 2.0, 3.0, 4.0])]
    rows += [(200, None, [1.0] * 4), (201, 0, None), (202, 0, [1.0, None, 1.0, 1.0]), (203, 0, [float("nan")] * 4),
             (204, 0, [float("inf")] * 4), (300, 0, []), (301, 0, []), (302, 1, []), (400, 0, [1.0, 2.0]), (401, 1, [1.0, 2.0]),
             (500, 1, [0.0] * 4)]
    assert mined(spark, rows) == plain_negatives(rows)
    big = [(i, i % 2, [1e5 * (i + 1), 1e5, 2e6]) for i in range(30)] + [(100, 1, [3e6, 1.0, 1.5e6])]
    assert mined(spark, big) == plain_negatives(big)
    huge = mined(spark, [(0, 1, [1e300]), (1, 1, [1e300]), (2, 0, [1e299]), (3, 2, [-1e300])])
    assert all(score == (1 << 63) - 1 for _, _, _, _, score, _ in huge)
    assert mined(spark, []) == Counter()


def test_a_vertical_scan_leaves_candidates_out_early():
    """Candidates leave before all dimensions are read, and the ones that stay are those of a full scan."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(64, 3_000)) * np.geomspace(1, 0.01, 64)[:, None]
    value = np.floor(256 * x).astype(np.int16)
    n = x.shape[1]
    block = negatives.Block(64, np.arange(n), np.arange(n), np.ones(n, np.uint8), np.zeros(n, np.int64), value,
                            value.min(1).astype(float), value.max(1).astype(float))
    anchor = value[:, 7].astype(float)
    left = []

    def keep(low, high):
        left.append(len(low))
        bar = np.partition(low, len(low) - 10)[len(low) - 10] if len(low) >= 10 else -np.inf
        return high >= bar

    at, score = negatives.vertical_scan(block, anchor, np.arange(n), keep)
    exact = anchor.astype(np.int64) @ value.astype(np.int64)
    first = np.sort(exact)[-10]
    assert set(np.flatnonzero(exact >= first)) <= set(at.tolist()) and (score == exact[at]).all()
    assert left[3] < n / 10
