"""Checks of process-mining analytics."""

from __future__ import annotations

from pyspark.sql import functions as F

from casemill.operators import cases, conformance, dfg, variants
from casemill.operators.model import SILENT, ProcessTree, allowed_pairs, block, discover_model, leaf
from casemill.operators.ordering import measure_cases, sequence
from casemill.operators.replay import fitness, replay
from casemill.session import cut_lineage

from checks.logs import CLICKS_SQL, DAYS_SQL, LOG_SQL, PAIRS_SQL, RAW_SQL, clicks, clicks_by_day, o2c
from checks.registry import check

_EDGES_SQL = f"{PAIRS_SQL}, edges AS (SELECT src, tgt, count(*) AS freq FROM pairs WHERE tgt IS NOT NULL GROUP BY 1, 2)"


@check("h01_dfg", f"WITH {_EDGES_SQL} SELECT * FROM edges")
def graph(spark, sf):
    return dfg.dfg(*o2c(spark, sf))


@check(
    "h02_start_end",
    f"""WITH {RAW_SQL}, r AS (SELECT activity, row_number() OVER (PARTITION BY case_id ORDER BY event_timestamp, source_seq, event_id) AS up,
  row_number() OVER (PARTITION BY case_id ORDER BY event_timestamp DESC, source_seq DESC, event_id DESC) AS down FROM raw)
SELECT activity, 'start' AS kind, count(*) AS n FROM r WHERE up = 1 GROUP BY 1
UNION ALL SELECT activity, 'end', count(*) FROM r WHERE down = 1 GROUP BY 1""",
)
def ends(spark, sf):
    return dfg.start_end(o2c(spark, sf)[0])


@check("h03_activity_counts", f"WITH {RAW_SQL} SELECT activity, count(*) AS n FROM raw GROUP BY 1")
def counts(spark, sf):
    return dfg.activity_counts(o2c(spark, sf)[0])


_LAYERS_SQL = f"""{LOG_SQL}, layers AS (
  SELECT activity, CAST(round_even(quantile_cont(event_rank, 0.5), 0) AS BIGINT) AS layer FROM log GROUP BY 1)"""


@check("h04_dfg_layers", f"WITH {_LAYERS_SQL} SELECT * FROM layers")
def layers(spark, sf):
    return dfg.dfg_layers(*o2c(spark, sf))


@check(
    "h05_dfg_layout",
    f"""WITH {_LAYERS_SQL} SELECT activity, layer, CAST(layer * 2 AS DOUBLE) AS x,
  CAST((row_number() OVER (PARTITION BY layer ORDER BY activity) - 1 - (count(*) OVER (PARTITION BY layer) - 1) / 2) * 1.5 AS DOUBLE) AS y
FROM layers""",
)
def layout(spark, sf):
    return dfg.dfg_layout(*o2c(spark, sf))


@check(
    "h06_dfg_weights",
    f"""WITH {_EDGES_SQL}, nodes AS (SELECT activity, count(*) AS n FROM raw GROUP BY 1)
SELECT 'edge' AS kind, src, tgt, freq AS n, round(greatest(0.5, 4 * freq / max(freq) OVER ()), 6) AS width,
  round(greatest(0.2, freq / max(freq) OVER ()), 6) AS opacity, CAST(NULL AS DOUBLE) AS size FROM edges
UNION ALL SELECT 'node', activity, NULL, n, NULL, NULL, round(greatest(20, 60 * n / max(n) OVER ()), 6) FROM nodes""",
)
def weights(spark, sf):
    out = dfg.dfg_weights(*o2c(spark, sf))
    return out.withColumns({c: F.round(c, 6) for c in ("width", "opacity", "size")})


_SPANS_SQL = f"""{RAW_SQL}, spans AS (SELECT case_id, count(*) AS events, min(event_timestamp) AS first, max(event_timestamp) AS last,
  (epoch_us(max(event_timestamp)) - epoch_us(min(event_timestamp))) / 1e6 AS seconds FROM raw GROUP BY 1)"""


@check(
    "h07_kpis",
    f"""WITH {_SPANS_SQL} SELECT count(*) AS cases, CAST(sum(events) AS BIGINT) AS events,
  (SELECT count(DISTINCT activity) FROM raw) AS activities, round(quantile_cont(seconds / 86400, 0.5), 6) AS median_duration_days FROM spans""",
)
def kpis(spark, sf):
    return cases.kpis(*o2c(spark, sf)).withColumn("median_duration_days", F.round("median_duration_days", 6))


@check(
    "h08_case_durations",
    f"""WITH {_SPANS_SQL} SELECT case_id, events, first, last, round(seconds, 6) AS duration_seconds,
  round(seconds / 86400, 6) AS duration_days FROM spans""",
)
def durations(spark, sf):
    out = cases.case_durations(o2c(spark, sf)[0])
    return out.withColumns({c: F.round(c, 6) for c in ("duration_seconds", "duration_days")})


@check(
    "h09_median_duration",
    f"""WITH {_SPANS_SQL} SELECT round(quantile_cont(seconds, 0.5), 6) AS median_seconds,
  round(quantile_cont(seconds / 86400, 0.5), 6) AS median_days FROM spans""",
)
def median(spark, sf):
    log, load = o2c(spark, sf)
    out = cases.median_duration(log, load=load)
    return out.select(F.round("median_seconds", 6).alias("median_seconds"), F.round("median_days", 6).alias("median_days"))


@check(
    "h10_duration_histogram",
    f"""WITH {_SPANS_SQL}, b AS (SELECT min(seconds / 86400) AS lo, max(seconds / 86400) AS hi FROM spans),
p AS (SELECT lo AS low, (hi - lo) / 40 AS w, least(floor((seconds / 86400 - lo) / ((hi - lo) / 40)), 39) AS bin FROM spans, b)
SELECT CAST(bin AS INTEGER) AS bin, round(low + bin * w, 6) AS lo, round(low + (bin + 1) * w, 6) AS hi, count(*) AS n
FROM p GROUP BY bin, low, w""",
)
def histogram(spark, sf):
    out = cases.duration_histogram(o2c(spark, sf)[0])
    return out.withColumns({c: F.round(c, 6) for c in ("lo", "hi")})


def _variants_sql(name: str, order: str) -> str:
    return f"""per_case AS (SELECT case_id, string_agg(activity, ',' ORDER BY {order}) AS variant, count(*) AS length,
  string_agg(activity, ' -> ' ORDER BY {order}) FILTER (place <= 3) || CASE WHEN count(*) > 3 THEN '...' ELSE '' END AS label
  FROM (SELECT *, row_number() OVER (PARTITION BY case_id ORDER BY {order}) AS place FROM {name}) GROUP BY case_id),
variants AS (SELECT variant, label, length, count(*) AS n, min(case_id) AS first_case FROM per_case GROUP BY 1, 2, 3)"""


_O2C_ORDER = "event_timestamp, source_seq, event_id"
_DAY_ORDER = "event_timestamp, event_id"


@check(
    "h11_variants",
    f"""WITH {RAW_SQL}, {_variants_sql('raw', _O2C_ORDER)}
SELECT CAST(row_number() OVER (ORDER BY n DESC, first_case) AS INTEGER) AS rank, * FROM variants ORDER BY n DESC, first_case LIMIT 10""",
)
def top_variants(spark, sf):
    log, load = o2c(spark, sf)
    return variants.variants(log, load=load).withColumn("variant", F.array_join("variant", ","))


@check(
    "h11_all_variants",
    f"WITH {RAW_SQL}, {_variants_sql('raw', _O2C_ORDER)} SELECT variant, label, length, n, first_case FROM variants",
)
def all_variants(spark, sf):
    log, load = o2c(spark, sf)
    out = variants.variants(log, None, load)
    return out.select(F.array_join("variant", ",").alias("variant"), "label", "length", "n", "first_case")


@check(
    "h11_variant_steps",
    f"""WITH {RAW_SQL}, {_variants_sql('raw', _O2C_ORDER)}
SELECT first_case, row_number() OVER (PARTITION BY first_case ORDER BY {_O2C_ORDER}) AS position, activity, length, n
FROM variants JOIN raw ON raw.case_id = first_case""",
)
def steps(spark, sf):
    return variants.variant_steps(*o2c(spark, sf))


@check(
    "h11_case_variants",
    f"""WITH {DAYS_SQL}, {_variants_sql('days', _DAY_ORDER)}
SELECT per_case.case_id, first_case FROM per_case JOIN variants USING (variant)""",
)
def case_variants(spark, sf):
    return variants.case_variants(*clicks_by_day(spark, sf))


@check(
    "h12_variants_by_day",
    f"""WITH {DAYS_SQL}, {_variants_sql('days', _DAY_ORDER)}
SELECT CAST(row_number() OVER (ORDER BY n DESC, first_case) AS INTEGER) AS rank, * FROM variants ORDER BY n DESC, first_case LIMIT 10""",
)
def day_variants(spark, sf):
    log, load = clicks_by_day(spark, sf)
    return variants.variants(log, load=load).withColumn("variant", F.array_join("variant", ","))


_TIMES_SQL = f"{PAIRS_SQL}, times AS (SELECT src, tgt, (epoch_us(next_ts) - epoch_us(ts)) / 1e6 AS s FROM pairs WHERE tgt IS NOT NULL)"


@check(
    "h13_performance_dfg",
    f"""WITH {_TIMES_SQL} SELECT src, tgt, count(*) AS n, round(avg(s), 4) AS mean_seconds, round(min(s), 4) AS min_seconds,
  round(max(s), 4) AS max_seconds, round(sum(s), 4) AS sum_seconds, round(quantile_cont(s, 0.5), 4) AS median_seconds
FROM times GROUP BY 1, 2""",
)
def performance(spark, sf):
    out = dfg.performance_dfg(*o2c(spark, sf))
    return out.withColumns({c: F.round(c, 4) for c in out.columns if c.endswith("_seconds")})


@check(
    "h14_bottlenecks",
    f"""WITH {_TIMES_SQL} SELECT src || ' -> ' || tgt AS label, src, tgt, count(*) AS n, round(avg(s) / 3600, 4) AS mean_hours
FROM times GROUP BY src, tgt ORDER BY avg(s) DESC, src, tgt LIMIT 10""",
)
def slowest(spark, sf):
    log, load = o2c(spark, sf)
    return dfg.bottlenecks(log, load=load).withColumn("mean_hours", F.round("mean_hours", 4))


# Activities that do not follow each other both ways are one group; groups that can each start and end a case run side by side.
# Where the same holds for the activities of every group in the cases without the others, all of them run side by side:
# optional where at least a fifth of the cases are without, repeated where a case has one more than once.
_SIDE_BY_SIDE_SQL = f"""RECURSIVE {_EDGES_SQL}, acts AS (SELECT DISTINCT activity AS a FROM raw),
apart AS (SELECT x.a, y.a AS b FROM acts AS x JOIN acts AS y ON x.a <> y.a LEFT JOIN edges AS e ON e.src = x.a AND e.tgt = y.a
  LEFT JOIN edges AS f ON f.src = y.a AND f.tgt = x.a WHERE e.src IS NULL OR f.src IS NULL),
near AS (SELECT a, a AS b FROM acts UNION SELECT near.a, apart.b FROM near JOIN apart ON apart.a = near.b),
grp AS (SELECT a AS activity, min(b) AS g FROM near GROUP BY 1),
cut AS (SELECT *, lag(activity) OVER w AS before, lead(activity) OVER w AS after, lag(activity) OVER c AS any_before, lead(activity) OVER c AS any_after
  FROM raw JOIN grp USING (activity) WINDOW w AS (PARTITION BY case_id, g ORDER BY event_timestamp, source_seq, event_id),
  c AS (PARTITION BY case_id ORDER BY event_timestamp, source_seq, event_id)),
whole AS (SELECT bool_and(starts AND ends) AND count(*) > 1 AS ok FROM (
  SELECT g, bool_or(any_before IS NULL) AS starts, bool_or(any_after IS NULL) AS ends FROM cut GROUP BY g)),
inner_pairs AS (SELECT DISTINCT activity, after FROM cut),
inner_whole AS (SELECT bool_and(EXISTS (SELECT 1 FROM inner_pairs AS p WHERE p.activity = x.activity AND p.after = y.activity)
  AND EXISTS (SELECT 1 FROM cut WHERE cut.activity = x.activity AND before IS NULL)
  AND EXISTS (SELECT 1 FROM inner_pairs AS p WHERE p.activity = x.activity AND p.after IS NULL)) AS ok
  FROM grp AS x JOIN grp AS y ON x.g = y.g AND x.activity <> y.activity),
per AS (SELECT activity, case_id, count(*) AS c FROM raw GROUP BY 1, 2), cases AS (SELECT count(DISTINCT case_id) AS n FROM raw),
parts AS (SELECT g, activity, CASE WHEN max(c) > 1 THEN 'loop(''' || activity || ''', tau)' ELSE '''' || activity || '''' END AS part,
  any_value(n) > count(*) AND any_value(n) - count(*) >= 0.2 * any_value(n) AS optional
  FROM per JOIN grp USING (activity) CROSS JOIN cases GROUP BY 1, 2)"""


@check(
    "h15_discover_model",
    f"""WITH {_SIDE_BY_SIDE_SQL} SELECT CASE WHEN (SELECT ok FROM whole) AND (SELECT ok FROM inner_whole)
  THEN 'parallel(' || string_agg(CASE WHEN optional THEN 'exclusive(tau, ' || part || ')' ELSE part END, ', ' ORDER BY g, activity) || ')' END AS model,
  CAST(count(*) AS INTEGER) AS activities FROM parts""",
)
def model(spark, sf):
    log, load = o2c(spark, sf)
    tree = discover_model(log, 0.2, load)
    return spark.createDataFrame([(str(tree), len(tree.labels()))], "model string, activities int")


# Replay on that model by counting: the split makes three tokens of one; an order takes and gives one, items and returns with
# the silent step before them two; the ways out, the join and the sink follow where orders and items are there.
_DISCOVERED_SQL = f"""{RAW_SQL}, c AS (SELECT case_id, count(*) FILTER (activity = 'Create Order') AS o, count(*) FILTER (activity = 'Return Item') AS r,
  count(*) FILTER (activity = 'Ship Item') AS s FROM raw GROUP BY 1),
counts AS (SELECT case_id, 4 + o + 2 * r + 2 * s + CASE WHEN o > 0 AND s > 0 THEN 3 ELSE 0 END AS produced,
  2 + o + 2 * r + 2 * s + CASE WHEN o > 0 AND s > 0 THEN 5 ELSE 0 END AS consumed,
  greatest(o - 1, 0) + CASE WHEN o > 0 AND s > 0 THEN 0 ELSE 1 END AS missing,
  greatest(o - 1, 0) + CASE WHEN o > 0 AND s > 0 THEN 0 ELSE 3 END AS remaining FROM c),
judged AS (SELECT *, 1 - (missing / consumed + remaining / produced) / 2 AS fitness, missing = 0 AND remaining = 0 AS fits
  FROM counts)"""


@check(
    "h16_replay",
    f"""WITH {_DISCOVERED_SQL} SELECT case_id, produced, consumed, missing, remaining, round(fitness, 6) AS fitness, fits FROM judged""",
)
def replayed(spark, sf):
    log, load = o2c(spark, sf)
    ranked = variants.ranked_events(log, load)
    signatures = cut_lineage(variants.case_signatures(log, load, ranked))
    steps = cut_lineage(variants.variant_steps(log, load, signatures, ranked))
    out = replay(log, discover_model(log, 0.2, load, steps=steps), load, steps, signatures)
    return out.withColumn("fitness", F.round("fitness", 6))


@check(
    "h17_fitness",
    f"""WITH {_DISCOVERED_SQL} SELECT count(*) AS cases, round(avg(fitness), 6) AS average_trace_fitness,
  round(count(*) FILTER (fits) * 100.0 / count(*), 4) AS pct_fitting,
  CASE WHEN avg(fitness) > 0.8 THEN 'good' ELSE 'warning' END AS status FROM judged""",
)
def fit(spark, sf):
    log, load = o2c(spark, sf)
    out = fitness(log, noise=0.2, load=load)
    return out.withColumns({c: F.round(c, d) for c, d in (("average_trace_fitness", 6), ("pct_fitting", 4))})


@check(
    "h15_model_fits_its_log",
    f"WITH {RAW_SQL} SELECT count(DISTINCT case_id) AS cases, count(DISTINCT case_id) AS fitting FROM raw",
)
def fits_own_log(spark, sf):
    """Without noise removal every case fits the discovered model."""
    log, load = o2c(spark, sf)
    signatures = cut_lineage(variants.case_signatures(log, load))
    steps = cut_lineage(variants.variant_steps(log, load, signatures))
    cases_ = replay(log, discover_model(log, 0.0, load, steps=steps), load, steps, signatures)
    return cases_.agg(F.count(F.lit(1)).alias("cases"), F.count_if("fits").alias("fitting"))


@check("h15_model_allows_its_log", f"WITH {_EDGES_SQL} SELECT src, tgt, freq, TRUE AS allowed FROM edges")
def allows_own_log(spark, sf):
    """Without noise removal the discovered model allows every pair of the directly-follows graph."""
    log, load = o2c(spark, sf)
    pairs = [(a, b, True) for a, b in sorted(allowed_pairs(discover_model(log, 0.0, load)))]
    allowed = spark.createDataFrame(pairs, "src string, tgt string, allowed boolean")
    return dfg.dfg(log, load).join(F.broadcast(allowed), ["src", "tgt"], "left").select(
        "src", "tgt", "freq", F.coalesce("allowed", F.lit(False)).alias("allowed")
    )


_ROUNDS_SQL = f"""{DAYS_SQL}, steps AS (SELECT case_id, event_timestamp, event_id,
  row_number() OVER (PARTITION BY case_id ORDER BY event_timestamp, event_id) % 3 AS k FROM days),
named AS (SELECT *, CASE k WHEN 1 THEN 'open' WHEN 2 THEN 'read' ELSE 'close' END AS a, (k + 2) % 3 AS place FROM steps),
pairs AS (SELECT a AS src, lead(a) OVER (PARTITION BY case_id ORDER BY event_timestamp, event_id) AS tgt FROM named),
names AS (SELECT DISTINCT a, place FROM named)"""


@check(
    "h15_rounds_of_visits",
    f"""WITH {_ROUNDS_SQL} SELECT x.a AS src, y.a AS tgt,
  (SELECT count(*) FROM pairs WHERE src = x.a AND tgt = y.a) AS freq,
  x.place < y.place OR (y.place = 0 AND EXISTS (SELECT 1 FROM pairs WHERE src = x.a AND tgt IS NULL)) AS allowed,
  CAST(100 AS DOUBLE) AS pct_fitting FROM names AS x, names AS y""",
)
def rounds_of_visits(spark, sf):
    """The events of a day named in turn open, read and close: their graph is a circle without a cut, and the days can end
    anywhere in it. The model is a loop of rounds that may stop early: it allows these pairs, those that skip and those that
    begin a round anew, and no others."""
    log, _ = clicks_by_day(spark, sf)
    ranked = sequence(log, [])
    name = F.element_at(F.array(F.lit("open"), F.lit("read"), F.lit("close")), ((F.col("_rank") - 1) % 3 + 1).cast("int"))
    log = cut_lineage(ranked.withColumn("activity", name).select(*log.columns))
    model_ = discover_model(log, 0.0)
    names = log.select("activity").distinct()
    pairs = names.withColumnRenamed("activity", "src").join(names.withColumnRenamed("activity", "tgt"))  # nine rows
    allowed = spark.createDataFrame([(a, b, True) for a, b in sorted(allowed_pairs(model_))], "src string, tgt string, allowed boolean")
    out = pairs.join(allowed, ["src", "tgt"], "left").join(dfg.dfg(log), ["src", "tgt"], "left")
    out = out.select("src", "tgt", F.coalesce("freq", F.lit(0)).alias("freq"), F.coalesce("allowed", F.lit(False)).alias("allowed"))
    return out.join(fitness(log, model_).select("pct_fitting"))


_ORDER, _SHIP, _RETURN = leaf("Create Order"), leaf("Ship Item"), leaf("Return Item")
_IN_ANY_ORDER = ProcessTree(
    "parallel",
    None,
    (
        _ORDER,
        ProcessTree("exclusive", None, (SILENT, ProcessTree("loop", None, (_RETURN, SILENT)))),
        ProcessTree("loop", None, (_SHIP, SILENT)),
    ),
)
_ORDER_FIRST = block(
    "sequence",
    [
        _ORDER,
        ProcessTree(
            "loop", None, (block("sequence", [_SHIP, ProcessTree("exclusive", None, (SILENT, _RETURN))]), SILENT)
        ),
    ],
)
_ORDER_FIRST_SQL = f"""{RAW_SQL}, traces AS (SELECT case_id, string_agg(activity, ',' ORDER BY event_timestamp, source_seq, event_id)
  AS trace FROM raw GROUP BY 1),
judged AS (SELECT case_id, regexp_full_match(trace, 'Create Order(,Ship Item(,Return Item)?)+') AS fits FROM traces)"""


@check(
    "h16_replay_in_any_order",
    f"""WITH {RAW_SQL} SELECT case_id, count(*) FILTER (activity = 'Create Order') = 1
  AND count(*) FILTER (activity = 'Ship Item') > 0 AS fits FROM raw GROUP BY 1""",
)
def any_order(spark, sf):
    log, load = o2c(spark, sf)
    return replay(log, _IN_ANY_ORDER, load).select("case_id", "fits")


@check("h16_replay_order_first", f"WITH {_ORDER_FIRST_SQL} SELECT * FROM judged")
def order_first(spark, sf):
    log, load = o2c(spark, sf)
    return replay(log, _ORDER_FIRST, load).select("case_id", "fits")


@check(
    "h17_fitness_order_first",
    f"""WITH {_ORDER_FIRST_SQL} SELECT count(*) AS cases, round(count(*) FILTER (fits) * 100.0 / count(*), 4) AS pct_fitting FROM judged""",
)
def order_first_fitness(spark, sf):
    log, load = o2c(spark, sf)
    return fitness(log, _ORDER_FIRST, load=load).select("cases", F.round("pct_fitting", 4).alias("pct_fitting"))


_ORDER_SHIP = block("sequence", [_ORDER, _SHIP])
# Replay on the net source -Create Order-> middle -Ship Item-> sink, one event at a time; the places are the bits 1, 4, 2.
_TOKENS_SQL = f"""RECURSIVE {RAW_SQL}, ev AS (SELECT case_id, activity, count(*) OVER (PARTITION BY case_id) AS len,
  row_number() OVER (PARTITION BY case_id ORDER BY event_timestamp, source_seq, event_id) AS i FROM raw),
arcs AS (SELECT * FROM (VALUES ('Create Order', 1, 4), ('Ship Item', 4, 2)) AS v(activity, takes, gives)),
r AS (SELECT DISTINCT case_id, CAST(0 AS BIGINT) AS i, 1 AS marking, 0 AS p, 0 AS c, 0 AS m, 0 AS q FROM raw
  UNION ALL
  SELECT r.case_id, ev.i, CASE WHEN takes IS NULL THEN marking ELSE (marking & ~takes) | gives END, p + 1, c + 1,
    m + CASE WHEN takes IS NULL OR (marking & takes) = 0 THEN 1 ELSE 0 END,
    q + CASE WHEN takes IS NULL OR ((marking & ~takes) & gives) <> 0 THEN 1 ELSE 0 END
  FROM r JOIN ev ON ev.case_id = r.case_id AND ev.i = r.i + 1 LEFT JOIN arcs ON arcs.activity = ev.activity),
counts AS (SELECT r.case_id, CAST(p + 1 AS BIGINT) AS produced, CAST(c + 1 AS BIGINT) AS consumed,
  CAST(m + CASE WHEN (marking & 2) = 0 THEN 1 ELSE 0 END AS BIGINT) AS missing,
  CAST(q + bit_count(marking & ~2) AS BIGINT) AS remaining
  FROM r JOIN (SELECT DISTINCT case_id, len FROM ev) AS l ON l.case_id = r.case_id AND l.len = r.i),
judged AS (SELECT *, 1 - (missing / consumed + remaining / produced) / 2 AS fitness, missing = 0 AND remaining = 0 AS fits
  FROM counts)"""


@check(
    "h16_token_counts",
    f"""WITH {_TOKENS_SQL} SELECT case_id, produced, consumed, missing, remaining, round(fitness, 6) AS fitness, fits FROM judged""",
)
def token_counts(spark, sf):
    log, load = o2c(spark, sf)
    return replay(log, _ORDER_SHIP, load).withColumn("fitness", F.round("fitness", 6))


@check(
    "h17_token_fitness",
    f"""WITH {_TOKENS_SQL} SELECT count(*) AS cases, round(avg(fitness), 6) AS average_trace_fitness,
  round(count(*) FILTER (fits) * 100.0 / count(*), 4) AS pct_fitting,
  CASE WHEN avg(fitness) > 0.8 THEN 'good' ELSE 'warning' END AS status FROM judged""",
)
def token_fitness(spark, sf):
    log, load = o2c(spark, sf)
    out = fitness(log, _ORDER_SHIP, load=load)
    return out.withColumns({c: F.round(c, d) for c, d in (("average_trace_fitness", 6), ("pct_fitting", 4))})


def _sliced_clicks(spark, sf):
    """The clicks with so small a bound for a task that long cases are sliced."""
    log, _ = clicks(spark, sf)
    return log, measure_cases(log, max_task_events=75)


_CLICK_PAIRS_SQL = f"""{CLICKS_SQL}, pairs AS (SELECT case_id, activity AS src, lead(activity) OVER w AS tgt,
  epoch_us(lead(event_timestamp) OVER w) - epoch_us(event_timestamp) AS us
  FROM clicks WINDOW w AS (PARTITION BY case_id ORDER BY event_timestamp, event_id))"""


@check(
    "h01_dfg_sliced",
    f"WITH {_CLICK_PAIRS_SQL} SELECT src, tgt, count(*) AS freq FROM pairs WHERE tgt IS NOT NULL GROUP BY 1, 2",
)
def sliced_graph(spark, sf):
    return dfg.dfg(*_sliced_clicks(spark, sf))


@check(
    "h11_variants_sliced",
    f"""WITH {CLICKS_SQL}, {_variants_sql('clicks', _DAY_ORDER)} SELECT variant, label, length, n, first_case FROM variants""",
)
def sliced_variants(spark, sf):
    log, load = _sliced_clicks(spark, sf)
    out = variants.variants(log, None, load)
    return out.select(F.array_join("variant", ",").alias("variant"), "label", "length", "n", "first_case")


@check(
    "h13_performance_sliced",
    f"""WITH {_CLICK_PAIRS_SQL} SELECT src, tgt, count(*) AS n, round(avg(us) / 1e6, 3) AS mean_seconds,
  round(min(us) / 1e6, 3) AS min_seconds, round(max(us) / 1e6, 3) AS max_seconds, round(sum(us) / 1e6, 3) AS sum_seconds,
  round(quantile_cont(us, 0.5) / 1e6, 3) AS median_seconds FROM pairs WHERE tgt IS NOT NULL GROUP BY 1, 2""",
)
def sliced_performance(spark, sf):
    out = dfg.performance_dfg(*_sliced_clicks(spark, sf))
    return out.withColumns({c: F.round(c, 3) for c in out.columns if c.endswith("_seconds")})


@check(
    "h16_replay_sliced",
    f"""WITH {CLICKS_SQL}, firsts AS (SELECT case_id, arg_min(activity, (event_timestamp, event_id)) AS first,
  count(*) AS n FROM clicks GROUP BY 1)
SELECT case_id, first = (SELECT min(activity) FROM clicks) AND n = 1 AS fits FROM firsts""",
)
def sliced_replay(spark, sf):
    """On a model of one step, the first activity by name."""
    log, load = _sliced_clicks(spark, sf)
    first = log.agg(F.min("activity")).first()[0]
    return replay(log, leaf(first), load).select("case_id", "fits")


_KEPT_SQL = f"""{_EDGES_SQL}, kept AS (SELECT src, tgt FROM (SELECT *, max(freq) OVER (PARTITION BY src) AS m FROM edges) WHERE freq >= 0.2 * m),
marked AS (SELECT p.*, p.tgt IS NOT NULL AND k.src IS NULL AS bad FROM pairs p LEFT JOIN kept k USING (src, tgt))"""


@check(
    "h18_dfg_conformance",
    f"""WITH {_KEPT_SQL} SELECT case_id, count(tgt) AS pairs, count(*) FILTER (bad) AS deviating, count(*) FILTER (bad) = 0 AS fits
FROM marked GROUP BY 1""",
)
def conforming(spark, sf):
    log, load = o2c(spark, sf)
    return conformance.dfg_conformance(log, 0.2, load)


@check(
    "h18_dfg_fitness",
    f"""WITH {_KEPT_SQL}, c AS (SELECT case_id, count(*) FILTER (bad) = 0 AS fits FROM marked GROUP BY 1)
SELECT count(*) AS cases, count(*) FILTER (fits) AS fitting, round(count(*) FILTER (fits) * 100.0 / count(*), 1) AS pct_fitting FROM c""",
)
def share(spark, sf):
    log, load = o2c(spark, sf)
    return conformance.dfg_fitness(log, 0.2, load)


@check(
    "h19_deviations",
    f"WITH {_KEPT_SQL} SELECT case_id, src, tgt, count(*) AS n FROM marked WHERE bad GROUP BY 1, 2, 3",
)
def deviating(spark, sf):
    log, load = o2c(spark, sf)
    return conformance.deviations(log, 0.2, load)
