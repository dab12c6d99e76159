"""Reference data for events, and how well it matches."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casemill.functions.columns import CASE, normalise_key, share_pct
from casemill.operators.joins import MEASURE, balanced_join
from casemill.operators.ordering import dealt, measure_cases, split_hot
from casemill.session import written

On = str | Mapping[str, str]


def key_pairs(on: On) -> list[tuple[str, str]]:
    """(log column, reference column) pairs of ``"key"`` or ``{"log_key": "ref_key"}``."""
    return [(on, on)] if isinstance(on, str) else list(on.items())


def check_ref_key(ref: DataFrame, on: On) -> DataFrame:
    """(key…, rows): reference keys that occur more than once and would multiply events."""
    keys = [r for _, r in key_pairs(on)]
    known = ref.dropna(subset=keys)
    return known.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1)


def enrich(
    log: DataFrame,
    ref: DataFrame,
    on: On,
    columns: Sequence[str],
    prefix: str = "",
    on_dup: str = "error",
    normalise: bool = False,
    hot: DataFrame | None | str = MEASURE,
) -> DataFrame:
    """Add reference columns to events; events without a match stay, with nulls.

    Columns never replace log columns (a clash raises; use ``prefix``). The reference key must be unique:
    ``on_dup="error"`` checks it and raises, ``"first"`` takes the smallest row per key, ``"trust"`` skips
    the check for keys known to be unique. ``normalise`` compares keys without case and outer blanks. ``hot`` is what
    ``measure_hot_keys`` found for the log's key.
    """
    pairs = key_pairs(on)
    names = [prefix + c for c in columns]
    clash = [n for n in names if n in log.columns]
    if clash:
        raise ValueError(f"enrichment would replace log columns {clash}; use a prefix")
    ref_keys = [normalise_key(r) if normalise else F.col(f"`{r}`") for _, r in pairs]
    table = ref.select(
        *[k.alias(f"_r{i}") for i, k in enumerate(ref_keys)],
        *[F.col(f"`{c}`").alias(n) for c, n in zip(columns, names)],
    ).dropna(subset=[f"_r{i}" for i in range(len(pairs))])
    keys = [f"_r{i}" for i in range(len(pairs))]
    if on_dup == "first":
        table = table.groupBy(*keys).agg(F.min(F.struct(*names)).alias("_v")).select(*keys, "_v.*")
    elif on_dup == "error":
        twice = check_ref_key(table, {k: k for k in keys}).limit(3).collect()
        if twice:
            raise ValueError(f"reference key is not unique, for example {[r.asDict() for r in twice]}")
    if not normalise:
        return balanced_join(log, table, [(l, k) for (l, _), k in zip(pairs, keys)], hot=hot)
    keyed = log.withColumns({f"_l{i}": normalise_key(l) for i, (l, _) in enumerate(pairs)})
    joined = balanced_join(keyed, table, [(f"_l{i}", k) for i, k in enumerate(keys)])
    return joined.drop(*[f"_l{i}" for i in range(len(pairs))])


def enrich_via(
    log: DataFrame,
    bridge: DataFrame,
    ref: DataFrame,
    on_bridge: On,
    on_ref: On,
    columns: Sequence[str],
    prefix: str = "",
    on_many: str = "error",
) -> DataFrame:
    """Enrich through a bridge table that leads from a log key to the reference key.

    The bridge is reduced to distinct key pairs. A log key with several reference keys raises, or takes the
    smallest one with ``on_many="min"``.
    """
    (from_log, in_bridge), = key_pairs(on_bridge)
    (leads_to, in_ref), = key_pairs(on_ref)
    steps = bridge.select(F.col(f"`{in_bridge}`").alias("_from"), F.col(f"`{leads_to}`").alias("_to")).dropna()
    many = steps.groupBy("_from").agg(F.min("_to").alias("_to"), F.max("_to").alias("_other"))
    if on_many == "error":
        bad = many.where(F.col("_to") != F.col("_other")).limit(1).collect()
        if bad:
            raise ValueError(f"bridge leads from {bad[0]['_from']} to several keys")
    keyed = balanced_join(log, many.select("_from", "_to"), [(from_log, "_from")])
    return enrich(keyed, ref, {"_to": in_ref}, columns, prefix).drop("_to")


def match_rate(log: DataFrame, ref: DataFrame, on: On) -> DataFrame:
    """(rows, matched, pct, keys, matched_keys): how much of the log finds its reference row."""
    pairs = key_pairs(on)
    keys = [f"`{l}`" for l, _ in pairs]
    per_key = log.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    known = ref.select(*[F.col(f"`{r}`") for _, r in pairs]).distinct().withColumn("_hit", F.lit(1))
    joined = balanced_join(per_key, known, pairs)
    hit = F.col("_hit").isNotNull()
    has_key = F.lit(True)
    for k in keys:
        has_key = has_key & F.col(k).isNotNull()
    total, matched = F.coalesce(F.sum("_n"), F.lit(0)), F.coalesce(F.sum(F.when(hit, F.col("_n"))), F.lit(0))
    return joined.agg(
        total.alias("rows"),
        matched.alias("matched"),
        share_pct(matched, total).alias("pct"),
        F.count_if(has_key).alias("keys"),
        F.count_if(hit).alias("matched_keys"),
    )


def match_rates(log: DataFrame, refs: Sequence[tuple[str, DataFrame, On]]) -> DataFrame:
    """(table, rows, matched, pct, keys, matched_keys) for several reference tables (name, table, keys) from one scan of the log.

    Keys are compared as text, those of the log in the type they have in the reference table. The log is counted per table and
    key before anything is joined.
    """

    def key(texts: Sequence[Column]) -> Column:
        whole = F.lit(True)
        for t in texts:
            whole = whole & t.isNotNull()
        return F.when(whole, F.array(*texts))

    cells, known = [], None
    for i, (_, ref, on) in enumerate(refs):
        pairs = key_pairs(on)
        kinds = [ref.schema[r].dataType.simpleString() for _, r in pairs]
        mine = [F.col(f"`{l}`") for l, _ in pairs]
        mine = [c if log.schema[l].dataType.simpleString() == kind else c.try_cast(kind) for c, kind, (l, _) in zip(mine, kinds, pairs)]
        cells.append(F.struct(F.lit(i).alias("_i"), key([c.cast("string") for c in mine]).alias("_key")))
        rows = ref.select(F.lit(i).alias("_i"), key([F.col(f"`{r}`").cast("string") for _, r in pairs]).alias("_key"))
        rows = rows.where(F.col("_key").isNotNull()).distinct()
        known = rows if known is None else known.unionByName(rows)
    per_key = log.select(F.inline(F.array(*cells))).groupBy("_i", "_key").agg(F.count(F.lit(1)).alias("_n"))
    joined = balanced_join(per_key, known.withColumn("_hit", F.lit(1)), [("_i", "_i"), ("_key", "_key")])
    hit = F.col("_hit").isNotNull()
    counts = joined.groupBy("_i").agg(
        F.sum("_n").alias("rows"), F.coalesce(F.sum(F.when(hit, F.col("_n"))), F.lit(0)).alias("matched"),
        F.count("_key").alias("keys"), F.count_if(hit).alias("matched_keys"),
    )
    names = log.sparkSession.createDataFrame([(i, name) for i, (name, _, _) in enumerate(refs)], "_i int, table string")
    numbers = [F.coalesce(c, F.lit(0)).alias(c) for c in ("rows", "matched", "keys", "matched_keys")]
    out = names.join(counts, "_i", "left").select("table", *numbers)
    return out.select("table", "rows", "matched", share_pct(F.col("matched"), F.col("rows")).alias("pct"), "keys", "matched_keys")


def coverage(log: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, total_rows, enriched, pct) for enrichment columns, in one pass."""
    counts = [F.count(F.col(f"`{c}`")).alias(f"_c{i}") for i, c in enumerate(columns)]
    totals = log.agg(F.count(F.lit(1)).alias("total_rows"), *counts)
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"_c{i}").alias("enriched")) for i, c in enumerate(columns)])
    long = totals.select("total_rows", F.inline(rows))
    return long.select("column", "total_rows", "enriched", share_pct(F.col("enriched"), F.col("total_rows")).alias("pct"))


def coverage_reasons(log: DataFrame, ref: DataFrame, on: On) -> DataFrame:
    """(reason, rows): matched, null key, matches only once normalised, or missing in the reference."""
    (l, r), = key_pairs(on)
    per_key = log.groupBy(F.col(f"`{l}`").alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
    per_key = per_key.withColumn("_norm", normalise_key("_key"))
    raw = ref.select(F.col(f"`{r}`").alias("_r")).dropna().distinct().withColumn("_raw_hit", F.lit(1))
    norm = ref.select(normalise_key(F.col(f"`{r}`")).alias("_r")).dropna().distinct().withColumn("_norm_hit", F.lit(1))
    joined = balanced_join(balanced_join(per_key, raw, [("_key", "_r")]), norm, [("_norm", "_r")])
    reason = (
        F.when(F.col("_key").isNull(), "null key")
        .when(F.col("_raw_hit").isNotNull(), "matched")
        .when(F.col("_norm_hit").isNotNull(), "matches after normalising")
        .otherwise("not in reference")
    )
    return joined.groupBy(reason.alias("reason")).agg(F.sum("_n").alias("rows"))


def check_case_constant(log: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, case_id, values): cases in which a case-level attribute takes several values (null not counted).

    The columns are written, so that they can be counted without making the log twice. Ordinary cases are dealt to as many
    tasks as the log needs, whole; the values of hot cases are spread.
    """
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"_v{i}").alias("value")) for i, c in enumerate(columns)])
    texts = [F.col(f"`{c}`").cast("string").alias(f"_v{i}") for i, c in enumerate(columns)]
    narrow = written(log.where(F.col(CASE).isNotNull()).select(CASE, *texts), "attributes")
    load = measure_cases(narrow)
    normal, hot = split_hot(narrow, load)

    def several(rows: DataFrame) -> DataFrame:
        long = rows.select(CASE, F.inline(cells)).where(F.col("value").isNotNull())
        per_case = long.distinct().groupBy("column", CASE).agg(F.count(F.lit(1)).alias("values"))
        return per_case.where(F.col("values") > 1)

    out = several(dealt(normal, [CASE], load.events * len(columns)))
    return out if hot is None else out.unionByName(several(hot))
