"""What is in a table: column statistics, roles, keys and personal data."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casemill.functions.columns import usable
from casemill.functions.patterns import ID_PATTERN, PII_PATTERNS, ROLE_PATTERNS, TEMPLATES, bare_name

_TIMES = ("timestamp", "timestamp_ntz", "date")
_PLAIN = ("string", "long", "integer", "short", "byte", "boolean", "double", "float", "date", "timestamp",
          "timestamp_ntz")


def _plain(df: DataFrame) -> list[str]:
    """Columns whose values can be compared and counted (no arrays, maps or binaries)."""
    return [f.name for f in df.schema.fields if f.dataType.typeName() in _PLAIN or f.dataType.typeName().startswith("decimal")]


def profile_table(df: DataFrame, exact: bool = False, sample: int = 5) -> DataFrame:
    """(column, type, rows, nulls, distinct, min, max, samples): one row per column.

    By default one aggregation with sketches: distinct counts and the most frequent values are approximate.
    ``exact`` counts (column, value) pairs instead, which shuffles one counter per distinct value.
    """
    names = _plain(df)
    measures = [F.count(F.lit(1)).alias("_rows")]
    for i, c in enumerate(names):
        v = F.col(f"`{c}`")
        measures += [
            F.count(v).alias(f"_n{i}"),
            F.min(v).cast("string").alias(f"_lo{i}"),
            F.max(v).cast("string").alias(f"_hi{i}"),
        ]
        if not exact:
            measures += [
                F.approx_count_distinct(v).alias(f"_d{i}"),
                F.expr(f"approx_top_k(cast(`{c}` as string), {sample}, 1000)").alias(f"_s{i}"),
            ]
    kinds = dict(df.dtypes)

    def cell(i: int, c: str):
        fields = [
            F.lit(c).alias("column"),
            F.lit(kinds[c]).alias("type"),
            F.col("_rows").alias("rows"),
            (F.col("_rows") - F.col(f"_n{i}")).alias("nulls"),
            F.col(f"_lo{i}").alias("min"),
            F.col(f"_hi{i}").alias("max"),
        ]
        if not exact:
            top = F.filter(F.transform(f"_s{i}", lambda s: s["item"]), lambda x: x.isNotNull())
            fields += [F.col(f"_d{i}").alias("distinct"), top.alias("samples")]
        return F.struct(*fields)

    long = df.agg(*measures).select(F.inline(F.array(*[cell(i, c) for i, c in enumerate(names)])))
    if exact:
        cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("_v")) for c in names])
        counts = df.select(F.inline(cells)).where(F.col("_v").isNotNull()).groupBy("column", "_v").count()
        distinct = counts.groupBy("column").agg(F.count(F.lit(1)).alias("distinct"))
        # A row-number limit is applied per task before the shuffle, so a column brings few rows to its task.
        place = F.row_number().over(Window.partitionBy("column").orderBy(F.desc("count"), "_v"))
        best = counts.withColumn("_p", place).where(F.col("_p") <= sample).groupBy("column").agg(
            F.transform(F.array_sort(F.collect_list(F.struct("_p", "_v"))), lambda s: s["_v"]).alias("samples")
        )
        long = long.join(distinct, "column", "left").join(best, "column", "left").withColumn(
            "distinct", F.coalesce("distinct", F.lit(0))
        )
    return long.select("column", "type", "rows", "nulls", "distinct", "min", "max", "samples")


def value_distribution(df: DataFrame, column: str, k: int = 20) -> DataFrame:
    """(value, cnt): the k most frequent values of a column."""
    counts = df.groupBy(F.col(f"`{column}`").alias("value")).agg(F.count(F.lit(1)).alias("cnt"))
    return counts.orderBy(F.desc("cnt"), F.asc_nulls_first("value")).limit(k)


def column_roles(df: DataFrame, exact: bool = False) -> DataFrame:
    """(column, role, score): what a column can be in a log, from its name, type and cardinality.

    A time column scores 1. A key scores its share of distinct values. For the other roles the name gives
    one half and a fitting type and cardinality the other.
    """
    rows = []
    for r in profile_table(df, exact, 1).select("column", "type", "rows", "nulls", "distinct").collect():
        role = role_of(r["column"], r["type"], r["rows"], r["distinct"])
        if role:
            rows.append((r["column"], *role))
    return df.sparkSession.createDataFrame(rows, "column string, role string, score double")


def role_of(name: str, kind: str, rows: int, distinct: int) -> tuple[str, float] | None:
    """The role of a column and its score, or None."""
    bare = bare_name(name)
    share = min(1.0, distinct / rows) if rows else 0.0
    text, number = kind == "string", kind in ("double", "float") or kind.startswith("decimal")
    if kind in _TIMES:
        return ("sla_date" if re.search(ROLE_PATTERNS[0][1], bare) else "timestamp", 1.0)
    if re.search(ID_PATTERN, bare):
        return ("key", round(share, 2))
    for role, pattern in ROLE_PATTERNS[1:]:
        if re.search(pattern, bare):
            fits = number if role == "amount" else text and (role in ("resource", "partner") or share < 0.5)
            if role == "amount" and not number:
                continue
            return (role, 1.0 if fits else 0.5)
    return None


def key_relationships(
    tables: Mapping[str, DataFrame], pairs: Sequence[tuple[str, str, str, str]] | None = None
) -> DataFrame:
    """(l_table, l_col, r_table, r_col, containment, cardinality) for key columns that occur in several tables.

    Columns are compared when they look like keys, have the same type and the same name after a one-letter
    prefix; ``pairs`` names other comparisons. ``containment`` is the share of left keys found on the right.
    Every table is read once and every column counted per key first, so a frequent key is one row in the comparison.
    """
    keys = {
        (t, c): (kind, bare_name(c))
        for t, df in tables.items()
        for c, kind in df.dtypes
        if re.search(ID_PATTERN, bare_name(c)) and kind in ("string", "bigint", "int")
    }
    wanted = list(pairs or [])
    wanted += [(*a, *b) for a, b in permutations(keys, 2) if a[0] != b[0] and keys[a] == keys[b]]
    if not wanted:
        spark = next(iter(tables.values())).sparkSession
        return spark.createDataFrame(
            [], "l_table string, l_col string, r_table string, r_col string, containment double, cardinality string"
        )

    columns = list(dict.fromkeys(c for w in wanted for c in (w[:2], w[2:])))
    number = {c: i for i, c in enumerate(columns)}
    parts = []
    for table in dict.fromkeys(t for t, _ in columns):
        cells = [
            F.struct(F.lit(number[t, c]).alias("col"), F.col(f"`{c}`").cast("string").alias("k"))
            for t, c in columns
            if t == table
        ]
        parts.append(tables[table].select(F.inline(F.array(*cells))).where(F.col("k").isNotNull()))
    counted = reduce(DataFrame.unionByName, parts).groupBy("k", "col").agg(F.count(F.lit(1)).alias("n"))
    # Per key value, how often each column has it: at most one entry per column.
    keys_of = counted.groupBy("k").agg(F.map_from_entries(F.collect_list(F.struct("col", "n"))).alias("m"))
    sides = [
        F.struct(F.lit(i).alias("pair"), F.col("m")[number[w[:2]]].alias("l"), F.col("m")[number[w[2:]]].alias("r"))
        for i, w in enumerate(wanted)
    ]
    both = keys_of.select(F.inline(F.filter(F.array(*sides), lambda s: s["l"].isNotNull())))
    one_l, one_r = F.max("l") == 1, F.coalesce(F.max("r"), F.lit(0)) <= 1
    cardinality = F.when(one_l & one_r, "1:1").when(one_l, "1:N").when(one_r, "N:1").otherwise("N:M")
    found = both.groupBy("pair").agg(
        F.round(F.count("r") / F.count(F.lit(1)), 4).alias("containment"), cardinality.alias("cardinality")
    )
    named = counted.sparkSession.createDataFrame(
        [(i, *w) for i, w in enumerate(wanted)], "pair int, l_table string, l_col string, r_table string, r_col string"
    )
    return named.join(found, "pair", "left").select(
        "l_table", "l_col", "r_table", "r_col", "containment", F.coalesce("cardinality", F.lit("N:1")).alias("cardinality")
    )


def _digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Does the last digit check the others? From the right, every second digit counts double, as the sum of its digits."""
    def worth(d: Column, i: Column) -> Column:
        double = d.cast("int") * 2
        return F.when(i % 2 == 0, d.cast("int")).otherwise(F.when(double > 9, double - 9).otherwise(double))

    return F.aggregate(F.transform(F.split(F.reverse(digits), ""), worth), F.lit(0), lambda a, b: a + b) % 10 == 0


def iban(found: Column) -> Column:
    """Is the number, with its first four characters last and letters as 10 to 35, one more than a multiple of 97?"""
    plain = F.upper(F.replace(found, F.lit(" "), F.lit("")))
    turned = F.split(F.concat(F.substring(plain, 5, 64), F.substring(plain, 1, 4)), "")
    value = lambda c: F.when(c.rlike("[0-9]"), c.cast("int")).otherwise(F.ascii(c) - 55)
    step = lambda rest, c: (rest * F.when(c.rlike("[0-9]"), 10).otherwise(100) + value(c)) % 97
    return (F.length(plain) >= 15) & (F.aggregate(turned, F.lit(0), step) == 1)


def _parts_up_to(found: Column, most: int) -> Column:
    return F.forall(F.split(found, r"\."), lambda part: part.cast("int") <= most)


def _issued(found: Column) -> Column:
    """Number ranges that are given out: no group of zeros, and no area 666 or from 900 on."""
    area, group, serial = (F.substring_index(found, "-", 1), F.substring(found, 5, 2), F.substring_index(found, "-", -1))
    return ~area.isin("000", "666") & (area < "900") & (group != "00") & (serial != "0000")


# What a match of a pattern must be to count, where digits alone do not tell.
PII_CHECKS = {"card": lambda m: luhn(_digits(m)), "iban": iban, "ip": lambda m: _parts_up_to(m, 255), "ssn": _issued}


def pii_scan(df: DataFrame, checked: bool = True) -> DataFrame:
    """(column, kind, rows, hits, rate): how many values of each text column contain personal data.

    All patterns are tested in one scan over the whole texts; rows counts the non-null values. With ``checked``, digit
    runs that look like a card, an account, an address or a social security number only count if one of them also passes its
    check digits or ranges.
    """

    def holds(text: Column, kind: str, pattern: str) -> Column:
        if not checked or kind not in PII_CHECKS:
            return text.rlike(pattern)
        found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        return F.when(text.rlike(pattern), F.exists(found, PII_CHECKS[kind])).otherwise(F.lit(False))

    texts = [f.name for f in df.schema.fields if f.dataType.typeName() == "string"]
    measures = [F.count(F.col(f"`{c}`")).alias(f"_n{i}") for i, c in enumerate(texts)]
    cells = []
    for i, c in enumerate(texts):
        for j, (kind, pattern) in enumerate(PII_PATTERNS):
            measures.append(F.count_if(holds(F.col(f"`{c}`"), kind, pattern)).alias(f"_h{i}_{j}"))
            rate = F.when(F.col(f"_n{i}") > 0, F.round(F.col(f"_h{i}_{j}") / F.col(f"_n{i}"), 4))
            cells.append(
                F.struct(
                    F.lit(c).alias("column"), F.lit(kind).alias("kind"), F.col(f"_n{i}").alias("rows"),
                    F.col(f"_h{i}_{j}").alias("hits"), rate.alias("rate"),
                )
            )
    return df.agg(*measures).select(F.inline(F.array(*cells)))


_SHORT = (("pr", "purchase requisition"), ("po", "purchase order"), ("gr", "goods receipt"))


def _stems(text: str) -> list[str]:
    words = re.sub(r"[^a-z]+", " ", text.lower()).split()
    words = " ".join(dict(_SHORT).get(w, w) for w in words).split()
    return sorted({re.sub(r"(ing|ed|e|s)$", "", w) for w in words})


def match_templates(log: DataFrame) -> DataFrame:
    """(template, steps, hits, coverage): which typical process the activities of a log look like.

    A step is hit when some activity has all of its words, compared without endings and word order. Only the
    distinct activities meet the step list.
    """
    short = F.create_map(*[F.lit(v) for pair in _SHORT for v in pair])
    names = usable(log).select("activity").distinct()
    words = F.split(F.trim(F.regexp_replace(F.lower("activity"), "[^a-z]+", " ")), " ")
    words = F.flatten(F.transform(words, lambda w: F.split(F.coalesce(short[w], w), " ")))
    names = names.withColumn("_w", F.transform(words, lambda w: F.regexp_replace(w, "(ing|ed|e|s)$", "")))
    steps = F.array(
        *[
            F.struct(F.lit(t).alias("template"), F.lit(s).alias("step"), F.array(*[F.lit(w) for w in _stems(s)]).alias("stems"))
            for t, flow in TEMPLATES.items()
            for s in flow
        ]
    )
    hits = names.select("_w", F.inline(steps)).where(F.size(F.array_except("stems", "_w")) == 0)
    hits = hits.groupBy("template").agg(F.count_distinct(F.col("step")).alias("_h"))
    known = log.sparkSession.createDataFrame([(t, len(f)) for t, f in TEMPLATES.items()], "template string, steps int")
    hit = F.coalesce("_h", F.lit(0))
    return known.join(hits, "template", "left").select(
        "template", "steps", hit.alias("hits"), F.round(hit / F.col("steps"), 4).alias("coverage")
    )
