"""Licence notices in documents (operator 7), in DataFrame functions only.

Blank lines part a text into paragraphs. A logistic regression over words and word pairs, made sparse by an L1 penalty,
gives each licence family and the class ``unknown`` a probability, for every line and for every run of neighbouring lines
of a paragraph in which a template that begins in the first can end. A family is predicted only above a threshold that is
calibrated on lines which hold no notice, and stands only if the lines have enough of one of the family's templates. Where
templates of several families are there, each is judged without the words that only the others have, and must have enough of
what tells it from each of them: two licences of a line are both reported, and a licence whose version is not told is none. The shortest run of lines with a family is one notice; those of a family do not overlap.

The regression learns from the templates, each also with some of its words left out, and from the lines of all distinct
texts as ``unknown``; lines like a template are left out of these. Lines with the same words and pairs of the vocabulary are
one row weighted by their number, so the texts are read once and only these words of them are shuffled. Scoring is one more
pass without a shuffle: lines out of reach of the words that every confirmed run of lines must have one of are passed over,
which changes no result.

Null and empty texts have no paragraphs. Rows are judged one by one, so repeated rows and ids change nothing; an empty
table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casemill.session import written

VARIANTS = 24  # of each template, with words left out
VOCABULARY = 4_096
PENALTY = 2e-4
UNKNOWN_SHARE = 5.0  # weight of all ``unknown`` lines, as a multiple of that of the templates
CONFIRM = 0.7  # share of a template's words and word pairs that a line must have
FALSE_ALARMS = 0.001  # of lines without a notice
LEAST_PROBABILITY = 0.5
UNKNOWN = "unknown"
TASK_LINES = 100_000  # different lines that a task of the regression goes over
STEPS = 1_000  # parts into which a round divides the probabilities that the threshold lies between

# Short notices by which texts name their licence.
TEMPLATES = {
    "agpl-3.0": ["Licensed under the GNU Affero General Public License, version 3."],
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance"
        " with the License.",
    ],
    "bsd": [
        "Released under the BSD License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that"
        " the following conditions are met.",
    ],
    "cc-by": ["Licensed under CC BY 4.0.", "Licensed under the Creative Commons Attribution 4.0 International License."],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "Licensed under the Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "cc-by-sa": [
        "Licensed under CC BY-SA 4.0.",
        "Licensed under the Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "cc0": ["Dedicated to the public domain under CC0 1.0 Universal."],
    "gpl-2.0": ["This work is licensed under the GNU General Public License, version 2."],
    "gpl-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General"
        " Public License as published by the Free Software Foundation, either version 3 of the License.",
    ],
    "isc": ["Released under the ISC License."],
    "lgpl": ["This library is licensed under the GNU Lesser General Public License."],
    "mit": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files.",
    ],
    "mpl-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "unlicense": ["This is free and unencumbered software released into the public domain."],
}


@dataclass(frozen=True)
class Model:
    """classes: the families in order, then ``unknown``; weights: of each word or word pair, one per class."""

    classes: list[str]
    intercepts: list[float]
    weights: dict[str, list[float]]
    threshold: float


def features(line: Column) -> Column:
    """The distinct words and word pairs of a line."""
    return _features(_words(line))


def _words(line: Column) -> Column:
    return F.regexp_extract_all(F.lower(line), F.lit(r"([a-z0-9]+)"), 1)


def _features(words: Column) -> Column:
    pairs = F.zip_with(words, F.slice(words, F.lit(2), F.size(words)), lambda a, b: F.concat(a, F.lit(" "), b))
    return F.array_distinct(F.concat(words, F.filter(pairs, lambda p: p.isNotNull())))


def lines(text: Column) -> Column:
    return F.filter(F.split(text, r"[\r\n]+"), lambda line: F.trim(line) != "")


def _templates(spark: SparkSession) -> DataFrame:
    rows = [F.struct(F.lit(f).alias("family"), F.lit(t).alias("line")) for f, texts in TEMPLATES.items() for t in texts]
    return spark.range(1).select(F.inline(F.array(*rows)))


def _likeness(found: Column, families: list[str]) -> Column:
    """The largest share of a template of ``families`` that a line with these features has."""
    shares = []
    for family in families:
        for text in TEMPLATES[family]:
            own = sorted(" ".join(g) for g in _grams(text))
            shares.append(F.size(F.array_intersect(F.array(*map(F.lit, own)), found)) / F.lit(len(own)))
    return F.greatest(*shares) if len(shares) > 1 else shares[0]


def _grams(template: str) -> set[tuple[str, ...]]:
    words = re.findall("[a-z0-9]+", template.lower())
    return {(w,) for w in words} | set(zip(words, words[1:]))


def anchors() -> list[str]:
    """Words of which every line with CONFIRM of a template has at least one: of each template, the longest ones, as
    many as it takes for the rest of its words and pairs to be too few."""
    chosen = set()
    for text in (t for texts in TEMPLATES.values() for t in texts):
        grams = _grams(text)
        left = set(grams)
        for word in sorted({w for g in grams for w in g}, key=lambda w: (-len(w), w)):
            if len(left) < CONFIRM * len(grams):
                break
            chosen.add(word)
            left = {g for g in left if word not in g}
    return sorted(chosen)


def _anchored(grams: set[str]) -> list[str]:
    """Those of ``grams`` that are a word with an anchor in it: a line without any is like no template."""
    return sorted(g for g in grams if " " not in g and any(a in g for a in anchors()))


def _known(text: Column, grams: set[str]) -> Column:
    """Those of ``grams`` that are words or word pairs, for every line of a text."""
    inner = sorted({w for g in grams for w in g.split(" ")})
    marked = F.transform(lines(text), lambda line: F.transform(_words(line), lambda w: F.when(w.isin(inner), w)))

    def found(words: Column) -> Column:
        pairs = F.zip_with(words, F.slice(words, F.lit(2), F.size(words)), lambda a, b: F.concat(a, F.lit(" "), b))
        return F.sort_array(F.array_distinct(F.filter(F.concat(words, pairs), lambda g: g.isin(sorted(grams)))))

    return F.transform(marked, found)


def _line_counts(docs: DataFrame, grams: set[str]) -> DataFrame:
    """(grams, weight): the lines of all distinct texts by those of ``grams`` they have, and their number.

    Texts are told apart by 128 bits of hashes beside what is known of their lines, so no whole text is shuffled.
    """
    text = F.col("text").cast("string")
    known = F.transform(_known(text, grams), lambda line: F.array_join(line, ","))
    texts = docs.where(text.isNotNull()).select(F.xxhash64(text), F.xxhash64(F.lit(1), text), known.alias("lines")).distinct()
    counts = texts.select(F.explode("lines").alias("line")).groupBy("line").agg(F.count(F.lit(1)).cast("double").alias("weight"))
    return counts.select(F.filter(F.split("line", ","), lambda g: g != "").alias("grams"), "weight")


def _exceeded(scored: DataFrame, share: float) -> float:
    """The largest p of ``scored`` (p, weight) that rows of more than ``share`` in weight have or exceed, LEAST_PROBABILITY at
    least. Each round adds the weights of STEPS ranges up and goes on within one of them."""
    least, most, left = LEAST_PROBABILITY, 1.0, share
    while True:
        step = F.floor((F.col("p") - least) / (most - least) * STEPS)
        within = scored.where((F.col("p") >= least) & (F.col("p") <= most)).groupBy(step.alias("step"))
        ranges = within.agg(F.sum("weight").alias("weight"), F.min("p").alias("least"), F.max("p").alias("most"))
        for row in sorted(ranges.collect(), key=lambda r: -r["step"]):  # STEPS + 1 rows at most
            if left < row["weight"]:
                break
            left -= row["weight"]
        else:
            return LEAST_PROBABILITY
        if row["least"] == row["most"]:
            return float(row["least"])
        least, most = row["least"], row["most"]


def train(docs: DataFrame) -> Model:
    """Fit to the templates and to the lines of all documents; the weights come to the driver, VOCABULARY times classes at
    most."""
    spark = docs.sparkSession
    classes = [*sorted(TEMPLATES), UNKNOWN]
    words = F.filter(F.split("line", " "), lambda w: F.pmod(F.xxhash64(w, F.col("variant")), F.lit(6)) != 0)
    variants = _templates(spark).withColumn("variant", F.explode(F.sequence(F.lit(0), F.lit(VARIANTS))))
    whole = F.when(F.col("variant") == 0, F.col("line")).otherwise(F.array_join(words, " "))
    number = F.array_position(F.array(*map(F.lit, classes)), F.col("family")) - 1
    positive = variants.select(number.cast("double").alias("label"), features(whole).alias("grams"))
    counter = CountVectorizer(inputCol="grams", outputCol="features", vocabSize=VOCABULARY, binary=True).fit(positive)
    own = {" ".join(g) for ts in TEMPLATES.values() for t in ts for g in _grams(t)}
    others = _line_counts(docs, own.union(counter.vocabulary))
    like = F.exists("grams", lambda g: g.isin(_anchored(own))) & (_likeness(F.col("grams"), sorted(TEMPLATES)) >= CONFIRM)
    others = written(others.where(~like), "licence-lines")
    tasks = 1 + others.count() // TASK_LINES
    none = spark.range(1).select(F.array().cast("array<string>").alias("grams"), F.lit(1.0).alias("weight"))
    others = others.unionByName(none).withColumn("label", F.lit(len(classes) - 1.0))
    data = positive.withColumn("weight", F.lit(1.0)).unionByName(others)
    data = counter.transform(data).repartition(tasks).cache()
    other = F.col("label") == len(classes) - 1.0
    notices, rest = data.agg(F.sum(F.when(~other, F.col("weight"))), F.sum(F.when(other, F.col("weight")))).first()
    scale = F.when(other, UNKNOWN_SHARE * notices / rest).otherwise(1.0)
    balanced = data.withColumn("weight", F.col("weight") * scale)
    fitted = LogisticRegression(
        weightCol="weight", family="multinomial", elasticNetParam=1.0, regParam=PENALTY, maxIter=100,
        standardization=False,
    ).fit(balanced)
    table = fitted.coefficientMatrix.toArray()
    weights = {g: [float(v) for v in table[:, i]] for i, g in enumerate(counter.vocabulary) if abs(table[:, i]).max() > 0}
    model = Model(classes, [float(v) for v in fitted.interceptVector], weights, LEAST_PROBABILITY)
    family = lambda p: F.array_max(F.slice(p, 1, len(classes) - 1))
    # The scan's own figures decide; the many lines that are surely below are passed over.
    alarm = fitted.transform(data.where(other)).where(family(vector_to_array("probability")) > LEAST_PROBABILITY - 0.01)
    alarm = written(alarm.select("weight", "grams"), "licence-alarms")
    alarm = alarm.select("weight", family(_probabilities(F.col("grams"), model)).alias("p"))
    threshold = _exceeded(alarm, FALSE_ALARMS * rest)
    data.unpersist()
    return Model(model.classes, model.intercepts, model.weights, threshold)


def _probabilities(grams: Column, model: Model) -> Column:
    """One probability per class of a line with these features."""
    known = F.create_map(*[x for g, w in model.weights.items() for x in (F.lit(g), F.array(*map(F.lit, w)))])
    zero = F.array(*map(F.lit, model.intercepts))
    logits = F.aggregate(
        F.filter(F.transform(grams, lambda g: F.element_at(known, g)), lambda w: w.isNotNull()),
        zero,
        lambda a, w: F.zip_with(a, w, lambda x, y: x + y),
    )
    powers = F.transform(logits, lambda x: F.exp(F.least(x, F.lit(500.0))))
    total = F.aggregate(powers, F.lit(0.0), lambda a, x: a + x)
    return F.transform(powers, lambda x: x / total)


def _lengthy() -> int:
    """Words of the longest template."""
    return max(len(re.findall("[a-z0-9]+", t.lower())) for ts in TEMPLATES.values() for t in ts)


def _judged(grams: Column, model: Model) -> Column:
    """(family, probability, share) of every family that stands in a window with these features."""
    named = F.array(*map(F.lit, model.classes))
    every = [
        F.struct(F.lit(f).alias("family"), F.array(*[F.lit(" ".join(g)) for g in sorted(_grams(t))]).alias("own"))
        for f, ts in sorted(TEMPLATES.items())
        for t in ts
    ]

    def held(own: Column) -> Column:
        return F.size(F.array_intersect(own, grams)) / F.size(own)

    close = F.filter(F.array(*every), lambda t: held(t["own"]) >= CONFIRM)

    def against(t: Column, close: Column) -> Column:
        rivals = F.filter(close, lambda o: o["family"] != t["family"])
        others = F.flatten(F.transform(rivals, lambda o: o["own"]))
        rest = F.array_except(grams, F.array_except(others, t["own"]))
        chance = F.element_at(_probabilities(rest, model), F.array_position(named, t["family"]).cast("int"))
        # What tells the template from a rival must be there too.
        told = F.forall(rivals, lambda o: held(F.array_except(t["own"], o["own"])) >= CONFIRM)
        return F.struct(
            t["family"].alias("family"), F.when(told, chance).otherwise(0.0).alias("probability"),
            held(t["own"]).alias("share"),
        )

    judged = F.flatten(F.transform(F.array(close), lambda c: F.transform(c, lambda t: against(t, c))))
    return F.filter(judged, lambda j: j["probability"] > model.threshold)


def scan(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, n_notices, families, notices) per document; ``notices``: first line (from 0, blank ones not counted),
    last line, family, probability and share of the template of each notice."""
    anchored, longest = anchors(), _lengthy()

    def hopeful(text: Column) -> Column:
        return reduce(lambda a, b: a | b, [F.contains(text, F.lit(w)) for w in anchored])

    def joined(part: Column) -> Column:
        return _features(F.flatten(F.transform(part, lambda q: q["words"])))

    def window(p: Column, i: Column, every: Column) -> Column:
        """The line and those after it in which a template that begins in it can end."""
        after = F.filter(
            F.slice(every, i + 1, F.lit(longest)),
            lambda q, m: (q["paragraph"] == p["paragraph"]) & (q["number"] == p["number"] + m),
        )
        start = F.struct((-F.size(p["words"])).alias("n"), F.slice(after, 1, 0).alias("part"))
        more = lambda a, q: F.when(
            a["n"] < longest - 1,
            F.struct((a["n"] + F.size(q["words"])).alias("n"), F.concat(a["part"], F.array(q)).alias("part")),
        ).otherwise(a)
        return F.aggregate(after, start, more, lambda a: a["part"])

    def confirmed(grams: Column) -> Column:
        return _likeness(grams, sorted(TEMPLATES)) >= CONFIRM

    def prefixes(part: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(1), F.size(part)),
            lambda n: F.struct(
                part[0]["line"].alias("line"), F.element_at(part, n)["line"].alias("end"),
                joined(F.slice(part, F.lit(1), n)).alias("grams"),
            ),
        )

    def reports(t: Column) -> Column:
        return F.transform(
            _judged(t["grams"], model),
            lambda j: F.struct(
                t["end"].alias("end"), (-t["line"]).alias("back"), (-j["share"]).alias("unlike"),
                j["family"].alias("family"), j["probability"].alias("probability"),
            ),
        )

    def apart(kept: Column, r: Column) -> Column:
        taken = F.exists(kept, lambda k: (k["family"] == r["family"]) & (k["end"] >= -r["back"]))
        return F.when(taken, kept).otherwise(F.concat(kept, F.array(r)))

    found = docs.select(F.col("doc_id").cast("long"), F.lower(F.col("text").cast("string")).alias("text"))
    found = found.select("doc_id", F.when(hopeful(F.col("text")), F.col("text")).alias("text"))
    numbered = F.transform(F.split("text", "\r\n|\r|\n"), lambda x, i: F.struct(i.alias("at"), x.alias("text")))
    found = found.select("doc_id", F.filter(numbered, lambda p: F.trim(p["text"]) != "").alias("lines"))
    # Blank lines leave a gap in ``at``, so ``at`` less the number of the line tells paragraphs apart.
    marked = F.transform(
        "lines", lambda p, n: F.struct(n.alias("line"), (p["at"] - n).alias("paragraph"), p["text"].alias("text"))
    )
    found = found.select("doc_id", F.filter(marked, lambda p: F.rlike(p["text"], F.lit("[a-z0-9]"))).alias("lines"))
    hopes = F.transform("lines", lambda p: hopeful(p["text"]))
    found = found.select("doc_id", "lines", hopes.alias("hopes"))
    numbered = F.transform(
        "lines",
        lambda p, i: F.struct(
            p["line"].alias("line"), p["paragraph"].alias("paragraph"), i.alias("number"),
            F.element_at("hopes", i + 1).alias("hope"), p["text"].alias("text"),
        ),
    )
    near = F.filter(
        numbered,
        lambda p, i: F.exists(F.slice("hopes", F.greatest(i + 2 - longest, F.lit(1)), F.lit(2 * longest - 1)), lambda h: h),
    )
    found = found.select("doc_id", near.alias("lines"))
    worded = F.transform(
        "lines",
        lambda p: F.struct(
            p["line"].alias("line"), p["paragraph"].alias("paragraph"), p["number"].alias("number"),
            p["hope"].alias("hope"), _words(p["text"]).alias("words"),
        ),
    )
    found = found.select("doc_id", worded.alias("lines"))
    found = found.select("doc_id", F.transform("lines", lambda p, i: window(p, i, F.col("lines"))).alias("parts"))
    found = found.select("doc_id", F.filter("parts", lambda w: F.exists(w, lambda q: q["hope"])).alias("parts"))
    # What the whole window lacks, its beginnings lack too.
    found = found.select("doc_id", F.filter("parts", lambda w: confirmed(joined(w))).alias("parts"))
    found = found.select("doc_id", F.flatten(F.transform("parts", prefixes)).alias("tries"))
    found = found.select("doc_id", F.flatten(F.transform("tries", reports)).alias("reports"))
    # A notice is the shortest run of lines; those of a family do not overlap, the one that ends first stands.
    ordered = F.array_sort("reports")
    found = found.select("doc_id", F.aggregate(ordered, F.slice("reports", 1, 0), apart).alias("kept"))
    notices = F.transform(
        "kept",
        lambda r: F.struct(
            (-r["back"]).alias("line"), r["end"].alias("end"), r["family"].alias("family"),
            r["probability"].alias("probability"), (-r["unlike"]).alias("share"),
        ),
    )
    none = F.array().cast("array<struct<line:int,end:int,family:string,probability:double,share:double>>")
    return found.select("doc_id", F.coalesce(F.array_sort(notices), none).alias("notices")).select(
        "doc_id",
        F.size("notices").cast("long").alias("n_notices"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("notices", lambda p: p["family"]))), ",").alias("families"),
        "notices",
    )
