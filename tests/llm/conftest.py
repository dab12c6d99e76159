import pytest
from pyspark.sql import functions as F

LONG = "lorem ipsum dolor sit amet " * 30_000
CLASHING = ("id", "part", "rank", "row", "k1", "bands", "class_no", "score", "predicted", "text_key", "n", "y", "spans",
            "held_out", "length", "place", "segments")
ROWS = [
    (None, None, None, None),
    (None, "no id here", "en", "s"),
    (1, "", "en", None),
    (2, "...!?", "en", "s"),
    (3, "...!?", None, "s"),
    (4, "one two", "fr", "s"),
    (5, "One, two", "fr", "s"),
    (6, LONG, "en", "s"),
    (7, LONG + "end", "en", "s"),
    (8, "Ünïcödé 漢字 😀 " * 50, "de", "s"),
    (9, "same words in the same order here", "en", "s"),
    (9, "same words in the same order here", "en", "s"),
    (10, "a" * 50_000, "en", "s"),
    (11, "\x00\x01 nul <|endoftext|> <|im_end|>", "en", "s"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls, empty, long and repeated texts, and columns named like those of the operators."""
    docs = spark.createDataFrame([(*r, None if r[1] is None else len(r[1])) for r in ROWS],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    return docs.withColumns({c: F.lit(c) for c in CLASHING})


@pytest.fixture(scope="session")
def labels(spark):
    rows = [(i, i % 2, (i + 1) % 2) for i in range(12)] + [(None, 1, 1), (4, None, None), (99, 0, 0), (5, 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int").withColumn("text", F.lit("clash"))


@pytest.fixture(scope="session")
def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").orderBy("doc_id").collect()]
