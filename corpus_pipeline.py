"""A training corpus from ``documents``: good, distinct, uncontaminated, free of secrets, packed into sequences.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each as Parquet in the shared folder and
reads it again for the next. All but the last return the columns of ``documents``. Rows are told apart by their
content, not by ``doc_id``: null and repeated ids and extra columns pass through every stage, also columns named as
the operators name theirs. Null texts are judged as the operators say and stay unless rejected. Empty tables give
empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casemill.llm import quality, secrets
from casemill.llm.common import stored, table
from casemill.llm.decontaminate import decontaminate
from casemill.llm.minhash import near_duplicates
from casemill.llm.packing import pack

ROW, KEPT, SCORE = "__row", "__kept", "__score"  # names no table is expected to have


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the quality trees reject; learned from the labelled documents of the corpus."""
    trees = quality.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    scored = docs.withColumn(SCORE, quality.scorer(trees)(F.col("text").cast("string")))
    return scored.where(F.col(SCORE) >= quality.THRESHOLD).select(*docs.columns)


def keep_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the first row of every group of exact and near copies."""
    rows = stored(docs.withColumn(ROW, F.monotonically_increasing_id()), "rows")
    kept = near_duplicates(rows.select(ROW, "text"), id_col=ROW).where("kept").select(ROW)
    return rows.join(kept, ROW, "left_semi").select(*docs.columns)


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents of which the benchmark holds a considerable part."""
    judged = decontaminate(docs, table(spark, sf_dir, "benchmark"))
    # Contamination depends on the text alone, so equal ids with equal texts are judged alike.
    bad = judged.where("contaminated").select(F.col("doc_id").alias(ROW), F.col("text_key").alias(KEPT)).distinct()
    same = docs["doc_id"].cast("long").eqNullSafe(bad[ROW]) & (F.xxhash64(docs["text"].cast("string")) == bad[KEPT])
    return docs.join(bad, same, "left_anti")


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace the secrets in every text by a mark; ``n_chars`` follows the new text."""
    clean = secrets.redact(docs, secrets.train(docs))
    if "n_chars" in docs.columns:
        changed = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        clean = clean.withColumn("n_chars", F.coalesce(changed, F.col("n_chars")))
    return clean.select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all documents in sequences of tokens."""
    return pack(docs)


STAGES = [
    ("quality classifier", keep_good),
    ("MinHash near-dedup", keep_distinct),
    ("benchmark decontamination", keep_uncontaminated),
    ("secret scans", hide_secrets),
    ("best-fit packing", pack_sequences),
]
ORACLE_SQL = None  # trained models, signatures and a tokenizer; tested against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
