"""Helpers shared by the corpus operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from casemill.session import shared_folder

PART_BYTES = 4 << 20  # text that a task works on at a time


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` as a table in the shared folder and go on from there.

    Unlike a checkpoint it stays columnar, so later steps read only the columns they need, and its rows are
    fixed: a lost executor cannot change what a partly run step has already seen.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def numbered(rows: DataFrame, order: list[Column]) -> tuple[DataFrame, int]:
    """``rows`` with their ``number``, 0 to n-1 in ``order``, and n.

    Rows are range-partitioned by ``order`` and, where that ties, by where they were read, sorted and written with
    their place; a count per partition gives the numbers. No partition has to hold all rows that tie.
    """
    place, part, before = "__place", "__part", "__before"
    ranged = rows.withColumn(place, F.monotonically_increasing_id()).repartitionByRange(*order, F.col(place))
    table = stored(ranged.sortWithinPartitions(*order).withColumn(place, F.monotonically_increasing_id()), "numbered")
    table = table.withColumn(part, F.shiftright(place, 33))
    counts = table.groupBy(part).agg(F.count(F.lit(1)).alias("n"))
    offsets = counts.withColumn(
        before, F.sum("n").over(Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1))
    ).select(part, F.coalesce(before, F.lit(0)).alias(before), "n")  # a row per partition
    offsets = stored(offsets, "offsets")
    n = offsets.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    number = F.col(before) + F.col(place).bitwiseAND(F.lit((1 << 33) - 1))
    table = table.join(F.broadcast(offsets.drop("n")), part)
    return table.withColumn("number", number).drop(place, part, before), n


def held_out(doc_id: str = "doc_id", folds: int = 5) -> Column:
    """Rows that no model may learn from: crc32 of the id as text divisible by the number of folds."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(folds)) == 0, F.lit(False))


def by_bytes(batches: Iterator[pa.RecordBatch], column: str, most: int = PART_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into parts whose texts have about ``most`` bytes; a longer text is a part of its own."""
    for batch in batches:
        text = batch.column(batch.schema.get_field_index(column))
        ends = byte_offsets(text)
        start = 0
        while start < len(batch):
            stop = start + 1
            while stop < len(batch) and ends[stop + 1] - ends[start] <= most:
                stop += 1
            yield batch.slice(start, stop - start)
            start = stop
        pa.default_memory_pool().release_unused()  # workers live on, with what their largest batch took


def byte_offsets(text: pa.Array):
    """Where each text begins in its UTF-8 buffer, and where the last one ends."""
    import numpy as np

    kind = np.int64 if pa.types.is_large_string(text.type) or pa.types.is_large_binary(text.type) else np.int32
    return np.frombuffer(text.buffers()[1], kind, text.offset + len(text) + 1)[text.offset :].astype(np.int64)


def utf8(text: pa.Array):
    """The UTF-8 bytes of a text column, without gaps, and where each text begins in them (nulls are empty)."""
    import numpy as np

    if len(text) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if text.null_count:
        text = text.fill_null("")
    ends = byte_offsets(text)
    data = text.buffers()[2]
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return data[ends[0] : ends[-1]], ends - ends[0]
