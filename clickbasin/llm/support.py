"""What several operators need: written tables, labelled samples, per-worker objects."""

from __future__ import annotations

import sys
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickbasin.session import scratch_path

# Rows handed to Python at a time. Documents may be very long, so batches are small.
BATCH_ROWS = 1000


def prepared(spark: SparkSession) -> SparkSession:
    """Bound the batches that go to Python workers."""
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") != str(BATCH_ROWS):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def stored(frame: DataFrame, label: str) -> DataFrame:
    """Write ``frame`` to the shared folder and read it back: cuts lineage, computes once.

    The folder is the one named in ``spark.checkpoint.dir``; a lost executor loses nothing of it.
    """
    spark = frame.sparkSession
    path = scratch_path(spark, label)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def fold(doc_id: Column, folds: int) -> Column:
    """The fold of a row: crc32 of its id as text, modulo the number of folds."""
    return F.crc32(doc_id.cast("string")) % folds


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, most: int
) -> DataFrame:
    """(doc_id, text, label) of at most ``most`` labelled documents outside the held-out fold.

    Which ones is settled by a hash of the id, alike on every run. An id with several labels
    counts with the largest, an id with several documents with the smallest text, a null text being
    empty. Labels without a document and documents without an id take no part.
    """
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
        .where(fold(F.col("doc_id"), folds) != held_out)
        .groupBy("doc_id")
        .agg(F.max(label).cast("int").alias("label"))
    )
    there = known.join(docs.select("doc_id"), "doc_id", "left_semi")
    chosen = there.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    # At most ``most`` rows of an id and a label: safe to send to every executor.
    return (
        docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
        .join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id")
        .agg(F.min("text").alias("text"), F.first("label").alias("label"))
    )


def per_worker(key: object, make: Callable[[], object]) -> object:
    """``make()`` once for each Python worker: workers outlive tasks, shipped functions do not."""
    held = sys.__dict__.setdefault("_clickbasin_llm", {})
    if key not in held:
        held[key] = make()
    return held[key]


def free_name(name: str, taken: list[str]) -> str:
    """``name``, or a longer one, that no column is called, in any case."""
    lower = {column.lower() for column in taken}
    while name.lower() in lower:
        name += "_"
    return name
