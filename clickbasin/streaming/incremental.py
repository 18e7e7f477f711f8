"""Curate only what is new: a bookmark over the raw files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from clickbasin.functions.dates import IngestDay
from clickbasin.operators.scan_budget import PARTITIONED_FILES
from clickbasin.plans.paths import LakePaths
from clickbasin.schemas import DATE_KEYS, PARTITION_FIELDS
from clickbasin.streaming.landing import NO_AGE_LIMIT


_SEEN = T.StructType([T.StructField("path", T.StringType()), T.StructField("batch", T.LongType()), *PARTITION_FIELDS[1:]])


def new_files(spark: SparkSession, raw_root: str) -> DataFrame:
    """A stream with one row per raw file not seen before. No file is opened."""
    return (
        spark.readStream.format("binaryFile")
        .schema(PARTITIONED_FILES)
        .option("maxFileAge", NO_AGE_LIMIT)
        .load(raw_root)
        .select("path", *DATE_KEYS)
    )


def seen_files(spark: SparkSession, lake: LakePaths, day: IngestDay) -> DataFrame:
    """``path, batch`` of a day's raw files that incremental runs have seen, with the first batch that did."""
    files = spark.read.schema(_SEEN).parquet(lake.raw_files).where(day.condition())
    return files.groupBy("path").agg(F.min("batch").alias("batch"))


def announced_days(spark: SparkSession, lake: LakePaths) -> DataFrame:
    """A stream with a row per day and landing batch not seen before: one small file per batch is listed."""
    days = spark.readStream.schema(T.StructType(PARTITION_FIELDS[1:]))
    return days.option("maxFileAge", NO_AGE_LIMIT).json(lake.landed_days)


def curate_new_days(
    spark: SparkSession,
    lake: LakePaths,
    checkpoint: str,
    curate: Callable[[IngestDay], object],
    *,
    announced: bool = False,
    note_files: bool = False,
) -> StreamingQuery:
    """Call ``curate`` for every ingest day that received files since the last run.

    The checkpoint remembers the files already seen. By default those are the raw files, all of
    which are listed on every run; with ``announced`` they are the announcements that the landing
    writes, so that a run costs the same however old the lake is. A checkpoint belongs to one of
    the two. A day with new files is
    recomputed as a whole, so its de-duplication also covers the files of
    earlier runs and a repeated batch changes nothing.

    ``note_files`` writes down which files each batch found before their days are curated, for ``seen_files``;
    a repeated batch writes the same again. Announcements name no files, so the two exclude each other.
    """
    if announced and note_files:
        raise ValueError("announcements name days, not files")

    def run(batch: DataFrame, batch_id: int) -> None:
        if note_files:
            # A folder a batch, so that a repeated one replaces what it wrote. Written from what the
            # checkpoint says, not from a new listing.
            noted = batch.select("path", *DATE_KEYS)
            noted.write.mode("overwrite").partitionBy(*DATE_KEYS).parquet(f"{lake.raw_files}/batch={batch_id}")
        # As many rows as there are days with news.
        for row in batch.select(*DATE_KEYS).distinct().orderBy(*DATE_KEYS).collect():
            curate(IngestDay(*row))

    return (
        (announced_days(spark, lake) if announced else new_files(spark, lake.raw))
        .writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
