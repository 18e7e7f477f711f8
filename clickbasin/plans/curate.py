"""The daily raw-to-curated job."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickbasin.functions.dates import IngestDay, fixed_clock
from clickbasin.operators.dedup import latest_per_event
from clickbasin.operators.validate import accepted, rejected, with_verdict
from clickbasin.plans.paths import LakePaths
from clickbasin.schemas import (
    CORRUPT_COLUMN,
    DATE_KEYS,
    LINEAGE,
    LINEAGE_FIELDS,
    PARTITION_FIELDS,
    PARTITION_KEYS,
    RAW_DATA,
    REASON_COLUMN,
)
from clickbasin.session import pin
from clickbasin.sources import versions
from clickbasin.sources.curated import read_curated_day
from clickbasin.sources.raw import read_raw_day
from clickbasin.sources.storage import exists, replace_day


@dataclass(frozen=True)
class CurateOutcome:
    """Rows of one run. ``curated_rows`` is counted after de-duplication."""

    raw_rows: int
    curated_rows: int
    quarantined_rows: int


def to_curated(raw: DataFrame, processed_at: Column) -> DataFrame:
    """Validate, flatten and de-duplicate raw rows, each ingest day by itself."""
    return latest_per_event(accepted(with_verdict(raw), processed_at), within=DATE_KEYS)


def quarantine_reason_counts(raw: DataFrame) -> DataFrame:
    return (
        with_verdict(raw)
        .where(F.col(REASON_COLUMN).isNotNull())
        .groupBy(F.col(REASON_COLUMN).alias("reject_reason"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .orderBy("reject_reason")
    )


def row_counts(raw: DataFrame) -> DataFrame:
    """``valid_rows`` after de-duplication and ``quarantined_rows``, in one pass."""
    good = F.col(REASON_COLUMN).isNull()
    return with_verdict(raw).agg(
        F.countDistinct(F.when(good, F.struct(*DATE_KEYS, "event_id"))).alias("valid_rows"),
        F.count_if(~good).alias("quarantined_rows"),
    )


def write_curated(curated: DataFrame, path: str, *, size_files: bool = True) -> None:
    """Replace the partitions ``curated`` produces.

    ``size_files`` rebalances by event type: files come out at the advisory
    partition size, a type that outgrows it is split over several tasks, and a
    rare type does not leave a file per task. It costs a shuffle of the rows.
    Ordering by event time within the order the writer needs anyway gives the
    row groups narrow time ranges.
    """
    rows = curated.hint("rebalance", "event_type") if size_files else curated
    (
        rows.sortWithinPartitions(*PARTITION_KEYS, "event_ts")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy(*PARTITION_KEYS)
        .parquet(path)
    )


def write_quarantine(rows: DataFrame, path: str) -> None:
    """Replace the partitions ``rows`` produces. A few rows of every task make a few files."""
    (
        rows.hint("rebalance", "event_type")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*PARTITION_KEYS)
        .json(path)
    )


def read_quarantine(spark: SparkSession, root: str) -> DataFrame | None:
    """The rejected rows with their reasons, or ``None`` before the first of them."""
    if not exists(spark, root):
        return None
    more = [T.StructField(name, T.StringType()) for name in (CORRUPT_COLUMN, REASON_COLUMN)]
    schema = T.StructType([*RAW_DATA.fields, *more, *LINEAGE_FIELDS, *PARTITION_FIELDS])
    if versions.is_versioned(spark, root):
        return versions.read_versions(spark, root, schema, versions.live_versions(spark, root), "json")
    return spark.read.schema(schema).json(root)


def curate_day(
    spark: SparkSession,
    lake: LakePaths,
    day: IngestDay,
    *,
    processed_at: datetime | str | None = None,
    any_case: bool = True,
    parquet: bool | None = None,
    raw: DataFrame | None = None,
    keep_decoded: bool = True,
    size_files: bool = True,
    files: DataFrame | None = None,
) -> CurateOutcome:
    """Recompute one ingest day from raw; running it again changes nothing.

    A day without raw rows writes nothing. A day that ends up without valid rows has no
    curated partitions afterwards. ``raw`` takes the place of the raw files, for instance
    a catalogued table; only the day's rows of it count. ``parquet`` is as in ``read_raw_day``. The decoded day is kept on the executors between the count
    and the two writes, because decompressing and parsing JSON is the dear part;
    ``keep_decoded=False`` reads it again instead, for a backfill larger than
    the executors' disks. Lost blocks are recomputed from the raw files.
    ``size_files`` is explained at ``write_curated``. With ``files`` (``path``, ``batch``; see
    ``streaming.incremental.seen_files``) curated and quarantined rows keep the raw file they came from and the
    batch that saw it first, for ``read_lineage``; of equal rows the one of the earliest batch stays.
    """
    pin(spark)
    if raw is None:
        raw = read_raw_day(spark, lake.raw, day, any_case=any_case, parquet=parquet, with_file=files is not None)
    if raw is None:
        return CurateOutcome(0, 0, 0)
    raw = raw.where(day.condition())
    keep = []
    if files is not None:
        # Few rows: Spark sends them to all tasks while they are.
        raw = raw.join(files.select(F.col("path").alias("source_file"), "batch"), "source_file", "left")
        keep = LINEAGE
    stamp = fixed_clock(processed_at)
    judged = with_verdict(raw)
    if keep_decoded:
        judged = judged.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        # At most one row per reject reason and one for the good rows.
        tally = {row[REASON_COLUMN]: row["count"] for row in judged.groupBy(REASON_COLUMN).count().collect()}
        valid = tally.pop(None, 0)
        quarantined = sum(tally.values())
        if valid + quarantined == 0:
            return CurateOutcome(0, 0, 0)

        def quarantine(path: str) -> None:
            if quarantined:
                write_quarantine(rejected(judged), path)

        replace_day(spark, lake.quarantine, day, quarantine)
        if valid == 0:
            # What an earlier run wrote goes, so that the outcome and the table agree.
            replace_day(spark, lake.curated, day, lambda path: None)
            return CurateOutcome(quarantined, 0, quarantined)
        curated = latest_per_event(accepted(judged, stamp, keep), then=keep[::-1])
        replace_day(
            spark, lake.curated, day, lambda path: write_curated(curated, path, size_files=size_files)
        )
    finally:
        if keep_decoded:
            judged.unpersist()
    # Counted from the files, so a task that ran twice is not counted twice.
    return CurateOutcome(
        valid + quarantined, read_curated_day(spark, lake.curated, day).count(), quarantined
    )
