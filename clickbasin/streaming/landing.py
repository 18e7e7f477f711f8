"""Streaming ingest: JSON lines in, partitioned raw files and an error route out."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from clickbasin.functions.dates import IngestDay, day_columns
from clickbasin.functions.json_lines import decode, is_blank
from clickbasin.plans.paths import LakePaths
from clickbasin.schemas import CORRUPT_COLUMN, DATE_KEYS, PARTITION_FIELDS, PARTITION_KEYS, RAW, RAW_DATA
from clickbasin.session import pin, small_frame
from clickbasin.sources.raw import decode_lines
from clickbasin.sources.storage import delete, exists, glob, newest_time, waiting_bytes

# Error folder names, and the limits of the delivery buffer.
FAILED = "processing-failed"
NOT_CONVERTED = "format-conversion-failed"
DELIVERED = "delivered"
BUFFER_MIB = (1, 128)
BUFFER_SECONDS = (60, 900)

# What makes a batch due: the query's own trigger, or, for ``land_buffered``, its first look, bytes, or seconds.
TRIGGER, FIRST, SIZE, TIME = "trigger", "first", "size", "time"

_KEY = T.StructType([T.StructField("event_type", T.StringType())])


@dataclass(frozen=True)
class Buffering:
    """Text per landed file at most, and seconds between micro-batches.

    The size is that of one buffer, hence of one task's share: a micro-batch
    fills a buffer on every core, so throughput grows with the cluster.
    """

    mebibytes: int = 64
    seconds: int = 60

    def __post_init__(self) -> None:
        for value, (low, high) in ((self.mebibytes, BUFFER_MIB), (self.seconds, BUFFER_SECONDS)):
            if not low <= value <= high:
                raise ValueError(f"{value} is outside {low}-{high}")

    def batch_bytes(self, buffers: int) -> int:
        return self.mebibytes * 1024 * 1024 * max(buffers, 1)


# Spark's file streams pass over files much older than the newest one they saw. Nothing may be
# passed over here, so the limit lies beyond any backfill.
NO_AGE_LIMIT = "36500d"


def line_stream(
    spark: SparkSession,
    folder: str,
    buffering: Buffering = Buffering(),
    buffers: int | None = None,
    archive: str | None = None,
) -> DataFrame:
    """A folder of JSON-lines files as a stream with a ``value`` column.

    ``buffers`` is how many buffers a micro-batch fills; by default one per core there
    is when the stream starts, so name it where executors come later. ``archive`` is a
    folder landed files are moved to, without which every trigger lists all of them.
    Any other streaming frame with a text ``value`` column (a message queue, for
    instance) can take the place of the folder.
    """
    limit = buffering.batch_bytes(buffers or spark.sparkContext.defaultParallelism)
    reader = spark.readStream.option("maxBytesPerTrigger", str(limit)).option("maxFileAge", NO_AGE_LIMIT)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.text(folder)


def with_route(lines: DataFrame, arrival: Column | None = None) -> DataFrame:
    """Add event_type, result (null when deliverable) and the arrival date.

    The partition date is when a line arrived, whatever its own ``ts`` says. In
    a stream the default clock is the batch's, recorded with its offsets, so a
    batch that is run again gets the same date.
    """
    arrived = arrival if arrival is not None else F.current_timestamp()
    key = F.col("_key.event_type")
    return (
        lines.where(~is_blank(F.col("value")))
        # Generated, so that the filters on the route do not parse the line again.
        .select("value", F.explode(F.array(decode(F.col("value"), _KEY))).alias("_key"))
        .select(
            "value",
            F.nullif(key, F.lit("")).alias("event_type"),
            F.when(
                F.col(f"_key.{CORRUPT_COLUMN}").isNotNull() | key.isNull() | (key == ""), FAILED
            ).alias("result"),
            *[column.alias(name) for name, column in day_columns(arrived).items()],
        )
    )


def with_conversion(routed: DataFrame) -> DataFrame:
    """Add the line's raw columns as ``_raw``, and route away the lines that lose something by it.

    A field of the wrong type, or a number its type cannot hold, is null after decoding.
    Such a line goes to the errors with its text.
    """
    keys = [*routed.columns]
    decoded = decode_lines(routed.withColumn("_line", F.col("value")))
    lossy = F.col("result").isNull() & F.col(CORRUPT_COLUMN).isNotNull()
    return decoded.select(
        F.col("_line").alias("value"),
        *[F.col(name) for name in keys if name not in ("value", "result")],
        F.when(lossy, NOT_CONVERTED).otherwise(F.col("result")).alias("result"),
        F.struct(*RAW_DATA.fieldNames()).alias("_raw"),
    )


def delivered(routed: DataFrame) -> DataFrame:
    return routed.where(F.col("result").isNull()).select("value", *PARTITION_KEYS)


def undeliverable(routed: DataFrame) -> DataFrame:
    return routed.where(F.col("result").isNotNull()).select("value", "result", *DATE_KEYS)


def _gather(rows: DataFrame, key: str) -> DataFrame:
    """Bring rows of one folder together, so that a batch of n tasks writes about n files.

    Left alone, every task would write a file per event type. Ranges are cut from
    a sample; the row number lets them cut through a type that fills many of
    them, even when its lines are copies of each other. A batch of empty files has
    no task at all.
    """
    tasks = rows.rdd.getNumPartitions()
    if tasks <= 1:
        return rows
    numbered = rows.withColumn("_row", F.monotonically_increasing_id())
    return numbered.repartitionByRange(tasks, key, "_row").drop("_row")


def _write_lines(rows: DataFrame, path: str, keys: list[str], prefix: str) -> None:
    """The source text, one record per line, gzip. ``prefix`` starts the file names."""
    (
        _gather(rows, keys[0])
        .write.mode("append")
        .partitionBy(*keys)
        .option("compression", "gzip")
        .option("mapreduce.output.basename", prefix)
        .text(path)
    )


def _write_parquet(rows: DataFrame, path: str, prefix: str) -> None:
    (
        _gather(rows, PARTITION_KEYS[0])
        .select("_raw.*", *PARTITION_KEYS)
        .select(*RAW.fieldNames())
        .write.mode("append")
        .partitionBy(*PARTITION_KEYS)
        .option("compression", "snappy")
        .option("mapreduce.output.basename", prefix)
        .parquet(path)
    )


_BATCH = T.StructType(
    [
        T.StructField("query", T.StringType()),
        T.StructField("batch", T.LongType()),
        T.StructField("cause", T.StringType()),
        T.StructField("route", T.StringType()),
        *PARTITION_FIELDS[1:],
        T.StructField("lines", T.LongType()),
        T.StructField("bytes", T.LongType()),
    ]
)


def _tally(routed: DataFrame) -> list[tuple]:
    """``route, year, month, day, lines, bytes`` of a batch: three routes, and a day or two around midnight."""
    route = F.coalesce("result", F.lit(DELIVERED)).alias("route")
    found = routed.groupBy(route, *DATE_KEYS).agg(F.count(F.lit(1)), F.sum(F.octet_length("value")))
    return [tuple(row) for row in found.collect()]


def _days(tally: list[tuple]) -> list[IngestDay]:
    return sorted({IngestDay(*row[1:4]) for row in tally})


def read_batches(spark: SparkSession, lake: LakePaths) -> DataFrame:
    """``query, batch, cause, route, year, month, day, lines, bytes`` of every landed batch."""
    if not exists(spark, lake.landed_batches):
        return small_frame(spark, [], _BATCH)
    return spark.read.schema(_BATCH).json(lake.landed_batches)


def announce_days(spark: SparkSession, lake: LakePaths, days: list[IngestDay], name: str) -> None:
    """Tell incremental curation that files were added to ``days``; ``name`` starts the file's name.

    The landing stream does this for every batch. Whoever copies raw files into the lake by
    other means calls it afterwards.
    """
    rows = small_frame(spark, [tuple(day) for day in days], T.StructType(PARTITION_FIELDS[1:]))
    rows.coalesce(1).write.mode("append").option("mapreduce.output.basename", name).json(lake.landed_days)


def _remove_attempt(spark: SparkSession, lake: LakePaths, days: list[IngestDay], prefix: str) -> None:
    """Delete files an earlier attempt at this batch left in the days it writes to."""
    for log in (lake.landed_days, lake.landed_batches):
        for leftover in glob(spark, f"{log}/{prefix}-*"):
            delete(spark, leftover)
    for found in days:
        day = found.folder()
        for folder in (f"{lake.raw}/event_type=*", f"{lake.errors}/result=*"):
            for leftover in glob(spark, f"{folder}/{day}/{prefix}-*"):
                delete(spark, leftover)


def batch_writer(lake: LakePaths, *, parquet: bool = False, cause: str = TRIGGER) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that lands a routed batch once, even if run twice.

    What it wrote, and the ``cause`` it is given, goes to ``lake.landed_batches``, a row a route and day.

    A batch is only ever repeated as the first one after a restart, when the
    run before stopped between writing its files and recording it. File names
    carry the query and batch id, so that first batch removes what its earlier
    attempt left behind before it writes.
    """
    started: set[str] = set()

    def land(batch: DataFrame, batch_id: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"
        prefix, spark = f"{query}-{batch_id:012d}", batch.sparkSession
        routed = (with_conversion(batch) if parquet else batch).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            tally = _tally(routed)
            if query not in started:
                _remove_attempt(spark, lake, _days(tally), prefix)
                started.add(query)
            if parquet:
                good = routed.where(F.col("result").isNull()).select("_raw", *PARTITION_KEYS)
                _write_parquet(good, lake.raw, prefix)
            else:
                _write_lines(delivered(routed), lake.raw, PARTITION_KEYS, prefix)
            _write_lines(undeliverable(routed), lake.errors, ["result", *DATE_KEYS], prefix)
            announce_days(spark, lake, _days(tally), prefix)
            rows = small_frame(spark, [(query, batch_id, cause, *row) for row in tally], _BATCH)
            rows.coalesce(1).write.mode("append").option("mapreduce.output.basename", prefix).json(lake.landed_batches)
        finally:
            routed.unpersist()

    return land


def start_landing(
    lines: DataFrame,
    lake: LakePaths,
    checkpoint: str,
    *,
    buffering: Buffering = Buffering(),
    parquet: bool = False,
    drain: bool = False,
    arrival: Column | None = None,
    cause: str = TRIGGER,
) -> StreamingQuery:
    """Run the landing stream. ``drain`` takes what is there and stops.

    ``parquet`` converts to the raw table's columns on the way in; lines that lose
    something by that go to the error route.
    """
    pin(lines.sparkSession)
    writer = (
        with_route(lines, arrival)
        .writeStream.foreachBatch(batch_writer(lake, parquet=parquet, cause=cause))
        .option("checkpointLocation", checkpoint)
    )
    if drain:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{buffering.seconds} seconds").start()


def land_buffered(
    spark: SparkSession,
    folder: str,
    lake: LakePaths,
    checkpoint: str,
    *,
    buffering: Buffering = Buffering(),
    buffers: int | None = None,
    archive: str | None = None,
    parquet: bool = False,
    arrival: Column | None = None,
    poll_seconds: float = 1.0,
    go_on: Callable[[], bool] = lambda: True,
    clock: Callable[[], float] = time.time,
    sleep: Callable[[float], None] = time.sleep,
) -> None:
    """Land a folder's files when its buffers are full or ``buffering.seconds`` after the last flush, whichever is first.

    Triggers of a streaming query know time only. Here the files that came since the last flush are summed up
    between flushes; each flush is a run of the landing stream over what is there, in batches of full buffers
    and one for the rest. Files that come during a flush may be counted again, which at most flushes early.
    Nothing is written while nothing came. ``go_on`` is asked before every look.
    """
    full = buffering.batch_bytes(buffers or spark.sparkContext.defaultParallelism)
    cause, since, flushed = FIRST, 0.0, clock()
    while go_on():
        waiting = waiting_bytes(spark, folder, since)
        if cause != FIRST:
            cause = SIZE if waiting >= full else TIME if clock() - flushed >= buffering.seconds else ""
        if not cause:
            sleep(poll_seconds)
            continue
        flushed = clock()
        # A file may bear the very time of the newest one that was flushed: after the seconds look in any case.
        if waiting or cause == TIME:
            since = newest_time(spark, folder)
            lines = line_stream(spark, folder, buffering, buffers, archive)
            start_landing(lines, lake, checkpoint, parquet=parquet, drain=True, arrival=arrival, cause=cause).awaitTermination()
        cause = ""
